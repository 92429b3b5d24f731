"""Comparison shapes: matrix, complete periods, waterfall, trend and key figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricspark.operators.topk import first_rows


def matrix(df: DataFrame, row: str, col: str, value: str, columns: Sequence) -> DataFrame:
    """Sums by row and column with the row's total; a missing cell stays null."""
    cells = df.groupBy(row).pivot(col, list(columns)).agg(F.sum(value))
    total = df.groupBy(F.col(row).alias("total_key")).agg(F.sum(value).alias("row_total"))
    return cells.join(total, cells[row].eqNullSafe(total["total_key"])).drop("total_key")


def complete_years(df: DataFrame, year: str, month: str) -> DataFrame:
    """``year, n_months, is_complete, recency, is_later_partial``.

    Complete years have as many months as the fullest; recency numbers them from
    the latest.  A partial year after the latest complete one is flagged.
    """
    years = df.groupBy(F.col(year).alias("year")).agg(F.count_distinct(month).alias("n_months"))
    one = Window.partitionBy(F.lit(0))  # one row per year
    years = years.withColumn("is_complete", F.col("n_months") == F.max("n_months").over(one))
    last = F.max(F.when(F.col("is_complete"), F.col("year"))).over(one)
    order = Window.partitionBy("is_complete").orderBy(F.desc("year"))
    return years.withColumn("recency", F.when(F.col("is_complete"), F.row_number().over(order))).withColumn(
        "is_later_partial", ~F.col("is_complete") & (F.col("year") > last)
    )


def waterfall(df: DataFrame, category: str, value: str, year: str, month: str, fold_above: int = 7) -> DataFrame:
    """``step, label, delta, base, level``: prior total, changes by size, tail folded, latest total.

    The two most recent complete years are compared; every category of either
    counts.  ``level`` is the running total after the step, so the last change
    reaches the latest total exactly.
    """
    # facts are summed once by year, month and category; what follows works on the sums
    cells = df.groupBy(F.col(year).alias("year_"), F.col(month).alias("month_"), F.col(category).alias(category)).agg(F.sum(value).alias("sum_"))
    years = complete_years(cells, "year_", "month_").filter("recency <= 2").agg(F.max("year").alias("y1"), F.min("year").alias("y0"))
    rows = cells.join(F.broadcast(years), F.lit(True), "left")  # one row
    side = lambda y: F.coalesce(F.sum(F.when(F.col("year_") == F.col(y), F.col("sum_"))), F.lit(0))
    sums = rows.groupBy(F.col(category).cast("string").alias("label")).agg(side("y0").alias("v0"), side("y1").alias("v1"))
    sums = sums.withColumn("delta", F.col("v1") - F.col("v0"))
    head = first_rows(sums, fold_above, [F.desc(F.abs("delta")), F.col("label")]).select(F.col("label").alias("head_label"), "rn")
    size = sums.agg(F.count("*").alias("n"))
    sums = sums.join(F.broadcast(head), F.col("label").eqNullSafe(F.col("head_label")), "left").join(F.broadcast(size), F.lit(True))  # fold_above rows and one
    tail = (F.col("n") > fold_above) & (F.col("rn").isNull() | (F.col("rn") >= fold_above))
    other = F.concat(F.lit("Other ("), (F.col("n") - (fold_above - 1)).cast("string"), F.lit(")"))
    steps = (
        sums.withColumn("step", F.when(tail, F.lit(fold_above)).otherwise(F.col("rn")))
        .withColumn("label", F.when(tail, other).otherwise(F.col("label")))
        .groupBy("step", "label")
        .agg(F.sum("delta").alias("delta"))
    )
    ends = sums.agg(F.sum("v0").alias("t0"), F.sum("v1").alias("t1"), F.count("*").alias("n"))
    first = ends.select(F.lit(0).alias("step"), F.lit("(prior)").alias("label"), F.col("t0").alias("delta"))
    walk = first.unionByName(steps.select(F.col("step").cast("int"), "label", "delta"))
    one = Window.partitionBy(F.lit(0))  # fold_above + 1 steps
    walk = walk.withColumn("level", F.sum("delta").over(one.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)))
    walk = walk.withColumn("base", F.when(F.col("step") == 0, F.col("delta") * 0).otherwise(F.col("level") - F.col("delta")))
    last = ends.select(
        F.lit(9999).alias("step"), F.lit("(latest)").alias("label"), F.col("t1").alias("delta"), F.col("t1").alias("level"), (F.col("t1") * 0).alias("base")
    )
    return walk.unionByName(last)


def trend(df: DataFrame, x: str, value: str, series: str | None = None) -> DataFrame:
    """One row per x and series, duplicates summed, in x order."""
    keys = [x] if series is None else [x, series]
    return df.groupBy(*keys).agg(F.sum(value).alias("value")).orderBy(*keys)


def kpi(df: DataFrame, value: Column, compare: Column, target: Column, by: Sequence[str] = ()) -> DataFrame:
    """``value, delta, delta_pct, attainment, band``; band is good from 1, warn from 0.9, else bad."""
    out = df.groupBy(*by).agg(value.alias("value"), compare.alias("compare"), target.alias("target"))
    attainment = F.col("value") / F.nullif("target", F.lit(0))
    return out.select(
        *by,
        "value",
        (F.col("value") - F.col("compare")).alias("delta"),
        ((F.col("value") - F.col("compare")) / F.nullif("compare", F.lit(0))).alias("delta_pct"),
        attainment.alias("attainment"),
        F.when(attainment >= 1, "good").when(attainment >= 0.9, "warn").when(attainment.isNotNull(), "bad").alias("band"),
    )


def compare(df: DataFrame, items: dict[str, Column]) -> DataFrame:
    """``label, value``: scalar aggregates side by side, from one scan."""
    row = df.agg(*[c.cast("double").alias(k) for k, c in items.items()])
    return row.unpivot([], list(items), "label", "value")
