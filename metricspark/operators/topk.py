"""Ranked results, tail folding, top-k and declared orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def first_rows(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows of the whole with their number ``rn``; each task sends ``n`` rows at most."""
    head = df.orderBy(*order).limit(n)
    return head.withColumn("rn", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def fold_labels(df: DataFrame, label: str, value: str, max_categories: int = 8) -> DataFrame:
    """``fold_key, folded``: each label's display label, the tail of a long list being ``Other (n)``."""
    sums = df.groupBy(F.col(label).alias("fold_key")).agg(F.sum(value).alias("total"))
    head = first_rows(sums, max_categories, [F.desc_nulls_last("total"), F.col("fold_key")]).select(F.col("fold_key").alias("head_key"), "rn")
    size = sums.agg(F.count("*").alias("n"))
    placed = sums.join(F.broadcast(head), F.col("fold_key").eqNullSafe(F.col("head_key")), "left").join(F.broadcast(size), F.lit(True))  # max_categories rows and one
    tail = (F.col("n") > max_categories) & (F.col("rn").isNull() | (F.col("rn") >= max_categories))
    other = F.concat(F.lit("Other ("), (F.col("n") - (max_categories - 1)).cast("string"), F.lit(")"))
    return placed.select("fold_key", F.when(tail, other).otherwise(F.col("fold_key").cast("string")).alias("folded"))


def ranked(df: DataFrame, label: str, value: str) -> DataFrame:
    """Sums by label, largest first."""
    return df.groupBy(label).agg(F.sum(value).alias("value")).orderBy(F.desc("value"), label)


def fold_tail(df: DataFrame, label: str, value: str, max_categories: int = 8) -> DataFrame:
    """Sums with the tail folded; the total is preserved."""
    sums = df.groupBy(label).agg(F.sum(value).alias("value"))  # facts are summed once; folding works on the sums
    labels = fold_labels(sums, label, "value", max_categories)
    joined = sums.join(labels, sums[label].eqNullSafe(labels["fold_key"]), "left")
    return joined.groupBy(F.col("folded").alias(label)).agg(F.sum("value").alias("value"))


def ranked_pre_aggregated(df: DataFrame, label: str, value: str, check: bool = True) -> DataFrame:
    """Rows as they are, largest first, nulls last, a null label as ``(Missing)``.

    With ``check``, duplicate or colliding labels and values that are no finite
    number make reading the result an error.
    """
    name = F.coalesce(F.col(label).cast("string"), F.lit("(Missing)"))
    out = df.select(name.alias(label), F.col(value).alias("value"))
    if check:
        number = F.col("value").cast("double")
        bad = F.col("value").isNotNull() & (number.isNull() | F.isnan(number) | F.abs(number).eqNullSafe(F.lit(float("inf"))))
        same = F.count("*").over(Window.partitionBy(label)) > 1
        out = out.withColumn(
            label,
            F.when(same, F.raise_error(F.lit("duplicate labels"))).when(bad, F.raise_error(F.lit("values must be finite"))).otherwise(F.col(label)),
        )
    return out.orderBy(F.desc_nulls_last("value"), label)


def top_k(df: DataFrame, k: int, order: Sequence[Column], by: Sequence[str]) -> DataFrame:
    """First ``k`` rows of each group under the order, which needs a tie-break."""
    rn = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rn", rn).filter(F.col("rn") <= k)


def top_k_global(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows under the order."""
    return df.orderBy(*order).limit(k)


def capped(df: DataFrame, n: int = 500, *order: Column) -> DataFrame:
    """First ``n`` rows with a flag that says whether more were left out."""
    rows = df.orderBy(*order).limit(n + 1)
    seen = F.count("*").over(Window.partitionBy(F.lit(0)))  # n + 1 rows at most
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
    return rows.withColumn("truncated", seen > n).withColumn("rn", place).filter(F.col("rn") <= n).drop("rn")


def month_order(label: Column) -> Column:
    """1 to 12 for a month name or abbreviation, 99 for any other label."""
    key = F.lower(F.substring(F.trim(label), 1, 3))
    at = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), key)
    return F.when(at > 0, at).otherwise(F.lit(99)).cast("int")


def order_abs(df: DataFrame, change: str, tie: str) -> DataFrame:
    """Rows by absolute change, largest first."""
    return df.orderBy(F.desc(F.abs(change)), tie)


def order_by_total(df: DataFrame, row: str, value: str) -> DataFrame:
    """Rows with their row label's total and its rank."""
    total = F.sum(value).over(Window.partitionBy(row))
    out = df.withColumn("row_total", total)
    return out.orderBy(F.desc("row_total"), row)
