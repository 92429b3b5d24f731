"""Aggregates that Spark has no single function for, and level-of-detail shapes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from metricspark.operators.ranges import running
from metricspark.operators.windows import value_ranks


def percentile_exclusive(df: DataFrame, value: str, p: float, by: Sequence[str] = ()) -> DataFrame:
    """Percentile at rank ``p * (n + 1)`` with interpolation; null outside ``1 .. n``.

    Only the values whose ranks enclose it contribute, so one pass over the
    ranked distinct values suffices and no task holds a whole group.
    """
    ranked = value_ranks(df, value, by)
    low = F.floor(F.lit(p) * (F.col("n") + 1))
    at = lambda r: F.max(F.when((F.col("before") < r) & (r <= F.col("before") + F.col("c")), F.col("v")))
    lower, upper = at(low), at(low + 1)
    n = F.first("n")
    out_rank = F.lit(p) * (n + 1)
    part = out_rank - F.floor(out_rank)
    result = F.when((out_rank < 1) | (out_rank > n), None).when(part == 0, lower).otherwise(lower + part * (upper - lower))
    return ranked.groupBy(*by).agg(result.alias("percentile_exc"))


def distinct_key_agg(df: DataFrame, by: Sequence[str], keys: Sequence[str], value: str, *metrics: Column) -> DataFrame:
    """Aggregates over one value per key after a fan-out; ``metrics`` read the column ``value``."""
    one = df.groupBy(*by, *keys).agg(F.max(value).alias(value))
    return one.groupBy(*by).agg(*metrics)


def list_values(df: DataFrame, by: Sequence[str], value: str, sep: str = ",", order: str | None = None) -> DataFrame:
    """Distinct values of a group joined in order (a report-size list)."""
    one = df.select(*by, F.col(value).cast("string").alias("v"), F.col(order or value).alias("o")).distinct()
    pairs = F.array_sort(F.collect_list(F.struct("o", "v")))
    return one.groupBy(*by).agg(F.array_join(F.transform(pairs, lambda x: x.v), sep).alias("values"))


def lod(df: DataFrame, metric: Column, fixed: Sequence[str], name: str) -> DataFrame:
    """A metric at a fixed level of detail on every row: aggregated there and joined back."""
    level = df.groupBy(*[F.col(c).alias(f"lod_{c}") for c in fixed]).agg(metric.alias(name))
    if not fixed:
        return df.join(F.broadcast(level), F.lit(True), "left")  # one row
    on = [F.col(c).eqNullSafe(F.col(f"lod_{c}")) for c in fixed]
    return df.join(level, on, "left").drop(*[f"lod_{c}" for c in fixed])


def include_level(dims: Sequence[str], include: Sequence[str]) -> list[str]:
    """Level of detail of the view plus further dimensions."""
    return list(dict.fromkeys([*dims, *include]))


def exclude_level(dims: Sequence[str], exclude: Sequence[str]) -> list[str]:
    """Level of detail of the view without some dimensions."""
    return [d for d in dims if d not in exclude]


def dense_ids(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows with a number from 0 for each distinct value of a column, in the order of the values; null stays null."""
    values = df.select(F.col(column).alias("value_")).filter("value_ is not null").distinct().withColumn("one_", F.lit(1).cast("long"))
    numbered = running(values, [], [F.col("value_")], {name: ("sum", "one_")}).select("value_", (F.col(name) - 1).alias(name))
    return df.join(numbered, F.col(column) == F.col("value_"), "left").drop("value_")


def distinct_states(df: DataFrame, dims: Sequence[str], number: str, name: str) -> DataFrame:
    """Which numbers occur in each cell: ``dims``, a range of numbers ``name_range`` and a bitmap ``name_bits`` over it.

    States of cells merge exactly, so they serve every coarser level.  Numbers are
    whole and not negative (:func:`dense_ids` makes them); dense ones fill the
    bitmaps best.
    """
    return df.filter(F.col(number).isNotNull()).groupBy(*dims, F.bitmap_bucket_number(number).alias(f"{name}_range")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(f"{name}_bits"))


def merged_distinct(states: DataFrame, sets: Sequence[Sequence[str]], name: str) -> DataFrame:
    """Distinct counts of every grouping set from one table of states: dimensions, ``grouping_id`` and ``name``."""
    dims, part = list(dict.fromkeys(c for s in sets for c in s)), f"{name}_range"
    spread = states.groupingSets([[*map(F.col, s), F.col(part)] for s in sets], *map(F.col, [*dims, part]))
    merged = spread.agg(F.grouping_id().alias("id_"), F.bitmap_or_agg(f"{name}_bits").alias("bits_"))
    group = (F.shiftright("id_", 1)).cast("int").alias("grouping_id")  # without the bit of the range, which every set has
    return merged.groupBy(*dims, group).agg(F.sum(F.bitmap_count("bits_")).alias(name))


def aggregate_aware(sources: Sequence[DataFrame], dims: Sequence[str], measure: str, combine: Column | None = None) -> DataFrame:
    """Answer from the first, most aggregated source that has every requested column.

    ``combine`` re-aggregates the measure, so it must be a sum, minimum or
    maximum; without it the measure is a distinct count and the sources hold its
    states (:func:`distinct_states`).
    """
    needed = {*dims, measure} if combine is not None else {*dims, f"{measure}_range", f"{measure}_bits"}
    for df in sources:
        if needed <= set(df.columns):
            return df.groupBy(*dims).agg(combine) if combine is not None else merged_distinct(df, [dims], measure).drop("grouping_id")
    raise ValueError("no source has all requested columns")


def selected_value(column: str, alternate: Column) -> Column:
    """The only distinct value of a group, else the alternate."""
    return F.when(F.min(column).eqNullSafe(F.max(column)) & (F.count(column) > 0), F.max(column)).otherwise(alternate)


def npv(df: DataFrame, by: Sequence[str], rate: float, amount: str, period: str) -> DataFrame:
    """Net present value of flows at whole periods, the first discounted by ``period``."""
    return df.groupBy(*by).agg(F.sum(F.col(amount) / F.pow(F.lit(1.0 + rate), F.col(period))).alias("npv"))


def _years(df: DataFrame, by: Sequence[str], date: str) -> DataFrame:
    """``df`` with ``years_``: days from the group's first date over 365; the firsts are aggregated and joined back."""
    firsts = df.groupBy(*[F.col(b).alias(f"first_{b}") for b in by]).agg(F.min(date).alias("first_"))
    same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"first_{b}")) for b in by])
    return df.join(firsts, same).withColumn("years_", F.datediff(F.col(date), F.col("first_")) / 365.0)


def xnpv(df: DataFrame, by: Sequence[str], rate: float, amount: str, date: str) -> DataFrame:
    """Net present value of dated flows against the group's first date, 365 days a year."""
    present = F.col(amount) / F.pow(F.lit(1.0 + rate), F.col("years_"))
    return _years(df, by, date).groupBy(*by).agg(F.sum(present).alias("xnpv"))


#: Logarithms of one plus the rate between which roots are looked for: a trillionth to a trillion.
RATE_BOUNDS = (-27.631, 27.631)


def solve_rates(times: Sequence[np.ndarray], amounts: Sequence[np.ndarray]) -> np.ndarray:
    """Rate at which each group's present value is zero, all groups bisected at once.

    The bracket of a group widens until its ends differ in sign; NaN where they
    do not within ``RATE_BOUNDS``, as when all flows have one sign.
    """
    sizes = np.array([len(t) for t in times])
    begin = np.cumsum(sizes) - sizes
    t, amount = np.concatenate(times).astype(float), np.concatenate(amounts).astype(float)
    first, last = np.minimum.reduceat(t, begin), np.maximum.reduceat(t, begin)

    def value(x: np.ndarray) -> np.ndarray:
        """Present values up to a positive factor that keeps the powers from overflowing."""
        base = np.where(x < 0, last, first)
        return np.add.reduceat(amount * np.exp(-(t - np.repeat(base, sizes)) * np.repeat(x, sizes)), begin)

    low, high = np.full(len(sizes), -0.7), np.full(len(sizes), 0.7)
    while True:
        apart = value(low) * value(high) > 0
        wider = apart & (high < RATE_BOUNDS[1])
        if not wider.any():
            break
        low = np.where(wider, np.maximum(low * 2, RATE_BOUNDS[0]), low)
        high = np.where(wider, np.minimum(high * 2, RATE_BOUNDS[1]), high)
    at_low = np.sign(value(low))
    for _ in range(80):
        middle = (low + high) / 2
        upper = np.sign(value(middle)) * at_low > 0
        low, high = np.where(upper, middle, low), np.where(upper, high, middle)
    return np.where(apart, np.nan, np.expm1((low + high) / 2))


@F.pandas_udf(DoubleType())
def _rates(times: pd.Series, amounts: pd.Series) -> pd.Series:
    found = solve_rates(list(times), list(amounts)) if len(times) else np.empty(0)
    return pd.Series(found).astype(object).where(~np.isnan(found), None)


def irr(df: DataFrame, by: str, amount: str, t: str) -> DataFrame:
    """Internal rate of return of each group's flows; flows of one period are summed first, so a group is as long as it has periods."""
    flows = df.groupBy(by, F.col(t).cast("double").alias("t")).agg(F.sum(F.col(amount).cast("double")).alias("amount"))
    lists = flows.groupBy(by).agg(F.collect_list(F.struct("t", "amount")).alias("flows"))
    return lists.select(by, _rates(F.col("flows.t"), F.col("flows.amount")).alias("irr"))


def xirr(df: DataFrame, by: str, amount: str, date: str) -> DataFrame:
    """Internal rate of return of dated flows, 365 days a year from the group's first date."""
    return irr(_years(df, [by], date), by, amount, "years_")


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Rank correlation with tied ranks averaged; rows with a null are left out.

    Rows meet their values' ranks in joins, so no task ranks a whole group.
    """
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by, F.col(x).cast("double").alias("x_"), F.col(y).cast("double").alias("y_")).agg(F.count("*").alias("rows_"))
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    for c, name in ((x, "x_"), (y, "y_")):
        ranks = value_ranks(rows, c, by).select(*[F.col(b).alias(f"{name}{b}") for b in by], F.col("v").alias(f"{name}v"), (F.col("before") + (F.col("c") + 1) / 2.0).alias(f"{name}rank"))
        same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"{name}{b}")) for b in by], F.col(name) == F.col(f"{name}v"))
        pairs = pairs.join(ranks, same).drop(*[f"{name}{b}" for b in by], f"{name}v")
    # correlation of the ranks, each pair of values weighted by its rows and taken from the mean for precision
    w, a, b = F.col("rows_"), F.col("x_rank"), F.col("y_rank")
    means = pairs.groupBy(*[F.col(k).alias(f"mean_{k}") for k in by]).agg((F.sum("rows_") + 1).alias("twice"))
    same = reduce(lambda p, q: p & q, [F.col(k).eqNullSafe(F.col(f"mean_{k}")) for k in by], F.lit(True))
    pairs = pairs.join(F.broadcast(means) if not by else means, same).withColumn("x_rank", a - F.col("twice") / 2.0).withColumn("y_rank", b - F.col("twice") / 2.0)
    spread = F.sqrt(F.sum(w * a * a) * F.sum(w * b * b))
    return pairs.groupBy(*by).agg((F.sum(w * a * b) / F.nullif(spread, F.lit(0.0))).alias("spearman"))
