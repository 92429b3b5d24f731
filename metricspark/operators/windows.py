"""Ranking, running and share windows.

Windows over groups partition by the group.  What runs over a whole result or over
large groups (``pareto``, ``value_ranks``, ``prefix_sums``) goes through sorted
ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricspark.lineage import cut
from metricspark.operators.ranges import running as running_in


def over(by: Sequence[str], *order: Column):
    """Window of a group, or of the whole (aggregated) result where no group is named."""
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return w.orderBy(*order) if order else w


def rank(by: Sequence[str], *order: Column) -> Column:
    """Competition rank."""
    return F.rank().over(over(by, *order))


def dense_rank(by: Sequence[str], *order: Column) -> Column:
    """Rank without gaps."""
    return F.dense_rank().over(over(by, *order))


def row_number(by: Sequence[str], *order: Column) -> Column:
    """Unique rank; the order needs a tie-break."""
    return F.row_number().over(over(by, *order))


def rank_modified(by: Sequence[str], order: Column) -> Column:
    """Ties take the highest rank number among them."""
    w = over(by, order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return F.count("*").over(w)


def rank_percentile(by: Sequence[str], *order: Column) -> Column:
    """Relative rank from 0 to 1."""
    return F.percent_rank().over(over(by, *order))


RUNNING: dict[str, Callable[[Column], Column]] = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}


def running(fn: str, value: Column, by: Sequence[str], *order: Column) -> Column:
    """Aggregate of all rows up to this one."""
    return RUNNING[fn](value).over(over(by, *order).rowsBetween(Window.unboundedPreceding, 0))


_WINDOWED = {
    **RUNNING,
    "median": lambda c: F.percentile(c, F.lit(0.5)),
    "stdev": F.stddev_samp,
    "stdevp": F.stddev_pop,
    "var": F.var_samp,
    "varp": F.var_pop,
    "corr": F.corr,
    "covar": F.covar_samp,
    "covarp": F.covar_pop,
}


def windowed(fn: str, value: Column, lo: int, hi: int, by: Sequence[str], order: Sequence[Column], *more: Column, p: float | None = None) -> Column:
    """Aggregate of the rows from ``lo`` to ``hi`` around this one."""
    frame = over(by, *order).rowsBetween(lo, hi)
    made = F.percentile(value, F.lit(p)) if fn == "percentile" else _WINDOWED[fn](value, *more)
    return made.over(frame)


def shift(value: Column, n: int, by: Sequence[str], *order: Column) -> Column:
    """Value ``n`` rows ahead (negative: behind), null outside the group."""
    w = over(by, *order)
    return F.lead(value, n).over(w) if n >= 0 else F.lag(value, -n).over(w)


def partition_stat(fn: str, by: Sequence[str], order: Sequence[Column] = (), value: Column | None = None) -> Column:
    """Offset to the first or last row, size or total of a partition."""
    if fn == "size":
        return F.count("*").over(over(by))
    if fn == "total":
        return F.sum(value).over(over(by))
    place = F.row_number().over(over(by, *order))
    return 1 - place if fn == "first" else F.count("*").over(over(by)) - place


def pct_of_total(value: Column, by: Sequence[str] = ()) -> Column:
    """Share of the partition's total, null on a zero total."""
    return value / F.nullif(F.sum(value).over(over(by)), F.lit(0))


def pct_of_previous(value: Column, by: Sequence[str], *order: Column) -> Column:
    """Relative change against the previous row."""
    return value / F.nullif(F.lag(value).over(over(by, *order)), F.lit(0)) - 1


def pareto(df: DataFrame, label: str, value: str, top_n: int = 20, mark: float = 80.0) -> DataFrame:
    """``label, value, rank, cumulative_pct, n_to_mark`` of the largest categories.

    Percentages are of the whole population, which is summed before the top rows
    are cut; there are no rows if the grand total is not positive.
    """
    sums = df.groupBy(label).agg(F.sum(value).alias("value")).withColumn("one", F.lit(1).cast("long"))
    ranked = cut(running_in(sums, [], [F.desc("value"), F.col(label)], {"running": ("sum", "value"), "rank": ("sum", "one")}))
    grand = ranked.agg(F.sum("value").alias("grand"))
    shares = ranked.join(F.broadcast(grand), F.lit(True)).filter("grand > 0").withColumn("cumulative_pct", F.col("running") * 100.0 / F.col("grand"))  # one row
    reached = shares.filter(F.col("cumulative_pct") >= mark).agg(F.min("rank").alias("n_to_mark"))
    top = shares.filter(F.col("rank") <= top_n).join(F.broadcast(reached), F.lit(True), "left")  # one row
    return top.select(label, "value", "rank", "cumulative_pct", "n_to_mark")


def value_ranks(df: DataFrame, value: str, by: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Each group's distinct values ``v`` with their rows ``c``, the rows below them ``before`` and the group's rows ``n``.

    Equal values are counted first and the distinct ones ranked in sorted ranges,
    so no task holds a whole group.  Null values are left out.
    """
    values = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("c"))
    ranked = running_in(values, by, [F.col("v")], {"through": ("sum", "c")}, parts)
    sizes = values.groupBy(*[F.col(b).alias(f"size_{b}") for b in by]).agg(F.sum("c").alias("n"))
    same = [F.col(b).eqNullSafe(F.col(f"size_{b}")) for b in by]
    joined = ranked.join(sizes, same) if by else ranked.join(F.broadcast(sizes), F.lit(True))  # one row
    return joined.select(*by, "v", "c", (F.col("through") - F.col("c")).alias("before"), "n")


def prefix_sums(df: DataFrame, value: str, tie: str, parts: int | None = None) -> DataFrame:
    """``rank`` and ``running`` by value descending, tie ascending, without a single-task window."""
    rows = df.withColumn("one_", F.lit(1).cast("long"))
    ranked = running_in(rows, [], [F.desc(value), F.col(tie)], {"rank": ("sum", "one_"), "running": ("sum", value)}, parts)
    return ranked.drop("one_")


def mix(df: DataFrame, x: str, series: str, value: str, max_categories: int = 8) -> DataFrame:
    """Share of each period's total by category, the tail folded to Other first; a zero total gives 0."""
    from metricspark.operators.topk import fold_labels

    cells = df.groupBy(x, series).agg(F.sum(value).alias("value"))  # facts are summed once; folding works on the sums
    labels = fold_labels(cells, series, "value", max_categories)
    folded = cells.join(labels, cells[series].eqNullSafe(labels["fold_key"]), "left")
    sums = folded.groupBy(x, F.col("folded").alias(series)).agg(F.sum("value").alias("value"))
    total = F.sum("value").over(Window.partitionBy(x))
    return sums.withColumn("share", F.when(F.coalesce(total, F.lit(0)) == 0, F.lit(0.0)).otherwise(F.col("value") / total))


def spark_series(df: DataFrame, key: str, period: str, value: str, n: int = 12) -> DataFrame:
    """The last ``n`` periods of each key in period order, as an array."""
    sums = df.groupBy(key, period).agg(F.sum(value).alias("value"))
    recent = sums.withColumn("back", F.dense_rank().over(Window.partitionBy(key).orderBy(F.desc(period)))).filter(F.col("back") <= n)
    pairs = F.sort_array(F.collect_list(F.struct(period, "value")))
    return recent.groupBy(key).agg(F.transform(pairs, lambda p: p["value"]).alias("series"))


def gap_series(df: DataFrame, period: str, upper: Column, lower: Column, clamp: bool = False) -> DataFrame:
    """Upper minus lower per period on one frame; a side without rows counts as 0."""
    sums = df.groupBy(period).agg(
        F.coalesce(F.sum(upper), F.lit(0)).alias("upper"), F.coalesce(F.sum(lower), F.lit(0)).alias("lower")
    )
    gap = F.col("upper") - F.col("lower")
    return sums.withColumn("gap", F.greatest(gap, gap * 0) if clamp else gap)


def rows_before(by: Sequence[str], order: Column) -> Column:
    """How many peers come strictly before the row (nested row context over an ordered column)."""
    return F.rank().over(over(by, order)) - 1
