"""Grouping sets, hierarchies, balances and totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], *metrics: Column) -> DataFrame:
    """All grouping sets in one pass over base rows, with ``grouping_id``.

    Columns are every dimension in first-mention order; a dimension outside a
    row's set is null, and the id tells it from a null value.
    """
    dims = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dims]).agg(
        F.grouping_id().cast("int").alias("grouping_id"), *metrics
    )


def reporting_set(df: DataFrame, dims: Sequence[str], *metrics: Column) -> DataFrame:
    """One total and one result per dimension, each aggregated from base rows: ``dimension, label`` and metrics."""
    rows = grouping_sets(df, [[], *[[d] for d in dims]], *metrics)
    full = (1 << len(dims)) - 1
    which = F.lit("(total)")
    label = F.lit(None).cast("string")
    for i, d in enumerate(dims):
        own = full & ~(1 << (len(dims) - 1 - i))
        which = F.when(F.col("grouping_id") == own, F.lit(d)).otherwise(which)
        label = F.when(F.col("grouping_id") == own, F.col(d).cast("string")).otherwise(label)
    return rows.select(which.alias("dimension"), label.alias("label"), *[c for c in rows.columns if c not in dims and c != "grouping_id"])


def hierarchy_nodes(df: DataFrame, levels: Sequence[str], value: str, sep: str = " / ") -> DataFrame:
    """One row per node at every depth: ``id, parent, label, depth, value`` and the labels from the top down, ``path``.

    Ids join the labels by ``sep`` and are for display; the path tells nodes apart.
    A null top level is dropped; a null deeper level ends the path there.
    """
    rows = df.filter(F.col(levels[0]).isNotNull())
    path = F.array(*[F.col(c).cast("string") for c in levels])
    stop = F.coalesce(F.array_position(F.transform(path, lambda x: F.coalesce(x.isNull().cast("int"), F.lit(0))), 1), F.lit(0))
    length = F.when(stop == 0, F.lit(len(levels))).otherwise(stop - 1).cast("int")
    return _nodes(rows.select(F.slice(path, 1, length).alias("path"), F.col(value).alias("v")), sep)


def _nodes(rows: DataFrame, sep: str) -> DataFrame:
    """Sums of ``v`` for every prefix of ``path``; whole paths are summed before prefixes spread."""
    leaves = rows.groupBy("path").agg(F.sum("v").alias("v"))
    prefixes = leaves.select(F.explode(F.expr("transform(sequence(1, size(path)), n -> slice(path, 1, n))")).alias("p"), "v")
    nodes = prefixes.groupBy("p").agg(F.sum("v").alias("value"))
    return nodes.select(
        F.array_join("p", sep).alias("id"),
        F.expr(f"array_join(slice(p, 1, size(p) - 1), '{sep}')").alias("parent"),
        F.element_at("p", -1).alias("label"),
        F.size("p").alias("depth"),
        "value",
        F.col("p").alias("path"),
    )


def hierarchy_tree(df: DataFrame, levels: Sequence[str], value: str, sep: str = " / ") -> DataFrame:
    """Nodes with labels trimmed, blanks skipped inside the path and zero values ignored, children ranked by value."""
    trimmed = F.filter(F.array(*[F.trim(F.col(c).cast("string")) for c in levels]), lambda x: x.isNotNull() & (x != ""))
    rows = df.select(trimmed.alias("path"), F.col(value).alias("v")).filter((F.size("path") > 0) & (F.coalesce("v", F.lit(0)) != 0))
    order = Window.partitionBy("parent", "depth").orderBy(F.desc("value"), "label")
    return _nodes(rows, sep).withColumn("child_rank", F.row_number().over(order))


def node_share(nodes: DataFrame) -> DataFrame:
    """Each node's share of its parent and of the top level's total."""
    parents = nodes.select(F.col("path").alias("up"), F.col("value").alias("up_value"))
    total = nodes.filter("depth = 1").agg(F.sum("value").alias("all_value"))
    joined = nodes.join(parents, F.expr("slice(path, 1, size(path) - 1)") == F.col("up"), "left").join(F.broadcast(total), F.lit(True), "left")  # one row
    whole = F.coalesce("up_value", "all_value")
    share = lambda x: F.when(x != 0, F.col("value") / x)
    return joined.select(*nodes.columns, share(whole).alias("share_of_parent"), share(F.col("all_value")).alias("share_of_total"))


def _period(date: str, period: str) -> Column:
    return F.to_date(F.date_trunc(period, F.col(date)))


def closing(df: DataFrame, measure: str, date: str, keys: Sequence[str], by: Sequence[str] = (), period: str = "month", tie: str | None = None) -> DataFrame:
    """Sum over keys of each key's last non-null value in the period."""
    return _edge(df, measure, date, keys, by, period, F.max_by, tie)


def opening(df: DataFrame, measure: str, date: str, keys: Sequence[str], by: Sequence[str] = (), period: str = "month", tie: str | None = None) -> DataFrame:
    """Sum over keys of each key's first non-null value in the period."""
    return _edge(df, measure, date, keys, by, period, F.min_by, tie)


def _edge(df, measure, date, keys, by, period, pick, tie) -> DataFrame:
    rows = df.filter(F.col(measure).isNotNull()).withColumn("period", _period(date, period))
    order = F.struct(date, tie) if tie else F.col(date)
    last = rows.groupBy("period", *by, *[k for k in keys if k not in by]).agg(pick(measure, order).alias("edge"))
    return last.groupBy("period", *by).agg(F.sum("edge").alias("balance"))


def opening_boundary(df: DataFrame, measure: str, date: str, keys: Sequence[str], period: str = "month") -> DataFrame:
    """Opening balance as the previous period's closing balance."""
    closed = closing(df, measure, date, keys, (), period)
    step = {"month": 1, "quarter": 3, "year": 12}[period]
    return closed.select(F.add_months("period", step).alias("period"), F.col("balance").alias("opening"))


#: Rollup names and how they reduce a key's values over time.
_ROLLUPS = {
    "first": lambda c, t: F.min_by(c, t),
    "last": lambda c, t: F.max_by(c, t),
    "average": lambda c, t: F.avg(c),
    "avg": lambda c, t: F.avg(c),
    "median": lambda c, t: F.median(c),
    "sum": lambda c, t: F.sum(c),
    "min": lambda c, t: F.min(c),
    "max": lambda c, t: F.max(c),
}


def semi_additive(df: DataFrame, measure: str, regular: str, rollup: str, dims: Sequence[str], time: str) -> DataFrame:
    """Regular aggregate across all keys at each moment, rollup across time."""
    across = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}[regular]
    moments = df.groupBy(*dims, time).agg(across(measure).alias("m"))
    return moments.groupBy(*dims).agg(_ROLLUPS[rollup]("m", time).alias(measure))


def mark_semi_additive(rules: DataFrame) -> DataFrame:
    """``rules(regular, rollup)`` with ``is_semi_additive``."""
    lower = F.lower("rollup")
    odd = lower.isin("first", "last", "median", "average", "avg") & (lower != F.lower("regular"))
    return rules.withColumn("is_semi_additive", F.coalesce(odd, F.lit(False)))


def with_total(df: DataFrame, label_col: str, kinds: Mapping[str, str], label: str = "Total") -> DataFrame:
    """Rows and a total row: sums of measures, means of percent columns, blank for others."""
    aggs = [
        F.sum(c).cast(df.schema[c].dataType).alias(c) if kinds.get(c) == "measure" else F.avg(c).cast(df.schema[c].dataType).alias(c)
        for c in df.columns
        if kinds.get(c) in ("measure", "percent")
    ]
    total = df.agg(*aggs).withColumn(label_col, F.lit(label))
    rows = df.withColumn("is_total", F.lit(False))
    return rows.unionByName(total.withColumn("is_total", F.lit(True)), allowMissingColumns=True)
