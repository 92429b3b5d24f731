"""Set operations and snapshot differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All rows of feeds with different columns, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def members(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Distinct union, difference or intersection of member sets."""
    return {"union": lambda: a.union(b).distinct(), "except": lambda: a.subtract(b), "intersect": lambda: a.intersect(b)}[how]()


def normalised_for_diff(value: str) -> Column:
    """Lower case, white space collapsed, outer quotes stripped."""
    text = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(value), F.lit(""))), r"\s+", " "))
    return F.regexp_replace(text, r"^[\"'`]+|[\"'`]+$", "")


def diff_snapshots(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys, status``: identical, expression_differs, only_in_a or only_in_b."""
    left = a.select(*keys, normalised_for_diff(value).alias("value_a"), F.lit(1).alias("in_a"))
    right = b.select(*keys, normalised_for_diff(value).alias("value_b"), F.lit(1).alias("in_b"))
    status = (
        F.when(F.col("in_b").isNull(), "only_in_a")
        .when(F.col("in_a").isNull(), "only_in_b")
        .when(F.col("value_a") == F.col("value_b"), "identical")
        .otherwise("expression_differs")
    )
    return left.join(right, list(keys), "full_outer").select(*keys, status.alias("status"))


def contains_all(values: Column, wanted: Sequence) -> Column:
    """Whether an array holds every wanted value."""
    return F.size(F.array_except(F.array(*[F.lit(w) for w in wanted]), values)) == 0


def contains_any(values: Column, wanted: Sequence) -> Column:
    """Whether an array holds some wanted value."""
    return F.arrays_overlap(values, F.array(*[F.lit(w) for w in wanted]))


def is_contained(value: Column, values: Column) -> Column:
    """Whether a value is in an array."""
    return F.array_contains(values, value)
