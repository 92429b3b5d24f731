"""Joins and join audits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row on a declared key: ``n_rows, n_null, n_duplicated`` (rows beyond the first of a key)."""
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    grouped = df.select(null.alias("has_null"), *keys).groupBy("has_null", *keys).agg(F.count("*").alias("n"))
    return grouped.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("has_null"), F.col("n"))), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum(F.when(~F.col("has_null"), F.col("n") - 1)), F.lit(0)).alias("n_duplicated"),
    )


def audit_fanout(left: DataFrame, right: DataFrame, on: Sequence[str], measure: Column) -> DataFrame:
    """Rows and measure total before and after a left join, in one row.

    The right side is counted per key first, so the joined rows are never made.
    """
    per_key = right.groupBy(*on).agg(F.count("*").alias("matches"))
    joined = left.withColumn("measure", measure).join(per_key, list(on), "left")
    copies = F.coalesce("matches", F.lit(1))
    return joined.agg(
        F.count("*").alias("rows_before"),
        F.sum(copies).alias("rows_after"),
        F.sum("measure").alias("total_before"),
        F.sum(F.col("measure") * copies).alias("total_after"),
    )


def orphan_rate(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """``n_rows, n_orphans, orphan_share`` of many-side rows without a match (null keys have none)."""
    keys = right.select(*[F.col(b).alias(f"one_{b}") for _, b in on]).distinct().withColumn("found", F.lit(1))
    joined = left.join(keys, [F.col(a) == F.col(f"one_{b}") for a, b in on], "left")
    n, lost = F.count("*"), F.count(F.when(F.col("found").isNull(), 1))
    return joined.agg(n.alias("n_rows"), lost.alias("n_orphans"), (lost / n).alias("orphan_share"))


def lookup(df: DataFrame, other: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """The related value; a key with two different values is an error when the row is read."""
    several = F.min(value) != F.max(value)
    one = other.groupBy(*on).agg(
        F.when(several, F.raise_error(F.lit(f"several values of {value}"))).otherwise(F.max(value)).alias(value)
    )
    return df.join(one, list(on), "left")


def related_agg(one: DataFrame, many: DataFrame, on: Sequence[tuple[str, str]], *metrics: Column) -> DataFrame:
    """Aggregates of the many side per one-side row; the many side is aggregated before the join."""
    grouped = many.groupBy(*[F.col(b).alias(f"many_{b}") for _, b in on]).agg(*metrics)
    joined = one.join(grouped, [F.col(a) == F.col(f"many_{b}") for a, b in on], "left")
    return joined.drop(*[f"many_{b}" for _, b in on])


def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the common column names."""
    common = [c for c in a.columns if c in b.columns]
    if not common:
        raise ValueError("no common columns")
    return a.join(b, common, how)


def treat_as(df: DataFrame, values: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows whose columns are among the values of an unrelated table."""
    wanted = values.select(*[F.col(b).alias(f"wanted_{b}") for _, b in on]).distinct()
    return df.join(wanted, [F.col(a) == F.col(f"wanted_{b}") for a, b in on], "left_semi")


def present_and_missing(described: DataFrame, existing: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Described objects that exist, and those that do not."""
    there = existing.select(*keys).distinct()
    return described.join(there, list(keys), "left_semi"), described.join(there, list(keys), "left_anti")


def with_calendar(df: DataFrame, date_col: str, calendar: DataFrame, day_col: str = "d") -> DataFrame:
    """Facts with the calendar columns of their day."""
    return df.join(calendar, F.to_date(date_col) == F.col(day_col), "left")


def audit_relationships(rel: DataFrame, scope: DataFrame, clone_pattern: str = r"_FY\d+$") -> DataFrame:
    """One row on the joins that touch entities of ``scope(entity)``.

    Invalid status (null counts as valid) and unsound predicates are counted
    apart; clone-related joins name an entity with a fiscal-year suffix.
    """
    names = scope.select("entity").distinct()
    inside = (
        rel.join(names.withColumnRenamed("entity", "l"), F.col("left_entity") == F.col("l"), "left")
        .join(names.withColumnRenamed("entity", "r"), F.col("right_entity") == F.col("r"), "left")
        .filter("l is not null or r is not null")
    )
    stale = F.coalesce(F.col("source_status") != "valid", F.lit(False))
    clone = F.col("left_entity").rlike(clone_pattern) | F.col("right_entity").rlike(clone_pattern)
    n = F.count("*")
    count = lambda c: F.count(F.when(c, 1))
    return inside.agg(
        n.alias("n_joins"),
        count(F.col("source_status") == "valid").alias("n_valid"),
        count(F.col("source_status").isNull()).alias("n_unknown"),
        count(stale).alias("n_stale"),
        count(~F.col("is_simple_equality")).alias("n_unsound"),
        count(stale & ~F.col("is_simple_equality")).alias("n_both"),
        count(clone).alias("n_clone"),
    )
