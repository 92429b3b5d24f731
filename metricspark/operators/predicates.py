"""Filters: cross-filters, row security, entitlements, filtered measures and filter context."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_condition(df: DataFrame, active: Mapping[str, Sequence], leave_out: str | None = None) -> Column:
    """All active filters but one, ANDed; values compare as strings and columns the frame lacks are ignored."""
    tests = [
        F.col(c).cast("string").isin([str(v) for v in values])
        for c, values in active.items()
        if c != leave_out and c in df.columns and values
    ]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def cross_filter(df: DataFrame, active: Mapping[str, Sequence], emits: str | None = None) -> DataFrame:
    """Rows under the active filters except the panel's own dimension."""
    return df.filter(filter_condition(df, active, emits))


def panels(df: DataFrame, active: Mapping[str, Sequence], specs: Mapping[str, str]) -> DataFrame:
    """Every panel's sum under its own exclude-self filters, in one scan.

    ``specs`` maps a dimension to the measure it shows.  Returns ``panel, label,
    value``; a label that the other filters exclude is absent.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(dim).alias("panel"),
                F.col(dim).cast("string").alias("label"),
                F.when(filter_condition(df, active, dim), F.expr(measure)).alias("value"),
                filter_condition(df, active, dim).alias("shown"),
            )
            for dim, measure in specs.items()
        ]
    )
    spread = df.select(F.explode(rows).alias("r")).select("r.*")
    return spread.filter("shown").groupBy("panel", "label").agg(F.sum("value").alias("value"))


def secure(df: DataFrame, rules: Mapping[str, str], roles: Sequence[str]) -> DataFrame:
    """Rows that any held role's predicate admits; with rules but no held role, none."""
    held = [F.expr(f"({rules[r]})") for r in roles if r in rules]
    return df.filter(F.coalesce(reduce(lambda a, b: a | b, held), F.lit(False)) if held else F.lit(False))


def security_mapping(rules: DataFrame) -> DataFrame:
    """Distinct ``principal, role_group, column_name, column_value`` of ``rules(principal, role_group, entity, predicates)``.

    ``predicates`` is an array of structs ``(column, value)``.  Column names are
    upper-cased with other characters as underscores; the smallest entity stays.
    """
    flat = rules.select("principal", "role_group", "entity", F.explode("predicates").alias("p"))
    name = F.upper(F.regexp_replace(F.trim("p.column"), r"[^0-9A-Za-z]+", "_"))
    return (
        flat.select("principal", "role_group", name.alias("column_name"), F.col("p.value").alias("column_value"), "entity")
        .groupBy("principal", "role_group", "column_name", "column_value")
        .agg(F.min("entity").alias("entity"))
    )


def entitled(df: DataFrame, mapping: DataFrame, principal: str, column: str) -> DataFrame:
    """Rows whose value is exactly one of the principal's mapped values; nothing is inherited."""
    allowed = mapping.filter((F.col("principal") == principal) & (F.col("column_name") == column.upper()))
    allowed = allowed.select(F.col("column_value").alias("allowed_value")).distinct()
    return df.join(allowed, F.col(column).cast("string") == F.col("allowed_value"), "left_semi")


def filtered(aggregate, condition: Column, value: Column) -> Column:
    """A measure over the rows that meet its own filter."""
    return aggregate(F.when(condition, value))


def explore(
    df: DataFrame,
    always: Sequence[str] = (),
    conditional: Sequence[str] = (),
    unless: Sequence[str] = (),
    filters: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Always-on filters, and conditional ones unless the user filters one of ``unless``."""
    filters = filters or {}
    for f in always:
        df = df.filter(f"({f})")
    if not any(filters.get(u) for u in unless):
        for f in conditional:
            df = df.filter(f"({f})")
    return cross_filter(df, filters)


def calculate(
    df: DataFrame,
    metric: Column,
    context: Mapping[str, Sequence] | None = None,
    add: str | None = None,
    remove: str | Sequence[str] = (),
    keep: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """A metric under a changed filter context.

    ``remove`` names filters to drop, ``'all'`` drops every one but ``keep``.
    """
    context = dict(context or {})
    if remove == "all":
        context = {k: v for k, v in context.items() if k in keep}
    else:
        context = {k: v for k, v in context.items() if k not in remove}
    df = cross_filter(df, context)
    if add is not None:
        df = df.filter(f"({add})")
    return df.groupBy(*by).agg(metric)
