"""Synthetic star schemas: tables in dependency order, keys wired, values with the distribution of a domain.

A value is an inverse-distribution sample of a hash of its row number, so a table is
the same for a seed whatever its partitions, and domains can keep the skew of a
column that exists.  Domains come from a profile, a name or a type.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Domain:
    """How a column is drawn.

    ``quantiles`` (ascending) are interpolated; ``values`` are chosen by
    ``weights``, equally without them; ``after`` adds up to ``spread`` days to a
    date column of the same table; ``template`` is a text with the row's number.
    """

    quantiles: Sequence[float] = ()
    values: Sequence[str] = ()
    weights: Sequence[float] = ()
    after: str | None = None
    spread: int = 0
    kind: str = "double"
    digits: int | None = None
    template: str | None = None


@dataclass(frozen=True)
class Table:
    """A table of ``rows`` rows with a key numbered from 1, domains by column, and foreign keys to other tables.

    ``skew`` above 1 sends more children to the first rows of a foreign key's parent.
    """

    name: str
    rows: int
    key: str
    columns: Mapping[str, Domain] = field(default_factory=dict)
    parents: Mapping[str, str] = field(default_factory=dict)
    skew: Mapping[str, float] = field(default_factory=dict)


# Words of a column's name that give it a domain, in order, before its type does.
NAMED = (
    (r"(?i)(is_|has_|flag)", Domain(values=("true", "false"), kind="boolean")),
    (r"(?i)status", Domain(values=("Active", "Inactive", "Pending", "Closed"), weights=(6, 1, 2, 1), kind="string")),
    (r"(?i)(country|nation)", Domain(values=("US", "CA", "GB", "DE", "FR", "JP"), kind="string")),
    (r"(?i)(region|territory)", Domain(values=("North", "South", "East", "West"), kind="string")),
    (r"(?i)(pct|percent|ratio|rate)", Domain(quantiles=(0.0, 1.0), digits=4)),
    (r"(?i)(amount|price|cost|revenue|total|balance)", Domain(quantiles=(1.0, 20.0, 60.0, 250.0, 10_000.0), digits=2)),
    (r"(?i)(count|qty|quantity|number|units)", Domain(quantiles=(1.0, 101.0), kind="long")),
    (r"(?i)email", Domain(template="user%d@example.com", kind="string")),
    (r"(?i)(phone|tel)", Domain(template="555-%04d", kind="string")),
    (r"(?i)(address|street)", Domain(template="%d Main St", kind="string")),
    (r"(?i)(description|note|comment|remark)", Domain(template="Sample text %d", kind="string")),
    (r"(?i)name", Domain(template="Name %d", kind="string")),
    (r"(?i)(date|_at$|_on$|time)", Domain(quantiles=(0.0, 1461.0), kind="date")),
)
TYPED = {
    "boolean": NAMED[0][1],
    "date": NAMED[-1][1],
    "number": Domain(quantiles=(0.0, 1000.0), digits=2),
    "text": Domain(values=tuple(f"value_{k}" for k in range(20)), kind="string"),
}
FIRST_DAY = "2020-01-01"


def domain_of(name: str, kind: str) -> Domain:
    """Domain of a column by its name, else by its type (``number, date, boolean, text``)."""
    numeric = kind == "number"
    for pattern, domain in NAMED:
        fits = domain.kind in ("double", "long") if numeric else domain.kind == {"text": "string"}.get(kind, kind)
        if fits and re.search(pattern, name):
            return domain
    return TYPED[kind]


def profile(df: DataFrame, numbers: Sequence[str] = (), labels: Sequence[str] = (), bins: int = 100, most: int = 200) -> dict[str, Domain]:
    """Domains with the distributions of existing columns: ``bins`` quantiles of each number, at most ``most`` frequent labels of each label column.

    One pass for the numbers and one grouped count per label column; only the
    quantiles and the listed labels come to the driver.
    """
    out: dict[str, Domain] = {}
    if numbers:
        steps = F.array(*[F.lit(k / bins) for k in range(bins + 1)])
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), steps, F.lit(100 * bins)).alias(c) for c in numbers]).first()
        for c in numbers:
            kind = df.schema[c].dataType.simpleString()
            whole = kind in ("int", "bigint", "smallint", "tinyint")
            out[c] = Domain(quantiles=tuple(row[c] or (0.0, 0.0)), kind="long" if whole else "double", digits=None if whole else 2)
    for c in labels:
        rows = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("v")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "v").limit(most).collect()
        out[c] = Domain(values=tuple(r.v for r in rows), weights=tuple(r.n for r in rows), kind="string")
    return out


def _uniform(table: str, column: str, seed: int) -> Column:
    """A number from 0 to below 1 for each row, by a hash of its number."""
    return F.pmod(F.xxhash64("id", F.lit(f"{table}.{column}"), F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _drawn(table: str, column: str, d: Domain, seed: int) -> Column:
    u = _uniform(table, column, seed)
    if d.after is not None:
        return F.date_add(F.col(d.after), F.floor(u * (d.spread + 1)).cast("int"))
    if d.template is not None:
        return F.format_string(d.template, F.col("id") + 1)
    if d.values:
        weights = d.weights or [1] * len(d.values)
        total, ends, sum_ = sum(weights), [], 0
        for w in weights:
            sum_ += w
            ends.append(sum_ / total)
        place = F.size(F.filter(F.array(*[F.lit(e) for e in ends[:-1]]), lambda e: e <= u)) if len(ends) > 1 else F.lit(0)
        return F.get(F.array(*[F.lit(v) for v in d.values]), place).cast(d.kind)
    at = u * (len(d.quantiles) - 1)
    points = F.array(*[F.lit(float(q)) for q in d.quantiles])
    low, high = F.get(points, F.floor(at).cast("int")), F.get(points, F.ceil(at).cast("int"))
    value = low + (high - low) * (at - F.floor(at))
    if d.kind == "long":
        return F.floor(value).cast("long")
    if d.kind == "date":
        return F.date_add(F.lit(FIRST_DAY).cast("date"), F.floor(value).cast("int"))
    return F.round(value, d.digits) if d.digits is not None else value


def in_order(tables: Sequence[Table]) -> list[Table]:
    """Parents before children; unknown parents and rings are errors."""
    known, out, left = {t.name for t in tables}, [], list(tables)
    for t in tables:
        if unknown := set(t.parents.values()) - known:
            raise ValueError(f"{t.name}: no table {', '.join(sorted(unknown))}")
    while left:
        ready = [t for t in left if {p for p in t.parents.values() if p != t.name} <= {o.name for o in out}]
        if not ready:
            raise ValueError(f"tables refer to each other in a ring: {', '.join(t.name for t in left)}")
        out += ready
        left = [t for t in left if t not in ready]
    return out


def generate(spark: SparkSession, tables: Sequence[Table], seed: int = 0) -> dict[str, DataFrame]:
    """All tables of a schema by name, parents first.  Nothing is written or collected; each is a projection of row numbers."""
    ordered = in_order(tables)
    rows = {t.name: t.rows for t in ordered}
    out = {}
    for t in ordered:
        df = spark.range(t.rows)
        for fk, parent in t.parents.items():
            u = F.pow(_uniform(t.name, fk, seed), F.lit(float(t.skew.get(fk, 1.0))))
            df = df.withColumn(fk, F.floor(u * rows[parent]).cast("long") + 1)
        for c, d in sorted(t.columns.items(), key=lambda x: x[1].after is not None):  # dates that follow others come last
            df = df.withColumn(c, _drawn(t.name, c, d, seed))
        out[t.name] = df.select((F.col("id") + 1).alias(t.key), *t.parents, *t.columns)
    return out
