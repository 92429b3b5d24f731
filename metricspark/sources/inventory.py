"""Inventories of metric definitions: ingest, merge, keyed upserts, provenance and synthetic tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Lists of an inventory document that hold definitions, and the kind each becomes.
KINDS = {"dimensions": "dimension", "facts": "fact", "metrics": "metric", "filters": "filter"}
ITEM = (
    "array<struct<name:string,expr:string,data_type:string,table:string,description:string,synonyms:array<string>,"
    "complexity:string,source_view:string,page_name:string,dashboard_name:string>>"
)
_TABLE = "array<struct<name:string,source:string,description:string>>"


def definition_rows(docs: DataFrame) -> DataFrame:
    """One row per definition of inventory documents, with its kind and position; other columns come along."""
    others = [c for c in docs.columns if c not in KINDS]
    parts = [
        docs.select(*others, F.lit(kind).alias("kind"), F.posexplode(name).alias("position", "item")).select(*others, "kind", "position", "item.*")
        for name, kind in KINDS.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("name", normal_name(F.col("name")))


def read_inventories(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One definitions table from many inventory JSON files, with kind, file and position.

    A file is one document, or with ``multi_line`` false one document a line, which
    large files need to be split.
    """
    schema = ", ".join(f"`{k}` {ITEM}" for k in KINDS)
    docs = spark.read.schema(schema).option("multiLine", multi_line).json(path).withColumn("source_file", F.input_file_name())
    return definition_rows(docs)


def read_inventory_tables(spark: SparkSession, path: str) -> DataFrame:
    """The logical tables of inventory JSON files."""
    docs = spark.read.schema(f"tables {_TABLE}").option("multiLine", True).json(path).withColumn("source_file", F.input_file_name())
    return docs.select("source_file", F.posexplode("tables").alias("position", "t")).select("source_file", "position", "t.*").withColumn("name", normal_name(F.col("name")))


def normal_name(name: Column) -> Column:
    """Upper case with spaces as underscores."""
    return F.upper(F.regexp_replace(F.trim(name), r"\s+", "_"))


def merge_inventories(tables: DataFrame, order_cols: Sequence[str], name_col: str = "name") -> tuple[DataFrame, DataFrame]:
    """First table of each name, and the later ones as error rows."""
    ranked = tables.withColumn("rn", F.row_number().over(Window.partitionBy(name_col).orderBy(*order_cols)))
    errors = ranked.filter("rn > 1").drop("rn").withColumn("error", F.concat(F.lit("duplicate table "), F.col(name_col)))
    return ranked.filter("rn = 1").drop("rn"), errors


def first_wins(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The first row of each key in load order."""
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols))).filter("rn = 1").drop("rn")


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New snapshot of a keyed table: matched rows take only the supplied columns, others keep their values, new keys are added."""
    new = updates.select(*[F.col(c).alias(f"new_{c}") for c in updates.columns], F.lit(True).alias("new_row"))
    old = target.withColumn("old_row", F.lit(True))
    on = [F.col(k).eqNullSafe(F.col(f"new_{k}")) for k in keys]
    joined = old.join(new, on, "full_outer")
    columns = []
    for c in target.columns:
        if c in updates.columns:
            kind = target.schema[c].dataType
            columns.append(F.when(F.col("new_row"), F.col(f"new_{c}").cast(kind)).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return joined.select(*columns)


def stable_id(*columns: Column) -> Column:
    """First 24 hex digits of the SHA-1 of the parts joined by U+0001, null as empty."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.substring(F.sha1(F.concat_ws("\u0001", *parts)), 1, 24)


def stamp(df: DataFrame, load_id: str, loaded_at: Column | None = None) -> DataFrame:
    """Load id and time on every row."""
    return df.withColumn("load_id", F.lit(load_id)).withColumn("loaded_at", F.current_timestamp() if loaded_at is None else loaded_at)


def load_summary(definitions: DataFrame, model_col: str, kinds: Sequence[str] = tuple(KINDS.values())) -> DataFrame:
    """Extraction counts per model, one column per kind."""
    counts = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in kinds]
    return definitions.groupBy(model_col).agg(*counts)


def synthesize(spark: SparkSession, columns: Mapping[str, str], rows: int, multiplier: int = 1, parents: Mapping[str, int] | None = None, key: str | None = None, seed: int = 0) -> DataFrame:
    """A synthetic table of ``rows * multiplier`` rows, the same for a seed whatever the partitioning.

    ``columns`` maps a name to ``number``, ``date``, ``boolean`` or ``text``; the
    key is the row number from 1 and a foreign key ``fk`` of ``parents`` is
    ``row mod parent_rows + 1``.
    """
    base = spark.range(rows * multiplier)
    h = lambda c, k: F.pmod(F.xxhash64("id", F.lit(c), F.lit(seed)), F.lit(k))
    make = {
        "number": lambda c: (h(c, 100_000) / 100.0),
        "date": lambda c: F.date_add(F.lit("2020-01-01").cast("date"), h(c, 1461).cast("int")),
        "boolean": lambda c: h(c, 2) == 0,
        "text": lambda c: F.concat(F.lit(f"{c}_"), h(c, 20).cast("string")),
    }
    out = [(F.col("id") + 1).alias(key)] if key else []
    out += [(F.pmod(F.col("id"), F.lit(n)) + 1).alias(fk) for fk, n in (parents or {}).items()]
    out += [make[kind](c).alias(c) for c, kind in columns.items()]
    return base.select(*out)


def export_grid(df: DataFrame, label_col: str, kinds: Mapping[str, str], path: str) -> None:
    """Write a grid with its total row as CSV."""
    from metricspark.operators.rollups import with_total

    with_total(df, label_col, kinds).drop("is_total").write.mode("overwrite").csv(path, header=True)
