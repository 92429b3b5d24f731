"""Streaming form of the keyed catalog load.

Row-level operators are plain transforms and work on a streaming DataFrame as they
are.  The keyed upsert needs the current rows, so it runs per micro-batch on a
Parquet table partitioned by a hash bucket of the key: a batch reads and rewrites
only the buckets that its keys fall in, by Spark's dynamic partition overwrite.  A
batch that runs again upserts the same values, so a repeat is harmless.  Only one
writer may run; a reader during a batch may see some of its buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from metricspark.sources.inventory import first_wins, upsert

BUCKET = "bucket_"


def bucket(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, keys: Sequence[str], buckets: int, mode: str) -> None:
    """Replace the buckets of the rows (``dynamic``) or the whole table (``static``); each bucket is written by one task."""
    rows = df.withColumn(BUCKET, bucket(keys, buckets))
    rows.repartition(BUCKET).write.partitionBy(BUCKET).mode("overwrite").option("partitionOverwriteMode", mode).parquet(path)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether the table was made whole."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def create(path: str, initial: DataFrame, keys: Sequence[str], buckets: int) -> None:
    """Write the first rows of a bucketed table."""
    _write(initial, path, keys, buckets, "static")


def _with_bucket(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BUCKET, IntegerType())])


def current(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table as it is now."""
    return spark.read.schema(_with_bucket(schema)).parquet(path).drop(BUCKET)


def upsert_batch(path: str, schema: StructType, updates: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    """Upsert rows with distinct keys into a table of a schema; returns the buckets that were rewritten (at most ``buckets`` numbers)."""
    spark = updates.sparkSession
    keyed = updates.withColumn(BUCKET, bucket(keys, buckets))
    touched = sorted(r[0] for r in keyed.select(BUCKET).distinct().collect())
    if touched:
        stored = spark.read.schema(_with_bucket(schema)).parquet(path).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        _write(upsert(stored, updates, keys), path, keys, buckets, "dynamic")
    return touched


def upsert_batches(path: str, initial: DataFrame, keys: Sequence[str], order_cols: Sequence[str], buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that upserts each micro-batch into the bucketed table at ``path``, which it creates from ``initial``.

    Of several rows of one key in a batch the first in ``order_cols`` wins.
    Choose ``buckets`` so that one bucket's rows suit a task.
    """
    if not is_written(initial.sparkSession, path):  # a stream that starts again goes on with what it has
        create(path, initial, keys, buckets)
    schema = initial.schema

    def write(batch: DataFrame, number: int) -> None:
        updates = first_wins(batch, keys, order_cols).drop(*[c for c in order_cols if c not in initial.columns])
        upsert_batch(path, schema, updates, keys, buckets)

    return write
