"""Queries that run row-level and keyed operators over a stream of the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from metricspark.lineage import shared_folder
from metricspark.operators.predicates import cross_filter
from metricspark.plans.registry import query, table
from metricspark.streaming.upserts import current, upsert_batches


def scratch(spark, name: str) -> str:
    """A new folder under the shared checkpoint folder, or a temporary one where none is set (tests)."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("stream_upsert", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment, c_name FROM customer")
def _(spark, sf):
    initial = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name")
    root = scratch(spark, "upserts")
    stream = spark.readStream.schema(table(spark, sf, "customer").schema).parquet(f"{sf}/customer.parquet*")
    moved = cross_filter(stream, {}).filter("c_custkey % 3 = 0").select("c_custkey", F.lit("MOVED").alias("c_mktsegment"), F.lit(1).alias("seq"))
    run = (
        moved.writeStream.foreachBatch(upsert_batches(root, initial, ["c_custkey"], ["seq"]))
        .option("checkpointLocation", f"{root}-state")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return current(spark, root, initial.schema)

