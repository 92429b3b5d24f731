"""Queries that write files derived from the driver's tables and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from metricspark.plans.queries_catalog import fixture
from metricspark.plans.queries_core import PRICE, money
from metricspark.plans.registry import query, table
from metricspark.sources import inventory as inv
from metricspark.streaming.queries_streaming import scratch

_PARTS = "SELECT p_partkey, upper(replace(p_name, ' ', '_')) AS name, p_brand AS tbl"


@query(
    "src_read_inventories",
    f"WITH p AS ({_PARTS} FROM part) SELECT CASE p_partkey % 3 WHEN 0 THEN 'dimension' WHEN 1 THEN 'fact' ELSE 'metric' END AS kind, tbl, count(*) AS n, min(name) AS first_name FROM p GROUP BY 1, 2",
)
def _(spark, sf):
    d = fixture(spark, sf, "fx_definitions").withColumn("raw", F.lower(F.regexp_replace("name", "_", " ")))
    item = F.struct(F.col("raw").alias("name"), "expr", F.col("tbl").alias("table"))
    lists = [F.collect_list(F.when(F.col("kind") == kind, item)).alias(name) for name, kind in inv.KINDS.items()]
    path = scratch(spark, "inventories")
    d.groupBy("tbl").agg(*lists).drop("tbl").write.json(path)
    rows = inv.read_inventories(spark, path, multi_line=False)
    return rows.groupBy("kind", F.col("table").alias("tbl")).agg(F.count("*").alias("n"), F.min("name").alias("first_name"))


@query(
    "src_export_grid",
    f"WITH g AS (SELECT o_orderpriority AS label, CAST(sum({PRICE}) AS DOUBLE) AS total FROM orders GROUP BY 1) SELECT label, round(total, 2) AS total FROM g UNION ALL SELECT 'Total', round(sum(total), 2) FROM g",
)
def _(spark, sf):
    g = money(table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("label")).agg(F.sum(F.expr(PRICE)).alias("total")), "total")
    path = scratch(spark, "grid")
    inv.export_grid(g, "label", {"total": "measure"}, path)
    return spark.read.schema("label string, total double").csv(path, header=True).withColumn("total", F.round("total", 2))
