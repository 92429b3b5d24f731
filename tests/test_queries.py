"""Every registered query against its SQL, or at least run whole."""

import pytest
from conftest import rows_of

from metricspark.plans import queries_catalog, queries_core, queries_rules, queries_scalar, queries_shapes, queries_time, registry
from metricspark.sources import queries_sources
from metricspark.streaming import queries_streaming

MODULES = (queries_core, queries_time, queries_shapes, queries_scalar, queries_catalog, queries_rules, queries_streaming, queries_sources)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(name, spark, sf_dir, duck):
    got = registry.QUERIES[name](spark, sf_dir).toPandas()
    if name not in registry.ORACLES:
        assert len(got) > 0
        return
    want = duck.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_formats_next_to_their_limits(spark, tmp_path):
    """An amount that rounds up to 1,000 keeps its separator on both sides; so do halves and signs."""
    duckdb = pytest.importorskip("duckdb")
    amounts = [999.77, -999.5, 999.4999, 1000.0, 0.5, 1.5, 2.5, -0.4, 0.0, 1.25, 0.05, -12.45, 999.95, 999999.5, 1234567.25, None]
    rows = [(4 * k + scale, k % 25, x) for k, x in enumerate(amounts) for scale in range(4)]
    spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    got = registry.QUERIES["val_formats"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert rows_of(got) == rows_of(con.execute(registry.ORACLES["val_formats"]).df())
    assert "$1,000" in set(got["money"])


def test_entry_module_runs(spark, sf_dir):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert len(rows) == 6
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
