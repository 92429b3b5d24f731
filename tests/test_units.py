"""Hand-computed cases: refusals, nulls, ties, month ends and zero bases."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from metricspark.functions import columns as col
from metricspark.operators import aggregates, catalog, definitions, joins, predicates, rollups, timewin, topk, windows
from metricspark.plans.model import Dataset, Field, Metric, Model, ModelError, Relationship
from metricspark.sources import inventory


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def loans(spark):
    return frame(spark, [(1, "A", 10.0), (2, "A", 30.0), (3, "B", None), (4, "B", -5.0)], "id int, category string, duration double")


def dataset(df, name="loans", **kw):
    kw.setdefault("metrics", [Metric("mean_duration", "average", "duration")])
    return Dataset(name, df, kw.pop("fields", ()), kw.pop("key", ["id"]), **kw)


def test_average_is_kept_and_no_sum_is_invented(loans):
    rows = Model([dataset(loans)]).query(["loans.mean_duration"], ["loans.category"]).collect()
    assert {r.category: r.mean_duration for r in rows} == {"A": 20.0, "B": -5.0}


def test_base_filter_stays_in_the_dataset_and_reaches_the_scan(loans, tmp_path, spark):
    loans.write.parquet(str(tmp_path / "loans"))
    ds = dataset(spark.read.parquet(str(tmp_path / "loans")), filters=["duration > 0"])
    df = Model([ds]).query(["loans.mean_duration"])
    assert df.collect()[0][0] == 20.0
    assert "GreaterThan(duration,0.0)" in df._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    "make",
    [
        lambda df: Metric("m", "expr", "duration"),
        lambda df: Metric("m", "expr", "count(*)"),
        lambda df: Metric("m", "expr", "sum(x) over ()"),
        lambda df: Metric("m", "none", "duration"),
        lambda df: dataset(df, key=["nothing"]),
        lambda df: dataset(df, fields=[Field("id"), Field("ID", "category")]),
        lambda df: Model([dataset(df), dataset(df)]),
        lambda df: Model([dataset(df), dataset(df, "o")], [Relationship("r", "loans", "o", [("category", "category")])]),
        lambda df: Model([dataset(df), dataset(df, "o")], [Relationship("r", "loans", "o", [("id", "id")], join_type="inner")]),
        lambda df: Model([dataset(df), dataset(df, "o")], [Relationship("r", "loans", "o", [("id", "id")], "one_to_many", "left_outer")]),
        lambda df: Model([dataset(df)]).query(["loans.absent"]),
        lambda df: Model([dataset(df)]).query(["loans.mean_duration"], ["loans.absent"]),
        lambda df: Model([dataset(df)]).query(["loans.mean_duration"], limit=3),
    ],
)
def test_undeclared_things_are_refused(loans, make):
    with pytest.raises(ModelError):
        make(loans)


def test_two_paths_are_refused(loans):
    m = Model([dataset(loans), dataset(loans, "o")], [Relationship("a", "loans", "o", [("id", "id")]), Relationship("b", "loans", "o", [("duration", "id")])])
    with pytest.raises(ModelError):
        m.query(["loans.mean_duration"], ["o.id"])


def test_security(loans):
    rules = {"reader": "category = 'A' AND duration > 0", "auditor": "category = 'B'"}
    seen = lambda roles: sorted(r.id for r in predicates.secure(loans, rules, roles).collect())
    assert seen(["reader"]) == [1, 2]
    assert seen(["reader", "auditor"]) == [1, 2, 3, 4]
    assert seen(["guest"]) == [] and seen([]) == []
    assert loans.count() == 4


def test_joins_on_odd_keys(spark):
    many = frame(spark, [(1, 10.0), (1, 5.0), (None, 1.0), (9, 2.0)], "k int, v double")
    one = frame(spark, [(1, "x"), (1, "x"), (2, "y")], "k int, name string")
    assert joins.check_key(one, ["k"]).collect()[0].asDict() == {"n_rows": 3, "n_null": 0, "n_duplicated": 1}
    audit = joins.audit_fanout(many, one, ["k"], F.col("v")).collect()[0]
    assert (audit.rows_before, audit.rows_after, audit.total_before, audit.total_after) == (4, 6, 18.0, 33.0)
    assert joins.orphan_rate(many, one, [("k", "k")]).collect()[0].n_orphans == 2
    assert joins.lookup(many, one, ["k"], "name").count() == 4
    with pytest.raises(Exception, match="several values"):
        joins.lookup(many, one.union(frame(spark, [(1, "z")], "k int, name string")), ["k"], "name").collect()
    empty = many.limit(0)
    assert joins.check_key(empty, ["k"]).collect()[0].n_rows == 0


@pytest.mark.parametrize(
    ("member", "as_of", "low", "high"),
    [
        ("month to date", "1999-03-31", "1999-03-01", "1999-03-31"),
        ("prior month to date", "1999-03-31", "1999-02-01", "1999-02-28"),
        ("ytd", "2000-02-29", "2000-01-01", "2000-02-29"),
        ("prior year to date", "2000-02-29", "1999-01-01", "1999-02-28"),
        ("week to date", "1998-08-15", "1998-08-10", "1998-08-15"),
        ("last week", "1998-08-15", "1998-08-03", "1998-08-09"),
        ("last 3 months", "1998-08-15", "1998-05-15", "1998-08-15"),
        ("previous 3 months", "1998-08-15", "1998-02-15", "1998-05-14"),
        ("last quarter", "1998-08-15", "1998-04-01", "1998-06-30"),
        ("last quarter last year", "1998-08-15", "1997-04-01", "1997-06-30"),
        ("last month last year", "1998-08-15", "1997-07-01", "1997-07-31"),
        ("prior to previous quarter", "1998-08-15", "1997-10-01", "1997-12-31"),
        ("2 mon", "1999-03-31", "1999-01-01", "1999-01-31"),
    ],
)
def test_window_bounds(spark, member, as_of, low, high):
    row = timewin.window_table(spark, [member], as_of).collect()[0]
    assert (str(row.first_day), str(row.last_day)) == (low, high)


def test_windows_and_growth_on_empty_and_zero(spark):
    df = frame(spark, [(dt.datetime(2000, 1, 31, 23, 59), 5.0), (None, 7.0)], "ts timestamp, v double")
    row = timewin.window_sums(df, F.col("v"), "ts", ["month to date", "last month"], as_of="2000-01-31").collect()[0]
    assert (row.month_to_date, row.last_month) == (5.0, 0.0)
    grown = df.select(timewin.growth(F.lit(1.0), F.lit(0.0)).alias("g")).first().g
    assert grown is None
    with pytest.raises(ValueError):
        timewin.bounds("someday")


def test_pre_aggregated_ranking(spark):
    rows = [(f"c{i}", float(i)) for i in range(10)] + [("n", None), ("neg", -1.0)]
    out = topk.ranked_pre_aggregated(frame(spark, rows, "k string, v double"), "k", "v").collect()
    assert len(out) == 12 and out[0].k == "c9" and out[-1].k == "n"
    for bad in ([("A", 0.3), ("A", 0.8)], [(None, 1.0), ("(Missing)", 2.0)], [("A", float("inf"))]):
        with pytest.raises(Exception, match="duplicate labels|finite"):
            topk.ranked_pre_aggregated(frame(spark, bad, "k string, v double"), "k", "v").collect()
    summed = topk.ranked(frame(spark, [("A", 0.3), ("A", 0.8)], "k string, v double"), "k", "v").first()
    assert summed.value == pytest.approx(1.1)


def test_fold_keeps_the_total_and_small_lists(spark):
    rows = [(f"c{i}", i) for i in range(12)]
    out = {r.k: r.value for r in topk.fold_tail(frame(spark, rows, "k string, v int"), "k", "v").collect()}
    assert len(out) == 8 and out["Other (5)"] == sum(range(5)) and sum(out.values()) == sum(range(12))
    assert topk.fold_tail(frame(spark, rows[:8], "k string, v int"), "k", "v").count() == 8
    assert topk.fold_tail(frame(spark, [], "k string, v int"), "k", "v").count() == 0


def test_pareto_without_positive_total(spark):
    assert windows.pareto(frame(spark, [("a", 1.0), ("b", -1.0)], "k string, v double"), "k", "v").count() == 0


def test_total_of_averages_is_not_the_average_of_the_total(spark):
    df = frame(spark, [("a", 1.0), ("a", 1.0), ("b", 4.0)], "k string, v double")
    out = {r.label: r.m for r in rollups.reporting_set(df, ["k"], F.avg("v").alias("m")).collect()}
    assert out == {None: 2.0, "a": 1.0, "b": 4.0}


def test_value_rules(spark):
    one = spark.range(1)
    val = lambda c: one.select(c.alias("x")).first().x
    lit = lambda v: F.lit(v).cast("double")
    assert val(col.safe_ratio(lit(1), lit(0))) == 0.0 and val(col.safe_ratio(lit(None), lit(2))) == 0.0
    assert val(col.divide(lit(1), lit(0))) is None
    assert val(col.round_up(lit(-2.1))) == -3.0 and val(col.round_down(lit(-2.9))) == -2.0
    assert [val(col.even(lit(x))) for x in (-1.5, 0, 3)] == [-2, 0, 4]
    assert [val(col.odd(lit(x))) for x in (-2, 0, 2, 3)] == [-3, 1, 3, 3]
    assert val(col.compact_currency(lit(-1234567))) == "-$1.2M" and val(col.signed_percent(lit(0.125))) == "+12.5%"
    day = lambda s: F.lit(s).cast("date")
    assert val(col.date_diff("month", day("2000-01-31"), day("2000-02-29"))) == 1
    assert val(col.date_diff("week", day("2000-01-02"), day("2000-01-03"))) == 1
    assert val(col.business_days(day("2000-01-07"), day("2000-01-10"))) == 1
    assert val(col.business_days(day("2000-01-10"), day("2000-01-07"))) == -1
    assert val(col.norm_dist(lit(1.96), 0, 1)) == pytest.approx(0.9750021048517795)
    assert val(col.pmt(0.0, 10, lit(100))) == -10.0
    assert val(col.fv(0.1, 2, lit(-10))) == pytest.approx(21.0)


def test_returns(spark):
    flows = frame(spark, [("a", 0, -100.0), ("a", 1, 60.0), ("a", 2, 60.0), ("b", 0, 5.0)], "g string, t int, amount double")
    out = {r.g: r.irr for r in aggregates.irr(flows, "g", "amount", "t").collect()}
    assert out["a"] == pytest.approx(0.130662386, abs=1e-8) and out["b"] is None
    assert aggregates.npv(flows, ["g"], 0.130662386, "amount", "t").filter("g = 'a'").first().npv == pytest.approx(0, abs=1e-5)
    dated = frame(spark, [("a", dt.date(2020, 1, 1), -100.0), ("a", dt.date(2020, 12, 31), 110.0)], "g string, d date, amount double")
    assert aggregates.xirr(dated, "g", "amount", "d").first().irr == pytest.approx(0.1)


def test_semi_additive_takes_last_non_null(spark):
    df = frame(spark, [("k", dt.date(2020, 1, 1), 5), ("k", dt.date(2020, 1, 20), 7), ("k", dt.date(2020, 1, 30), None), ("l", dt.date(2020, 1, 2), 1)], "k string, d date, v int")
    assert rollups.closing(df, "v", "d", ["k"]).first().balance == 8
    assert rollups.opening(df, "v", "d", ["k"]).first().balance == 6
    assert str(rollups.opening_boundary(df, "v", "d", ["k"]).first().period) == "2020-02-01"


def test_hierarchy_variants(spark):
    df = frame(spark, [("a", None, "x", 1), ("a", " b ", "", 2), (None, "b", "c", 4), ("a", "b", "c", 0)], "p string, q string, r string, v int")
    nodes = {r.id: r.value for r in rollups.hierarchy_nodes(df, ["p", "q", "r"], "v").collect()}
    assert nodes["a"] == 3 and "a /  b " in nodes and not any(k.startswith("b") for k in nodes)
    tree = {r.id: r.value for r in rollups.hierarchy_tree(df, ["p", "q", "r"], "v").collect()}
    assert tree == {"a": 3, "a / x": 1, "a / b": 2, "b": 4, "b / c": 4}


def test_inventories(spark, tmp_path):
    doc = {
        "tables": [{"name": "fact sales", "source": "db.s"}, {"name": "FACT SALES", "source": "db.t"}],
        "dimensions": [{"name": "City Name", "expr": "city", "table": "S", "synonyms": ["town"]}],
        "metrics": [{"name": "rev", "expr": "SUM(x)", "page_name": "P1"}],
    }
    for k in range(2):
        (tmp_path / f"i{k}.json").write_text(json.dumps(doc))
    defs = inventory.read_inventories(spark, str(tmp_path))
    assert defs.count() == 4 and {r.name for r in defs.collect()} == {"CITY_NAME", "REV"}
    kept, errors = inventory.merge_inventories(inventory.read_inventory_tables(spark, str(tmp_path)), ["source_file", "position"])
    assert kept.count() == 1 and errors.count() == 3


def test_upsert_converges_and_keeps_unsupplied_columns(spark):
    target = frame(spark, [(1, "a", "kept"), (2, "b", "kept")], "k int, v string, steward string")
    updates = frame(spark, [(2, "B"), (3, "c")], "k int, v string")
    once = inventory.upsert(target, updates, ["k"])
    twice = inventory.upsert(once, updates, ["k"])
    want = [(1, "a", "kept"), (2, "B", "kept"), (3, "c", None)]
    assert sorted(map(tuple, once.collect())) == want == sorted(map(tuple, twice.collect()))


def test_stable_id_counts_nulls(spark):
    row = spark.range(1).select(inventory.stable_id(F.lit("a"), F.lit(None), F.lit("b")).alias("x"), inventory.stable_id(F.lit("a"), F.lit("b")).alias("y")).first()
    assert len(row.x) == 24 and row.x != row.y


def test_synthetic_rows_do_not_depend_on_partitioning(spark):
    one = inventory.synthesize(spark, {"amount": "number", "city": "text"}, 50, 2, {"fk": 7}, "id", seed=3)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, one.repartition(7).collect()))
    assert {r.fk for r in one.collect()} == set(range(1, 8))


def test_components_of_chains_and_loops(spark):
    edges = frame(spark, [(i, i + 1) for i in range(40)] + [(100, 100), (101, 102)], "src int, dst int")
    got = {r.node: r.component for r in definitions.components(edges).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == 100 and got[102] == 101


def test_impact_stops_in_cycles(spark):
    edges = frame(spark, [("a", "b"), ("b", "c"), ("c", "a")], "src string, dst string")
    got = {r.node: r.depth for r in catalog.impact(edges, frame(spark, [("a",)], "node string")).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_expression_rules(spark):
    df = frame(spark, [("Sales.Amount  + 1",), ("${view.field} + Tab.x",), (None,)], "e string")
    assert [r[0] for r in df.select(definitions.normalised_expression(F.col("e"))).collect()] == ["amount + 1", "${view.field} + x", ""]


def test_paths(spark):
    df = frame(spark, [(1, None), (2, 1), (3, 2), (8, 9), (9, 8)], "id int, up int")
    out = {r.id: r.path for r in col.paths(df, "id", "up").collect()}
    assert out == {1: "1", 2: "1|2", 3: "1|2|3"}


def test_long_chains_are_walked_to_their_ends(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(24)], "src long, dst long")
    start = spark.createDataFrame([(0,)], "node long")
    assert {r.node: r.depth for r in catalog.impact(edges, start).collect()} == {i: i for i in range(25)}
    with pytest.raises(RuntimeError, match="deeper"):
        catalog.impact(edges, start, max_depth=5)
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(52)], "id long, up long")
    assert col.paths(chain, "id", "up").agg(F.max("depth"), F.count("*")).first() == (52, 52)
    loop = spark.createDataFrame([(1, None), (1, 2), (2, 1)], "id long, up long")
    with pytest.raises(RuntimeError, match="under itself"):
        col.paths(loop, "id", "up")


def test_normal_distribution(spark):
    from math import erfc, sqrt

    points = [-40.0, -8.0, -7.0, -2.5, -0.1, 0.0, 0.3, 1.0, 3.0, 7.2, 9.0, 50.0]
    rows = spark.createDataFrame([(x,) for x in points] + [(None,)], "x double").select("x", col.norm_dist(F.col("x"), 0.0, 1.0).alias("p")).collect()
    assert all(r.p is None if r.x is None else abs(r.p - erfc(-r.x / sqrt(2)) / 2) <= 1e-14 for r in rows)


def test_rates_in_wide_brackets(spark):
    flows = [("high", 0, -1.0), ("high", 1, 51.0), ("low", 0, -1000.0), ("low", 1, 0.5), ("none", 0, 5.0), ("none", 1, 5.0), ("plain", 0, -100.0), ("plain", 1, 110.0)]
    got = {r.g: r.irr for r in aggregates.irr(spark.createDataFrame(flows, "g string, t int, amount double"), "g", "amount", "t").collect()}
    assert got["none"] is None and abs(got["high"] - 50) < 1e-9 and abs(got["low"] + 0.9995) < 1e-9 and abs(got["plain"] - 0.1) < 1e-9


def test_ranks_of_frequent_values(spark):
    rows = [(i, 5.0) for i in range(500)] + [(1000 + i, float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(5)
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    got = {r.k: (r["rank"], r.running) for r in windows.prefix_sums(df, "v", "k", 16).collect()}
    total = 0.0
    for place, (k, v) in enumerate(order, 1):
        total += v
        assert got[k] == (place, total)
    ranges = windows.prefix_sums(spark.createDataFrame(rows[:500], "k long, v double"), "v", "k", 16)
    assert ranges.agg(F.max("rank"), F.max("running")).first() == (500, 2500.0)
    values = sorted(v for _, v in rows)
    for r in windows.value_ranks(df, "v", parts=8).collect():
        assert (r.before, r.c, r.n) == (values.index(r.v), values.count(r.v), 800)
    assert aggregates.spearman(df.withColumn("w", -F.col("v")), "v", "w").first()[0] == pytest.approx(-1)
    assert aggregates.percentile_exclusive(df, "v", 0.5).first()[0] == 5.0
    assert aggregates.percentile_exclusive(df.limit(0), "v", 0.5, ["k"]).count() == 0


def test_any_number_of_months_back(spark):
    from datetime import date

    low, high = timewin.bounds("30 mon", "2000-02-29")
    assert spark.range(1).select(low, high).first() == (date(1997, 8, 1), date(1997, 8, 31))
    with pytest.raises(ValueError):
        timewin.bounds("0 mon", "2000-02-29")
