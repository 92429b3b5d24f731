"""Peers, running aggregates and datasets in several roles, against plain loops and on odd rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from metricspark.operators import ranges
from metricspark.operators.ranges import Span
from metricspark.plans.model import Dataset, Field, Metric, Model, ModelError, Relationship

SCHEMA = "id int, g string, x int, y double, v long"


def rows_of(seed: int, n: int = 120) -> list[tuple]:
    rng = random.Random(seed)
    pick = lambda *v: rng.choice(v)
    return [(k, pick("a", "a", "a", "b", None), pick(*range(8), None), pick(0.5, 1.0, 1.5, 2.0, None), pick(1, 2, 3, None)) for k in range(n)]


def loop(rows, meets):
    out = {}
    for k, g, x, y, _ in rows:
        peers = [p for p in rows if p[1] == g and p[2] is not None and x is not None and meets((x, y), (p[2], p[3]))]
        values = [p[4] for p in peers if p[4] is not None]
        out[k] = (len(peers), sum(values) if values else None, max(values, default=None), min(values, default=None))
    return out


AGGREGATES = {"n": ("count", "id"), "total": ("sum", "v"), "most": ("max", "v"), "least": ("min", "v")}


def asked(spark, rows, spans, values=None, by=("g",)):
    values = values or AGGREGATES
    out = ranges.peers(spark.createDataFrame(rows, SCHEMA).repartition(3), list(by), spans, values)
    return {r.id: tuple(r[n] for n in values) for r in out.collect()}


@pytest.mark.parametrize(
    ("span", "meets"),
    [
        (Span("x", high="x", high_open=True), lambda o, p: p[0] < o[0]),
        (Span("x", low="x"), lambda o, p: p[0] >= o[0]),
        (Span("x", "x - 2", "x + 1"), lambda o, p: o[0] - 2 <= p[0] <= o[0] + 1),
        (Span("x", "x - 2", "x", True, True), lambda o, p: o[0] - 2 < p[0] < o[0]),
        (Span("x", "x / 2", "x - 0.5"), lambda o, p: o[0] / 2 <= p[0] <= o[0] - 0.5),
        (Span("x", "x + 1", "x - 1"), lambda o, p: False),
    ],
)
def test_peers_in_one_span(spark, span, meets):
    rows = rows_of(1)
    assert asked(spark, rows, [span]) == loop(rows, meets)


@pytest.mark.parametrize(
    ("second", "meets", "kinds"),
    [
        (Span("y", high="y", high_open=True), lambda o, p: p[1] < o[1], "n total most least"),
        (Span("y", low="y"), lambda o, p: p[1] >= o[1], "n total most least"),
        (Span("y", low="y", low_open=True), lambda o, p: p[1] > o[1], "n total most least"),
        (Span("y", "y - 0.5", "y + 0.5", high_open=True), lambda o, p: o[1] - 0.5 <= p[1] < o[1] + 0.5, "n total"),
    ],
)
def test_peers_in_two_spans(spark, second, meets, kinds):
    rows = rows_of(2)
    kinds = {k: AGGREGATES[k] for k in kinds.split()}
    both = lambda o, p: p[0] <= o[0] + 1 and o[1] is not None and p[1] is not None and meets(o, p)
    want = {k: v[: len(kinds)] for k, v in loop(rows, both).items()}
    assert asked(spark, rows, [Span("x", high="x + 1"), second], kinds) == want


def test_peers_of_odd_tables(spark):
    assert asked(spark, [], [Span("x", low="x")]) == {}
    assert asked(spark, [(1, "a", None, None, 1)], [Span("x", low="x")]) == {1: (0, None, None, None)}
    same = [(7, "a", 1, 1.0, 2)] * 3
    assert asked(spark, same, [Span("x", "x", "x")]) == {7: (3, 6, 2, 2)}
    assert asked(spark, same, [Span("x", "x", "x")], by=()) == {7: (3, 6, 2, 2)}
    with pytest.raises(ValueError, match="one end of the second span"):
        asked(spark, same, [Span("x", low="x"), Span("y", "y", "y")])
    with pytest.raises(ValueError, match="a span has an end"):
        Span("x")


def test_peers_compare_no_pairs(spark):
    df = spark.createDataFrame(rows_of(3), SCHEMA)
    plan = ranges.peers(df, ["g"], [Span("x", "x - 2", "x + 1")], AGGREGATES)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("asks", [3, 1 << 18])
@pytest.mark.parametrize(
    ("spans", "meets", "kinds"),
    [
        ([Span("x", "x - 2", "x + 1")], lambda o, p: o[0] - 2 <= p[0] <= o[0] + 1, "n total most least"),
        ([Span("x", high="x", high_open=True)], lambda o, p: p[0] < o[0], "n total most least"),
        ([Span("x", low="x"), Span("y", low="y", low_open=True)], lambda o, p: p[0] >= o[0] and p[1] > o[1], "n total most least"),
        ([Span("x", high="x + 1"), Span("y", "y - 0.5", "y + 0.5", high_open=True)], lambda o, p: p[0] <= o[0] + 1 and o[1] - 0.5 <= p[1] < o[1] + 0.5, "n total"),
        ([Span("x", high="x + 1"), Span("y", "y + 1", "y - 1")], lambda o, p: False, "n total"),
    ],
)
def test_peers_over_many_chunks(spark, monkeypatch, spans, meets, kinds, asks):
    """Chunks of 8 points: intervals end in them and pass over whole ones; with few intervals at a time, chunks are copied."""
    monkeypatch.setattr(ranges, "CHUNK_BITS", 3)
    monkeypatch.setattr(ranges, "CHUNK_ASKS", asks)
    rows = [(k, g, x if x is None else x + k % 11, y, v) for k, g, x, y, v in rows_of(5, 200)]
    kinds = {k: AGGREGATES[k] for k in kinds.split()}
    whole = lambda o, p: (len(spans) == 1 or None not in (o[1], p[1])) and meets(o, p)
    assert asked(spark, rows, spans, kinds) == {k: v[: len(kinds)] for k, v in loop(rows, whole).items()}


def test_peers_copy_no_points_of_small_groups(spark, monkeypatch):
    """Each point and each end of a span is sorted once; only spans over whole chunks need points once for every level of blocks."""
    sorted_rows, run = [], ranges.running
    monkeypatch.setattr(ranges, "running", lambda df, *a, **b: sorted_rows.append(df.count()) or run(df, *a, **b))
    df = spark.range(4000).selectExpr("id", "id % 400 as g", "id as x", "id * 7 % 31 as y")
    ranges.peers(df, ["g"], [Span("x", high="x"), Span("y", low="y")], {"n": ("count", "id")})
    assert sum(sorted_rows) == 8000


def test_peers_of_odd_types(spark):
    """Decimals past 64 bits, endless doubles, texts and days; a sum is no difference that an endless value spoils."""
    rows = [(k, f"2000-01-{k % 9 + 1:02}", "9" * 20 + ".25" if k % 3 else f"-{k}.5", float("inf") if k == 0 else k / 4, "äb"[k % 2] + str(k)) for k in range(40)]
    df = spark.createDataFrame(rows, "id int, d string, m string, f double, s string").selectExpr("id", "date(d) d", "cast(m as decimal(26,2)) m", "f", "s")
    out = ranges.peers(df, [], [Span("d", "date_add(d, 1)", "date_add(d, 2)")], {"sum_m": ("sum", "m"), "sum_f": ("sum", "f"), "min_s": ("min", "s"), "max_d": ("max", "d")})
    met = F.expr("p.d between date_add(o.d, 1) and date_add(o.d, 2)")
    want = df.alias("o").join(df.alias("p"), met, "left").groupBy("o.id").agg(F.expr("sum(p.m) as sum_m"), F.expr("sum(p.f) as sum_f"), F.expr("min(p.s) as min_s"), F.expr("max(p.d) as max_d"))
    assert sorted(out.select(want.columns).collect()) == sorted(want.collect())


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_running_is_the_same_for_any_number_of_ranges(spark, parts):
    rows = [(k, *r[1:]) for k, r in enumerate(rows_of(4))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = ranges.running(df, ["g"], [F.desc_nulls_last("x"), F.col("id")], {"s": ("sum", "v"), "m": ("max", "v")}, parts)
    seen, want = {}, {}
    for r in sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0])):
        have = seen.setdefault(r[1], [])
        have.extend([] if r[4] is None else [r[4]])
        want[r[0]] = (sum(have) if have else None, max(have, default=None))
    assert {r.id: (r.s, r.m) for r in got.collect()} == want


# ---------------------------------------------------------------- roles


@pytest.fixture(scope="module")
def trade(spark):
    sale = spark.createDataFrame([(1, 1, 2, "x", 5), (2, 1, 1, "y", 7), (3, 2, 3, "x", 1), (4, None, 1, "x", 2)], "id int, seller int, buyer int, name string, v int")
    person = spark.createDataFrame([(1, 10, "ann", None), (2, 20, "bo", 1), (3, 20, "cy", 2)], "pid int, cid int, name string, boss int")
    city = spark.createDataFrame([(10, "rome"), (20, "oslo")], "cid int, name string")
    return Model(
        [
            Dataset("sale", sale, metrics=[Metric("total", "sum", "v"), Metric("ids", "list", "id", args=("id desc", "+")), Metric("odd", "list", "v", "v % 2 = 1", ("v", "'", "distinct"))]),
            Dataset("person", person, key=["pid"]),
            Dataset("city", city, key=["cid"]),
        ],
        [
            Relationship("sold_by", "sale", "person", [("seller", "pid")], role="seller"),
            Relationship("bought_by", "sale", "person", [("buyer", "pid")], role="buyer"),
            Relationship("lives", "person", "city", [("cid", "cid")]),
            Relationship("reports", "person", "person", [("boss", "pid")], role="boss", active=False),
        ],
    )


def test_two_roles_of_one_dataset(trade):
    rows = trade.query(["sale.total"], ["seller.name", "buyer.name"]).collect()
    assert {(r.seller__name, r.buyer__name, r.total) for r in rows} == {("ann", "bo", 5), ("ann", "ann", 7), ("bo", "cy", 1), (None, "ann", 2)}


def test_a_role_has_joins_of_its_own(trade):
    rows = trade.query(["sale.total"], ["seller.city.name", "buyer.city.name", "sale.name"], where="buyer__city__name <> 'paris' and sale__v < 7").collect()
    assert {(r.seller__city__name, r.buyer__city__name, r.name, r.total) for r in rows} == {("rome", "oslo", "x", 5), ("oslo", "oslo", "x", 1), (None, "rome", "x", 2)}


def test_a_role_that_is_not_active_must_be_named(trade):
    rows = trade.query(["sale.total"], ["buyer.boss.name"]).collect()
    assert {(r.buyer__boss__name, r.total) for r in rows} == {("ann", 5), (None, 9), ("bo", 1)}


@pytest.mark.parametrize("dims", [["person.name"], ["city.name"], ["nobody.name"], ["seller.absent"], ["seller.name", "seller.name"]])
def test_roles_that_are_refused(trade, dims):
    with pytest.raises(ModelError):
        trade.query(["sale.total"], dims)


def test_the_error_names_the_choices(trade):
    with pytest.raises(ModelError, match="name one of buyer.city, seller.city"):
        trade.query(["sale.total"], ["city.name"])


def test_lists_are_ordered(trade):
    rows = trade.query(["sale.ids", "sale.odd"], ["sale.name"]).collect()
    assert {(r.name, r.ids, r.odd) for r in rows} == {("x", "4+3+1", "1'5"), ("y", "2", "7")}
    with pytest.raises(ModelError, match="needs an order"):
        Metric("l", "list", "id")


def test_unqualified_names_stay(spark):
    a = Dataset("a", spark.createDataFrame([(1, 2)], "k int, b_k int"), metrics=[Metric("n", "count", "k")])
    b = Dataset("b", spark.createDataFrame([(2, "z")], "b_id int, label string"), [Field("b_id"), Field("label")], key=["b_id"])
    out = Model([a, b], [Relationship("r", "a", "b", [("b_k", "b_id")])]).query(["a.n"], ["b.label"])
    assert out.columns == ["label", "n"]
