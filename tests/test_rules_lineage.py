"""Rule tables and lineage: single cases, odd rows, cycles."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from metricspark.operators import lineage, rules


def decided(spark, source: str, rows: list[tuple], schema: str = "expr string") -> list[tuple]:
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], f"k int, {schema}")
    return [(r.rule, r.tier) for r in rules.decide(frame, rules.TABLES[source]).orderBy("k").collect()]


def test_the_first_rule_decides_wherever_it_matches(spark):
    texts = ["ZN(1) + window_sum(x)", "x" * 50, None, "", "  ", "ZN (1)", "{ fixed a}", "{Fixed a : ZN(1)}", "SCRIPT_REAL(1) + BUFFER(2)", "MYZN(1)"]
    got = [r for r, _ in decided(spark, "tableau", [(t,) for t in texts])]
    assert got == ["table calculation", None, None, None, None, "function to map", None, "level of detail", "spatial function", None]


def test_words_need_no_parenthesis(spark):
    got = decided(spark, "powerbi", [("all",), ("ALLOY",), ("PERCENTILE.INC(x)",), ("PERCENTILEX.INC(x)",), ("Value + Npv",)])
    assert [r for r, _ in got] == ["filter context or table function", None, "statistics", "filter context or table function", "financial function"]


def test_unknown_functions_are_flagged(spark):
    got = decided(spark, "cognos", [("f(x)",), ("a + b",), ("trim(f(x))",), ("f(lead(x))",), ("#a# ",), ("a -> [b]",)])
    assert got == [
        ("unknown function", "needs_translation"), (None, "simple"), ("function to map", "needs_translation"), ("dimensional function", "manual_required"), ("macro", "manual_required"), ("member reference", "manual_required"),
    ]


def test_depths(spark):
    rows = [
        ("SELECT (SELECT (SELECT (SELECT 1)))", "VIEW", 0),
        ("SELECT (SELECT 1), ((SELECT 2), (SELECT 3)), f(((SELECT 4)))", "VIEW", 0),
        ("'(SELECT (SELECT (SELECT'", "VIEW", 0),
        (")))) (SELECT 1", "VIEW", 0),
        ("CASE CASE CASE", "VIEW", 0),
        ("CASE END CASE END CASE \"CASE\" 'CASE'", "VIEW", 0),
        ("x", "VIEW", 5),
        ("refresh", "MATERIALIZED", 9),
        ("refresh ADDDAY(1)", "INTERFACE", 9),
        (None, None, None),
    ]
    got = [r for r, _ in decided(spark, "denodo", rows, "expr string, view_type string, n_joins int")]
    assert got == ["deep subquery", None, None, None, "deep case", None, "many joins", "refreshed materialization", "interface", None]


@pytest.mark.parametrize(("text", "n"), [("DECODE(a,b,c)", 3), ("x DECODE (a, f(b, c), 'd', e) + g(1,2,3)", 4), ("decode(", 1), ("coalesce(a,b)", 0), ("DECODE((a,b),(c,d)) DECODE(1,2,3)", 2)])
def test_decode_arguments(spark, text, n):
    assert spark.createDataFrame([(text,)], "x string").selectExpr(rules.DECODE_ARGUMENTS.format(text="x")).first()[0] == n


def test_field_types(spark):
    schema = "expr string, field_type string, is_native_derived boolean, is_group boolean, has_filters boolean"
    rows = [("x", "Sum", False, False, False), ("x", "sum", False, False, True), ("${a.b}", "number", False, False, False), ("{{x}}", "sum", False, False, False), ("x", None, None, None, None), ("x", "date_raw", False, True, True)]
    assert [r for r, _ in decided(spark, "looker", rows, schema)] == ["plain type", "filtered measure", "number across views", "template", None, "dimension type"]


def test_a_rule_has_one_kind():
    with pytest.raises(ValueError, match="names, a pattern or a condition"):
        rules.Rule("x", "simple", calls="A", pattern="B")
    with pytest.raises(ValueError, match="share a name"):
        rules.RuleTable("s", [rules.Rule("x", "simple", calls="A"), rules.Rule("x", "simple", calls="B")])


# ---------------------------------------------------------------- lineage

M = ("sys", "m")


@pytest.fixture(scope="module")
def catalog(spark):
    entity = spark.createDataFrame([(*M, "orders", "T_ORDERS"), (*M, "shops", None), ("sys", "other", "orders", "T_OTHER")], "source_system string, source_model string, entity_name string, physical_object string")
    term = spark.createDataFrame(
        [
            (*M, "orders", "price", "C_PRICE"), (*M, "orders", "count", "C_COUNT"), (*M, "orders", "net", None), (*M, "orders", "gross", None), (*M, "orders", "tax", None),
            (*M, "shops", "count", "C_SHOPS"), (*M, "shops", "size_FY21", "C_SIZE"), (*M, "shops", "name", ""), ("sys", "other", "orders", "lonely", "C_LONELY"),
        ],
        "source_system string, source_model string, entity_name string, term_name string, physical_column string",
    )
    term_refs = spark.createDataFrame(
        [
            (*M, "orders", "net", None, "price"), (*M, "orders", "net", "", "tax"), (*M, "orders", "tax", "orders", "gross"), (*M, "orders", "gross", None, "net"),
            (*M, "shops", "name", "orders", "count"), (*M, "shops", "name", None, "size_FY22"), (*M, "shops", "name", None, "lonely"), (*M, "shops", "name", None, None),
        ],
        "source_system string, source_model string, entity_name string, term_name string, ref_object string, ref_item string",
    )
    metric_refs = spark.createDataFrame(
        [(*M, "revenue", None, "net"), (*M, "revenue", None, "net"), (*M, "heads", None, "count"), (*M, "heads", "elsewhere", "price"), (*M, "none", "x", "y")],
        "source_system string, source_model string, metric_name string, ref_object string, ref_item string",
    )
    return entity, term, term_refs, metric_refs


def test_references_resolve_to_the_nearest_scope(catalog):
    got = {(r.from_name, r.to_name, r.to_entity, r.resolution, r.n_matches) for r in lineage.lineage_edges(*catalog).filter("edge_type <> 'binds_to'").collect()}
    assert got == {
        ("net", "price", "orders", "entity", 1), ("net", "tax", "orders", "entity", 1), ("tax", "gross", "orders", "entity", 1), ("gross", "net", "orders", "entity", 1),
        ("name", "count", "orders", "entity", 1), ("name", "size_FY21", "shops", "canonical", 1), ("name", "lonely", "", "missing", 0),
        ("revenue", "net", "orders", "model", 1), ("heads", "count", "", "ambiguous", 2), ("heads", "price", "orders", "model", 1), ("none", "y", "x", "missing", 0),
    }


def test_chains_through_calculated_terms_reach_their_columns(catalog):
    edges = lineage.lineage_edges(*catalog)
    got = {(r.from_name, r.column_name, r.depth) for r in lineage.origins(edges).filter("from_kind = 'metric'").collect()}
    assert got == {("revenue", "C_PRICE", 3), ("heads", "C_PRICE", 2)}
    changed = catalog[1].selectExpr("source_system", "source_model", "entity_name as entity", "physical_column as name").filter("name = 'C_PRICE'")
    broken = {(r.kind, r.name, r.depth) for r in lineage.breaks(edges, changed).collect()}
    assert broken == {("term", "price", 1), ("term", "net", 2), ("term", "gross", 3), ("term", "tax", 4), ("metric", "revenue", 3), ("metric", "heads", 2)}


def test_the_view_reads_the_edges_as_they_stand(catalog):
    rows = lineage.lineage_view(lineage.lineage_edges(*catalog), catalog[0]).collect()
    assert {r.fully_qualified_target for r in rows} == {None, "T_ORDERS.C_PRICE", "T_ORDERS.C_COUNT", "T_OTHER.C_LONELY"}
    assert len(rows) == lineage.lineage_edges(*catalog).count()


def closure(edges: set[tuple[int, int]]) -> dict[int, set[int]]:
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b]
    out = {}
    for n in near:
        seen, todo = set(), [n]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        out[n] = seen
    return out


@pytest.mark.parametrize("seed", range(4))
def test_components_and_reach_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = {(rng.randint(0, 24), rng.randint(0, 24)) for _ in range(rng.choice([12, 25, 40]))}
    want = closure(edges)
    frame = spark.createDataFrame(sorted(edges), "src long, dst long")
    components = {r.node: r.component for r in lineage.strong_components(frame).collect()}
    assert components == {n: min({m for m in want[n] if n in want[m]} | {n}) for n in want}
    got = {r.node: (r.component_size, r.n_reached) for r in lineage.reach(frame).collect()}
    assert got == {n: (len({m for m in want[n] if n in want[m]} | {n}), len(want[n] - {n})) for n in want}


def test_graphs_without_edges_and_long_rings(spark):
    none = spark.createDataFrame([], "src long, dst long")
    assert lineage.strong_components(none).count() == lineage.reach(none).count() == 0
    ring = spark.range(12).select(F.col("id").alias("src"), ((F.col("id") + 1) % 12).alias("dst"))
    assert {(r.component, r.component_size, r.n_reached) for r in lineage.reach(ring).collect()} == {(0, 12, 11)}
    assert {r.depth for r in lineage.trace(ring, spark.range(1).toDF("node")).collect()} == set(range(12))
