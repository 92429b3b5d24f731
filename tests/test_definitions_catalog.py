"""Labels of definitions, large name groups, issue severities, security and scope summaries."""

from __future__ import annotations

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from metricspark.operators import catalog, definitions

DEFS = "kind string, name string, tbl string, expr string, page_name string, dashboard_name string, source_file string, widget_name string"
M = ("sys", "m")
MODEL = "source_system string, source_model string"


@pytest.fixture(scope="module")
def defs(spark):
    return spark.createDataFrame(
        [
            ("metric", "a", "t", "x", "P1, P2 ,", "D9", None, "w1, unknown"), ("fact", "b", "t", "x", "P1", None, None, None), ("dimension", "c", "u", "x", "", "D1, D2", "f", None),
            ("metric", "d", "u", "x", None, " ", "file.csv", None), ("fact", "e", "u", "x", None, None, None, None), ("fact", "a", "t", "y", None, None, None, None),
        ],
        DEFS,
    )


def test_every_definition_has_a_label(defs):
    got = {(r.field, r.page) for r in definitions.field_labels(defs).collect()}
    assert got == {("t.a", "P1"), ("t.a", "P2"), ("t.b", "P1"), ("u.c", "D1, D2"), ("u.d", "file.csv"), ("u.e", "(model-only)"), ("t.a", "(model-only)")}
    rows = {r.page: (r.n_fields, r.n_unique, r.n_shared, r.n_dimensions, r.n_facts, r.n_metrics) for r in definitions.coverage_by_dashboard(defs).collect()}
    assert rows == {"P1": (2, 1, 1, 0, 1, 1), "P2": (1, 0, 1, 0, 0, 1), "D1, D2": (1, 1, 0, 1, 0, 0), "file.csv": (1, 1, 0, 0, 0, 1), "(model-only)": (2, 1, 1, 0, 2, 0)}


def test_pairs_and_what_differs(defs):
    got = {(r.page_a, r.page_b): (r.n_shared, r.shared_fields, r.jaccard) for r in definitions.similarity(defs).collect()}
    assert got == {("P1", "P2"): (1, ["t.a"], 0.5), ("(model-only)", "P1"): (1, ["t.a"], 0.3333), ("(model-only)", "P2"): (1, ["t.a"], 0.5)}
    assert definitions.similarity(defs, zero_pairs=True).count() == 10
    summary = definitions.similarity_summary(defs).first()
    assert (summary.n_pages, summary.n_pairs, summary.average, summary.largest) == (5, 10, 0.1333, 0.5)
    rows = [(r.page_a, r.page_b, r.n_only_a, r.n_only_b, r.only_in_a, r.only_in_b) for r in definitions.consolidation(defs, 0.3).collect()]
    assert rows == [("P1", "P2", 1, 0, ["b"], [])]


def test_page_profiles_list_what_they_show(defs):
    rows = {r.page: (r.n_fields, r.n_facts, r.n_metrics, r.tables, r.widgets, r.dashboards) for r in definitions.page_profiles(defs).collect()}
    assert rows == {"P1": (2, 1, 1, ["t"], ["w1"], ["D9"]), "P2": (1, 0, 1, ["t"], ["w1"], ["D9"])}


def test_definitions_without_optional_columns(spark):
    plain = spark.createDataFrame([("fact", "a", "t", "x", None)], "kind string, name string, tbl string, expr string, page_name string")
    assert [r.page for r in definitions.field_labels(plain).collect()] == ["(model-only)"]
    assert definitions.page_profiles(plain).count() == 0
    assert definitions.similarity_summary(plain).first().n_pairs == 0


@pytest.mark.parametrize("tile", [2, 7, 1000])
def test_pair_sums_of_any_tile(spark, tile):
    rng = random.Random(tile)
    names = ["_".join(rng.sample(["net", "total", "sum", "year", "x1", "x2"], rng.randint(1, 4))) for _ in range(60)]
    rows = [("fact", n, "t", rng.choice(["a", "b"]), None) for n in names]
    frame = spark.createDataFrame(rows, "kind string, name string, tbl string, expr string, page_name string")
    sets = frame.groupBy(F.col("expr").alias("norm_expr"), F.array_sort(definitions.name_tokens(F.col("name"))).alias("tokens")).agg(F.count("*").cast("double").alias("w"))
    got = {r.norm_expr: r.s for r in definitions.pair_sums(sets, tile).collect()}
    for e in "ab":
        tokens = [frozenset(re.findall("[a-z0-9]+", n)) for _, n, _, x, _ in rows if x == e]
        want = sum(len(x & y) / len(x | y) for x, y in itertools.combinations(tokens, 2) if x != y)
        assert got[e] == pytest.approx(want, rel=1e-5)


def test_many_names_of_one_expression(spark):
    rows = spark.range(6000).select(F.lit("fact").alias("kind"), F.concat(F.lit("total_"), F.col("id"), F.lit("_n"), F.col("id") % 40).alias("name"), F.lit("t").alias("tbl"), F.lit("x").alias("expr"))
    one = definitions.categorise(rows).first()
    same, pairs = 40 * 150 * 149 / 2, 6000 * 5999 / 2
    assert one.n_items == 6000 and one.name_similarity == round((same * 2 / 4 + (pairs - same) / 5) / pairs, 4)


def test_issues_follow_the_stated_severities(spark):
    flagged = spark.createDataFrame([(*M, "a", "empty expression", None), (*M, "b", "on the fiscal calendar", "SUM(x)"), (*M, "c", "odd function", "f(x)"), (*M, "d", None, "y")], f"{MODEL}, name string, reason string, expression string")
    rel = spark.createDataFrame(
        [(*M, "r1", "a", "b", "valid", True), (*M, "r2", "a", "c", "needsReevaluation", True), (*M, "r3", "b", "c", "invalid", False), (*M, "r4", "b", "c", None, False), (*M, "r5", "b", "c", "", False)],
        f"{MODEL}, relationship_name string, left_entity string, right_entity string, source_status string, is_simple_equality boolean",
    )
    metric = spark.createDataFrame([(*M, "m_FY21"), (*M, "m_FY22"), (*M, "n")], f"{MODEL}, metric_name string")
    packages = spark.createDataFrame([(*M, "p", "/x", True), (*M, "q", None, True), (*M, "r", "/x", False)], f"{MODEL}, package_name string, folder_path string, is_role_based boolean")
    rows = {(r.severity, r.category, r.object_kind, r.object_name, r.issue, r.detail) for r in catalog.issues(flagged, rel, metric, packages).collect()}
    assert rows == {
        ("risk", "source_model_defect", "metric", "a", "Metric has no expression in the source model", "empty expression"),
        ("blocker", "needs_decision", "metric", "b", "Metric depends on the fiscal calendar", "SUM(x)"),
        ("risk", "unconvertible", "term", "c", "odd function", "f(x)"),
        ("risk", "unconvertible", "term", "d", "", "y"),
        ("risk", "stale_metadata", "relationship", "2 relationships", "2 of 5 relationships are not flagged valid by the source tool", "1 simple equality joins; a->c [needsReevaluation]; b->c [invalid]"),
        ("note", "source_model_defect", "model", "m", "3 metrics collapse to 2 distinct patterns (1.5x duplication)", "2 cloned objects; 2 role-based package exports"),
    }
    assert catalog.issues(flagged.limit(0), rel.filter("source_status = 'valid'"), metric.filter("metric_name = 'n'")).count() == 0


def test_security_summaries(spark):
    rules = spark.createDataFrame(
        [("p", "g", ["Region Level 4", "a-b"]), ("q", "g", ["REGION_LEVEL4", "A B"]), ("q", None, ["region level 5", "a_b"]), ("r", "", [])], "principal string, role_group string, columns array<string>"
    )
    assert {(r["shape"], r.n_rules, r.n_principals) for r in catalog.security_shapes(rules).collect()} == {("A_B,REGION_LEVEL4", 2, 2), ("A_B,REGION_LEVEL5", 1, 1), ("", 1, 1)}
    assert {(r["shape"], r.n_rules) for r in catalog.security_shapes(rules, general=True).collect()} == {("A_B,REGION_LEVEL#", 3), ("", 1)}
    assert {(r.role_group, r.n_rules, r.n_principals, *r.levels) for r in catalog.security_by_role(rules).collect()} == {("g", 2, 2, "REGION_LEVEL4"), ("(none)", 2, 2, "REGION_LEVEL5")}
    rows = [("c_1", f"a.{k}") for k in range(9)] + [("C 1", "plain"), ("d", "x.y"), ("d", "z"), ("d", None), (None, "v"), ("c-1", "a.1")]
    values = {r.column: (r.n_values, r.is_hierarchical) for r in catalog.security_values(spark.createDataFrame(rows, "column_name string, column_value string")).collect()}
    assert values == {"C1": (10, True), "D": (2, False)}


def test_grains_in_and_outside_the_scope(spark):
    grain = spark.createDataFrame([("Sales_FY22", True), ("SALES", False), ("shops", True)], "entity_name string, double_count_risk boolean")
    scope = spark.createDataFrame([("sales",), ("Sales_FY21",), ("people",)], "entity_name string")
    r = catalog.grain_scope(grain, scope).first()
    assert (r.n_in_scope, r.n_out_of_scope, r.n_risky, r.n_with_grain, r.n_entities, r.n_without_grain) == (2, 1, 1, 1, 2, 1)
