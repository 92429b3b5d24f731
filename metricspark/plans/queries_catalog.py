"""Queries of sources, catalog views and definition analytics over projected fixtures.

Fixtures are projected from the driver's tables by one SQL text that both
engines run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.operators import catalog as cat
from metricspark.operators import definitions as dfn
from metricspark.operators import joins as jn
from metricspark.operators import lineage as lin
from metricspark.plans.registry import query, table
from metricspark.sources import inventory as inv
from metricspark.sources import star

FIXTURES = {
    "fx_definitions": (
        "part",
        "SELECT CAST(p_partkey AS BIGINT) AS ord, CASE WHEN p_partkey % 3 = 0 THEN 'dimension' WHEN p_partkey % 3 = 1 THEN 'fact' ELSE 'metric' END AS kind, upper(replace(p_name, ' ', '_')) AS name, p_brand AS tbl, "
        "CASE WHEN p_partkey % 3 = 2 THEN concat('SUM(', p_type, '.SIZE_', CAST(p_size AS VARCHAR(20)), ')') ELSE concat(p_type, '.', 'SIZE_', CAST(p_size AS VARCHAR(20))) END AS expr, "
        "CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat('PAGE_', CAST(p_partkey % 7 AS VARCHAR(20)), ', PAGE_', CAST((p_partkey + p_size) % 11 AS VARCHAR(20))) END AS page_name, "
        "CASE WHEN p_partkey % 10 = 0 THEN concat('DASH_', CAST(p_size % 3 AS VARCHAR(20))) WHEN p_partkey % 5 <> 0 THEN concat('DASH_', CAST(p_size % 4 AS VARCHAR(20)), ', DASH_', CAST(p_partkey % 4 AS VARCHAR(20))) END AS dashboard_name, "
        "CASE WHEN p_partkey % 15 = 0 THEN concat('FILE_', CAST(p_size % 2 AS VARCHAR(20))) END AS source_file, concat('W_', CAST(p_size % 6 AS VARCHAR(20)), ', unknown') AS widget_name FROM part",
    ),
    "fx_similar": (
        "part",
        "SELECT CAST(p_partkey AS BIGINT) AS ord, 'metric' AS kind, concat(upper(p_type), '_TOTAL_NET_', CAST(p_size % 12 AS VARCHAR(20))) AS name, p_brand AS tbl, concat('X', CAST(p_size AS VARCHAR(20))) AS expr, '' AS page_name FROM part",
    ),
    "fx_entity": (
        "supplier",
        "SELECT 'sys' AS source_system, concat('MODEL_', CAST(s_nationkey % 3 AS VARCHAR(20))) AS source_model, "
        "CASE WHEN s_suppkey % 4 = 0 THEN concat('ENT_', CAST(s_suppkey % 10 AS VARCHAR(20)), '_FY', CAST(20 + s_suppkey % 5 AS VARCHAR(20)), '') ELSE concat('ENT_', CAST(s_suppkey AS VARCHAR(20))) END AS entity_name, "
        "max(CASE WHEN s_acctbal > 0 THEN concat('T_', CAST(s_suppkey AS VARCHAR(20))) END) AS physical_object, max(concat('conn_', CAST(s_nationkey % 5 AS VARCHAR(20)), CASE WHEN s_nationkey % 2 = 0 THEN '_oracle' ELSE '_pg' END)) AS connection FROM supplier GROUP BY 1, 2, 3",
    ),
    "fx_term": (
        "part",
        "SELECT 'sys' AS source_system, concat('MODEL_', CAST(p_partkey % 3 AS VARCHAR(20))) AS source_model, concat('ENT_', CAST(p_partkey % 97 AS VARCHAR(20))) AS entity_name, "
        "concat(upper(p_type), CASE p_size % 5 WHEN 0 THEN '_ID' WHEN 1 THEN '_NUMBER' ELSE '_AMT' END, CAST(p_size % 3 AS VARCHAR(20)), CASE WHEN p_size % 5 = 0 THEN '_KEY' ELSE '' END) AS term_name, "
        "min(CASE (p_partkey * 7 + p_size) % 3 WHEN 0 THEN 'measure' WHEN 1 THEN 'identifier' ELSE 'attribute' END) AS term_role, min(CASE WHEN p_size % 6 = 0 THEN NULL ELSE concat('C_', CAST(p_size AS VARCHAR(20))) END) AS physical_column, min(p_brand) AS expression FROM part GROUP BY 1, 2, 3, 4",
    ),
    "fx_metric": (
        "part",
        "SELECT 'sys' AS source_system, concat('MODEL_', CAST(p_partkey % 3 AS VARCHAR(20))) AS source_model, concat('MET_', CAST(p_partkey AS VARCHAR(20))) AS metric_name, upper(p_type) AS metric_canonical, "
        "CASE WHEN p_size % 9 = 0 THEN 'unsupported' ELSE 'ratio' END AS metric_kind, CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('SUM(', p_brand, ')') END AS translated_expr, p_size % 7 = 0 AS requires_fiscal_calendar, p_brand AS expression FROM part",
    ),
    "fx_grain": (
        "part",
        "SELECT 'sys' AS source_system, concat('MODEL_', CAST(p_partkey % 3 AS VARCHAR(20))) AS source_model, concat('ENT_', CAST(p_partkey % 97 AS VARCHAR(20))) AS entity_name, concat('G_', CAST(p_partkey AS VARCHAR(20))) AS grain_name, p_size % 3 = 0 AS is_row_grain, p_size % 2 = 0 AS is_groupable, p_size % 4 + 1 AS n_keys FROM part",
    ),
    "fx_rule": (
        "part",
        "SELECT source_system, source_model, entity_name, term_name, regular_aggregate, rollup_aggregate, rollup_aggregate IN ('last', 'average') AS is_semi_additive FROM (SELECT 'sys' AS source_system, concat('MODEL_', CAST(p_partkey % 3 AS VARCHAR(20))) AS source_model, concat('ENT_', CAST(p_partkey % 97 AS VARCHAR(20))) AS entity_name, "
        "concat(upper(p_type), CASE p_size % 5 WHEN 0 THEN '_ID' WHEN 1 THEN '_NUMBER' ELSE '_AMT' END, CAST(p_size % 3 AS VARCHAR(20)), CASE WHEN p_size % 5 = 0 THEN '_KEY' ELSE '' END) AS term_name, min(CASE p_size % 4 WHEN 0 THEN 'count' WHEN 1 THEN 'max' ELSE 'sum' END) AS regular_aggregate, min(CASE p_size % 3 WHEN 0 THEN 'last' WHEN 1 THEN 'sum' ELSE 'average' END) AS rollup_aggregate FROM part GROUP BY 1, 2, 3, 4) x",
    ),
    "fx_rel": (
        "orders",
        "SELECT 'sys' AS source_system, concat('MODEL_', CAST(o_custkey % 3 AS VARCHAR(20))) AS source_model, concat('R_', CAST(o_orderkey AS VARCHAR(20))) AS relationship_name, concat('ENT_', CAST(o_custkey % 50 AS VARCHAR(20)), CASE WHEN o_custkey % 11 = 0 THEN '_FY21' ELSE '' END) AS left_entity, concat('ENT_', CAST(o_orderkey % 50 AS VARCHAR(20))) AS right_entity, "
        "CASE o_orderstatus WHEN 'F' THEN 'valid' WHEN 'P' THEN 'invalid' END AS source_status, o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_simple_equality FROM orders",
    ),
    "fx_mapping": (
        "customer",
        "SELECT DISTINCT 'sys' AS source_system, concat('MODEL_', CAST(c_nationkey % 3 AS VARCHAR(20))) AS source_model, concat('role_', CAST(c_nationkey % 4 AS VARCHAR(20))) AS principal, concat(CASE WHEN c_custkey % 3 = 0 THEN 'Region Level ' ELSE 'segment-' END, CAST(c_nationkey % 2 AS VARCHAR(20)), CAST(c_custkey % 10 AS VARCHAR(20))) AS column_name, CASE WHEN c_custkey % 3 = 0 THEN concat('R', CAST(c_nationkey AS VARCHAR(20)), '.', c_mktsegment) ELSE c_mktsegment END AS column_value, CASE WHEN c_nationkey % 4 = 3 THEN '' ELSE concat('group_', CAST(c_nationkey % 4 AS VARCHAR(20))) END AS role_group FROM customer",
    ),
    "fx_level": (
        "part",
        "SELECT DISTINCT 'sys' AS source_system, 'MODEL_0' AS source_model, p_type AS dimension_name, concat('H_', p_type) AS hierarchy_name, p_size % 5 AS level_ordinal, concat('L_', CAST(p_size % 5 AS VARCHAR(20))) AS level_name, p_size % 5 = 0 AS is_all_level FROM part",
    ),
    "fx_context": (
        "lineitem",
        "SELECT DISTINCT concat('CTX_', CAST(l_suppkey % 12 AS VARCHAR(20))) AS context, concat('T_', CAST((l_suppkey * 7 + l_partkey % 3) % 40 AS VARCHAR(20))) AS tbl FROM lineitem",
    ),
    "fx_refs": (
        "orders",
        "SELECT DISTINCT concat('OBJ_', CAST(o_custkey % 60 AS VARCHAR(20))) AS object, CASE WHEN o_custkey % 60 < 5 THEN NULL ELSE concat('T_', CAST((o_custkey % 60 + o_orderkey % 2) % 45 AS VARCHAR(20))) END AS tbl FROM orders",
    ),
    "fx_joins": (
        "lineitem",
        "SELECT DISTINCT concat(CASE WHEN l_suppkey % 3 = 0 THEN 'FACT_' ELSE 'TAB_' END, CAST(l_suppkey % 20 AS VARCHAR(20))) AS from_tbl, concat('DIM_', CAST(l_partkey % 9 AS VARCHAR(20))) AS to_tbl FROM lineitem",
    ),
}
_TERMS = FIXTURES["fx_term"][1]
# Within an entity, in the order of their names: four terms of five derive from the one before; the fifth closes the ring, or names a
# clone, a term that is not there or one of another entity.
FIXTURES["fx_term_refs"] = (
    "part",
    "SELECT source_system, source_model, entity_name, term_name, CASE WHEN rn % 5 <> 1 AND rn % 3 = 1 THEN entity_name WHEN rn % 3 = 0 THEN '' END AS ref_object, "
    "CASE WHEN rn % 5 <> 1 THEN before WHEN kind = 0 THEN behind WHEN kind = 1 THEN concat(term_name, '_FY21') WHEN kind = 2 THEN 'NO_SUCH_TERM' ELSE least_term END AS ref_item FROM (SELECT source_system, source_model, entity_name, term_name, "
    "row_number() OVER (PARTITION BY source_model, entity_name ORDER BY term_name) AS rn, lag(term_name) OVER (PARTITION BY source_model, entity_name ORDER BY term_name) AS before, lead(term_name, 4) OVER (PARTITION BY source_model, entity_name ORDER BY term_name) AS behind, "
    f"length(entity_name) + length(term_name) - 4 * CAST(floor((length(entity_name) + length(term_name)) / 4) AS INT) AS kind, min(term_name) OVER (PARTITION BY source_model) AS least_term FROM ({_TERMS}) t) x",
)
FIXTURES["fx_metric_refs"] = (
    "part",
    "SELECT 'sys' AS source_system, concat('MODEL_', CAST(p_partkey % 3 AS VARCHAR(20))) AS source_model, concat('MET_', CAST(p_partkey AS VARCHAR(20))) AS metric_name, CASE WHEN p_size % 2 = 0 THEN concat('ENT_', CAST(p_partkey % 97 AS VARCHAR(20))) END AS ref_object, "
    "concat(upper(p_type), CASE p_size % 5 WHEN 0 THEN '_ID' WHEN 1 THEN '_NUMBER' ELSE '_AMT' END, CAST(p_size % 3 AS VARCHAR(20)), CASE WHEN p_size % 5 = 0 THEN '_KEY' WHEN p_size % 7 = 0 THEN '_FY22' ELSE '' END) AS ref_item FROM part",
)
_SQL = {k: v[1] for k, v in FIXTURES.items()}


def fixture(spark, sf: str, name: str) -> DataFrame:
    """A fixture as Spark rows."""
    source, sql = FIXTURES[name]
    return spark.sql(sql.replace("VARCHAR(20)", "STRING").replace(f"FROM {source}", "FROM {t}"), t=table(spark, sf, source))


def _with(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({_SQL[n]})" for n in names) + " "


_K = "source_system, source_model"
_E = "source_system, source_model, entity_name"


# --- sources --------------------------------------------------------------------------------------------------------------


@query("src_merge_inventories", "SELECT p_partkey, p_brand AS name, CASE WHEN row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1 THEN 'kept' ELSE 'duplicate table ' || p_brand END AS outcome FROM part")
def _(spark, sf):
    kept, errors = inv.merge_inventories(table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("name")), ["p_partkey"])
    return kept.withColumn("outcome", F.lit("kept")).union(errors.withColumnRenamed("error", "outcome"))


@query("src_first_wins", "SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def _(spark, sf):
    return inv.first_wins(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("src_upsert", "SELECT coalesce(c.c_custkey, u.k) AS c_custkey, CASE WHEN u.k IS NOT NULL THEN u.seg ELSE c.c_mktsegment END AS c_mktsegment, c.c_name FROM customer c FULL JOIN (SELECT c_custkey + 1000 AS k, 'NEW' AS seg FROM customer WHERE c_custkey % 2 = 0) u ON c.c_custkey = u.k")
def _(spark, sf):
    target = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name")
    updates = target.filter("c_custkey % 2 = 0").select((F.col("c_custkey") + 1000).alias("c_custkey"), F.lit("NEW").alias("c_mktsegment"))
    return inv.upsert(target, updates, ["c_custkey"])


@query("src_stable_id", "SELECT c_custkey, substr(sha1(c_name || chr(1) || coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END, '') || chr(1) || CAST(c_custkey AS VARCHAR)), 1, 24) AS id FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", inv.stable_id(F.col("c_name"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")), F.col("c_custkey")).alias("id"))


@query("src_load_summary", _with("fx_definitions") + "SELECT tbl, 'load-1' AS load_id, " + ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ("dimension", "fact", "metric", "filter")) + " FROM fx_definitions GROUP BY 1")
def _(spark, sf):
    out = inv.load_summary(inv.stamp(fixture(spark, sf, "fx_definitions"), "load-1"), "tbl")
    return inv.stamp(out, "load-1").drop("loaded_at")


@query("src_synthesize", "SELECT c_custkey, CAST(2 AS BIGINT) AS n_rows, true AS in_range, CAST(2 AS BIGINT) AS n_keys FROM customer")
def _(spark, sf):
    """The synthetic sales of every customer: how many, whether their values are in range and their keys distinct."""
    customers = table(spark, sf, "customer").select("c_custkey")
    n = customers.count()  # as many parents as the table of this scale
    sales = inv.synthesize(spark, {"amount": "number", "sold_on": "date", "is_new": "boolean", "city": "text"}, n, 2, {"customer_id": n}, "sale_id", seed=7)
    good = F.col("amount").between(0, 1000) & F.col("sold_on").between("2020-01-01", "2023-12-31") & F.col("is_new").isNotNull() & F.col("city").rlike("^city_1?[0-9]$") & F.col("sale_id").between(1, 2 * n)
    per = sales.groupBy("customer_id").agg(F.count("*").alias("n_rows"), F.bool_and(good).alias("in_range"), F.count_distinct("sale_id").alias("n_keys"))
    return customers.join(per, F.pmod("c_custkey", F.lit(n)) + 1 == F.col("customer_id")).select("c_custkey", "n_rows", "in_range", "n_keys")



def _star(spark, sf) -> dict[str, DataFrame]:
    """Customers and orders as many as there are, with their distributions; a third of the orders goes to the first twelfth of the customers."""
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    n, m = customer.count(), orders.count()
    people = star.profile(customer, ["c_acctbal"], ["c_mktsegment"])
    trade = star.profile(orders, ["o_totalprice"], ["o_orderstatus", "o_orderpriority"])
    return star.generate(
        spark,
        [
            star.Table("orders", m, "order_id", trade | {"order_date": star.domain_of("order_date", "date"), "ship_date": star.Domain(after="order_date", spread=30), "is_new": star.domain_of("is_new", "boolean")}, {"customer_id": "customer"}, {"customer_id": 2.25}),
            star.Table("customer", n, "customer_id", people),
        ],
        seed=11,
    )


@query("src_star_keys", "SELECT (SELECT count(*) FROM orders) AS n_orders, (SELECT count(*) FROM orders) AS n_keys, (SELECT count(*) FROM customer) AS n_customers, CAST(0 AS BIGINT) AS n_orphans, CAST(0 AS BIGINT) AS n_out_of_order, true AS is_skewed")
def _(spark, sf):
    """Keys of the generated schema: distinct, wired, as many as in the given tables; dates in order; children skewed to the first parents."""
    made = _star(spark, sf)
    orders, customer = made["orders"], made["customer"]
    n = customer.agg(F.count_distinct("customer_id").alias("n_customers"))
    orphans = orders.join(customer, "customer_id", "left_anti").agg(F.count("*").alias("n_orphans"))
    late = F.count(F.when((F.col("ship_date") < F.col("order_date")) | (F.datediff("ship_date", "order_date") > 30), 1))
    first = orders.join(n).agg(
        F.count("*").alias("n_orders"), F.count_distinct("order_id").alias("n_keys"), late.alias("n_out_of_order"),
        F.avg((12 * F.col("customer_id") <= F.col("n_customers")).cast("int")).alias("share"),
    )
    return first.join(n).join(orphans).select("n_orders", "n_keys", "n_customers", "n_orphans", "n_out_of_order", F.col("share").between(0.28, 0.38).alias("is_skewed"))


_LABELLED = (("customer", "c_mktsegment"), ("orders", "o_orderpriority"), ("orders", "o_orderstatus"))


@query(
    "src_star_values",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS label, count(*) AS given, true AS is_near FROM {t} GROUP BY {c}" for t, c in _LABELLED)
    + " UNION ALL SELECT 'o_totalprice', CAST(k AS VARCHAR), (SELECT count(*) FROM orders), true FROM generate_series(1, 10) t(k)",
)
def _(spark, sf):
    """Histograms of the generated values: labels beside the given ones, prices over the deciles of the given prices.

    Counts are near where chance explains the difference (four standard deviations).
    """
    made, out = _star(spark, sf), None
    near = lambda given, got: (F.abs(F.coalesce(got, F.lit(0)) - given) <= 4 * F.sqrt(given) + 1).alias("is_near")
    for t, c in _LABELLED:
        given = table(spark, sf, t).groupBy(F.col(c).alias("label")).agg(F.count("*").alias("given"))
        got = made[t].groupBy(F.col(c).alias("label")).agg(F.count("*").alias("got"))
        one = given.join(got, "label", "left").select(F.lit(c).alias("column"), "label", "given", near(F.col("given"), F.col("got")))
        out = one if out is None else out.unionByName(one)
    deciles = table(spark, sf, "orders").agg(F.count("*").alias("given"), F.percentile_approx(F.col("o_totalprice").cast("double"), F.array(*[F.lit(k / 10) for k in range(1, 10)]), F.lit(100_000)).alias("d"))
    placed = made["orders"].join(F.broadcast(deciles)).select("given", (F.size(F.filter("d", lambda d: d < F.col("o_totalprice"))) + 1).cast("string").alias("label"))  # one row
    counts = placed.groupBy("label", "given").agg(F.count("*").alias("got"))
    return out.unionByName(counts.select(F.lit("o_totalprice").alias("column"), "label", "given", near(F.col("given") / 10, F.col("got"))))


# --- catalog -----------------------------------------------------------------------------------------------------------------


@query(
    "cat_glossary",
    _with("fx_term", "fx_entity", "fx_metric") + f"SELECT t.source_system, t.source_model, 'TERM' AS term_kind, term_name AS business_term, t.entity_name AS subject_area, term_role AS classification, physical_object, physical_column, physical_column IS NULL AS is_model_only, expression FROM fx_term t LEFT JOIN fx_entity e USING ({_E}) "
    f"UNION ALL SELECT {_K}, 'METRIC', metric_canonical, 'Metrics', metric_kind, NULL, NULL, true, expression FROM fx_metric",
)
def _(spark, sf):
    return cat.glossary(fixture(spark, sf, "fx_term"), fixture(spark, sf, "fx_entity"), fixture(spark, sf, "fx_metric"))


@query("cat_metric_library", _with("fx_metric") + "SELECT metric_name, CASE WHEN coalesce(translated_expr, '') = '' THEN 'not_convertible' WHEN requires_fiscal_calendar THEN 'needs_fiscal_binding' WHEN metric_kind = 'unsupported' THEN 'not_convertible' ELSE 'ready' END AS deploy_readiness FROM fx_metric")
def _(spark, sf):
    return cat.metric_library(fixture(spark, sf, "fx_metric")).select("metric_name", "deploy_readiness")


_HIER = f"(SELECT DISTINCT {_K}, dimension_name, hierarchy_name, dimension_name LIKE '%S%' AS is_default FROM fx_level)"


@query("cat_hierarchy_tree", _with("fx_level") + f"SELECT dimension_name, level_ordinal, is_default, dimension_name || ' > ' || hierarchy_name || ' > ' || level_name AS display_path FROM fx_level JOIN {_HIER} USING ({_K}, dimension_name, hierarchy_name)")
def _(spark, sf):
    level = fixture(spark, sf, "fx_level")
    h = level.select(*cat.MODEL, "dimension_name", "hierarchy_name", F.col("dimension_name").like("%S%").alias("is_default")).distinct()
    return cat.hierarchy_tree_view(h, level).select("dimension_name", "level_ordinal", "is_default", "display_path")


def _edges(spark, sf) -> DataFrame:
    return lin.lineage_edges(*[fixture(spark, sf, n) for n in ("fx_entity", "fx_term", "fx_term_refs", "fx_metric_refs")])


def _canonical(name: str) -> str:
    return f"regexp_replace(upper({name}), '_FY[0-9][0-9]$', '')"


_LINEAGE = _with("fx_entity", "fx_term", "fx_term_refs", "fx_metric_refs").replace("WITH ", "WITH RECURSIVE ", 1) + f""",
r AS (SELECT {_K}, 'term' AS from_kind, term_name AS from_name, entity_name AS from_entity, ref_object, ref_item FROM fx_term_refs WHERE coalesce(ref_item, '') <> ''
  UNION SELECT {_K}, 'metric', metric_name, '', ref_object, ref_item FROM fx_metric_refs),
c AS (SELECT r.*, (SELECT list((entity_name, term_name)) FROM fx_term t WHERE t.source_model = r.source_model AND t.term_name = ref_item AND t.entity_name = coalesce(nullif(ref_object, ''), nullif(from_entity, ''))) AS near,
  (SELECT list((entity_name, term_name)) FROM fx_term t WHERE t.source_model = r.source_model AND t.term_name = ref_item) AS model,
  (SELECT list((entity_name, term_name)) FROM fx_term t WHERE t.source_model = r.source_model AND {_canonical("t.term_name")} = {_canonical("ref_item")}) AS canonical FROM r),
b AS (SELECT *, coalesce(near, model, canonical) AS found, CASE WHEN near IS NOT NULL THEN 'entity' WHEN model IS NOT NULL THEN 'model' ELSE 'canonical' END AS scope FROM c),
u AS (SELECT {_K}, from_kind, from_name, from_entity, 'term' AS to_kind, CASE WHEN len(found) = 1 THEN found[1][2] ELSE ref_item END AS to_name,
  CASE WHEN len(found) = 1 THEN found[1][1] ELSE coalesce(ref_object, '') END AS to_entity, CASE from_kind WHEN 'term' THEN 'derives_from' ELSE 'aggregates' END AS edge_type,
  CASE WHEN found IS NULL THEN 'missing' WHEN len(found) > 1 THEN 'ambiguous' ELSE scope END AS resolution, coalesce(len(found), 0) AS n_matches FROM b
  UNION ALL SELECT {_K}, 'entity', entity_name, entity_name, 'physical_object', physical_object, '', 'binds_to', 'bound', 1 FROM fx_entity WHERE physical_object IS NOT NULL
  UNION ALL SELECT {_K}, 'term', term_name, entity_name, 'physical_column', physical_column, entity_name, 'binds_to', 'bound', 1 FROM fx_term WHERE physical_column IS NOT NULL),
e AS (SELECT {_K}, from_kind, from_name, from_entity, to_kind, to_name, to_entity, edge_type, min(resolution) AS resolution, max(n_matches) AS n_matches FROM u GROUP BY ALL),
g AS (SELECT DISTINCT source_model || '|' || from_kind || '|' || from_entity || '|' || from_name AS src, source_model || '|' || to_kind || '|' || to_entity || '|' || to_name AS dst FROM e),
w(src, dst) AS (SELECT src, dst FROM g UNION SELECT w.src, g.dst FROM w JOIN g ON g.src = w.dst),
q AS (SELECT source_model, from_kind AS kind, from_name AS name, from_entity AS entity FROM e UNION SELECT source_model, to_kind, to_name, to_entity FROM e),
nodes AS (SELECT *, source_model || '|' || kind || '|' || entity || '|' || name AS node FROM q) """


@query("cat_lineage_edges", _LINEAGE + "SELECT source_model, from_kind, from_name, from_entity, to_kind, to_name, to_entity, edge_type, resolution, n_matches, substr(sha1(concat_ws(chr(1), from_kind, from_name, from_entity, to_kind, to_name, to_entity, edge_type)), 1, 24) AS edge_id FROM e")
def _(spark, sf):
    return _edges(spark, sf).drop("source_system", "from_id", "to_id")


@query("cat_lineage_resolution", _LINEAGE + "SELECT edge_type, resolution, count(*) AS n_edges, CAST(sum(n_matches) AS BIGINT) AS n_matches FROM e GROUP BY 1, 2")
def _(spark, sf):
    return _edges(spark, sf).groupBy("edge_type", "resolution").agg(F.count("*").alias("n_edges"), F.sum("n_matches").alias("n_matches"))


@query(
    "cat_lineage_view",
    _LINEAGE + "SELECT e.source_model, from_kind, from_name, to_name, to_entity, x.physical_object, CASE WHEN to_kind = 'physical_column' AND x.physical_object IS NOT NULL THEN x.physical_object || '.' || to_name END AS fully_qualified_target FROM e LEFT JOIN fx_entity x ON x.source_model = e.source_model AND x.entity_name = CASE WHEN to_entity = '' THEN from_entity ELSE to_entity END",
)
def _(spark, sf):
    out = lin.lineage_view(_edges(spark, sf), fixture(spark, sf, "fx_entity"))
    return out.select("source_model", "from_kind", "from_name", "to_name", "to_entity", "physical_object", "fully_qualified_target")


@query(
    "cat_lineage_origins",
    _LINEAGE + ", h AS (SELECT a.node, CAST(0 AS INT) AS depth, a.node AS here FROM nodes a WHERE a.kind IN ('term', 'metric')), l AS (SELECT node, here, depth FROM h UNION SELECT l.node, g.dst, l.depth + 1 FROM l JOIN g ON g.src = l.here WHERE l.depth < 12) "
    "SELECT f.source_model, f.kind AS from_kind, f.name AS from_name, f.entity AS from_entity, t.entity AS column_entity, t.name AS column_name, CAST(min(l.depth) AS INT) AS depth FROM l JOIN nodes f ON f.node = l.node JOIN nodes t ON t.node = l.here WHERE t.kind = 'physical_column' GROUP BY ALL",
)
def _(spark, sf):
    """Columns that every metric and term comes from, through any number of calculated terms (no chain of these tables is longer than a dozen)."""
    return lin.origins(_edges(spark, sf)).drop("source_system")


@query(
    "cat_lineage_breaks",
    _LINEAGE + "SELECT n.source_model, n.kind, n.name, n.entity FROM nodes n WHERE n.kind IN ('metric', 'term') AND EXISTS (SELECT 1 FROM w JOIN nodes c ON c.node = w.dst WHERE w.src = n.node AND c.kind = 'physical_column' AND c.name = 'C_7')",
)
def _(spark, sf):
    """What breaks when the columns named C_7 change."""
    changed = fixture(spark, sf, "fx_term").filter("physical_column = 'C_7'").select(*cat.MODEL, F.col("entity_name").alias("entity"), F.col("physical_column").alias("name"))
    return lin.breaks(_edges(spark, sf), changed).select("source_model", "kind", "name", "entity")


_SAME = "s AS (SELECT a.src AS node, a.dst AS other FROM w a JOIN w b ON b.src = a.dst AND b.dst = a.src), k AS (SELECT n.node, count(DISTINCT other) FILTER (other <> n.node) + 1 AS size FROM nodes n LEFT JOIN s USING (node) GROUP BY 1)"


@query("cat_lineage_cycles", _LINEAGE + f", {_SAME} SELECT source_model, kind, entity, name, size AS component_size FROM k JOIN nodes USING (node) WHERE size > 1")
def _(spark, sf):
    """Terms that are defined by way of themselves, with the size of their ring."""
    edges = _edges(spark, sf)
    found = lin.strong_components(lin.graph(edges))
    rings = found.join(found.groupBy("component").agg(F.count("*").alias("component_size")).filter("component_size > 1"), "component")
    return lin.nodes(edges).join(rings, "node").select("source_model", "kind", "entity", "name", "component_size")


@query("cat_lineage_reach", _LINEAGE + f", {_SAME} SELECT n.source_model, n.kind, n.entity, n.name, any_value(k.size) AS component_size, count(DISTINCT w.dst) FILTER (w.dst <> n.node) AS n_reached FROM nodes n JOIN k USING (node) LEFT JOIN w ON w.src = n.node GROUP BY 1, 2, 3, 4")
def _(spark, sf):
    """How many nodes each node of the lineage leads to."""
    edges = _edges(spark, sf)
    return lin.nodes(edges).join(lin.reach(lin.graph(edges)), "node").select("source_model", "kind", "entity", "name", "component_size", "n_reached")


@query("cat_lineage_dependents", _LINEAGE + "SELECT n.source_model, n.entity, n.name, count(DISTINCT w.src) AS n_dependents FROM nodes n LEFT JOIN w ON w.dst = n.node WHERE n.kind = 'physical_column' GROUP BY 1, 2, 3")
def _(spark, sf):
    """How many terms and metrics hang on each physical column."""
    edges = _edges(spark, sf)
    named = lin.nodes(edges).filter("kind = 'physical_column'")
    return named.join(lin.reach(lin.graph(edges, backward=True)), "node").select("source_model", "entity", "name", F.col("n_reached").alias("n_dependents"))


@query("cat_impact", "WITH RECURSIVE e AS (SELECT DISTINCT CAST(floor(p_partkey / 5) AS BIGINT) AS src, p_partkey AS dst FROM part WHERE p_partkey > 0), t AS (SELECT CAST(1 AS BIGINT) AS node, 0 AS depth UNION SELECT dst, depth + 1 FROM t JOIN e ON src = node ) SELECT node, CAST(min(depth) AS INT) AS depth FROM t GROUP BY 1")
def _(spark, sf):
    edges = table(spark, sf, "part").filter("p_partkey > 0").select(F.floor(F.col("p_partkey") / 5).alias("src"), F.col("p_partkey").alias("dst"))
    return cat.impact(edges, table(spark, sf, "region").select(F.lit(1).cast("long").alias("node")).distinct())


@query("cat_impact_chain", "WITH RECURSIVE e AS (SELECT DISTINCT s_nationkey AS src, s_nationkey + 1 AS dst FROM supplier UNION SELECT DISTINCT 100 + p_size, 101 + p_size FROM part), t AS (SELECT CAST(0 AS BIGINT) AS node, 0 AS depth UNION SELECT dst, depth + 1 FROM t JOIN e ON src = node) SELECT node, CAST(min(depth) AS INT) AS depth FROM t GROUP BY 1")
def _(spark, sf):
    """A lineage of as many levels as there are consecutive nations with suppliers."""
    hops = table(spark, sf, "supplier").select(F.col("s_nationkey").cast("long").alias("src")).union(table(spark, sf, "part").select((F.col("p_size") + 100).cast("long"))).distinct()
    edges = hops.select("src", (F.col("src") + 1).alias("dst"))
    return cat.impact(edges, table(spark, sf, "region").select(F.lit(0).cast("long").alias("node")).distinct())


@query("cat_expression_refs", _with("fx_definitions") + "SELECT ord, CASE WHEN expr LIKE 'SUM(%' THEN 'SUM' ELSE '' END AS aggregates, regexp_extract(expr, '([A-Za-z_][A-Za-z0-9_]*[.][A-Za-z_][A-Za-z0-9_]*)', 1) AS refs, ord % 3 = 0 AS has_filter FROM fx_definitions")
def _(spark, sf):
    filtered = F.when(F.col("ord") % 3 == 0, F.concat("expr", F.lit(" WHERE x > 1"))).otherwise(F.col("expr"))
    out = cat.expression_refs(fixture(spark, sf, "fx_definitions").withColumn("expr", filtered))
    return out.select("ord", F.array_join("aggregates", ",").alias("aggregates"), F.array_join("refs", ",").alias("refs"), "has_filter")


@query("cat_security_patterns", _with("fx_mapping") + "SELECT regexp_replace(column_name, '[0-9]+$', '#') AS pattern, count(DISTINCT principal) AS n_principals, count(DISTINCT column_value) AS n_values, count(*) AS n_grants FROM fx_mapping GROUP BY 1")
def _(spark, sf):
    return cat.security_patterns(fixture(spark, sf, "fx_mapping"))


@query("cat_security_counts", _with("fx_mapping") + f"SELECT {_K}, count(DISTINCT (principal, column_name)) AS n_rules, count(DISTINCT principal) AS n_principals, count(*) AS n_mapping_rows, CAST(NULL AS BIGINT) AS n_policies FROM fx_mapping GROUP BY 1, 2")
def _(spark, sf):
    mapping = fixture(spark, sf, "fx_mapping")
    return cat.security_counts(mapping.select(*cat.MODEL, "principal", "column_name").distinct(), mapping)


_NORMAL = "regexp_replace(trim(regexp_replace(upper(column_name), '[^A-Z0-9]+', '_', 'g'), '_'), '_([0-9]+)$', '\\1')"
_GENERAL = f"regexp_replace({_NORMAL}, '^(.+_LEVEL)[0-9]+$', '\\1#')"
_RULES = _with("fx_mapping") + f", m AS (SELECT *, {_NORMAL} AS c, {_GENERAL} AS g FROM fx_mapping), r AS (SELECT principal, source_model, role_group, array_to_string(list_sort(list(DISTINCT c)), ',') AS shape, array_to_string(list_sort(list(DISTINCT g)), ',') AS pattern, list(DISTINCT c) AS cs FROM m GROUP BY 1, 2, 3)"


def _rules(spark, sf) -> DataFrame:
    return fixture(spark, sf, "fx_mapping").groupBy("principal", "source_model", "role_group").agg(F.collect_set("column_name").alias("columns"))


@query("cat_security_shapes", _RULES + " SELECT shape, count(*) AS n_rules, count(DISTINCT principal) AS n_principals FROM r GROUP BY 1")
def _(spark, sf):
    return cat.security_shapes(_rules(spark, sf))


@query("cat_security_pattern_sets", _RULES + " SELECT pattern AS shape, count(*) AS n_rules, count(DISTINCT principal) AS n_principals FROM r GROUP BY 1")
def _(spark, sf):
    return cat.security_shapes(_rules(spark, sf), general=True)


@query("cat_security_by_role", _RULES + " SELECT coalesce(nullif(role_group, ''), '(none)') AS role_group, count(*) AS n_rules, count(DISTINCT principal) AS n_principals, array_to_string(list_sort(list_distinct(list_filter(flatten(list(cs)), lambda x: regexp_matches(x, '^.+_LEVEL[0-9]+$')))), ',') AS levels FROM r GROUP BY 1")
def _(spark, sf):
    return cat.security_by_role(_rules(spark, sf)).withColumn("levels", F.array_join("levels", ","))


@query("cat_security_values", _RULES + " SELECT c AS column, count(DISTINCT column_value) AS n_values, count(DISTINCT CASE WHEN regexp_matches(column_value, '^[A-Z0-9_]+([.][A-Z0-9_]+)+$', 'i') THEN column_value END) > 0.8 * count(DISTINCT column_value) AS is_hierarchical FROM m GROUP BY 1".replace("AS column,", 'AS "column",'))
def _(spark, sf):
    return cat.security_values(fixture(spark, sf, "fx_mapping"))


_CANON = "regexp_replace(upper(entity_name), '_FY[0-9][0-9]$', '')"


@query("cat_clone_families", _with("fx_entity") + f", k AS (SELECT {_K}, {_CANON} AS canonical, coalesce(nullif(regexp_extract(upper(entity_name), '_(FY[0-9][0-9])$', 1), ''), '(base)') AS v FROM fx_entity) SELECT {_K}, 'entity' AS kind, canonical, count(*) AS n_members, string_agg(v, ',' ORDER BY v) AS variants FROM k GROUP BY 1, 2, 4 HAVING count(*) > 1")
def _(spark, sf):
    objects = fixture(spark, sf, "fx_entity").select(*cat.MODEL, F.lit("entity").alias("kind"), F.col("entity_name").alias("name"))
    return cat.clone_families(objects)


@query("cat_clone_stats", _with("fx_entity") + f"SELECT {_K}, 'entity' AS kind, count(*) AS n_definitions, count(DISTINCT {_CANON}) AS n_patterns, round(count(*) / count(DISTINCT {_CANON}), 2) AS clone_ratio, count(*) FILTER (regexp_matches(upper(entity_name), '_FY[0-9][0-9]$')) AS n_cloned FROM fx_entity GROUP BY 1, 2")
def _(spark, sf):
    return cat.clone_stats(fixture(spark, sf, "fx_entity").select(*cat.MODEL, F.lit("entity").alias("kind"), F.col("entity_name").alias("name")))


def _grain(spark, sf) -> DataFrame:
    return cat.grain_risk(fixture(spark, sf, "fx_grain").withColumn("key_columns", F.expr("array_repeat('k', cast(n_keys as int))")))


_RISK = "((is_groupable AND NOT is_row_grain) OR (is_row_grain AND n_keys > 1))"


@query("cat_grain_risk", _with("fx_grain") + f"SELECT grain_name, nullif(concat_ws('; ', CASE WHEN is_groupable AND NOT is_row_grain THEN 'groupable grain above the row grain' END, CASE WHEN is_row_grain AND n_keys > 1 THEN 'composite row grain' END), '') AS risk_reason, {_RISK} AS double_count_risk FROM fx_grain")
def _(spark, sf):
    return _grain(spark, sf).select("grain_name", "risk_reason", "double_count_risk")


@query("cat_aggregation_risk", _with("fx_entity", "fx_grain", "fx_rule") + f", j AS (SELECT e.{_E.replace(', ', ', e.')}, count(DISTINCT grain_name) AS n_grains, count(DISTINCT CASE WHEN {_RISK} THEN grain_name END) AS n_risky, count(DISTINCT CASE WHEN is_semi_additive THEN term_name END) AS n_semi_additive FROM fx_entity e LEFT JOIN fx_grain g USING ({_E}) LEFT JOIN fx_rule r USING ({_E}) GROUP BY 1, 2, 3) SELECT *, n_risky > 0 OR n_semi_additive > 0 AS needs_review FROM j")
def _(spark, sf):
    return cat.aggregation_risk(fixture(spark, sf, "fx_entity"), _grain(spark, sf), fixture(spark, sf, "fx_rule"))


@query("cat_grain_coverage", _with("fx_entity", "fx_grain") + f", s AS (SELECT DISTINCT {_CANON} AS entity FROM fx_entity), g AS (SELECT {_CANON} AS entity, count(*) AS n, count(*) FILTER ({_RISK}) AS k FROM fx_grain GROUP BY 1) SELECT s.entity, n IS NOT NULL AS has_grain, coalesce(n, 0) AS n_grains, coalesce(k, 0) AS n_risky FROM s LEFT JOIN g ON s.entity = g.entity")
def _(spark, sf):
    return cat.grain_coverage(_grain(spark, sf), fixture(spark, sf, "fx_entity"))


@query("cat_grain_scope", _with("fx_entity", "fx_grain") + f", s AS (SELECT DISTINCT {_CANON} AS entity FROM fx_entity WHERE source_model <> 'MODEL_2'), g AS (SELECT {_CANON} AS entity, {_RISK} AS risk FROM fx_grain) SELECT (SELECT count(*) FROM g WHERE entity IN (SELECT entity FROM s)) AS n_in_scope, (SELECT count(*) FROM g WHERE entity NOT IN (SELECT entity FROM s)) AS n_out_of_scope, (SELECT count(*) FROM g WHERE risk AND entity IN (SELECT entity FROM s)) AS n_risky, (SELECT count(DISTINCT entity) FROM g WHERE entity IN (SELECT entity FROM s)) AS n_with_grain, (SELECT count(*) FROM s) AS n_entities, (SELECT count(*) FROM s WHERE entity NOT IN (SELECT entity FROM g)) AS n_without_grain")
def _(spark, sf):
    """Grains in and outside the scope of two of the three models."""
    return cat.grain_scope(_grain(spark, sf), fixture(spark, sf, "fx_entity").filter("source_model <> 'MODEL_2'"))


_PACKAGES = "SELECT 'sys' AS source_system, concat('MODEL_', CAST(s_nationkey % 3 AS VARCHAR(20))) AS source_model, s_name AS package_name, CASE WHEN s_nationkey % 5 > 0 THEN concat('/sales/', CAST(s_nationkey % 5 AS VARCHAR(20))) END AS folder_path, s_acctbal > 2000 AS is_role_based FROM supplier"
FIXTURES["fx_packages"] = ("supplier", _PACKAGES)
_SQL["fx_packages"] = _PACKAGES


@query("cat_role_packages", _with("fx_packages") + f"SELECT {_K}, coalesce(folder_path, '') AS folder_path, count(*) AS n_packages FROM fx_packages WHERE is_role_based GROUP BY ALL")
def _(spark, sf):
    """Packages exported for a role, by folder."""
    return cat.role_packages(fixture(spark, sf, "fx_packages"))


@query(
    "cat_coverage",
    _with("fx_entity", "fx_term", "fx_metric", "fx_rel", "fx_grain") + f", m AS (SELECT DISTINCT {_K} FROM fx_entity) SELECT m.source_system, m.source_model, " + ", ".join(f"(SELECT count(*) FROM {t} x WHERE x.source_model = m.source_model{c}) AS {n}" for n, t, c in (("entities", "fx_entity", ""), ("terms", "fx_term", ""), ("metric_patterns", "fx_metric", ""), ("translated", "fx_metric", " AND translated_expr IS NOT NULL AND metric_kind <> 'unsupported'"), ("fiscal", "fx_metric", " AND requires_fiscal_calendar"), ("relationships", "fx_rel", ""), ("flagged", "fx_rel", " AND source_status <> 'valid'"), ("flagged_simple", "fx_rel", " AND source_status <> 'valid' AND is_simple_equality"), ("grains", "fx_grain", ""))) + " FROM m",
)
def _(spark, sf):
    entity, metric, rel = (fixture(spark, sf, n) for n in ("fx_entity", "fx_metric", "fx_rel"))
    flagged = F.col("source_status") != "valid"
    parts = {
        "entities": (entity, None),
        "terms": (fixture(spark, sf, "fx_term"), None),
        "metric_patterns": (metric, None),
        "translated": (metric, F.col("translated_expr").isNotNull() & (F.col("metric_kind") != "unsupported")),
        "fiscal": (metric, F.col("requires_fiscal_calendar")),
        "relationships": (rel, None),
        "flagged": (rel, flagged),
        "flagged_simple": (rel, flagged & F.col("is_simple_equality")),
        "grains": (fixture(spark, sf, "fx_grain"), None),
    }
    return cat.coverage(entity.select(*cat.MODEL).distinct(), parts)


_BIND = f"SELECT {_E}, any_value(physical_object) AS physical_object, count(term_name) AS term_count, count(*) FILTER (term_role = 'measure') AS measure_count, count(*) FILTER (term_role = 'identifier') AS key_count, count(*) FILTER (term_role = 'attribute') AS attribute_count FROM fx_entity LEFT JOIN fx_term USING ({_E}) WHERE physical_object IS NOT NULL GROUP BY 1, 2, 3"


@query("cat_physical_binding", _with("fx_entity", "fx_term") + _BIND)
def _(spark, sf):
    return cat.physical_binding(fixture(spark, sf, "fx_entity"), fixture(spark, sf, "fx_term"))


_QUALITY = f"q AS (SELECT {_E}, term_name, regular_aggregate, regexp_matches(upper(term_name), '_(ID|NUMBER|CODE|KEY)$') AS n, coalesce(regular_aggregate IN ('count', 'countdistinct', 'min', 'max'), false) AS a FROM fx_term LEFT JOIN fx_rule USING ({_E}, term_name) WHERE term_role = 'measure')"


@query("cat_measure_quality", _with("fx_term", "fx_rule") + f", {_QUALITY} SELECT {_E}, term_name, regular_aggregate, CASE WHEN n AND a THEN 'almost_certainly_identifier' WHEN n THEN 'probably_identifier' WHEN a THEN 'possibly_identifier' ELSE 'genuine_measure' END AS verdict, NOT (n OR a) AS is_safe FROM q")
def _(spark, sf):
    return cat.measure_quality(fixture(spark, sf, "fx_term"), fixture(spark, sf, "fx_rule"))


@query("cat_safe_measures", _with("fx_term", "fx_rule", "fx_entity") + f", {_QUALITY}, b AS ({_BIND}) SELECT {_E}, term_name, regular_aggregate, physical_object FROM q JOIN b USING ({_E}) WHERE NOT (n OR a)")
def _(spark, sf):
    return cat.safe_measures(fixture(spark, sf, "fx_term"), fixture(spark, sf, "fx_rule"), fixture(spark, sf, "fx_entity"))


FIXTURES["fx_flagged"] = (
    "part",
    "SELECT 'sys' AS source_system, concat('MODEL_', CAST(p_partkey % 3 AS VARCHAR(20))) AS source_model, upper(p_name) AS name, CASE p_size % 7 WHEN 0 THEN 'empty expression: nothing to convert' WHEN 1 THEN 'uses the fiscal calendar' WHEN 2 THEN 'unknown function' WHEN 3 THEN NULL ELSE 'member reference' END AS reason, concat('SUM(', p_brand, ')') AS expression FROM part",
)
FIXTURES["fx_yearly"] = (
    "part",
    "SELECT 'sys' AS source_system, concat('MODEL_', CAST(p_partkey % 4 AS VARCHAR(20))) AS source_model, CASE WHEN p_partkey % 4 = 3 THEN concat('MET_', CAST(p_partkey AS VARCHAR(20))) ELSE concat(upper(p_type), '_', CAST(p_size % 9 AS VARCHAR(20)), CASE WHEN p_size % 2 = 0 THEN concat('_FY', CAST(20 + p_size % 5 AS VARCHAR(20))) ELSE '' END) END AS metric_name FROM part",
)
_SQL |= {k: FIXTURES[k][1] for k in ("fx_flagged", "fx_yearly")}
_ISSUES = (
    f"f AS (SELECT *, coalesce(reason, '') AS why FROM fx_flagged), v AS (SELECT *, coalesce(source_status, '') NOT IN ('', 'valid') AS stale FROM fx_rel), "
    f"k AS (SELECT {_K}, count(*) AS n, count(DISTINCT {_canonical('metric_name')}) AS p, count(*) FILTER (regexp_matches(upper(metric_name), '_FY[0-9][0-9]$')) AS c FROM fx_yearly GROUP BY ALL), "
    f"s AS (SELECT {_K}, count(*) FILTER (stale) AS n, count(*) AS total, count(*) FILTER (stale AND is_simple_equality) AS sound, list(left_entity || '->' || right_entity || ' [' || source_status || ']' ORDER BY relationship_name) FILTER (stale) AS names FROM v GROUP BY ALL), "
    "i AS (SELECT source_system, source_model, CASE WHEN why LIKE '%empty expression%' THEN 'risk' WHEN why LIKE '%fiscal calendar%' THEN 'blocker' ELSE 'risk' END AS severity, "
    "CASE WHEN why LIKE '%empty expression%' THEN 'source_model_defect' WHEN why LIKE '%fiscal calendar%' THEN 'needs_decision' ELSE 'unconvertible' END AS category, CASE WHEN why LIKE '%empty expression%' OR why LIKE '%fiscal calendar%' THEN 'metric' ELSE 'term' END AS object_kind, name AS object_name, "
    "CASE WHEN why LIKE '%empty expression%' THEN 'Metric has no expression in the source model' WHEN why LIKE '%fiscal calendar%' THEN 'Metric depends on the fiscal calendar' ELSE why END AS issue, CASE WHEN why LIKE '%empty expression%' THEN why ELSE expression END AS detail FROM f "
    f"UNION ALL SELECT {_K}, 'risk', 'stale_metadata', 'relationship', n || ' relationships', n || ' of ' || total || ' relationships are not flagged valid by the source tool', sound || ' simple equality joins; ' || array_to_string(names[1:40], '; ') FROM s WHERE n > 0 "
    f"UNION ALL SELECT k.source_system, k.source_model, 'note', 'source_model_defect', 'model', k.source_model, n || ' metrics collapse to ' || p || ' distinct patterns (' || round(n / p, 2) || 'x duplication)', c || ' cloned objects; ' || coalesce((SELECT count(*) FROM fx_packages g WHERE g.source_model = k.source_model AND is_role_based), 0) || ' role-based package exports' FROM k WHERE n > p)"
)


@query("cat_issues", _with("fx_flagged", "fx_yearly", "fx_rel", "fx_packages") + f", {_ISSUES} SELECT severity, category, object_kind, object_name, issue, detail, substr(sha1(concat_ws(chr(1), source_system, source_model, severity, category, object_kind, object_name, issue, detail)), 1, 24) AS issue_id FROM i")
def _(spark, sf):
    """The issue ledger of three models, blockers first."""
    out = cat.issues(*[fixture(spark, sf, n) for n in ("fx_flagged", "fx_rel", "fx_yearly", "fx_packages")])
    return cat.issues_ordered(out).drop(*cat.MODEL)


@query(
    "cat_business_glossary",
    _with("fx_term", "fx_entity", "fx_metric", "fx_rule") + f", l AS (SELECT {_K}, metric_canonical, arg_min(coalesce(translated_expr, '(null)'), metric_name) AS logic FROM fx_metric GROUP BY 1, 2, 3), r AS (SELECT {_E}, max(CAST(is_semi_additive AS INT)) AS semi_flag FROM fx_rule GROUP BY 1, 2, 3) "
    f"SELECT source_model, 'TERM' AS term_kind, term_name AS business_term, entity_name AS subject_area, expression AS calculation_logic, CASE WHEN semi_flag = 1 THEN 'semi_additive' ELSE 'none' END AS semantic_risk, CASE WHEN physical_column IS NULL THEN 'bi_model' ELSE 'warehouse' END AS definition_source, 'DRAFT' AS status FROM fx_term LEFT JOIN r USING ({_E}) "
    f"UNION ALL SELECT source_model, 'METRIC', metric_canonical, 'Metrics', nullif(logic, '(null)'), 'none', 'bi_model', 'DRAFT' FROM fx_metric JOIN l USING ({_K}, metric_canonical)",
)
def _(spark, sf):
    return cat.business_glossary(*[fixture(spark, sf, n) for n in ("fx_term", "fx_entity", "fx_metric", "fx_rule")]).drop("source_system")


@query("cat_risk_tags", _with("fx_term", "fx_rule") + f", {_QUALITY}, t AS (SELECT {_E}, term_name, min(p) AS p FROM (SELECT {_E}, term_name, 0 AS p FROM q WHERE n OR a UNION ALL SELECT {_E}, term_name, 1 FROM fx_rule WHERE is_semi_additive) GROUP BY 1, 2, 3, 4) SELECT {_E}, term_name, physical_column, CASE p WHEN 0 THEN 'misdeclared_measure' WHEN 1 THEN 'semi_additive' ELSE 'none' END AS risk FROM fx_term LEFT JOIN t USING ({_E}, term_name) WHERE physical_column IN (SELECT physical_column FROM fx_term WHERE entity_name < 'ENT_5')")
def _(spark, sf):
    term = fixture(spark, sf, "fx_term")
    return cat.risk_tags(term, fixture(spark, sf, "fx_rule"), term.filter("entity_name < 'ENT_5'").select("physical_column"))


@query("cat_ontology_classes", _with("fx_entity", "fx_term") + f", b AS ({_BIND}) SELECT {_E}, CASE WHEN measure_count > 0 AND key_count > 0 THEN 'fact' ELSE 'dimension' END AS entity_class FROM b")
def _(spark, sf):
    return cat.ontology_classes(fixture(spark, sf, "fx_entity"), fixture(spark, sf, "fx_term"))


@query("cat_ontology_joins", _with("fx_rel") + "SELECT relationship_name FROM fx_rel WHERE is_simple_equality AND NOT regexp_matches(left_entity, '_FY[0-9][0-9]$') AND NOT regexp_matches(right_entity, '_FY[0-9][0-9]$')")
def _(spark, sf):
    return cat.ontology_joins(fixture(spark, sf, "fx_rel")).select("relationship_name")


@query("cat_ontology_drills", _with("fx_level") + "SELECT dimension_name, count(*) AS depth, string_agg(level_name, ' > ' ORDER BY level_ordinal) AS drill_path FROM fx_level WHERE NOT is_all_level GROUP BY 1 HAVING count(*) >= 2")
def _(spark, sf):
    return cat.ontology_drills(fixture(spark, sf, "fx_level")).select("dimension_name", "depth", "drill_path")


@query("cat_classify_columns", _with("fx_definitions") + ", c AS (SELECT ord, concat(name, CASE ord % 4 WHEN 0 THEN '_ID' WHEN 1 THEN '_DATE' ELSE '_V' END) AS name, CASE WHEN ord % 9 = 0 THEN 'Measure' END AS tag, expr, CASE WHEN ord % 2 = 0 THEN 'number' ELSE 'string' END AS dt FROM fx_definitions), o AS (SELECT DISTINCT name, 'dimension' AS role FROM c WHERE ord % 13 = 0) SELECT ord, coalesce(o.role, lower(tag), CASE WHEN expr LIKE 'SUM(%' THEN 'measure' END, CASE WHEN c.name LIKE '%DATE' THEN 'time' WHEN c.name LIKE '%ID' THEN 'identifier' END, CASE WHEN dt = 'number' THEN 'measure' ELSE 'dimension' END) AS role FROM c LEFT JOIN o ON c.name = o.name")
def _(spark, sf):
    c = fixture(spark, sf, "fx_definitions").selectExpr("ord", "concat(name, case ord % 4 when 0 then '_ID' when 1 then '_DATE' else '_V' end) as name", "case when ord % 9 = 0 then 'Measure' end as tag", "expr", "case when ord % 2 = 0 then 'number' else 'string' end as data_type")
    return cat.classify_columns(c, c.filter("ord % 13 = 0").select("name", F.lit("dimension").alias("role")).distinct()).select("ord", "role")


@query("cat_complexity", _with("fx_definitions") + ", t AS (SELECT tbl, kind = 'metric' AS act, ord % 17 = 0 AS cf, CASE WHEN regexp_matches(expr, 'SIZE_1[0-9]') THEN 'manual' WHEN expr LIKE 'SUM(%' THEN 'needs_translation' ELSE 'simple' END AS tier FROM fx_definitions) SELECT tbl, " + ", ".join(f"count(*) FILTER (tier = '{t}') AS n_{t}" for t in ("simple", "needs_translation", "manual")) + ", count(*) FILTER (NOT cf AND tier = 'simple' AND act) AS n_yes, count(*) FILTER (cf OR (tier <> 'manual' AND NOT (tier = 'simple' AND act))) AS n_review FROM t GROUP BY 1")
def _(spark, sf):
    rows = fixture(spark, sf, "fx_definitions").withColumns({"is_active": F.col("kind") == "metric", "has_conflict": F.col("ord") % 17 == 0})
    tiers = cat.default_include(cat.complexity(rows, r"SIZE_1\d", r"^SUM\("))
    counts = tiers.groupBy("tbl").agg(F.count(F.when(F.col("include") == "Yes", 1)).alias("n_yes"), F.count(F.when(F.col("include") == "Review", 1)).alias("n_review"))
    return cat.complexity_tally(tiers, ["tbl"]).join(counts, "tbl")


@query("cat_source_audit", _with("fx_entity") + ", c AS (SELECT connection, count(*) AS n FROM fx_entity GROUP BY 1), s AS (SELECT DISTINCT connection, CASE WHEN connection LIKE 'conn_0%' THEN 'postgres' ELSE 'oracle' END AS p FROM fx_entity) SELECT c.connection, p AS declared_platform, n AS n_objects, CASE WHEN c.connection LIKE '%oracle%' THEN 'oracle' ELSE 'postgres' END AS named_platform, (CASE WHEN c.connection LIKE '%oracle%' THEN 'oracle' ELSE 'postgres' END) <> p AS is_misleading FROM c JOIN s USING (connection)")
def _(spark, sf):
    entity = fixture(spark, sf, "fx_entity")
    sources = entity.select("connection", F.when(F.col("connection").like("conn_0%"), "postgres").otherwise("oracle").alias("declared_platform")).distinct()
    return cat.source_audit(entity, sources, {"oracle": "oracle", "postgres": "_pg"})


@query("jn_audit_relationships", _with("fx_rel") + "SELECT count(*) AS n_joins, count(*) FILTER (source_status = 'valid') AS n_valid, count(*) FILTER (source_status IS NULL) AS n_unknown, count(*) FILTER (source_status <> 'valid') AS n_stale, count(*) FILTER (NOT is_simple_equality) AS n_unsound, count(*) FILTER (source_status <> 'valid' AND NOT is_simple_equality) AS n_both, count(*) FILTER (regexp_matches(left_entity, '_FY[0-9]+$')) AS n_clone FROM fx_rel WHERE left_entity IN (SELECT right_entity FROM fx_rel WHERE is_simple_equality) OR right_entity IN (SELECT right_entity FROM fx_rel WHERE is_simple_equality)")
def _(spark, sf):
    rel = fixture(spark, sf, "fx_rel")
    return jn.audit_relationships(rel, rel.filter("is_simple_equality").select(F.col("right_entity").alias("entity")))


# --- definitions -----------------------------------------------------------------------------------------------------------------

_D = "fx_definitions"


def defs(spark, sf) -> DataFrame:
    return fixture(spark, sf, _D)


_NORM = "regexp_replace(lower(expr), '[a-z_][a-z0-9_]*[.]', '', 'g')"
_LABELS = "l AS (SELECT DISTINCT tbl || '.' || name AS field, kind, unnest(CASE WHEN page_name <> '' THEN list_transform(string_split(page_name, ','), lambda x: trim(x)) ELSE [coalesce(nullif(trim(dashboard_name), ''), nullif(trim(source_file), ''), '(model-only)')] END) AS page FROM fx_definitions), lf AS (SELECT DISTINCT field, page FROM l)"
_PAGES = f"u AS (SELECT DISTINCT tbl || '.' || name AS field, tbl, kind, trim(unnest(string_split(page_name, ','))) AS page FROM fx_definitions WHERE page_name <> ''), f AS (SELECT DISTINCT field, page FROM u)"


@query("def_reuse_stats", _with(_D) + ", g AS (SELECT kind, name, tbl, expr, count(*) AS n FROM fx_definitions GROUP BY ALL) SELECT CAST(sum(n) AS BIGINT) AS n_definitions, count(*) AS n_distinct, CAST(sum(n - 1) AS BIGINT) AS n_repeats, (SELECT count(*) FROM (SELECT kind, name FROM g GROUP BY 1, 2 HAVING count(DISTINCT expr) > 1)) AS n_inconsistent_names, round(sum(n - 1) * 100.0 / sum(n), 1) AS reuse_pct FROM g")
def _(spark, sf):
    return dfn.reuse_stats(defs(spark, sf))


@query("def_most_reused", "SELECT p_brand AS name, p_type AS tbl, 'x' AS kind, 'e' AS expr, count(*) AS n FROM part GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY n DESC, name, tbl LIMIT 20")
def _(spark, sf):
    rows = table(spark, sf, "part").select(F.lit("x").alias("kind"), F.col("p_brand").alias("name"), F.col("p_type").alias("tbl"), F.lit("e").alias("expr"))
    return dfn.most_reused(rows)


@query("def_expression_groups", _with(_D) + f"SELECT {_NORM} AS norm_expr, count(*) AS n_items, count(DISTINCT kind) AS n_kinds, count(DISTINCT name) AS n_names FROM fx_definitions GROUP BY 1 HAVING count(*) >= 2")
def _(spark, sf):
    return dfn.expression_groups(defs(spark, sf))


_TOK = "list_filter(string_split_regex(lower(name), '[^a-z0-9]+'), lambda x: x <> '')"


@query("def_categorise", _with(_D) + f", r AS (SELECT ord, kind, {_NORM} AS e, {_TOK} AS t FROM fx_definitions), p AS (SELECT a.e, avg(len(list_intersect(list_distinct(a.t), list_distinct(b.t))) / len(list_distinct(list_concat(a.t, b.t)))) AS s FROM r a JOIN r b ON a.e = b.e AND a.ord < b.ord GROUP BY 1), g AS (SELECT e, count(*) AS n, count(DISTINCT kind) AS k FROM r GROUP BY 1 HAVING count(*) >= 2) SELECT e AS norm_expr, n AS n_items, round(s, 4) AS name_similarity, CASE WHEN round(s, 4) > 0.85 THEN 'duplicate' ELSE 'semantic_overlap' END AS category, k = 1 AS is_actionable FROM g JOIN p USING (e)")
def _(spark, sf):
    return dfn.categorise(defs(spark, sf))


_SIM = f"n AS (SELECT tbl, name, list_sort(list(DISTINCT {_NORM})) AS ex, list_distinct({_TOK}) AS t FROM fx_similar GROUP BY tbl, name), s AS (SELECT a.tbl, a.name AS name_a, b.name AS name_b, len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) AS j, a.ex <> b.ex AS dif FROM n a JOIN n b ON a.tbl = b.tbl AND a.name < b.name), z AS (SELECT * FROM s WHERE j >= 0.6 AND dif)"


@query("def_similar_names", _with("fx_similar") + f", {_SIM} SELECT tbl, name_a, name_b, round(j, 4) AS similarity FROM z")
def _(spark, sf):
    return dfn.similar_names(fixture(spark, sf, "fx_similar"), 0.6)


@query("def_parallel_definitions", "WITH RECURSIVE " + _with("fx_similar")[5:] + f", {_SIM}, e AS (SELECT tbl, name_a AS a, name_b AS b FROM z UNION SELECT tbl, name_b, name_a FROM z), r AS (SELECT DISTINCT tbl, a AS n, a AS m FROM e UNION SELECT r.tbl, e.b, r.m FROM r JOIN e ON r.tbl = e.tbl AND r.n = e.a), c AS (SELECT tbl, n, min(m) AS g FROM r GROUP BY 1, 2) SELECT tbl, g AS group_id, count(*) AS n_names, string_agg(n, ',' ORDER BY n) AS names FROM c GROUP BY 1, 2")
def _(spark, sf):
    return dfn.parallel_definitions(fixture(spark, sf, "fx_similar"), 0.6)


@query("def_is_calculated", _with(_D) + "SELECT ord, expr LIKE 'SUM(%' AS is_calculated FROM fx_definitions")
def _(spark, sf):
    return defs(spark, sf).select("ord", dfn.is_calculated(F.col("expr")).alias("is_calculated"))


@query("def_coverage_by_dashboard", _with(_D) + f", {_LABELS}, k AS (SELECT field, count(*) AS c FROM lf GROUP BY 1), n AS (SELECT page, " + ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}s" for k in ("dimension", "fact", "metric")) + " FROM l GROUP BY 1) SELECT page, count(*) AS n_fields, count(*) FILTER (c = 1) AS n_unique, count(*) FILTER (c > 1) AS n_shared, any_value(n_dimensions) AS n_dimensions, any_value(n_facts) AS n_facts, any_value(n_metrics) AS n_metrics FROM lf JOIN k USING (field) JOIN n USING (page) GROUP BY 1")
def _(spark, sf):
    return dfn.coverage_by_dashboard(defs(spark, sf))


_PAIRS = f"{_LABELS}, z AS (SELECT page, list(field) AS fs FROM lf GROUP BY 1), p AS (SELECT a.page AS page_a, b.page AS page_b, list_sort(list_intersect(a.fs, b.fs)) AS shared, a.fs AS fa, b.fs AS fb, round(len(list_intersect(a.fs, b.fs)) / (len(a.fs) + len(b.fs) - len(list_intersect(a.fs, b.fs))), 4) AS jaccard FROM z a JOIN z b ON a.page < b.page)"


@query("def_similarity", _with(_D) + f", {_PAIRS} SELECT page_a, page_b, len(shared) AS n_shared, array_to_string(shared, ',') AS shared_fields, jaccard FROM p")
def _(spark, sf):
    """Every pair of pages, dashboards and files, those without a common field too."""
    return dfn.similarity(defs(spark, sf), zero_pairs=True).withColumn("shared_fields", F.array_join("shared_fields", ","))


@query("def_similarity_summary", _with(_D) + f", {_PAIRS} SELECT (SELECT count(*) FROM z) AS n_pages, count(*) AS n_pairs, round(avg(jaccard), 4) AS average, max(jaccard) AS largest FROM p")
def _(spark, sf):
    return dfn.similarity_summary(defs(spark, sf))


@query(
    "def_page_profiles",
    _with(_D) + f", {_PAGES}, x AS (SELECT trim(unnest(string_split(page_name, ','))) AS page, widget_name, dashboard_name FROM fx_definitions WHERE page_name <> ''), w AS (SELECT page, trim(unnest(string_split(widget_name, ','))) AS v FROM x), d AS (SELECT page, trim(unnest(string_split(dashboard_name, ','))) AS v FROM x) "
    "SELECT page, count(DISTINCT field) AS n_fields, count(DISTINCT field) FILTER (kind <> 'metric') AS n_facts, count(DISTINCT field) FILTER (kind = 'metric') AS n_metrics, count(DISTINCT tbl) AS n_tables, string_agg(DISTINCT tbl, ',' ORDER BY tbl) AS tables, "
    "(SELECT string_agg(DISTINCT v, ',' ORDER BY v) FROM w WHERE w.page = u.page AND v NOT IN ('', 'unknown')) AS widgets, (SELECT string_agg(DISTINCT v, ',' ORDER BY v) FROM d WHERE d.page = u.page AND v <> '') AS dashboards FROM u GROUP BY page",
)
def _(spark, sf):
    return dfn.page_profiles(defs(spark, sf)).withColumns({c: F.array_join(c, ",") for c in ("tables", "widgets", "dashboards")})


@query("def_active_vs_model", _with(_D) + f", {_PAGES}, d AS (SELECT DISTINCT tbl || '.' || name AS field, tbl FROM fx_definitions) SELECT tbl, count(*) AS n_fields, count(*) FILTER (field IN (SELECT field FROM f)) AS n_active, count(*) FILTER (field NOT IN (SELECT field FROM f)) AS n_unused FROM d GROUP BY 1 ORDER BY 4 DESC, 1 LIMIT 10")
def _(spark, sf):
    return dfn.active_vs_model(defs(spark, sf))


@query("def_reuse_distribution", _with(_D) + f", {_PAGES}, k AS (SELECT field, count(*) AS n_pages FROM f GROUP BY 1) SELECT n_pages, count(*) AS n_fields, n_pages >= 2 AS is_core FROM k GROUP BY 1")
def _(spark, sf):
    return dfn.reuse_distribution(defs(spark, sf), 2)


_ALONE = "array_to_string(list_sort(list_transform(list_filter({a}, lambda x: NOT list_contains({b}, x)), lambda x: string_split(x, '.')[-1]))[1:10], ',')"


@query("def_consolidation", _with(_D) + f", {_PAIRS} SELECT page_a, page_b, len(shared) AS n_shared, jaccard, len(fa) - len(shared) AS n_only_a, len(fb) - len(shared) AS n_only_b, {_ALONE.format(a='fa', b='fb')} AS only_in_a, {_ALONE.format(a='fb', b='fa')} AS only_in_b FROM p WHERE jaccard >= 0.1 AND page_a <> '(model-only)' AND page_b <> '(model-only)'")
def _(spark, sf):
    return dfn.consolidation(defs(spark, sf), 0.1).withColumns({c: F.array_join(c, ",") for c in ("only_in_a", "only_in_b")})


_CONF = f"{_PAGES}, c AS (SELECT tbl || '.' || name AS field FROM fx_definitions GROUP BY 1 HAVING count(DISTINCT {_NORM}) > 1), cc AS (SELECT page, count(*) AS n_fields, count(*) FILTER (field IN (SELECT field FROM c)) AS n_conflicts FROM f GROUP BY 1)"


@query("def_conflict_coverage", _with(_D) + f", {_CONF} SELECT *, round(n_conflicts / n_fields, 4) AS conflict_ratio FROM cc")
def _(spark, sf):
    d = defs(spark, sf)
    return dfn.conflict_coverage(d, dfn.conflict_fields(d))


_CORE = "k AS (SELECT field, count(*) AS n FROM f GROUP BY 1)"


@query("def_priorities", _with(_D) + f", {_CONF}, {_CORE}, d AS (SELECT DISTINCT tbl || '.' || name AS field FROM fx_definitions) SELECT CASE WHEN n >= 2 AND field NOT IN (SELECT field FROM c) THEN 'P1' WHEN n >= 2 THEN 'blocked' WHEN n > 0 THEN 'P2' ELSE 'P3' END AS bucket, count(*) AS n_fields FROM d LEFT JOIN k USING (field) GROUP BY 1")
def _(spark, sf):
    d = defs(spark, sf)
    return dfn.priorities(d, dfn.conflict_fields(d), 2)


@query("def_readiness", _with(_D) + f", {_CONF}, {_CORE}, r AS (SELECT page, round(n_conflicts / n_fields, 4) AS conflict_ratio, (SELECT count(*) FROM f JOIN k USING (field) WHERE f.page = cc.page AND n >= 2) AS n_core FROM cc) SELECT *, CASE WHEN conflict_ratio = 0 AND n_core > 0 THEN 'ready' WHEN conflict_ratio <= 0.1 THEN 'nearly_ready' WHEN conflict_ratio <= 0.3 THEN 'needs_work' ELSE 'blocked' END AS tier FROM r")
def _(spark, sf):
    d = defs(spark, sf)
    return dfn.readiness(d, dfn.conflict_fields(d), 2)


@query("def_domains", "WITH RECURSIVE " + _with(_D)[5:] + ", q AS (SELECT DISTINCT tbl, tbl || '/' || CAST(ord % 2 AS VARCHAR) AS page FROM fx_definitions WHERE ord % 5 <> 0 UNION SELECT tbl, left(tbl, 7) || '/x' FROM fx_definitions WHERE ord % 11 = 0), e AS (SELECT DISTINCT a.tbl AS x, b.tbl AS y FROM q a JOIN q b USING (page)), r AS (SELECT x AS n, x AS m FROM e UNION SELECT e.y, r.m FROM r JOIN e ON r.n = e.x), g AS (SELECT n, min(page) AS domain FROM r JOIN q ON q.tbl = r.m GROUP BY 1) SELECT DISTINCT d.tbl, coalesce(domain, 'Other') AS domain FROM fx_definitions d LEFT JOIN g ON g.n = d.tbl")
def _(spark, sf):
    d = defs(spark, sf)
    a = d.filter("ord % 5 <> 0").withColumn("page_name", F.concat_ws("/", "tbl", (F.col("ord") % 2).cast("string")))
    b = d.filter("ord % 11 = 0").withColumn("page_name", F.concat(F.substring("tbl", 1, 7), F.lit("/x")))
    return dfn.domains(a.unionByName(b).unionByName(d.withColumn("page_name", F.lit(""))))


@query("def_prefix_domains", _with("fx_joins") + ", t AS (SELECT from_tbl AS tbl FROM fx_joins UNION SELECT to_tbl FROM fx_joins UNION SELECT 'SOLO_1' UNION SELECT 'noprefix'), p AS (SELECT tbl, nullif(regexp_extract(upper(tbl), '^([A-Z0-9]+)_', 1), '') AS x FROM t) SELECT tbl, CASE WHEN x IS NOT NULL AND count(*) OVER (PARTITION BY x) >= 2 THEN x ELSE 'General' END AS domain FROM p")
def _(spark, sf):
    j = fixture(spark, sf, "fx_joins")
    extra = j.select(F.explode(F.array(F.lit("SOLO_1"), F.lit("noprefix"))).alias("tbl"))
    return dfn.prefix_domains(j.select(F.col("from_tbl").alias("tbl")).union(j.select("to_tbl")).union(extra).distinct())


@query("def_bridges", _with("fx_joins") + ", d AS (SELECT tbl, 'D' || (CAST(regexp_extract(tbl, '([0-9]+)$', 1) AS INT) % 3) AS domain FROM (SELECT from_tbl AS tbl FROM fx_joins UNION SELECT to_tbl FROM fx_joins)) SELECT least(a.domain, b.domain) AS domain_a, greatest(a.domain, b.domain) AS domain_b, count(*) AS n_links, string_agg(DISTINCT to_tbl, ',' ORDER BY to_tbl) AS shared FROM fx_joins JOIN d a ON a.tbl = from_tbl JOIN d b ON b.tbl = to_tbl WHERE a.domain <> b.domain GROUP BY 1, 2")
def _(spark, sf):
    j = fixture(spark, sf, "fx_joins")
    tables = j.select(F.col("from_tbl").alias("tbl")).union(j.select("to_tbl")).distinct()
    return dfn.bridges(tables.withColumn("domain", F.concat(F.lit("D"), (F.regexp_extract("tbl", "([0-9]+)$", 1).cast("int") % 3).cast("string"))), j)


@query("def_within_budget", "WITH t AS (SELECT DISTINCT p_brand AS bridge, p_type || p_size AS tbl, p_size AS n, p_size % 10 = 0 AS ess FROM part), s AS (SELECT *, coalesce(sum(CASE WHEN ess THEN n END) OVER (PARTITION BY bridge), 0) + coalesce(sum(CASE WHEN NOT ess THEN n END) OVER (PARTITION BY bridge ORDER BY ess, n, tbl ROWS UNBOUNDED PRECEDING), 0) AS used FROM t) SELECT bridge, tbl, n AS n_columns, ess AS is_essential FROM s WHERE ess OR used <= 300")
def _(spark, sf):
    t = table(spark, sf, "part").select(F.col("p_brand").alias("bridge"), F.concat("p_type", F.col("p_size").cast("string")).alias("tbl"), F.col("p_size").alias("n_columns"), (F.col("p_size") % 10 == 0).alias("is_essential"))
    return dfn.within_budget(t, 300)


@query("def_context_split", _with("fx_context") + ", k AS (SELECT tbl, count(*) AS n FROM fx_context GROUP BY 1), c AS (SELECT context, count(*) AS n_tables, count(*) FILTER (n > 1) AS s FROM fx_context JOIN k USING (tbl) GROUP BY 1) SELECT context, n_tables, round(s / n_tables, 4) AS overlap, CASE WHEN s / n_tables > 0.8 THEN 'review' WHEN s > 0 THEN 'shared_dims' ELSE 'one_to_one' END AS verdict FROM c")
def _(spark, sf):
    return dfn.context_split(fixture(spark, sf, "fx_context"))


@query("def_valid_contexts", _with("fx_context", "fx_refs") + ", n AS (SELECT object, count(tbl) AS need FROM fx_refs GROUP BY 1), g AS (SELECT object, context FROM fx_refs JOIN fx_context USING (tbl) GROUP BY 1, 2 HAVING count(*) = (SELECT need FROM n WHERE n.object = fx_refs.object)), l AS (SELECT object, string_agg(context, ',' ORDER BY context) AS contexts FROM g GROUP BY 1) SELECT object, CASE WHEN need = 0 THEN 'all' WHEN contexts IS NULL THEN 'unmapped' ELSE 'mapped' END AS status, coalesce(contexts, '') AS contexts FROM n LEFT JOIN l USING (object)")
def _(spark, sf):
    return dfn.valid_contexts(fixture(spark, sf, "fx_refs"), fixture(spark, sf, "fx_context"))


@query("def_table_roles", _with("fx_joins") + ", o AS (SELECT from_tbl AS tbl, count(DISTINCT to_tbl) AS n FROM fx_joins GROUP BY 1), t AS (SELECT from_tbl AS tbl FROM fx_joins UNION SELECT to_tbl FROM fx_joins) SELECT tbl, CASE WHEN tbl LIKE 'FACT%' OR coalesce(n, 0) >= 8 THEN 'fact' ELSE 'dimension' END AS role FROM t LEFT JOIN o USING (tbl)")
def _(spark, sf):
    j = fixture(spark, sf, "fx_joins")
    return dfn.table_roles(j.select(F.col("from_tbl").alias("tbl")).union(j.select("to_tbl")), j, 8)


@query("def_key_candidates", "WITH c AS (SELECT DISTINCT p_brand AS tbl, p_type || (CASE p_size % 4 WHEN 0 THEN '_ID' ELSE '_X' END) AS name, p_size = 50 AND p_partkey % 9 = 0 AS is_key, CASE WHEN p_size % 3 = 0 THEN 'number' ELSE 'text' END AS dt FROM part), r AS (SELECT *, CASE WHEN is_key THEN 0 WHEN regexp_matches(upper(name), '(_ID|_KEY|KEY|ID)$') THEN 1 WHEN dt = 'number' THEN 2 ELSE 3 END AS place FROM c), w AS (SELECT *, row_number() OVER (PARTITION BY tbl ORDER BY place, name) AS rn FROM r) SELECT tbl, name AS key_column FROM w WHERE rn = 1 AND place < 3")
def _(spark, sf):
    c = table(spark, sf, "part").selectExpr("p_brand as tbl", "concat(p_type, case p_size % 4 when 0 then '_ID' else '_X' end) as name", "p_size = 50 and p_partkey % 9 = 0 as is_key", "case when p_size % 3 = 0 then 'number' else 'text' end as data_type").distinct()
    return dfn.key_candidates(c)


@query("def_answer", "SELECT 'ranking' AS question, c_mktsegment AS label, CAST(sum(cast(c_acctbal as decimal(14,2))) AS DOUBLE) AS value FROM customer GROUP BY 2 UNION ALL SELECT 'overall', '', CAST(sum(cast(c_acctbal as decimal(14,2))) AS DOUBLE) FROM customer")
def _(spark, sf):
    c, m = table(spark, sf, "customer"), F.expr("cast(c_acctbal as decimal(14,2))")
    a = dfn.answer(c, "ranking", m, "c_mktsegment").select(F.lit("ranking").alias("question"), F.col("c_mktsegment").alias("label"), F.col("value").cast("double").alias("value"))
    return a.union(dfn.answer(c, "overall", m).select(F.lit("overall"), F.lit(""), F.col("value").cast("double")))
