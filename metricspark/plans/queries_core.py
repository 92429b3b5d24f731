"""Queries of the model, filters, joins, aggregates and rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricspark.operators import aggregates as agg
from metricspark.operators import joins as jn
from metricspark.operators import predicates as flt
from metricspark.operators import rollups as rol
from metricspark.operators import windows as win
from metricspark.plans.model import Dataset, Field, Metric, Model, Relationship
from metricspark.plans.registry import query, table

#: Exact revenue of a line item, the same text for both engines.
REVENUE = "cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))"
PRICE = "cast(o_totalprice as decimal(14,2))"
BALANCE = "cast(c_acctbal as decimal(14,2))"


def sales_model(spark: SparkSession, sf: str) -> Model:
    """Line items with their orders, customers, nations, regions, parts and suppliers."""
    t = lambda n: table(spark, sf, n)
    many = lambda name, a, b, x, y: Relationship(name, a, b, [(x, y)])
    return Model(
        [
            Dataset(
                "lineitem",
                t("lineitem"),
                [Field("orderkey", "l_orderkey"), Field("partkey", "l_partkey"), Field("suppkey", "l_suppkey"), Field("quantity", "l_quantity"), Field("rev", REVENUE), Field("returnflag", "l_returnflag"), Field("shipdate", "to_date(l_shipdate)")],
                metrics=[
                    Metric("revenue", "sum", "rev"),
                    Metric("n_lines", "count", "orderkey"),
                    Metric("n_orders", "count_distinct", "orderkey"),
                    Metric("returned", "sum", "rev", where="returnflag = 'R'"),
                    Metric("price_per_unit", "expr", "sum(rev) / sum(quantity)"),
                    Metric("max_quantity", "max", "quantity"),
                    Metric("min_quantity", "min", "quantity"),
                ],
            ),
            Dataset("orders", t("orders"), [Field("orderkey2", "o_orderkey"), Field("custkey", "o_custkey"), Field("status", "o_orderstatus"), Field("priority", "o_orderpriority"), Field("orderyear", "year(o_orderdate)")], key=["orderkey2"]),
            Dataset("customer", t("customer"), [Field("custkey2", "c_custkey"), Field("nationkey", "c_nationkey"), Field("segment", "c_mktsegment")], key=["custkey2"]),
            Dataset("nation", t("nation"), [Field("nationkey2", "n_nationkey"), Field("regionkey", "n_regionkey"), Field("nation", "n_name")], key=["nationkey2"]),
            Dataset("region", t("region"), [Field("regionkey2", "r_regionkey"), Field("region", "r_name")], key=["regionkey2"]),
            Dataset("part", t("part"), [Field("partkey2", "p_partkey"), Field("brand", "p_brand"), Field("type", "p_type")], key=["partkey2"]),
        ],
        [
            many("line_order", "lineitem", "orders", "orderkey", "orderkey2"),
            many("order_customer", "orders", "customer", "custkey", "custkey2"),
            Relationship("nation_customers", "nation", "customer", [("nationkey2", "nationkey")], "one_to_many"),
            many("nation_region", "nation", "region", "regionkey", "regionkey2"),
            many("line_part", "lineitem", "part", "partkey", "partkey2"),
        ],
    )


def money(df: DataFrame, *columns: str) -> DataFrame:
    """Exact sums as doubles, for results that cross engines."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


_CHAIN = (
    "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)


@query("model_revenue_by_region", f"SELECT r_name AS region, CAST(sum({REVENUE}) AS DOUBLE) AS revenue, count(*) AS n_lines, count(DISTINCT l_orderkey) AS n_orders FROM {_CHAIN} GROUP BY 1")
def _(spark, sf):
    return money(sales_model(spark, sf).query(["lineitem.revenue", "lineitem.n_lines", "lineitem.n_orders"], ["region.region"]), "revenue")


@query("model_two_dims_having", f"SELECT o_orderpriority AS priority, l_returnflag AS returnflag, CAST(sum({REVENUE}) AS DOUBLE) AS revenue, CAST(sum(CASE WHEN l_returnflag = 'R' THEN {REVENUE} END) AS DOUBLE) AS returned FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1, 2 HAVING count(*) > 100")
def _(spark, sf):
    out = sales_model(spark, sf).query(["lineitem.revenue", "lineitem.returned", "lineitem.n_lines"], ["orders.priority", "lineitem.returnflag"], where="orders__status = 'F'", having="n_lines > 100")
    return money(out.drop("n_lines"), "revenue", "returned")


@query("model_top_brands", f"SELECT p_brand AS brand, CAST(sum({REVENUE}) AS DOUBLE) AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY sum({REVENUE}) DESC, 1 LIMIT 10")
def _(spark, sf):
    return money(sales_model(spark, sf).query(["lineitem.revenue"], ["part.brand"], order=[F.desc("revenue"), F.col("brand")], limit=10), "revenue")


@query("model_composite_metric", f"SELECT l_returnflag AS returnflag, round(CAST(sum({REVENUE}) AS DOUBLE) / sum(l_quantity), 6) AS price_per_unit, max(l_quantity) AS max_quantity, min(l_quantity) AS min_quantity FROM lineitem GROUP BY 1")
def _(spark, sf):
    out = sales_model(spark, sf).query(["lineitem.price_per_unit", "lineitem.max_quantity", "lineitem.min_quantity"], ["lineitem.returnflag"])
    return out.withColumn("price_per_unit", F.round("price_per_unit", 6))


@query("model_base_filter", "SELECT c_mktsegment AS segment, count(c_custkey) AS n, CAST(sum(cast(c_acctbal as decimal(14,2))) AS DOUBLE) AS balance FROM customer WHERE (c_acctbal > 0) AND (c_nationkey < 10 OR c_nationkey > 20) GROUP BY 1")
def _(spark, sf):
    ds = Dataset(
        "customer", table(spark, sf, "customer"), [Field("custkey", "c_custkey"), Field("segment", "c_mktsegment"), Field("bal", BALANCE)], key=["custkey"], filters=["c_acctbal > 0", "c_nationkey < 10 OR c_nationkey > 20"],
        metrics=[Metric("n", "count", "custkey"), Metric("balance", "sum", "bal")],
    )
    return money(Model([ds]).query(["customer.n", "customer.balance"], ["customer.segment"]), "balance")


@query("model_row_security", "SELECT o_orderpriority AS priority, count(o_orderkey) AS n FROM orders WHERE (o_orderstatus = 'F') OR (o_totalprice > 200000) GROUP BY 1")
def _(spark, sf):
    rules = {"closed": "o_orderstatus = 'F'", "large": "o_totalprice > 200000", "nobody": "false"}
    ds = Dataset("orders", table(spark, sf, "orders"), [Field("orderkey", "o_orderkey"), Field("priority", "o_orderpriority")], key=["orderkey"], rules=rules, metrics=[Metric("n", "count", "orderkey")])
    return Model([ds]).query(["orders.n"], ["orders.priority"], roles=["closed", "large", "guest"])


@query("model_role_playing_join", "SELECT n_name AS nation, count(*) AS n FROM customer JOIN nation ON (c_custkey % 25) = n_nationkey GROUP BY 1")
def _(spark, sf):
    fields = [Field("custkey", "c_custkey"), Field("home", "c_nationkey"), Field("billing", "cast(c_custkey % 25 as int)")]
    m = Model(
        [Dataset("customer", table(spark, sf, "customer"), fields, key=["custkey"], metrics=[Metric("n", "count", "custkey")]), Dataset("nation", table(spark, sf, "nation"), [Field("nationkey", "n_nationkey"), Field("nation", "n_name")], key=["nationkey"])],
        [Relationship("home_nation", "customer", "nation", [("home", "nationkey")]), Relationship("billing_nation", "customer", "nation", [("billing", "nationkey")], active=False)],
    )
    return m.query(["customer.n"], ["nation.nation"], via={"nation": "billing_nation"})


def trade_model(spark: SparkSession, sf: str) -> Model:
    """Line items with order and ship date on one calendar, and customers and suppliers on one table of nations."""
    t = lambda n: table(spark, sf, n)
    days = t("orders").selectExpr("to_date(o_orderdate) AS day").union(t("lineitem").selectExpr("to_date(l_shipdate)")).distinct()
    many = lambda name, a, b, x, y, **more: Relationship(name, a, b, [(x, y)], **more)
    return Model(
        [
            Dataset(
                "lineitem",
                t("lineitem"),
                [Field("orderkey", "l_orderkey"), Field("suppkey", "l_suppkey"), Field("rev", REVENUE), Field("shipday", "to_date(l_shipdate)"), Field("name", "l_returnflag")],
                metrics=[Metric("revenue", "sum", "rev"), Metric("n_lines", "count", "orderkey"), Metric("flags", "list", "name", args=("name", "|", "distinct"))],
            ),
            Dataset("orders", t("orders"), [Field("orderkey", "o_orderkey"), Field("custkey", "o_custkey"), Field("orderday", "to_date(o_orderdate)")], key=["orderkey"]),
            Dataset("customer", t("customer"), [Field("custkey", "c_custkey"), Field("nationkey", "c_nationkey"), Field("name", "c_name")], key=["custkey"]),
            Dataset("supplier", t("supplier"), [Field("suppkey", "s_suppkey"), Field("nationkey", "s_nationkey"), Field("name", "s_name")], key=["suppkey"]),
            Dataset("nation", t("nation"), [Field("nationkey", "n_nationkey"), Field("regionkey", "n_regionkey"), Field("name", "n_name")], key=["nationkey"]),
            Dataset("region", t("region"), [Field("regionkey", "r_regionkey"), Field("name", "r_name")], key=["regionkey"]),
            Dataset("calendar", days, [Field("day"), Field("year", "year(day)"), Field("month", "month(day)")], key=["day"]),
        ],
        [
            many("line_order", "lineitem", "orders", "orderkey", "orderkey"),
            many("line_supplier", "lineitem", "supplier", "suppkey", "suppkey"),
            many("order_customer", "orders", "customer", "custkey", "custkey"),
            many("customer_nation", "customer", "nation", "nationkey", "nationkey"),
            many("supplier_nation", "supplier", "nation", "nationkey", "nationkey"),
            many("nation_region", "nation", "region", "regionkey", "regionkey"),
            many("line_shipped", "lineitem", "calendar", "shipday", "day", role="ship_date"),
            many("order_placed", "orders", "calendar", "orderday", "day", role="order_date"),
        ],
    )


_TRADE = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON s_nationkey = sn.n_nationkey"


@query("model_two_nations", f"SELECT cn.n_name AS customer__nation__name, sn.n_name AS supplier__nation__name, CAST(sum({REVENUE}) AS DOUBLE) AS revenue, count(*) AS n_lines FROM {_TRADE} GROUP BY 1, 2")
def _(spark, sf):
    """Trade between the nations of customers and of suppliers: one table in two roles."""
    return money(trade_model(spark, sf).query(["lineitem.revenue", "lineitem.n_lines"], ["customer.nation.name", "supplier.nation.name"]), "revenue")


@query("model_two_dates", f"SELECT year(o_orderdate) AS order_date__year, year(l_shipdate) AS ship_date__year, CAST(sum({REVENUE}) AS DOUBLE) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2")
def _(spark, sf):
    """Order year by ship year: one calendar in two roles."""
    return money(trade_model(spark, sf).query(["lineitem.revenue"], ["order_date.year", "ship_date.year"]), "revenue")


@query(
    "model_foreign_trade",
    f"SELECT cr.r_name AS customer__region__name, l_returnflag AS name, count(*) AS n_lines FROM {_TRADE} JOIN region cr ON cn.n_regionkey = cr.r_regionkey JOIN region sr ON sn.n_regionkey = sr.r_regionkey WHERE cr.r_name <> sr.r_name AND month(l_shipdate) <> month(o_orderdate) GROUP BY 1, 2",
)
def _(spark, sf):
    """Lines that crossed regions, with both roles in the condition."""
    m = trade_model(spark, sf)
    return m.query(["lineitem.n_lines"], ["customer.region.name", "lineitem.name"], where="customer__region__name <> supplier__region__name and ship_date__month <> order_date__month")


@query("model_ordered_list", "SELECT s_name AS supplier__name, string_agg(DISTINCT l_returnflag, '|' ORDER BY l_returnflag) AS flags FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1")
def _(spark, sf):
    """Return flags of each supplier, in order."""
    return trade_model(spark, sf).query(["lineitem.flags"], ["supplier.name"])


@query("model_composite_key_join", "SELECT o.y, count(*) AS n FROM (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders) o LEFT JOIN (SELECT DISTINCT year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders) c ON o.y = c.y AND o.m = c.m GROUP BY 1")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    months = orders.select(F.year("o_orderdate").alias("cy"), F.month("o_orderdate").alias("cm")).distinct()
    m = Model(
        [
            Dataset("orders", orders, [Field("orderkey", "o_orderkey"), Field("oy", "year(o_orderdate)"), Field("om", "month(o_orderdate)")], key=["orderkey"], metrics=[Metric("n", "count", "orderkey")]),
            Dataset("months", months, [Field("y", "cy"), Field("m", "cm")], key=["y", "m"]),
        ],
        [Relationship("in_month", "orders", "months", [("oy", "y"), ("om", "m")])],
    )
    return m.query(["orders.n"], ["months.y"])


# --- filters ------------------------------------------------------------------------------------------------------


@query("flt_cross_filter", "SELECT c_mktsegment, count(*) AS n FROM customer WHERE CAST(c_nationkey AS VARCHAR) IN ('1', '2', '3') GROUP BY 1")
def _(spark, sf):
    return flt.cross_filter(table(spark, sf, "customer"), {"c_mktsegment": ["BUILDING"], "c_nationkey": [1, 2, 3], "absent": ["x"]}, emits="c_mktsegment").groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query(
    "flt_panels",
    f"SELECT 'o_orderstatus' AS panel, o_orderstatus AS label, CAST(sum({PRICE}) AS DOUBLE) AS value FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 2 "
    f"UNION ALL SELECT 'o_orderpriority', o_orderpriority, CAST(sum({PRICE}) AS DOUBLE) FROM orders WHERE o_orderstatus IN ('F') GROUP BY 2",
)
def _(spark, sf):
    active = {"o_orderstatus": ["F"], "o_orderpriority": ["1-URGENT", "2-HIGH"]}
    return money(flt.panels(table(spark, sf, "orders"), active, {"o_orderstatus": PRICE, "o_orderpriority": PRICE}), "value")


@query("flt_filtered_measure", f"SELECT o_orderpriority, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN {PRICE} END) AS DOUBLE) AS open_value FROM orders GROUP BY 1")
def _(spark, sf):
    return money(table(spark, sf, "orders").groupBy("o_orderpriority").agg(flt.filtered(F.sum, F.col("o_orderstatus") == "O", F.expr(PRICE)).alias("open_value")), "open_value")


@query("flt_security_mapping", "SELECT concat('role_', CAST(c_nationkey % 4 AS VARCHAR)) AS principal, 'g' AS role_group, 'C_MKTSEGMENT' AS column_name, c_mktsegment AS column_value, min('CUSTOMER') AS entity FROM customer GROUP BY ALL")
def _(spark, sf):
    rules = table(spark, sf, "customer").select(
        F.expr("concat('role_', cast(c_nationkey % 4 as string))").alias("principal"),
        F.lit("g").alias("role_group"),
        F.lit("CUSTOMER").alias("entity"),
        F.array(F.struct(F.lit("c mktsegment").alias("column"), F.col("c_mktsegment").alias("value"))).alias("predicates"),
    )
    return flt.security_mapping(rules)


@query("flt_entitled", "SELECT count(*) AS n, count(DISTINCT c_mktsegment) AS n_segments FROM customer WHERE c_mktsegment IN (SELECT c_mktsegment FROM customer WHERE c_custkey % 97 = 0 AND c_nationkey % 4 = 1)")
def _(spark, sf):
    customer = table(spark, sf, "customer")
    mapping = customer.filter("c_custkey % 97 = 0").select(
        F.expr("concat('role_', cast(c_nationkey % 4 as string))").alias("principal"), F.lit("C_MKTSEGMENT").alias("column_name"), F.col("c_mktsegment").alias("column_value")
    )
    return flt.entitled(customer, mapping, "role_1", "c_mktsegment").agg(F.count("*").alias("n"), F.count_distinct("c_mktsegment").alias("n_segments"))


@query("flt_explore", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 1000 AND o_orderpriority IN ('1-URGENT') GROUP BY 1")
def _(spark, sf):
    rows = flt.explore(table(spark, sf, "orders"), always=["o_totalprice > 1000"], conditional=["o_orderstatus = 'F'"], unless=["o_orderpriority"], filters={"o_orderpriority": ["1-URGENT"]})
    return rows.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("flt_calculate", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 50000 GROUP BY 1")
def _(spark, sf):
    context = {"o_orderstatus": ["F"], "o_orderpriority": ["1-URGENT"]}
    return flt.calculate(table(spark, sf, "orders"), F.count("*").alias("n"), context, add="o_totalprice > 50000", remove="all", keep=["o_orderstatus"], by=["o_orderpriority"])


# --- joins ---------------------------------------------------------------------------------------------------------


@query("jn_check_key", "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_null, CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS n_duplicated FROM lineitem")
def _(spark, sf):
    return jn.check_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("jn_audit_fanout", f"SELECT (SELECT count(*) FROM orders) AS rows_before, (SELECT count(*) FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey) AS rows_after, (SELECT CAST(sum({PRICE}) AS DOUBLE) FROM orders) AS total_before, (SELECT CAST(sum({PRICE}) AS DOUBLE) FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey) AS total_after")
def _(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "k")
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "k")
    return money(jn.audit_fanout(orders, lines, ["k"], F.expr(PRICE)), "total_before", "total_after")


@query("jn_orphan_rate", "SELECT count(*) AS n_rows, count(*) FILTER (NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS n_orphans, count(*) FILTER (NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) / count(*) AS orphan_share FROM customer")
def _(spark, sf):
    return jn.orphan_rate(table(spark, sf, "customer"), table(spark, sf, "orders"), [("c_custkey", "o_custkey")])


@query("jn_by_type", " UNION ALL ".join(f"SELECT '{h}' AS how, count(*) AS n, count(c_custkey) AS n_left, count(o_orderkey) AS n_right FROM (SELECT * FROM customer WHERE c_nationkey < 5) {h} JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey" for h in ("inner", "left", "right", "full")))
def _(spark, sf):
    a, b = table(spark, sf, "customer").filter("c_nationkey < 5"), table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    parts = [a.join(b, a.c_custkey == b.o_custkey, h).agg(F.lit(h).alias("how"), F.count("*").alias("n"), F.count("c_custkey").alias("n_left"), F.count("o_orderkey").alias("n_right")) for h in ("inner", "left", "right", "full")]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query("jn_lookup", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(spark, sf):
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return jn.lookup(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), nation, ["c_nationkey"], "n_name").drop("c_nationkey")


@query("jn_related_agg", f"SELECT c_custkey, count(o_orderkey) AS n_orders, CAST(sum({PRICE}) AS DOUBLE) AS spent FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def _(spark, sf):
    out = jn.related_agg(table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders"), [("c_custkey", "o_custkey")], F.count("o_orderkey").alias("n_orders"), F.sum(F.expr(PRICE)).alias("spent"))
    return money(out.na.fill(0, ["n_orders"]), "spent")


@query("jn_natural_join", "SELECT n_regionkey, count(*) AS n FROM nation JOIN (SELECT DISTINCT n_regionkey FROM nation WHERE n_nationkey < 5) USING (n_regionkey) GROUP BY 1")
def _(spark, sf):
    nation = table(spark, sf, "nation")
    return jn.natural_join(nation, nation.filter("n_nationkey < 5").select("n_regionkey").distinct()).groupBy("n_regionkey").agg(F.count("*").alias("n"))


@query("jn_generate", "SELECT r_name, n_name FROM region, nation WHERE n_nationkey < 5")
def _(spark, sf):
    return table(spark, sf, "region").select("r_name").crossJoin(table(spark, sf, "nation").filter("n_nationkey < 5").select("n_name"))


@query("jn_treat_as", "SELECT count(*) AS n FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(spark, sf):
    return jn.treat_as(table(spark, sf, "orders"), table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'"), [("o_custkey", "c_custkey")]).agg(F.count("*").alias("n"))


@query("jn_present_and_missing", "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS present FROM customer")
def _(spark, sf):
    there, missing = jn.present_and_missing(table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders").filter("o_orderstatus = 'P'").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])
    return there.withColumn("present", F.lit(True)).union(missing.withColumn("present", F.lit(False)))


# --- aggregates -------------------------------------------------------------------------------------------------------


@query(
    "agg_statistics",
    "SELECT o_orderpriority, round(stddev_samp(o_totalprice), 3) AS sd, round(stddev_pop(o_totalprice), 3) AS sdp, round(var_samp(o_totalprice) / 1e6, 3) AS v, median(o_totalprice) AS med, round(quantile_cont(o_totalprice, 0.9), 6) AS p90 FROM orders GROUP BY 1",
)
def _(spark, sf):
    c = F.col("o_totalprice")
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.round(F.stddev_samp(c), 3).alias("sd"), F.round(F.stddev_pop(c), 3).alias("sdp"), F.round(F.var_samp(c) / 1e6, 3).alias("v"), F.median(c).alias("med"), F.round(F.percentile(c, F.lit(0.9)), 6).alias("p90")
    )


@query(
    "agg_percentile_exclusive",
    "WITH r AS (SELECT o_orderpriority AS g, o_totalprice AS v, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) AS rn, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders), "
    "k AS (SELECT g, 0.75 * (n + 1) AS rk, max(CASE WHEN rn = floor(0.75 * (n + 1)) THEN v END) AS lo, max(CASE WHEN rn = floor(0.75 * (n + 1)) + 1 THEN v END) AS hi FROM r GROUP BY g, n) "
    "SELECT g AS o_orderpriority, round(lo + (rk - floor(rk)) * (hi - lo), 6) AS percentile_exc FROM k",
)
def _(spark, sf):
    out = agg.percentile_exclusive(table(spark, sf, "orders"), "o_totalprice", 0.75, ["o_orderpriority"])
    return out.withColumn("percentile_exc", F.round("percentile_exc", 6))


@query("agg_correlation", "SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 8) AS r, round(covar_pop(l_quantity, l_extendedprice), 3) AS cp, round(covar_samp(l_quantity, l_extendedprice), 3) AS cs FROM lineitem GROUP BY 1")
def _(spark, sf):
    a, b = "l_quantity", "l_extendedprice"
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.round(F.corr(a, b), 8).alias("r"), F.round(F.covar_pop(a, b), 3).alias("cp"), F.round(F.covar_samp(a, b), 3).alias("cs"))


@query("agg_list_values", "SELECT s_nationkey, string_agg(s_name, ', ' ORDER BY s_name) AS \"values\" FROM supplier GROUP BY 1")
def _(spark, sf):
    return agg.list_values(table(spark, sf, "supplier"), ["s_nationkey"], "s_name", ", ")


@query(
    "agg_distinct_key",
    f"WITH one AS (SELECT o_orderpriority, o_orderkey, max({PRICE}) AS p FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2) SELECT o_orderpriority, CAST(sum(p) AS DOUBLE) AS total, count(*) AS n, median(CAST(p AS DOUBLE)) AS med FROM one GROUP BY 1",
)
def _(spark, sf):
    joined = table(spark, sf, "orders").join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).withColumn("p", F.expr(PRICE))
    out = agg.distinct_key_agg(joined, ["o_orderpriority"], ["o_orderkey"], "p", F.sum("p").alias("total"), F.count("*").alias("n"), F.median(F.col("p").cast("double")).alias("med"))
    return money(out, "total")


@query("agg_iterator", "SELECT l_returnflag, CAST(sum(cast(l_quantity as decimal(12,2)) * cast(l_tax as decimal(4,2))) AS DOUBLE) AS taxed, max(l_quantity * 2) AS mx, count(CASE WHEN l_discount > 0.05 THEN 1 END) AS n_disc FROM lineitem GROUP BY 1")
def _(spark, sf):
    out = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.sum(F.expr("cast(l_quantity as decimal(12,2)) * cast(l_tax as decimal(4,2))")).alias("taxed"), F.max(F.expr("l_quantity * 2")).alias("mx"), F.count(F.expr("CASE WHEN l_discount > 0.05D THEN 1 END")).alias("n_disc")
    )
    return money(out, "taxed")


@query("agg_lod_fixed", f"SELECT o_orderkey, CAST(sum({PRICE}) OVER (PARTITION BY o_custkey) AS DOUBLE) AS customer_total FROM orders")
def _(spark, sf):
    out = agg.lod(table(spark, sf, "orders"), F.sum(F.expr(PRICE)), ["o_custkey"], "customer_total")
    return money(out.select("o_orderkey", "customer_total"), "customer_total")


@query("agg_lod_distinct", "SELECT o_orderkey, n_days FROM orders JOIN (SELECT o_custkey AS k, count(DISTINCT CAST(o_orderdate AS DATE)) AS n_days FROM orders GROUP BY 1) ON o_custkey = k")
def _(spark, sf):
    return agg.lod(table(spark, sf, "orders"), F.count_distinct(F.to_date("o_orderdate")), ["o_custkey"], "n_days").select("o_orderkey", "n_days")


@query("agg_aggregate_aware", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    base = table(spark, sf, "orders").withColumn("n", F.lit(1).cast("long"))
    fine = base.groupBy("o_orderstatus", "o_orderpriority").agg(F.sum("n").alias("n"))
    coarse = base.groupBy("o_orderpriority").agg(F.sum("n").alias("n"))
    return agg.aggregate_aware([coarse, fine, base], ["o_orderstatus"], "n", F.sum("n").alias("n"))


@query("agg_selected_value", "SELECT o_custkey, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN max(o_orderstatus) ELSE '(mixed)' END AS status FROM orders GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(agg.selected_value("o_orderstatus", F.lit("(mixed)")).alias("status"))


_FLOWS = "SELECT o_custkey AS grp, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS t, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1 THEN -3 * o_totalprice ELSE o_totalprice END AS amount, CAST(o_orderdate AS DATE) AS d FROM orders"


def cash_flows(spark, sf) -> DataFrame:
    """Flows per customer, the first one negative."""
    t = win.row_number(["o_custkey"], F.col("o_orderdate"), F.col("o_orderkey")) - 1
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("grp"), t.alias("t"), F.when(t == 0, -3 * F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("amount"), F.to_date("o_orderdate").alias("d")
    )


@query("agg_npv", f"SELECT grp, round(sum(amount / pow(1.1, t)), 3) AS npv FROM ({_FLOWS}) GROUP BY 1")
def _(spark, sf):
    return agg.npv(cash_flows(spark, sf), ["grp"], 0.1, "amount", "t").withColumn("npv", F.round("npv", 3))


@query("agg_xnpv", f"SELECT grp, round(sum(amount / pow(1.1, date_diff('day', d0, d) / 365.0)), 3) AS xnpv FROM (SELECT *, min(d) OVER (PARTITION BY grp) AS d0 FROM ({_FLOWS})) GROUP BY 1")
def _(spark, sf):
    return agg.xnpv(cash_flows(spark, sf), ["grp"], 0.1, "amount", "d").withColumn("xnpv", F.round("xnpv", 3))


def _rate_sql(years: str) -> str:
    """The logarithm of one plus the rate by bisection, 60 halvings of a bracket; null where its ends have one sign."""
    value = "sum(f.amount * exp(-f.y * {}))"
    middle = "(lo + hi) / 2"
    return (
        f"WITH RECURSIVE f AS (SELECT grp, CAST(sum(amount) AS DOUBLE) AS amount, CAST({years} AS DOUBLE) AS y FROM (SELECT *, min(d) OVER (PARTITION BY grp) AS d0 FROM ({_FLOWS})) GROUP BY grp, {years}), "
        "b AS (SELECT grp, ln(1e-12) AS lo, ln(1e12) AS hi, 0 AS i FROM f GROUP BY grp UNION ALL "
        f"SELECT b.grp, CASE WHEN {value.format(middle)} > 0 THEN {middle} ELSE lo END, CASE WHEN {value.format(middle)} > 0 THEN hi ELSE {middle} END, i + 1 "
        "FROM b JOIN f ON f.grp = b.grp WHERE i < 60 GROUP BY b.grp, lo, hi, i), "
        f"k AS (SELECT grp, {value.format('ln(1e-12)')} > 0 AND {value.format('ln(1e12)')} < 0 AS crosses FROM f GROUP BY 1) "
        f"SELECT b.grp, CASE WHEN crosses THEN round({middle}, 6) END AS log_growth FROM b JOIN k ON k.grp = b.grp WHERE i = 60"
    )


def _log_growth(rates: DataFrame) -> DataFrame:
    return rates.select("grp", F.round(F.log1p("irr"), 6).alias("log_growth"))


@query("agg_irr", _rate_sql("t"))
def _(spark, sf):
    return _log_growth(agg.irr(cash_flows(spark, sf), "grp", "amount", "t"))


@query("agg_spearman", "WITH r AS (SELECT l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS a, rank() OVER (PARTITION BY l_returnflag ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_returnflag, l_discount) - 1) / 2.0 AS b FROM lineitem) SELECT l_returnflag, round(corr(a, b), 8) AS spearman FROM r GROUP BY 1")
def _(spark, sf):
    return agg.spearman(table(spark, sf, "lineitem"), "l_quantity", "l_discount", ["l_returnflag"]).withColumn("spearman", F.round("spearman", 8))


# --- rollups ------------------------------------------------------------------------------------------------------------


@query("rol_grouping_sets", f"SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) * 2 + grouping(o_orderpriority) AS INT) AS grouping_id, count(*) AS n, CAST(sum({PRICE}) AS DOUBLE) AS total FROM orders GROUP BY GROUPING SETS ((), (o_orderstatus), (o_orderpriority))")
def _(spark, sf):
    out = rol.grouping_sets(table(spark, sf, "orders"), [[], ["o_orderstatus"], ["o_orderpriority"]], F.count("*").alias("n"), F.sum(F.expr(PRICE)).alias("total"))
    return money(out, "total")


@query(
    "rol_reporting_set",
    "SELECT '(total)' AS dimension, NULL AS label, count(DISTINCT o_custkey) AS customers FROM orders UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(DISTINCT o_custkey) FROM orders GROUP BY 2 UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(DISTINCT o_custkey) FROM orders GROUP BY 2",
)
def _(spark, sf):
    return rol.reporting_set(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], F.count_distinct("o_custkey").alias("customers"))


_LEVELS = "SELECT p_type AS a, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS b, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS c, cast(p_retailprice as decimal(12,2)) AS v FROM part"


def _levels(spark, sf) -> DataFrame:
    return table(spark, sf, "part").selectExpr(
        "p_type as a", "case when p_partkey % 5 = 0 then null else p_brand end as b", "case when p_partkey % 3 = 0 then null else cast(p_size as string) end as c", "cast(p_retailprice as decimal(12,2)) as v"
    )


_NODES = (
    f"WITH r AS ({_LEVELS}) SELECT a AS id, '' AS parent, a AS label, 1 AS depth, CAST(sum(v) AS DOUBLE) AS value FROM r GROUP BY a "
    "UNION ALL SELECT a || ' / ' || b, a, b, 2, CAST(sum(v) AS DOUBLE) FROM r WHERE b IS NOT NULL GROUP BY a, b "
    "UNION ALL SELECT a || ' / ' || b || ' / ' || c, a || ' / ' || b, c, 3, CAST(sum(v) AS DOUBLE) FROM r WHERE b IS NOT NULL AND c IS NOT NULL GROUP BY a, b, c"
)


@query("rol_hierarchy_nodes", _NODES)
def _(spark, sf):
    return money(rol.hierarchy_nodes(_levels(spark, sf), ["a", "b", "c"], "v"), "value").drop("path")


@query(
    "rol_hierarchy_tree",
    f"WITH r AS (SELECT list_filter([a, b, c], lambda x: x IS NOT NULL) AS p, v FROM ({_LEVELS})), n AS (SELECT p[1:k] AS q, sum(v) AS v FROM r, generate_series(1, 3) g(k) WHERE k <= len(p) GROUP BY 1), "
    "m AS (SELECT array_to_string(q, ' / ') AS id, array_to_string(q[1:len(q) - 1], ' / ') AS parent, q[len(q)] AS label, CAST(len(q) AS INT) AS depth, v FROM n) "
    "SELECT id, parent, label, depth, CAST(v AS DOUBLE) AS value, row_number() OVER (PARTITION BY parent, depth ORDER BY v DESC, label) AS child_rank FROM m",
)
def _(spark, sf):
    return money(rol.hierarchy_tree(_levels(spark, sf), ["a", "b", "c"], "v"), "value").drop("path").withColumn("child_rank", F.col("child_rank").cast("long"))


@query(
    "rol_node_share",
    f"WITH r AS ({_LEVELS}), x AS (SELECT a, CAST(sum(v) AS DOUBLE) AS v FROM r GROUP BY a), y AS (SELECT a, b, CAST(sum(v) AS DOUBLE) AS v FROM r WHERE b IS NOT NULL GROUP BY a, b), "
    "z AS (SELECT a, b, c, CAST(sum(v) AS DOUBLE) AS v FROM r WHERE b IS NOT NULL AND c IS NOT NULL GROUP BY a, b, c), t AS (SELECT a, v, sum(v) OVER () AS total FROM x) "
    "SELECT a AS id, '' AS parent, a AS label, 1 AS depth, v AS value, round(v / total, 8) AS share_of_parent, round(v / total, 8) AS share_of_total FROM t "
    "UNION ALL SELECT y.a || ' / ' || y.b, y.a, y.b, 2, y.v, round(y.v / t.v, 8), round(y.v / total, 8) FROM y JOIN t ON y.a = t.a "
    "UNION ALL SELECT z.a || ' / ' || z.b || ' / ' || z.c, z.a || ' / ' || z.b, z.c, 3, z.v, round(z.v / y.v, 8), round(z.v / total, 8) FROM z JOIN y ON z.a = y.a AND z.b = y.b JOIN t ON z.a = t.a",
)
def _(spark, sf):
    out = rol.node_share(money(rol.hierarchy_nodes(_levels(spark, sf), ["a", "b", "c"], "v"), "value")).drop("path")
    return out.withColumns({c: F.round(c, 8) for c in ("share_of_parent", "share_of_total")})


_CELLS = ("o_orderstatus", "o_orderpriority")


def _customer_states(spark, sf) -> DataFrame:
    """Who bought, by status, priority and year, as bitmaps of customer numbers."""
    orders = agg.dense_ids(table(spark, sf, "orders").withColumn("year", F.year("o_orderdate")), "o_custkey", "number")
    return agg.distinct_states(orders, [*_CELLS, "year"], "number", "customers")


@query("rol_distinct_states", "SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) * 2 + grouping(o_orderpriority) AS INT) AS grouping_id, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def _(spark, sf):
    """Distinct customers on three levels from one table of states."""
    return agg.merged_distinct(_customer_states(spark, sf), [[], _CELLS[:1], _CELLS], "customers")


@query("agg_aware_distinct", "SELECT year(o_orderdate) AS year, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1")
def _(spark, sf):
    """Distinct customers by year, answered from the states."""
    states = _customer_states(spark, sf)
    coarse = states.groupBy("o_orderstatus", "customers_range").agg(F.bitmap_or_agg("customers_bits").alias("customers_bits"))
    return agg.aggregate_aware([coarse, states], ["year"], "customers")


@query(
    "model_percentiles",
    f"SELECT l_returnflag AS returnflag, count(l_orderkey) AS n_lines, round(median(l_extendedprice), 6) AS mid_price, round(quantile_cont(l_extendedprice, 0.99), 6) AS high_price, round(median(CASE WHEN l_discount > 0.05 THEN l_quantity END), 6) AS mid_discounted FROM lineitem GROUP BY 1",
)
def _(spark, sf):
    """Exact medians and percentiles of several measures beside a count."""
    return _ranked_lines(spark, sf, ["lineitem.returnflag"])


@query("model_percentiles_all", "SELECT count(l_orderkey) AS n_lines, round(median(l_extendedprice), 6) AS mid_price, round(quantile_cont(l_extendedprice, 0.99), 6) AS high_price, round(median(CASE WHEN l_discount > 0.05 THEN l_quantity END), 6) AS mid_discounted FROM lineitem")
def _(spark, sf):
    """The same over all line items at once."""
    return _ranked_lines(spark, sf, [])


def _ranked_lines(spark, sf, dims) -> DataFrame:
    ds = Dataset(
        "lineitem", table(spark, sf, "lineitem"), [Field("orderkey", "l_orderkey"), Field("returnflag", "l_returnflag"), Field("price", "l_extendedprice"), Field("quantity", "l_quantity"), Field("discount", "l_discount")],
        metrics=[Metric("n_lines", "count", "orderkey"), Metric("mid_price", "median", "price"), Metric("high_price", "percentile", "price", args=(0.99,)), Metric("mid_discounted", "median", "quantity", where="discount > 0.05")],
    )
    out = Model([ds]).query([f"lineitem.{m}" for m in ("n_lines", "mid_price", "high_price", "mid_discounted")], dims)
    return out.withColumns({c: F.round(c, 6) for c in ("mid_price", "high_price", "mid_discounted")})


_BAL = "SELECT user_id, event_type, CAST(ts AS DATE) AS d, max(cast(value as decimal(14,2))) AS balance FROM events GROUP BY ALL"


def balances(spark, sf) -> DataFrame:
    """Daily balances per user and event type, with gaps."""
    return table(spark, sf, "events").groupBy("user_id", "event_type", F.to_date("ts").alias("d")).agg(F.max(F.expr("cast(value as decimal(14,2))")).alias("balance"))


@query("rol_closing", f"WITH e AS (SELECT date_trunc('week', d) AS p, event_type, user_id, arg_max(balance, d) AS b FROM ({_BAL}) GROUP BY ALL) SELECT CAST(CAST(p AS DATE) AS VARCHAR) AS period, event_type, CAST(sum(b) AS DOUBLE) AS balance FROM e GROUP BY ALL")
def _(spark, sf):
    out = rol.closing(balances(spark, sf), "balance", "d", ["user_id"], ["event_type"], "week")
    return money(out, "balance").withColumn("period", F.col("period").cast("string"))


@query("rol_opening", f"WITH e AS (SELECT date_trunc('month', d) AS p, event_type, user_id, arg_min(balance, d) AS b FROM ({_BAL}) GROUP BY ALL) SELECT CAST(CAST(p AS DATE) AS VARCHAR) AS period, CAST(sum(b) AS DOUBLE) AS balance FROM e GROUP BY 1")
def _(spark, sf):
    out = rol.opening(balances(spark, sf), "balance", "d", ["user_id", "event_type"])
    return money(out, "balance").withColumn("period", F.col("period").cast("string"))


@query("rol_semi_additive", f"WITH m AS (SELECT event_type, d, sum(balance) AS m FROM ({_BAL}) GROUP BY ALL) SELECT event_type, CAST(arg_max(m, d) AS DOUBLE) AS balance FROM m GROUP BY 1")
def _(spark, sf):
    return money(rol.semi_additive(balances(spark, sf), "balance", "sum", "last", ["event_type"], "d"), "balance")


@query("rol_mark_semi_additive", "SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN 'Sum' ELSE 'last' END AS regular, CASE p_size % 4 WHEN 0 THEN 'Last' WHEN 1 THEN 'last' WHEN 2 THEN 'sum' ELSE 'AVG' END AS rollup, p_size % 4 IN (0, 3) AS is_semi_additive FROM part")
def _(spark, sf):
    rules = table(spark, sf, "part").selectExpr("case when p_size % 2 = 0 then 'Sum' else 'last' end as regular", "case p_size % 4 when 0 then 'Last' when 1 then 'last' when 2 then 'sum' else 'AVG' end as rollup").distinct()
    return rol.mark_semi_additive(rules)


@query(
    "rol_with_total",
    f"WITH g AS (SELECT o_orderpriority AS label, CAST(sum({PRICE}) AS DOUBLE) AS total, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0 END), 6) AS share FROM orders GROUP BY 1) SELECT label, round(total, 2) AS total, round(share, 6) AS share, false AS is_total FROM g UNION ALL SELECT 'Total', round(sum(total), 2), round(avg(share), 6), true FROM g",
)
def _(spark, sf):
    g = money(table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("label")).agg(F.sum(F.expr(PRICE)).alias("total"), F.round(F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)), 6).alias("share")), "total")
    out = rol.with_total(g, "label", {"total": "measure", "share": "percent"})
    return out.withColumns({"total": F.round("total", 2), "share": F.round("share", 6)})


@query("model_one_to_one_join", "SELECT c_mktsegment AS segment, count(*) AS n, CAST(sum(o.spent) AS DOUBLE) AS spent FROM customer LEFT JOIN (SELECT o_custkey, sum(cast(o_totalprice as decimal(14,2))) AS spent FROM orders GROUP BY 1) o ON c_custkey = o_custkey GROUP BY 1")
def _(spark, sf):
    spent = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.sum(F.expr(PRICE)).alias("spent"))
    m = Model(
        [
            Dataset("customer", table(spark, sf, "customer"), [Field("custkey", "c_custkey"), Field("segment", "c_mktsegment")], key=["custkey"], metrics=[Metric("n", "count", "custkey")]),
            Dataset("spending", spent, [Field("spender", "k"), Field("spent")], key=["spender"]),
        ],
        [Relationship("spends", "customer", "spending", [("custkey", "spender")], "one_to_one")],
    )
    out = m.joined("customer", ["spending.spent"]).groupBy(F.col("customer__segment").alias("segment")).agg(F.count("*").alias("n"), F.sum("spending__spent").alias("spent"))
    return money(out, "spent")


@query("agg_xirr", _rate_sql("date_diff('day', d0, d) / 365.0"))
def _(spark, sf):
    return _log_growth(agg.xirr(cash_flows(spark, sf), "grp", "amount", "d"))


@query("agg_lod_levels", f"SELECT DISTINCT o_orderstatus, o_orderpriority, CAST(sum({PRICE}) OVER (PARTITION BY o_orderstatus, o_orderpriority) AS DOUBLE) AS included, CAST(sum({PRICE}) OVER (PARTITION BY o_orderstatus) AS DOUBLE) AS excluded FROM orders")
def _(spark, sf):
    view, price = ["o_orderstatus"], F.sum(F.expr(PRICE))
    finer = agg.include_level(view, ["o_orderpriority"])
    rows = agg.lod(table(spark, sf, "orders"), price, finer, "included")
    rows = agg.lod(rows, price, agg.exclude_level(finer, ["o_orderpriority"]), "excluded")
    return money(rows.select(*finer, "included", "excluded").distinct(), "included", "excluded")


@query(
    "agg_percentile_all",
    "WITH r AS (SELECT o_totalprice AS v, row_number() OVER (ORDER BY o_totalprice) AS rn, count(*) OVER () AS n FROM orders), "
    "k AS (SELECT 0.9 * (n + 1) AS rk, max(CASE WHEN rn = floor(0.9 * (n + 1)) THEN v END) AS lo, max(CASE WHEN rn = floor(0.9 * (n + 1)) + 1 THEN v END) AS hi FROM r GROUP BY n) "
    "SELECT round(lo + (rk - floor(rk)) * (hi - lo), 6) AS percentile_exc FROM k",
)
def _(spark, sf):
    return agg.percentile_exclusive(table(spark, sf, "orders"), "o_totalprice", 0.9).withColumn("percentile_exc", F.round("percentile_exc", 6))


@query("agg_spearman_all", "WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b FROM lineitem) SELECT round(corr(a, b), 8) AS spearman FROM r")
def _(spark, sf):
    return agg.spearman(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").withColumn("spearman", F.round("spearman", 8))


@query("rol_opening_boundary", f"WITH e AS (SELECT date_trunc('month', d) AS p, user_id, event_type, arg_max(balance, d) AS b FROM ({_BAL}) GROUP BY ALL) SELECT CAST(CAST(p + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS period, CAST(sum(b) AS DOUBLE) AS opening FROM e GROUP BY 1")
def _(spark, sf):
    out = rol.opening_boundary(balances(spark, sf), "balance", "d", ["user_id", "event_type"])
    return money(out, "opening").withColumn("period", F.col("period").cast("string"))


@query("flt_field_expressions", "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') AND NOT o_totalprice BETWEEN 1000 AND 50000 THEN 'a' WHEN o_orderstatus IS NULL THEN 'b' ELSE coalesce(nullif(o_orderpriority, '5-LOW'), 'low') END AS label, CAST(o_custkey AS VARCHAR) AS k, CAST(o_totalprice * 2 + 1 AS DOUBLE) AS x FROM orders")
def _(spark, sf):
    ds = Dataset(
        "orders",
        table(spark, sf, "orders"),
        [
            Field("o_orderkey"),
            Field("label", "CASE WHEN o_orderstatus IN ('F', 'O') AND NOT o_totalprice BETWEEN 1000 AND 50000 THEN 'a' WHEN o_orderstatus IS NULL THEN 'b' ELSE coalesce(nullif(o_orderpriority, '5-LOW'), 'low') END"),
            Field("k", "CAST(o_custkey AS STRING)"),
            Field("x", "CAST(o_totalprice * 2 + 1 AS DOUBLE)"),
        ],
        key=["o_orderkey"],
    )
    return ds.frame()
