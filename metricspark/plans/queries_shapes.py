"""Queries of windows, ranked results, comparison shapes and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricspark.operators import moving, sets, shapes, topk
from metricspark.operators import ranges as rng
from metricspark.operators import windows as win
from metricspark.plans.queries_core import PRICE, REVENUE, money
from metricspark.plans.registry import query, table


def line_facts(spark, sf) -> DataFrame:
    """Line items with brand, type, year, month and exact revenue."""
    line, order, part = table(spark, sf, "lineitem"), table(spark, sf, "orders"), table(spark, sf, "part")
    joined = line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select("p_brand", "p_type", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.expr(REVENUE).alias("rev"), "o_orderstatus")


_FACTS = f"SELECT p_brand, p_type, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, {REVENUE} AS rev, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"
_WITH = f"WITH f AS ({_FACTS})"

# --- windows ------------------------------------------------------------------------------------------------------------


@query("win_ranks", "SELECT l_orderkey, l_linenumber, l_partkey, rank() OVER w AS rk, dense_rank() OVER w AS dr, round(percent_rank() OVER w, 10) AS pr, count(*) OVER (PARTITION BY l_orderkey ORDER BY l_quantity RANGE UNBOUNDED PRECEDING) AS rm FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_quantity)")
def _(spark, sf):
    by, q = ["l_orderkey"], F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", win.rank(by, q).cast("long").alias("rk"), win.dense_rank(by, q).cast("long").alias("dr"), F.round(win.rank_percentile(by, q), 10).alias("pr"), win.rank_modified(by, q).alias("rm")
    )


_O = "PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey"


@query("win_running", f"SELECT o_orderkey, CAST(row_number() OVER ({_O}) AS BIGINT) AS rn, " + ", ".join(f"CAST({fn}({PRICE}) OVER ({_O} ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS r_{fn}" for fn in ("sum", "min", "max")) + f", count(*) OVER ({_O} ROWS UNBOUNDED PRECEDING) AS r_count, CAST(sum({PRICE}) OVER ({_O} ROWS UNBOUNDED PRECEDING) AS DOUBLE) / count(*) OVER ({_O} ROWS UNBOUNDED PRECEDING) AS r_avg FROM orders")
def _(spark, sf):
    by, order, v = ["o_custkey"], (F.col("o_orderdate"), F.col("o_orderkey")), F.expr(PRICE)
    run = lambda fn: win.running(fn, v, by, *order)
    return table(spark, sf, "orders").select(
        "o_orderkey", win.row_number(by, *order).cast("long").alias("rn"), *[run(fn).cast("double").alias(f"r_{fn}") for fn in ("sum", "min", "max")], run("count").alias("r_count"), (win.running("sum", v, by, *order).cast("double") / run("count")).alias("r_avg")
    )


@query("win_windowed", f"SELECT o_orderkey, CAST(sum({PRICE}) OVER w AS DOUBLE) AS s, CAST(min({PRICE}) OVER w AS DOUBLE) AS lo, round(quantile_cont(o_totalprice, 0.5) OVER w, 6) AS med, round(quantile_cont(o_totalprice, 0.25) OVER w, 6) AS q1, round(stddev_samp(o_totalprice) OVER w, 3) AS sd FROM orders WINDOW w AS ({_O} ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)")
def _(spark, sf):
    by, order = ["o_custkey"], (F.col("o_orderdate"), F.col("o_orderkey"))
    at = lambda fn, v, **k: win.windowed(fn, v, -2, 1, by, order, **k)
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", at("sum", F.expr(PRICE)).cast("double").alias("s"), at("min", F.expr(PRICE)).cast("double").alias("lo"), F.round(at("median", price), 6).alias("med"), F.round(at("percentile", price, p=0.25), 6).alias("q1"), F.round(at("stdev", price), 3).alias("sd")
    )


@query("win_windowed_pairs", "SELECT l_orderkey, l_linenumber, l_partkey, round((covar_pop(l_quantity, l_discount) OVER w) + 3e-8, 6) + 0.0 AS cp FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
def _(spark, sf):
    order = (F.col("l_linenumber"), F.col("l_partkey"), F.col("l_quantity"))
    made = win.windowed("covarp", F.col("l_quantity"), Window.unboundedPreceding, Window.unboundedFollowing, ["l_orderkey"], order, F.col("l_discount"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.round(made + 3e-8, 6) + 0.0).alias("cp"))


@query("win_shift", f"SELECT o_orderkey, lag(o_orderkey, 1) OVER ({_O}) AS prev, lead(o_orderkey, 2) OVER ({_O}) AS next2 FROM orders")
def _(spark, sf):
    by, order = ["o_custkey"], (F.col("o_orderdate"), F.col("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey", win.shift(F.col("o_orderkey"), -1, by, *order).alias("prev"), win.shift(F.col("o_orderkey"), 2, by, *order).alias("next2"))


@query("win_partition_stat", f"SELECT o_orderkey, 1 - row_number() OVER ({_O}) AS first, count(*) OVER (PARTITION BY o_custkey) - row_number() OVER ({_O}) AS last, count(*) OVER (PARTITION BY o_custkey) AS size, CAST(sum({PRICE}) OVER (PARTITION BY o_custkey) AS DOUBLE) AS total FROM orders")
def _(spark, sf):
    by, order = ["o_custkey"], (F.col("o_orderdate"), F.col("o_orderkey"))
    stat = lambda fn, **k: win.partition_stat(fn, by, order, **k)
    return table(spark, sf, "orders").select("o_orderkey", *[stat(fn).cast("long").alias(fn) for fn in ("first", "last", "size")], stat("total", value=F.expr(PRICE)).cast("double").alias("total"))


@query("win_percent_of", f"{_WITH}, g AS (SELECT p_brand, y, CAST(sum(rev) AS DOUBLE) AS v, sum(rev) AS e FROM f GROUP BY 1, 2) SELECT p_brand, y, round(v / CAST(sum(e) OVER (PARTITION BY y) AS DOUBLE), 10) AS of_total, round(v / lag(v) OVER (PARTITION BY p_brand ORDER BY y) - 1, 8) AS of_previous FROM g")
def _(spark, sf):
    g = line_facts(spark, sf).groupBy("p_brand", "y").agg(F.sum("rev").alias("e")).withColumn("v", F.col("e").cast("double"))
    return g.select("p_brand", "y", F.round(win.pct_of_total(F.col("e"), ["y"]).cast("double"), 10).alias("of_total"), F.round(win.pct_of_previous(F.col("v"), ["p_brand"], F.col("y")), 8).alias("of_previous"))


@query("win_pareto", f"{_WITH}, g AS (SELECT p_brand, sum(rev) AS e FROM f GROUP BY 1), r AS (SELECT p_brand, e, row_number() OVER (ORDER BY e DESC, p_brand) AS rank, sum(e) OVER (ORDER BY e DESC, p_brand) AS run, sum(e) OVER () AS tot FROM g), p AS (SELECT *, CAST(run AS DOUBLE) * 100 / CAST(tot AS DOUBLE) AS pct FROM r) SELECT p_brand, CAST(e AS DOUBLE) AS value, CAST(rank AS INT) AS rank, round(pct, 6) AS cumulative_pct, CAST((SELECT min(rank) FROM p WHERE pct >= 80) AS INT) AS n_to_mark FROM p WHERE rank <= 20")
def _(spark, sf):
    facts = line_facts(spark, sf).groupBy("p_brand").agg(F.sum("rev").cast("double").alias("rev"))
    return win.pareto(facts, "p_brand", "rev").withColumn("cumulative_pct", F.round("cumulative_pct", 6))


@query("win_prefix_sums", f"SELECT o_orderkey, row_number() OVER w AS rank, CAST(sum({PRICE}) OVER (ORDER BY {PRICE} DESC, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM orders WINDOW w AS (ORDER BY {PRICE} DESC, o_orderkey)")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.expr(PRICE).alias("price"))
    return money(win.prefix_sums(rows, "price", "o_orderkey", 64), "running").select("o_orderkey", F.col("rank").cast("long").alias("rank"), "running")


_FOLD = (
    "r AS (SELECT k, row_number() OVER (ORDER BY t DESC NULLS LAST, k) AS rn, count(*) OVER () AS n FROM s), "
    "l AS (SELECT k, CASE WHEN n > {m} AND rn >= {m} THEN 'Other (' || (n - ({m} - 1)) || ')' ELSE k END AS folded FROM r)"
)


@query("win_mix", f"{_WITH}, s AS (SELECT p_brand AS k, sum(rev) AS t FROM f GROUP BY 1), {_FOLD.format(m=8)}, g AS (SELECT y, folded, sum(rev) AS e FROM f JOIN l ON p_brand = k GROUP BY 1, 2) SELECT y, folded AS p_brand, CAST(e AS DOUBLE) AS value, round(CAST(e AS DOUBLE) / CAST(sum(e) OVER (PARTITION BY y) AS DOUBLE), 8) AS share FROM g")
def _(spark, sf):
    out = win.mix(line_facts(spark, sf), "y", "p_brand", "rev")
    return out.select("y", "p_brand", F.col("value").cast("double").alias("value"), F.round(F.col("share").cast("double"), 8).alias("share")).withColumn("share", F.round(F.col("value") / F.sum("value").over(Window.partitionBy("y")), 8))


@query("win_spark_series", f"{_WITH}, g AS (SELECT p_brand, y * 100 + m AS p, sum(rev) AS e FROM f GROUP BY 1, 2), r AS (SELECT *, dense_rank() OVER (PARTITION BY p_brand ORDER BY p DESC) AS b FROM g) SELECT p_brand, array_to_string(list(CAST(e AS DECIMAL(38,4)) ORDER BY p), ';') AS series FROM r WHERE b <= 12 GROUP BY 1")
def _(spark, sf):
    rows = line_facts(spark, sf).withColumn("p", F.col("y") * 100 + F.col("m")).withColumn("rev", F.col("rev").cast("decimal(20,4)"))
    return win.spark_series(rows, "p_brand", "p", "rev").select("p_brand", F.expr("array_join(transform(series, x -> cast(x as string)), ';')").alias("series"))


@query("win_gap_series", f"SELECT CAST(year(o_orderdate) AS INT) AS y, CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN {PRICE} END), 0) AS DOUBLE) AS upper, CAST(coalesce(sum(CASE WHEN o_orderstatus = 'O' THEN {PRICE} END), 0) AS DOUBLE) AS lower, CAST(greatest(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN {PRICE} END), 0) - coalesce(sum(CASE WHEN o_orderstatus = 'O' THEN {PRICE} END), 0), 0) AS DOUBLE) AS gap FROM orders GROUP BY 1")
def _(spark, sf):
    rows = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    side = lambda s: F.when(F.col("o_orderstatus") == s, F.expr(PRICE))
    return money(win.gap_series(rows, "y", side("F"), side("O"), clamp=True), "upper", "lower", "gap")


@query("win_moving_median", "SELECT o_orderkey, round(median(o_totalprice) OVER w, 6) AS moving FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 500 PRECEDING AND 500 FOLLOWING)")
def _(spark, sf):
    """Median price of the thousand orders around each, by priority."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    out = moving.moving_percentile(rows, ["o_orderpriority"], [F.col("o_orderdate"), F.col("o_orderkey")], "o_totalprice", 0.5, 500, 500, block=2048)
    return out.select("o_orderkey", F.round("moving", 6).alias("moving"))


@query("win_moving_percentile", "SELECT l_orderkey, l_linenumber, l_partkey, round(quantile_cont(l_extendedprice, 0.9) OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS 99 PRECEDING), 6) AS moving FROM lineitem")
def _(spark, sf):
    """Ninth decile of the last hundred prices over all line items as one group."""
    names = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    out = moving.moving_percentile(table(spark, sf, "lineitem").select(*names), [], [F.col(c) for c in names], "l_extendedprice", 0.9, 99)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("moving", 6).alias("moving"))


_PEERS = (
    "FROM orders o LEFT JOIN orders p ON p.o_custkey = o.o_custkey AND {condition} GROUP BY o.o_orderkey"
)


@query("win_peers_less", f"SELECT o.o_orderkey, count(p.o_orderkey) AS n, CAST(sum(CAST(p.o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total, max(p.o_totalprice) AS most {_PEERS.format(condition='p.o_totalprice < o.o_totalprice')}")
def _(spark, sf):
    """The cheaper orders of the same customer: how many, their sum and the dearest."""
    rows = table(spark, sf, "orders").withColumn("price", F.expr(PRICE))
    out = rng.peers(rows, ["o_custkey"], [rng.Span("o_totalprice", high="o_totalprice", high_open=True)], {"n": ("count", "o_orderkey"), "total": ("sum", "price"), "most": ("max", "o_totalprice")})
    return money(out.select("o_orderkey", "n", "total", "most"), "total")


@query("win_peers_between", "SELECT o.o_orderkey, count(p.o_orderkey) AS n, max(p.o_totalprice) AS most, min(p.o_custkey) AS least_customer FROM orders o LEFT JOIN orders p ON p.o_orderpriority = o.o_orderpriority AND p.o_totalprice BETWEEN o.o_totalprice - 500 AND o.o_totalprice + 250 GROUP BY o.o_orderkey")
def _(spark, sf):
    """Orders of the same priority whose price is near; the groups are a fifth of the table each."""
    near = rng.Span("o_totalprice", "o_totalprice - 500", "o_totalprice + 250")
    out = rng.peers(table(spark, sf, "orders"), ["o_orderpriority"], [near], {"n": ("count", "o_orderkey"), "most": ("max", "o_totalprice"), "least_customer": ("min", "o_custkey")})
    return out.select("o_orderkey", "n", "most", "least_customer")


@query("win_peers_two_columns", f"SELECT o.o_orderkey, count(p.o_orderkey) AS n, CAST(sum(CAST(p.o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total, max(p.o_totalprice) AS most {_PEERS.format(condition='p.o_orderdate < o.o_orderdate AND p.o_totalprice >= o.o_totalprice')}")
def _(spark, sf):
    """Earlier orders of the customer that cost at least as much."""
    rows = table(spark, sf, "orders").withColumn("price", F.expr(PRICE))
    spans = [rng.Span("o_orderdate", high="o_orderdate", high_open=True), rng.Span("o_totalprice", low="o_totalprice")]
    out = rng.peers(rows, ["o_custkey"], spans, {"n": ("count", "o_orderkey"), "total": ("sum", "price"), "most": ("max", "o_totalprice")})
    return money(out.select("o_orderkey", "n", "total", "most"), "total")


@query("win_peers_dominated", "SELECT o.p_partkey, count(p.p_partkey) AS n, CAST(sum(p.p_size) AS BIGINT) AS sizes FROM part o LEFT JOIN part p ON p.p_size BETWEEN o.p_size - 3 AND o.p_size + 3 AND p.p_retailprice > o.p_retailprice - 20 AND p.p_retailprice <= o.p_retailprice GROUP BY o.p_partkey")
def _(spark, sf):
    """Parts of like size a little cheaper, over all parts: two spans with both ends and no group."""
    spans = [rng.Span("p_size", "p_size - 3", "p_size + 3"), rng.Span("p_retailprice", "p_retailprice - 20", "p_retailprice", low_open=True)]
    return rng.peers(table(spark, sf, "part"), [], spans, {"n": ("count", "p_partkey"), "sizes": ("sum", "p_size")}).select("p_partkey", "n", "sizes")


@query("win_rows_before", "SELECT o_orderkey, (SELECT count(*) FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_totalprice < o.o_totalprice) AS n_cheaper FROM orders o")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", win.rows_before(["o_custkey"], F.col("o_totalprice")).cast("long").alias("n_cheaper"))


# --- top-k ----------------------------------------------------------------------------------------------------------------


@query("top_ranked", f"{_WITH} SELECT p_type, CAST(sum(rev) AS DOUBLE) AS value FROM f GROUP BY 1 ORDER BY 2 DESC, 1")
def _(spark, sf):
    return money(topk.ranked(line_facts(spark, sf), "p_type", "rev"), "value")


@query("top_fold_tail", f"{_WITH}, s AS (SELECT p_brand AS k, sum(rev) AS t FROM f GROUP BY 1), {_FOLD.format(m=8)} SELECT folded AS p_brand, CAST(sum(rev) AS DOUBLE) AS value FROM f JOIN l ON p_brand = k GROUP BY 1")
def _(spark, sf):
    return money(topk.fold_tail(line_facts(spark, sf), "p_brand", "rev"), "value")


@query("top_pre_aggregated", "SELECT CASE WHEN c_custkey = 5 THEN '(Missing)' ELSE c_name END AS c_name, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS value FROM customer WHERE c_custkey < 100")
def _(spark, sf):
    rows = table(spark, sf, "customer").filter("c_custkey < 100").selectExpr("case when c_custkey <> 5 then c_name end as c_name", "case when c_custkey % 7 <> 0 then c_acctbal end as bal")
    return topk.ranked_pre_aggregated(rows, "c_name", "bal")


@query("top_per_group", "SELECT o_custkey, o_orderkey, CAST(rn AS INT) AS rn FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3")
def _(spark, sf):
    return topk.top_k(table(spark, sf, "orders"), 3, [F.desc("o_totalprice"), F.col("o_orderkey")], ["o_custkey"]).select("o_custkey", "o_orderkey", "rn")


@query("top_global", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(spark, sf):
    return topk.top_k_global(table(spark, sf, "orders"), 10, F.desc("o_totalprice"), F.col("o_orderkey")).select("o_orderkey", "o_totalprice")


@query(
    "top_capped",
    "SELECT * FROM (SELECT 'orders' AS list, o_orderkey AS k, (SELECT count(*) > 500 FROM orders) AS truncated FROM orders ORDER BY o_orderkey LIMIT 500) "
    "UNION ALL SELECT * FROM (SELECT 'nations', n_nationkey, (SELECT count(*) > 500 FROM nation) FROM nation ORDER BY n_nationkey LIMIT 500)",
)
def _(spark, sf):
    lists = (("orders", "o_orderkey", "orders"), ("nations", "n_nationkey", "nation"))
    capped = [topk.capped(table(spark, sf, t).select(F.lit(name).alias("list"), F.col(key).cast("long").alias("k")), 500, F.col("k")) for name, key, t in lists]
    return capped[0].unionByName(capped[1])


@query("top_month_order", "SELECT label, CAST(CASE WHEN label IN ('x', '') THEN 99 ELSE month(strptime(left(label, 3), '%b')) END AS INT) AS place FROM (SELECT DISTINCT CASE WHEN o_orderkey % 50 = 0 THEN 'x' WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%B') ELSE strftime(o_orderdate, '%b') END AS label FROM orders)")
def _(spark, sf):
    label = F.when(F.col("o_orderkey") % 50 == 0, "x").when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "MMMM")).otherwise(F.date_format("o_orderdate", "MMM"))
    return table(spark, sf, "orders").select(label.alias("label")).distinct().withColumn("place", topk.month_order(F.col("label")))


@query("top_order_by_total", f"{_WITH}, g AS (SELECT p_type, y, sum(rev) AS e FROM f GROUP BY 1, 2) SELECT p_type, y, CAST(e AS DOUBLE) AS value, CAST(sum(e) OVER (PARTITION BY p_type) AS DOUBLE) AS row_total FROM g")
def _(spark, sf):
    g = line_facts(spark, sf).groupBy("p_type", "y").agg(F.sum("rev").alias("value"))
    return money(topk.order_by_total(g, "p_type", "value"), "value", "row_total")


# --- shapes ------------------------------------------------------------------------------------------------------------------


@query("piv_matrix", f"{_WITH} SELECT p_type, " + ", ".join(f"CAST(sum(CASE WHEN y = {y} THEN rev END) AS DOUBLE) AS \"{y}\"" for y in (1998, 1999, 2000)) + ", CAST(sum(rev) AS DOUBLE) AS row_total FROM f GROUP BY 1")
def _(spark, sf):
    return money(shapes.matrix(line_facts(spark, sf), "p_type", "y", "rev", [1998, 1999, 2000]), "1998", "1999", "2000", "row_total")


_YEARS = "c AS (SELECT y AS year, count(DISTINCT m) AS n_months FROM f GROUP BY 1), d AS (SELECT *, n_months = max(n_months) OVER () AS is_complete FROM c)"


@query("piv_complete_years", f"{_WITH}, {_YEARS} SELECT year, n_months, is_complete, CAST(CASE WHEN is_complete THEN row_number() OVER (PARTITION BY is_complete ORDER BY year DESC) END AS INT) AS recency, NOT is_complete AND year > (SELECT max(year) FROM d WHERE is_complete) AS is_later_partial FROM d")
def _(spark, sf):
    return shapes.complete_years(line_facts(spark, sf), "y", "m")


@query(
    "piv_waterfall",
    f"{_WITH}, {_YEARS}, y2 AS (SELECT max(year) AS y1, min(year) AS y0 FROM (SELECT year FROM d WHERE is_complete ORDER BY year DESC LIMIT 2)), "
    "s AS (SELECT p_brand AS label, coalesce(sum(CASE WHEN y = y0 THEN rev END), 0) AS v0, coalesce(sum(CASE WHEN y = y1 THEN rev END), 0) AS v1 FROM f, y2 GROUP BY 1), "
    "r AS (SELECT label, v1 - v0 AS delta, row_number() OVER (ORDER BY abs(v1 - v0) DESC, label) AS rn, count(*) OVER () AS n FROM s), "
    "t AS (SELECT CAST(CASE WHEN n > 7 AND rn >= 7 THEN 7 ELSE rn END AS INT) AS step, CASE WHEN n > 7 AND rn >= 7 THEN 'Other (' || (n - 6) || ')' ELSE label END AS label, sum(delta) AS delta FROM r GROUP BY 1, 2), "
    "w AS (SELECT 0 AS step, '(prior)' AS label, (SELECT sum(v0) FROM s) AS delta UNION ALL SELECT step, label, delta FROM t) "
    "SELECT step, label, CAST(delta AS DOUBLE) AS delta, CAST(sum(delta) OVER (ORDER BY step) AS DOUBLE) AS level, CASE WHEN step = 0 THEN 0.0 ELSE CAST(sum(delta) OVER (ORDER BY step) - delta AS DOUBLE) END AS base FROM w "
    "UNION ALL SELECT 9999, '(latest)', CAST(sum(v1) AS DOUBLE), CAST(sum(v1) AS DOUBLE), 0.0 FROM s",
)
def _(spark, sf):
    return money(shapes.waterfall(line_facts(spark, sf), "p_brand", "rev", "y", "m"), "delta", "level", "base")


@query("piv_trend", f"{_WITH} SELECT y, p_type, CAST(sum(rev) AS DOUBLE) AS value FROM f GROUP BY 1, 2")
def _(spark, sf):
    return money(shapes.trend(line_facts(spark, sf), "y", "rev", "p_type"), "value")


@query("piv_kpi", f"{_WITH}, g AS (SELECT p_type, CAST(sum(CASE WHEN y = 2000 THEN rev END) AS DOUBLE) AS v, CAST(sum(CASE WHEN y = 1999 THEN rev END) AS DOUBLE) AS c FROM f GROUP BY 1) SELECT p_type, v AS value, round(v - c, 4) AS delta, round((v - c) / nullif(c, 0), 8) AS delta_pct, round(v / nullif(c, 0), 8) AS attainment, CASE WHEN v / nullif(c, 0) >= 1 THEN 'good' WHEN v / nullif(c, 0) >= 0.9 THEN 'warn' WHEN c <> 0 THEN 'bad' END AS band FROM g")
def _(spark, sf):
    year = lambda y: F.sum(F.when(F.col("y") == y, F.col("rev"))).cast("double")
    out = shapes.kpi(line_facts(spark, sf), year(2000), year(1999), year(1999), ["p_type"])
    return out.withColumns({"delta": F.round("delta", 4), "delta_pct": F.round("delta_pct", 8), "attainment": F.round("attainment", 8)})


@query("piv_compare", f"{_WITH} SELECT 'total' AS label, CAST(sum(rev) AS DOUBLE) AS value FROM f UNION ALL SELECT 'lines', CAST(count(*) AS DOUBLE) FROM f")
def _(spark, sf):
    return shapes.compare(line_facts(spark, sf), {"total": F.sum("rev"), "lines": F.count("*")})


@query("piv_unpivot", "SELECT s_suppkey, 's_nationkey' AS field, s_nationkey AS value FROM supplier UNION ALL SELECT s_suppkey, 'len', CAST(length(s_name) AS INT) FROM supplier")
def _(spark, sf):
    return table(spark, sf, "supplier").withColumn("len", F.length("s_name")).unpivot(["s_suppkey"], ["s_nationkey", "len"], "field", "value")


# --- sets ---------------------------------------------------------------------------------------------------------------------


@query("set_union_feeds", "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL AS size FROM customer UNION ALL SELECT p_partkey, p_name, NULL, p_size FROM part")
def _(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return sets.union_feeds(a, b)


@query("set_members", " UNION ALL ".join(f"SELECT '{k}' AS op, count(*) AS n FROM (SELECT DISTINCT c_nationkey FROM customer WHERE c_acctbal > 5000 {op} SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal > 7000)" for k, op in (("union", "UNION"), ("except", "EXCEPT"), ("intersect", "INTERSECT"))))
def _(spark, sf):
    a, b = table(spark, sf, "customer").filter("c_acctbal > 5000").select("c_nationkey"), table(spark, sf, "supplier").filter("s_acctbal > 7000").select("s_nationkey")
    parts = [sets.members(a, b, k).agg(F.lit(k).alias("op"), F.count("*").alias("n")) for k in ("union", "except", "intersect")]
    return parts[0].union(parts[1]).union(parts[2])


@query(
    "set_diff_snapshots",
    "WITH a AS (SELECT p_brand AS tbl, p_name AS name, p_partkey AS k, p_type AS expr FROM part WHERE p_partkey % 10 <> 0), b AS (SELECT p_brand AS tbl, p_name AS name, p_partkey AS k, CASE WHEN p_partkey % 7 = 0 THEN 'NEW' ELSE '\"' || upper(p_type) || '\"' END AS expr FROM part WHERE p_partkey % 9 <> 0) "
    "SELECT coalesce(a.tbl, b.tbl) AS tbl, coalesce(a.name, b.name) AS name, coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'only_in_a' WHEN a.k IS NULL THEN 'only_in_b' WHEN lower(a.expr) = trim(lower(b.expr), '\"') THEN 'identical' ELSE 'expression_differs' END AS status FROM a FULL JOIN b ON a.tbl = b.tbl AND a.name = b.name AND a.k = b.k",
)
def _(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_brand").alias("tbl"), F.col("p_name").alias("name"), F.col("p_partkey").alias("k"), F.col("p_type").alias("expr"))
    new = F.when(F.col("k") % 7 == 0, "NEW").otherwise(F.concat(F.lit('"'), F.upper("expr"), F.lit('"')))
    return sets.diff_snapshots(part.filter("k % 10 <> 0"), part.filter("k % 9 <> 0").withColumn("expr", new), ["tbl", "name", "k"], "expr")


@query("set_containment", "SELECT o_custkey, list_has_all(list(DISTINCT o_orderstatus), ['F', 'O']) AS has_all, list_has_any(list(DISTINCT o_orderstatus), ['P']) AS has_any, list_contains(list(DISTINCT o_orderstatus), 'O') AS has_o FROM orders GROUP BY 1")
def _(spark, sf):
    g = table(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("s"))
    return g.select("o_custkey", sets.contains_all(F.col("s"), ["F", "O"]).alias("has_all"), sets.contains_any(F.col("s"), ["P"]).alias("has_any"), sets.is_contained(F.lit("O"), F.col("s")).alias("has_o"))


@query("top_order_abs", f"{_WITH}, g AS (SELECT p_type, sum(CASE WHEN y = 2000 THEN rev ELSE 0 END) - sum(CASE WHEN y = 1999 THEN rev ELSE 0 END) AS d FROM f GROUP BY 1) SELECT p_type, CAST(d AS DOUBLE) AS change, row_number() OVER (ORDER BY abs(d) DESC, p_type) AS place FROM g")
def _(spark, sf):
    side = lambda y: F.sum(F.when(F.col("y") == y, F.col("rev")).otherwise(0))
    g = line_facts(spark, sf).groupBy("p_type").agg((side(2000) - side(1999)).alias("change"))
    ordered = topk.order_abs(g, "change", "p_type")
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(F.abs("change")), "p_type"))
    return money(ordered.withColumn("place", place.cast("long")), "change")


@query("piv_pivot", "SELECT o_orderpriority, " + ", ".join(f"count(*) FILTER (o_orderstatus = '{s}') AS \"{s}\"" for s in "FOP") + " FROM orders GROUP BY 1")
def _(spark, sf):
    out = table(spark, sf, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count("o_orderkey"))
    return out.na.fill(0)
