"""Queries of value rules and scalar helpers over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.functions import columns as col
from metricspark.operators import workdays
from metricspark.plans.registry import query, table


@query("val_safe_ratio", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount = 0 THEN 0.0 ELSE l_tax / l_discount END AS safe, CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS divided FROM lineitem")
def _(spark, sf):
    a, b = F.col("l_tax"), F.col("l_discount")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", col.safe_ratio(a, b).alias("safe"), col.divide(a, b).alias("divided"))


# Names and the kinds that the value rules give them.
_KINDS = (
    ("customer_name", "label"), ("FISCAL_MONTH_ID", "label"), ("order_date", "label"), ("level2", "label"), ("updated_timestamp", "label"), ("growth_usd", "percent"), ("attainment", "percent"),
    ("gross_margin", "percent"), ("SALES_QUANTITY_TOTAL", "count"), ("order_count", "count"), ("n_rows", "count"), ("total_revenue", "currency"), ("backlog", "currency"), ("booked_usd", "currency"), ("latitude", "number"), ("win_rate", "number"),
)


@query("val_field_kind", "SELECT c_custkey, CASE c_custkey % 16 " + " ".join(f"WHEN {i} THEN '{kind}'" for i, (_, kind) in enumerate(_KINDS)) + " END AS kind FROM customer")
def _(spark, sf):
    name = F.element_at(F.array(*[F.lit(x) for x, _ in _KINDS]), (F.col("c_custkey") % 16 + 1).cast("int"))
    return table(spark, sf, "customer").select("c_custkey", col.field_kind(name).alias("kind"))


_SCALED = "SELECT c_custkey, c_nationkey, c_acctbal * (CASE c_custkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 1000000 END) AS v FROM customer"


@query(
    "val_formats",
    "SELECT c_custkey, CASE WHEN v IS NULL THEN '--' ELSE (CASE WHEN v < 0 THEN '-' ELSE '' END) || '$' || CASE WHEN abs(v) >= 1e9 THEN format('{:.1f}B', abs(v) / 1e9) WHEN abs(v) >= 1e6 THEN format('{:.1f}M', abs(v) / 1e6) WHEN abs(v) >= 1e3 THEN format('{:.0f}K', abs(v) / 1e3) ELSE format('{:,.0f}', abs(v)) END END AS money, "
    "CASE WHEN v IS NULL THEN '--' ELSE format('{:,}', CAST(c_custkey * 1000 AS BIGINT)) END AS cnt, (CASE WHEN c_nationkey >= 12 THEN '+' ELSE '-' END) || format('{:.1f}%', abs(c_nationkey - 12) * CASE WHEN abs(c_nationkey - 12) <= 5 THEN 100.0 ELSE 1.0 END) AS pct, "
    f"CASE WHEN v IS NULL THEN '--' ELSE format('{{:.1f}}%', c_nationkey / 25.0 * 100) END AS share FROM ({_SCALED})",
)
def _(spark, sf):
    scale = F.when(F.col("c_custkey") % 4 == 0, 1.0).when(F.col("c_custkey") % 4 == 1, 1e3).when(F.col("c_custkey") % 4 == 2, 1e6)
    rows = table(spark, sf, "customer").withColumn("v", F.col("c_acctbal") * scale)
    given = lambda c: F.when(F.col("v").isNotNull(), c)
    return rows.select(
        "c_custkey",
        col.compact_currency(F.col("v")).alias("money"),
        col.count_format(given(F.col("c_custkey") * 1000)).alias("cnt"),
        col.signed_percent(F.col("c_nationkey") - 12).alias("pct"),
        col.unsigned_share(given(F.col("c_nationkey") / 25.0)).alias("share"),
    )


@query("scl_logic", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS switched, coalesce(nullif(o_orderstatus, 'P'), '?') AS filled, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(o_custkey AS BIGINT) END AS zn, CASE WHEN o_totalprice < 1000 THEN 'below 1000' WHEN o_totalprice < 100000 THEN '1000 to 100000' WHEN o_totalprice < 200000 THEN '100000 to 200000' ELSE '200000 or above' END AS tier, CAST(floor(o_totalprice / 5000) * 5000 AS BIGINT) AS bin FROM orders")
def _(spark, sf):
    s = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        col.switch(s, [("F", "done"), ("O", "open")], F.lit("other")).alias("switched"),
        F.coalesce(F.nullif(s, F.lit("P")), F.lit("?")).alias("filled"),
        col.zn(F.when(s != "P", F.col("o_custkey"))).alias("zn"),
        col.tier(F.col("o_totalprice"), [1000, 100000, 200000]).alias("tier"),
        col.bin_floor(F.col("o_totalprice"), 5000).cast("long").alias("bin"),
    )


@query("scl_if_error_decode", "SELECT p_partkey, coalesce(TRY_CAST(p_brand AS INT), -1) AS as_int, CASE p_size % 3 WHEN 0 THEN 'zero' WHEN 1 THEN 'one' ELSE 'more' END AS decoded, TRY_CAST(p_name AS DOUBLE) IS NOT NULL AS is_num FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", col.if_error(F.col("p_brand").try_cast("int"), F.lit(-1)).alias("as_int"), col.decode(F.col("p_size") % 3, 0, "zero", 1, "one", "more").alias("decoded"), col.is_number(F.col("p_name")).alias("is_num")
    )


@query(
    "scl_text",
    "SELECT p_partkey, substr(p_name, 2, 4) AS mid, replace(p_name, 'a', 'A') AS subst, substr(p_name, 1, 1) || '##' || substr(p_name, 4) AS replaced, nullif(strpos(lower(p_name), 'e'), 0) AS searched, nullif(strpos(p_name, 'e'), 0) AS found, upper(p_brand) || '-' || p_type AS combined, left(p_name, 3) AS l, right(p_name, 3) AS r, reverse(p_name) AS rev, length(p_name) AS len, lpad(p_brand, 12, '*') AS lp, rpad(p_brand, 12, '*') AS rp, repeat('ab', 2) AS rept, p_name LIKE '%a%' AS contains_a, starts_with(p_name, 'p') AS starts_p, CAST(ascii(p_name) AS INT) AS code, trim('  x ') AS trimmed, p_brand = upper(p_brand) AS exact FROM part",
)
def _(spark, sf):
    n, b = F.col("p_name"), F.col("p_brand")
    return table(spark, sf, "part").select(
        "p_partkey",
        col.mid(n, 2, 4).alias("mid"),
        F.replace(n, F.lit("a"), F.lit("A")).alias("subst"),
        col.replace_at(n, 2, 2, "##").alias("replaced"),
        col.search("E", n).alias("searched"),
        col.find("e", n).alias("found"),
        F.concat_ws("-", F.upper(b), "p_type").alias("combined"),
        F.left(n, F.lit(3)).alias("l"),
        F.right(n, F.lit(3)).alias("r"),
        F.reverse(n).alias("rev"),
        F.length(n).alias("len"),
        F.lpad(b, 12, "*").alias("lp"),
        F.rpad(b, 12, "*").alias("rp"),
        F.repeat(F.lit("ab"), 2).alias("rept"),
        n.contains("a").alias("contains_a"),
        n.startswith("p").alias("starts_p"),
        F.ascii(n).alias("code"),
        F.trim(F.lit("  x ")).alias("trimmed"),
        col.exact(b, F.upper(b)).alias("exact"),
    )


@query("scl_text_parts", "SELECT p_partkey, split_part(p_name, ' ', 1) AS first_part, CASE WHEN length(p_name) - length(replace(p_name, 'a', '')) >= 2 THEN length(array_to_string(list_slice(string_split(p_name, 'a'), 1, 2), 'a')) + 1 ELSE 0 END AS second_a FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("first_part"), col.find_nth(F.col("p_name"), "a", 2).cast("long").alias("second_a"))


@query("scl_regex", "SELECT p_partkey, regexp_matches(p_brand, '[13]$') AS matched, regexp_extract(p_brand, '([0-9]+)', 1) AS extracted, regexp_replace(p_type, '[aeiou]', '_', 'g') AS replaced, list_extract(regexp_extract_all(p_name, '[a-z]+'), 2) AS second, p_type ILIKE '%S%' AS ilike_s FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.col("p_brand").rlike("[13]$").alias("matched"), F.regexp_extract("p_brand", "([0-9]+)", 1).alias("extracted"), F.regexp_replace("p_type", "[aeiou]", "_").alias("replaced"), col.extract_nth(F.col("p_name"), "[a-z]+", 2).alias("second"), F.col("p_type").ilike("%S%").alias("ilike_s")
    )


@query("scl_date_diff", "SELECT o_orderkey, " + ", ".join(f"date_diff('{u}', o_orderdate, TIMESTAMP '2000-02-29 13:30:00') AS {u}s" for u in ("year", "quarter", "month", "day", "hour", "minute", "second")) + " FROM orders")
def _(spark, sf):
    end = F.lit("2000-02-29 13:30:00").cast("timestamp")
    return table(spark, sf, "orders").select("o_orderkey", *[col.date_diff(u, F.col("o_orderdate"), end).cast("long").alias(f"{u}s") for u in ("year", "quarter", "month", "day", "hour", "minute", "second")])


@query("scl_date_plus", "SELECT o_orderkey, " + ", ".join(f"CAST(CAST(CAST(o_orderdate AS DATE) {op} INTERVAL {n} {u} AS DATE) AS VARCHAR) AS {u}" for u, op, n in (("day", "+", 40), ("month", "+", 1), ("year", "-", 1))) + ", CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS quarter, CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 14 DAY AS DATE) AS VARCHAR) AS week, date_diff('second', o_orderdate, o_orderdate + INTERVAL 5 HOUR) AS hour_s FROM orders")
def _(spark, sf):
    d = F.to_date("o_orderdate")
    moves = (("day", 40), ("month", 1), ("year", -1), ("quarter", 1), ("week", 2))
    hour = F.unix_timestamp(col.date_plus("hour", F.col("o_orderdate").cast("timestamp"), 5)) - F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    return table(spark, sf, "orders").select("o_orderkey", *[col.date_plus(u, d, n).cast("string").alias(u) for u, n in moves], hour.alias("hour_s"))


@query("scl_date_parts", "SELECT o_orderkey, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS first_of, CAST(last_day(o_orderdate + INTERVAL 1 MONTH) AS VARCHAR) AS eom, CAST(dayofweek(o_orderdate) + 1 AS INT) AS dow, CAST(dayofyear(o_orderdate) AS INT) AS doy, CAST(isoyear(o_orderdate) AS INT) AS iso_year, CAST(weekofyear(o_orderdate) AS INT) AS iso_week, CAST(isodow(o_orderdate) AS INT) AS iso_weekday, CAST(quarter(o_orderdate) AS INT) AS iso_quarter, monthname(o_orderdate) AS month_name FROM orders")
def _(spark, sf):
    d = F.to_date("o_orderdate")
    iso = {k: v.cast("int").alias(k) for k, v in col.iso_parts(d).items()}
    return table(spark, sf, "orders").select("o_orderkey", col.first_of_month(d).cast("string").alias("first_of"), col.end_of_month(d, 1).cast("string").alias("eom"), col.weekday_number(d).alias("dow"), F.dayofyear(d).alias("doy"), *iso.values(), F.date_format(d, "MMMM").alias("month_name"))


@query("scl_dates_made", "SELECT o_orderkey, CAST(make_date(year(o_orderdate), month(o_orderdate), 1) AS VARCHAR) AS made, CASE WHEN o_orderkey % 2 = 0 THEN true ELSE false END AS is_date FROM orders")
def _(spark, sf):
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("1999-13-45")
    return table(spark, sf, "orders").select("o_orderkey", F.make_date(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1)).cast("string").alias("made"), col.is_date(text).alias("is_date"))


_DAYS = "g AS (SELECT CAST(d AS DATE) AS d FROM generate_series(DATE '1990-01-01', DATE '2002-12-31', INTERVAL 1 DAY) t(d))"


@query("scl_business_days", f"WITH {_DAYS}, c AS (SELECT d, sum(CASE WHEN isodow(d) < 6 THEN 1 ELSE 0 END) OVER (ORDER BY d DESC) AS n FROM g WHERE d < DATE '2001-12-31') SELECT o_orderkey, CAST(n AS BIGINT) AS days FROM orders JOIN c ON c.d = CAST(o_orderdate AS DATE)")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", col.business_days(F.to_date("o_orderdate"), F.lit("2001-12-31").cast("date")).cast("long").alias("days"))


# Two calendars: one rests on the first of each month, the other when an order of over 400,000 came in.
_WORKDAYS = (
    f"WITH {_DAYS}, h AS (SELECT 'monthly' AS cal, d FROM g WHERE day(d) = 1 UNION SELECT 'busy', CAST(o_orderdate AS DATE) FROM orders WHERE o_totalprice > 400000), "
    "w AS (SELECT k.cal, g.d FROM (SELECT unnest(['monthly', 'busy']) AS cal) k, g WHERE isodow(d) < 6 AND NOT EXISTS (SELECT 1 FROM h WHERE h.cal = k.cal AND h.d = g.d)), "
    "o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'monthly' ELSE 'busy' END AS cal, CAST(o_orderdate AS DATE) AS a, CAST(o_custkey % 41 - 20 AS INT) AS n FROM orders), "
    "s AS (SELECT o.*, a + n AS b FROM o) "
)


def _order_days(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Orders with their calendar, a day and a number, and the two calendars."""
    orders = table(spark, sf, "orders")
    rows = orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "monthly").otherwise("busy").alias("cal"), F.to_date("o_orderdate").alias("a"), (F.col("o_custkey") % 41 - 20).cast("int").alias("n"))
    spans = spark.createDataFrame([("monthly", "1990-01-01", "2002-12-31"), ("busy", "1990-01-01", "2002-12-31")], "calendar string, first_day string, last_day string")
    firsts = spans.filter("calendar = 'monthly'").select("calendar", F.explode(F.expr("sequence(date'1990-01-01', date'2002-12-31', interval 1 month)")).alias("day"))
    busy = orders.filter("o_totalprice > 400000").select(F.lit("busy").alias("calendar"), F.to_date("o_orderdate").alias("day"))
    return rows.withColumn("b", F.date_add("a", F.col("n"))), workdays.index(spans, firsts.unionByName(busy))


@query("scl_workdays_between", _WORKDAYS + "SELECT o_orderkey, CASE WHEN b >= a THEN (SELECT count(*) FROM w WHERE w.cal = s.cal AND w.d >= a AND w.d < b) ELSE -(SELECT count(*) FROM w WHERE w.cal = s.cal AND w.d >= b AND w.d < a) END AS workdays FROM s")
def _(spark, sf):
    """Working days of each order's calendar between two days, either of which may come first."""
    rows, days = _order_days(spark, sf)
    return workdays.between(rows, days, "cal", "a", "b").select("o_orderkey", F.col("workdays").cast("long").alias("workdays"))


@query(
    "scl_add_workdays",
    _WORKDAYS + ", r AS (SELECT cal, d, row_number() OVER (PARTITION BY cal ORDER BY d) AS k FROM w), p AS (SELECT s.*, (SELECT count(*) FROM w WHERE w.cal = s.cal AND w.d < a) AS before, (SELECT count(*) FROM w WHERE w.cal = s.cal AND w.d <= a) AS through FROM s) "
    "SELECT o_orderkey, CAST(r.d AS VARCHAR) AS workday FROM p JOIN r ON r.cal = p.cal AND r.k = CASE WHEN n > 0 THEN through + n ELSE before + n + 1 END",
)
def _(spark, sf):
    """The day so many working days later or earlier."""
    rows, days = _order_days(spark, sf)
    return workdays.add(rows, days, "cal", "a", "n").select("o_orderkey", F.col("workday").cast("string").alias("workday"))


@query(
    "scl_rounding",
    "WITH v AS (SELECT c_custkey, c_acctbal AS x, CAST(floor(c_acctbal) AS INT) AS i FROM customer) SELECT c_custkey, sign(x) * ceil(abs(x)) AS up, sign(x) * floor(abs(x)) AS down, CAST(floor(x) AS BIGINT) AS int_, CAST(ceil(x / 25) * 25 AS BIGINT) AS c25, CAST(floor(x / 25) * 25 AS BIGINT) AS f25, CAST(sign(i) * (abs(i) + abs(i) % 2) AS BIGINT) AS even, CAST(CASE WHEN i = 0 THEN 1 ELSE sign(i) * (abs(i) + (abs(i) + 1) % 2) END AS BIGINT) AS odd, CAST(trunc(x / 7) AS BIGINT) AS quot, CAST(sign(i) * floor(abs(i) / 50.0 + 0.5) * 50 AS BIGINT) AS m50 FROM v",
)
def _(spark, sf):
    rows = table(spark, sf, "customer").withColumn("i", F.floor("c_acctbal").cast("int"))
    x = F.col("c_acctbal")
    return rows.select(
        "c_custkey",
        col.round_up(x).alias("up"),
        col.round_down(x).alias("down"),
        F.floor(x).alias("int_"),
        col.ceiling_to(x, 25).cast("long").alias("c25"),
        col.floor_to(x, 25).cast("long").alias("f25"),
        col.even(F.col("i")).alias("even"),
        col.odd(F.col("i")).alias("odd"),
        col.quotient(x, F.lit(7)).alias("quot"),
        col.mround(F.col("i"), 50).cast("long").alias("m50"),
    )


@query("scl_math", "SELECT p_partkey, round(ln(p_retailprice), 9) AS ln, round(log10(p_retailprice), 9) AS l10, round(log2(p_retailprice), 9) AS l2, round(sqrt(p_retailprice), 9) AS sq, CAST(power(p_size, 2) AS DOUBLE) AS pw, abs(-p_size) AS ab, p_size % 7 AS md, p_size // 7 AS dv, round(sin(p_size), 9) AS sn, round(exp(p_size / 10.0), 6) AS ex, round(pi(), 9) AS pi FROM part")
def _(spark, sf):
    v, z = F.col("p_retailprice"), F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey", F.round(F.log(v), 9).alias("ln"), F.round(F.log10(v), 9).alias("l10"), F.round(col.log_base(v, 2), 9).alias("l2"), F.round(F.sqrt(v), 9).alias("sq"), F.pow(z, 2).alias("pw"), F.abs(-z).alias("ab"), (z % 7).alias("md"), F.expr("cast(p_size div 7 as int)").alias("dv"), F.round(F.sin(z), 9).alias("sn"), F.round(F.exp(z / 10.0), 6).alias("ex"), F.round(F.pi(), 9).alias("pi")
    )


@query("scl_casts", "SELECT p_partkey, CAST(CAST(TRY_CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS DECIMAL(19,4)) AS DOUBLE) AS DOUBLE) AS money, strftime(DATE '1999-03-31', '%d/%m/%Y') AS shown, CAST(strptime('31/03/1999', '%d/%m/%Y') AS DATE) = DATE '1999-03-31' AS parsed, format('{:,.2f}', p_retailprice) AS fixed FROM part WHERE abs(p_retailprice * 1000 - floor(p_retailprice * 1000) - 0.5) > 0.01")
def _(spark, sf):
    rows = table(spark, sf, "part").filter("abs(p_retailprice * 1000 - floor(p_retailprice * 1000) - 0.5) > 0.01")
    day = F.lit("1999-03-31").cast("date")
    return rows.select("p_partkey", col.currency(F.regexp_extract("p_brand", "([0-9]+)", 1)).cast("double").alias("money"), F.date_format(day, "dd/MM/yyyy").alias("shown"), (F.to_date(F.lit("31/03/1999"), "dd/MM/yyyy") == day).alias("parsed"), col.fixed(F.col("p_retailprice")).alias("fixed"))


@query("scl_finance", "SELECT c_custkey, round(-(c_acctbal * power(1.01, 12)) * 0.01 / (power(1.01, 12) - 1), 6) AS pmt, round(-(c_acctbal * (power(1.01, 12) - 1) / 0.01) / power(1.01, 12), 4) AS pv, round(-(c_acctbal * (power(1.01, 12) - 1) / 0.01), 4) AS fv, round(-c_acctbal / 12, 6) AS pmt0 FROM customer")
def _(spark, sf):
    x = F.col("c_acctbal")
    return table(spark, sf, "customer").select("c_custkey", F.round(col.pmt(0.01, 12, x), 6).alias("pmt"), F.round(col.pv(0.01, 12, x), 4).alias("pv"), F.round(col.fv(0.01, 12, x), 4).alias("fv"), F.round(col.pmt(0, 12, x), 6).alias("pmt0"))


@query("scl_rand_between", "SELECT c_custkey, true AS in_range, true AS same_again, (SELECT count(*) >= 100 FROM customer) AS all_faces FROM customer")
def _(spark, sf):
    """Throws per customer: in range, the same when drawn again, and of all six faces where there are many."""
    throws = table(spark, sf, "customer").select("c_custkey", col.rand_between(1, 6, F.col("c_custkey"), seed=3).alias("die"), col.rand_between(1, 6, F.col("c_custkey"), seed=3).alias("again"))
    faces = throws.agg(F.count_distinct("die").alias("faces"))
    return throws.join(F.broadcast(faces), F.lit(True), "left").select("c_custkey", F.col("die").between(1, 6).alias("in_range"), (F.col("die") == F.col("again")).alias("same_again"), (F.col("faces") == 6).alias("all_faces"))


# The distribution function as a power series of the error function, with each term's factor in front of the next.
_NORM_SQL = "SELECT c_custkey, round(0.5 + exp(-z * z / 2) / sqrt(2 * pi()) * list_reduce(list_prepend(CAST(0.0 AS DOUBLE), list_transform(range(0, 60), lambda n: CAST(60 - n AS DOUBLE))), lambda s, n: (s * z * z / (2 * n + 1)) + 1) * z, 9) AS p, round(exp(-z * z / 2) / (3000.0 * sqrt(2 * pi())), 12) AS density FROM (SELECT c_custkey, (c_acctbal - 4500.0) / 3000.0 AS z FROM customer)"


@query("scl_norm_dist", _NORM_SQL)
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.round(col.norm_dist(F.col("c_acctbal"), 4500.0, 3000.0), 9).alias("p"), F.round(col.norm_dist(F.col("c_acctbal"), 4500.0, 3000.0, False), 12).alias("density"))


_PARENT = "SELECT p_partkey AS id, CASE WHEN p_partkey = (SELECT min(p_partkey) FROM part) THEN NULL ELSE CAST(floor((p_partkey - 1) / 5) AS BIGINT) END AS parent_id FROM part"


@query(
    "scl_paths",
    f"WITH RECURSIVE n AS ({_PARENT}), t AS (SELECT id, CAST(id AS VARCHAR) AS path, 1 AS depth FROM n WHERE parent_id IS NULL UNION ALL SELECT n.id, t.path || '|' || n.id, t.depth + 1 FROM n JOIN t ON n.parent_id = t.id) SELECT id, path, CAST(depth AS INT) AS depth, split_part(path, '|', 2) AS second, string_split(path, '|')[-1] AS own, CAST(depth AS INT) AS items FROM t",
)
def _(spark, sf):
    part = table(spark, sf, "part")
    first = part.agg(F.min("p_partkey").alias("root"))
    nodes = part.join(F.broadcast(first), F.lit(True), "left").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") != F.col("root"), F.floor((F.col("p_partkey") - 1) / 5)).alias("parent_id"))
    out = col.paths(nodes, "id", "parent_id")
    return out.select("id", "path", "depth", F.coalesce(col.path_item(F.col("path"), 2), F.lit("")).alias("second"), col.path_item_reverse(F.col("path"), 1).alias("own"), col.path_length(F.col("path")).alias("items"))


@query("scl_series", "SELECT c_custkey, value FROM customer, LATERAL (SELECT unnest(generate_series(1, c_nationkey, 3)) AS value)")
def _(spark, sf):
    """The numbers 1, 4, 7 ... up to each customer's nation."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return col.series(spark, 1, 25, 3).join(customers, F.col("value") <= F.col("c_nationkey")).select("c_custkey", "value")


@query("scl_row_number_limit", "SELECT o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25")
def _(spark, sf):
    return col.row_number_limit(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 25, F.col("o_totalprice"), F.col("o_orderkey")).select("o_orderkey")


@query("scl_misc", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END IS NULL AS is_blank, coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END, 'none') AS nvl, CASE WHEN c_custkey % 3 <> 0 THEN 'set' ELSE 'unset' END AS nvl2, CAST(c_custkey % 7 + 1 AS INT) AS plus_days, true AS today_is_date, chr(65 + CAST(c_nationkey AS INT)) AS letter, repeat(' ', 3) || 'x' AS spaced FROM customer")
def _(spark, sf):
    seg = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        seg.isNull().alias("is_blank"),
        F.nvl(seg, F.lit("none")).alias("nvl"),
        F.nvl2(seg, F.lit("set"), F.lit("unset")).alias("nvl2"),
        F.datediff(F.date_add(F.current_date(), (F.col("c_custkey") % 7 + 1).cast("int")), F.to_date(F.current_timestamp())).alias("plus_days"),
        F.lit(col.is_type(table(spark, sf, "customer").select(F.current_date().alias("today")), "today", "date")).alias("today_is_date"),
        F.char(F.col("c_nationkey") + 65).alias("letter"),
        F.concat(F.repeat(F.lit(" "), 3), F.lit("x")).alias("spaced"),
    )
