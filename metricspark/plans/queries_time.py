"""Queries of relative-time windows and time intelligence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.operators import joins as jn
from metricspark.operators import timewin as tim
from metricspark.plans.queries_core import PRICE, money
from metricspark.plans.registry import query, table

AS_OF = "1998-08-15"
MEMBERS = [*tim.BOUNDS, "3 mon", "30 mon"]


def _orders(spark, sf) -> DataFrame:
    return table(spark, sf, "orders")


def _range(member: str, d: str) -> str:
    """First and last day of a window as DuckDB SQL, written independently of the operator."""
    m = lambda unit, n=0: f"(CAST(date_trunc('{unit}', DATE '{d}') AS DATE) {'-' if n >= 0 else '+'} INTERVAL {abs(n)} MONTH)"
    back = lambda n: f"(DATE '{d}' - INTERVAL {n} MONTH)"
    full = lambda unit, n, k, more=0: (m(unit, n * k + more), f"({m(unit, n * k + more - k)} - INTERVAL 1 DAY)")
    week = f"CAST(date_trunc('week', DATE '{d}') AS DATE)"
    table_ = {
        "week to date": (week, f"DATE '{d}'"),
        "prior week to date": (f"({week} - INTERVAL 7 DAY)", f"(DATE '{d}' - INTERVAL 7 DAY)"),
        "month to date": (m("month"), f"DATE '{d}'"),
        "prior month to date": (m("month", 1), back(1)),
        "quarter to date": (m("quarter"), f"DATE '{d}'"),
        "prior quarter to date": (m("quarter", 3), back(3)),
        "prior year quarter to date": (m("quarter", 12), back(12)),
        "year to date": (m("year"), f"DATE '{d}'"),
        "prior year to date": (m("year", 12), back(12)),
        "last week": (f"({week} - INTERVAL 7 DAY)", f"({week} - INTERVAL 1 DAY)"),
        "last month": full("month", 1, 1),
        "previous month": full("month", 2, 1),
        "last quarter": full("quarter", 1, 3),
        "previous quarter": full("quarter", 2, 3),
        "prior to previous quarter": full("quarter", 3, 3),
        "last year": full("year", 1, 12),
        "previous year": full("year", 2, 12),
        "last quarter last year": full("quarter", 1, 3, 12),
        "last month last year": full("month", 1, 1, 12),
        "3 mon": full("month", 3, 1),
        "30 mon": full("month", 30, 1),
    }
    for n in (3, 6, 12):
        table_[f"last {n} months"] = (back(n), f"DATE '{d}'")
        table_[f"previous {n} months"] = (back(2 * n), f"({back(n)} - INTERVAL 1 DAY)")
    return "CAST({} AS DATE)".format(table_[member][0]), "CAST({} AS DATE)".format(table_[member][1])


def _sums_sql(d: str, members, by: str = "") -> str:
    parts = []
    for m in members:
        lo, hi = _range(m, d)
        parts.append(f"CAST(coalesce(sum(CASE WHEN CAST(o_orderdate AS DATE) BETWEEN {lo} AND {hi} THEN {PRICE} END), 0) AS DOUBLE) AS \"{tim.column_name(m)}\"")
    return f"SELECT {by + ', ' if by else ''}{', '.join(parts)} FROM orders{f' GROUP BY {by}' if by else ''}"


@query("tim_window_sums", _sums_sql(AS_OF, MEMBERS, "o_orderpriority"))
def _(spark, sf):
    out = tim.window_sums(_orders(spark, sf), F.expr(PRICE), "o_orderdate", MEMBERS, ["o_orderpriority"], AS_OF)
    return money(out, *[tim.column_name(m) for m in MEMBERS])


@query("tim_window_sums_leap_day", _sums_sql("2000-02-29", MEMBERS))
def _(spark, sf):
    return money(tim.window_sums(_orders(spark, sf), F.expr(PRICE), "o_orderdate", MEMBERS, (), "2000-02-29"), *[tim.column_name(m) for m in MEMBERS])


@query("tim_window_sums_pruned", _sums_sql("1999-03-31", ["month to date", "prior month to date"]))
def _(spark, sf):
    names = ["mtd", "prior mtd"]
    out = tim.window_sums(_orders(spark, sf), F.expr(PRICE), "o_orderdate", names, (), "1999-03-31", prune=True)
    return money(out.withColumnsRenamed({"mtd": "month_to_date", "prior_mtd": "prior_month_to_date"}), "month_to_date", "prior_month_to_date")


@query("tim_window_bounds", " UNION ALL ".join(f"SELECT '{m}' AS member, CAST({_range(m, d)[0]} AS VARCHAR) AS first_day, CAST({_range(m, d)[1]} AS VARCHAR) AS last_day, '{d}' AS as_of, (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN {_range(m, d)[0]} AND {_range(m, d)[1]}) AS n_orders" for d in ("1999-03-31", "2000-02-29") for m in MEMBERS))
def _(spark, sf):
    frames = [tim.window_table(spark, MEMBERS, d).withColumn("as_of", F.lit(d)) for d in ("1999-03-31", "2000-02-29")]
    windows = frames[0].union(frames[1])
    days = _orders(spark, sf).groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    joined = windows.join(days, F.col("day").between(F.col("first_day"), F.col("last_day")), "left")
    return joined.groupBy("member", F.col("first_day").cast("string").alias("first_day"), F.col("last_day").cast("string").alias("last_day"), "as_of").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_orders"))


@query("tim_change_growth_rate", f"WITH s AS ({_sums_sql(AS_OF, ['year to date', 'prior year to date', 'last 3 months'], 'o_orderstatus')}) SELECT o_orderstatus, round(year_to_date - prior_year_to_date, 2) AS change, round((year_to_date - prior_year_to_date) / nullif(prior_year_to_date, 0), 8) AS growth, round(last_3_months / 3 * 12, 2) AS rate FROM s")
def _(spark, sf):
    s = money(tim.window_sums(_orders(spark, sf), F.expr(PRICE), "o_orderdate", ["year to date", "prior year to date", "last 3 months"], ["o_orderstatus"], AS_OF), "year_to_date", "prior_year_to_date", "last_3_months")
    a, b = F.col("year_to_date"), F.col("prior_year_to_date")
    return s.select("o_orderstatus", F.round(tim.change(a, b), 2).alias("change"), F.round(tim.growth(a, b), 8).alias("growth"), F.round(tim.rate(F.col("last_3_months"), 3, 12), 2).alias("rate"))


_CAL = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 7 THEN 1 ELSE 0 END AS INT) AS fiscal_year_id, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INT) AS month_id FROM orders"


def fiscal_calendar(spark, sf) -> DataFrame:
    """Days with fiscal years from July and running month ids."""
    d = F.col("o_orderdate")
    return _orders(spark, sf).select(
        F.to_date(d).alias("d"), (F.year(d) + F.when(F.month(d) >= 7, 1).otherwise(0)).alias("fiscal_year_id"), (F.year(d) * 12 + F.month(d)).alias("month_id")
    ).distinct()


@query("tim_fiscal_sums", f"WITH c AS ({_CAL}), n AS (SELECT * FROM c WHERE d = DATE '{AS_OF}') SELECT o_orderstatus, " + ", ".join(f"CAST(coalesce(sum(CASE WHEN c.{i} = n.{i} + ({k}) THEN {PRICE} END), 0) AS DOUBLE) AS {m}" for m, i, k in (("this_fy", "fiscal_year_id", 0), ("prior_fy", "fiscal_year_id", -1), ("last_month", "month_id", -1))) + " FROM orders JOIN c ON CAST(o_orderdate AS DATE) = c.d LEFT JOIN n ON true GROUP BY 1")
def _(spark, sf):
    offsets = {"this_fy": ("fiscal_year_id", 0), "prior_fy": ("fiscal_year_id", -1), "last_month": ("month_id", -1)}
    out = tim.fiscal_sums(_orders(spark, sf), F.expr(PRICE), offsets, AS_OF, fiscal_calendar(spark, sf), "o_orderdate", by=["o_orderstatus"])
    return money(out, *offsets)


@query("jn_with_calendar", f"WITH c AS ({_CAL}) SELECT fiscal_year_id, count(*) AS n FROM orders LEFT JOIN c ON CAST(o_orderdate AS DATE) = d GROUP BY 1")
def _(spark, sf):
    return jn.with_calendar(_orders(spark, sf), "o_orderdate", fiscal_calendar(spark, sf)).groupBy("fiscal_year_id").agg(F.count("*").alias("n"))


@query("tim_running_in_year", f"WITH s AS (SELECT CAST(o_orderdate AS DATE) AS d, sum({PRICE}) AS v FROM orders GROUP BY 1) SELECT CAST(d AS VARCHAR) AS d, CAST(v AS DOUBLE) AS value, CAST(sum(v) OVER (PARTITION BY year(d) ORDER BY d) AS DOUBLE) AS to_date FROM s")
def _(spark, sf):
    return money(tim.running_in_period(_orders(spark, sf), F.sum(F.expr(PRICE)), "o_orderdate"), "value", "to_date").withColumn("d", F.col("d").cast("string"))


_MONTHLY = f"SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, sum({PRICE}) AS v FROM orders GROUP BY 1"


@query("tim_period_shift", f"WITH s AS ({_MONTHLY}) SELECT CAST(a.period AS VARCHAR) AS period, CAST(a.v AS DOUBLE) AS value, CAST(b.v AS DOUBLE) AS value_shifted FROM s a LEFT JOIN s b ON b.period = CAST(a.period - INTERVAL 2 MONTH AS DATE)")
def _(spark, sf):
    return money(tim.period_shift(_orders(spark, sf), F.sum(F.expr(PRICE)), "o_orderdate", "month", -2), "value", "value_shifted").withColumn("period", F.col("period").cast("string"))


@query("tim_same_period_last_year", f"WITH s AS ({_MONTHLY}) SELECT CAST(a.period AS VARCHAR) AS period, CAST(a.v AS DOUBLE) AS value, CAST(b.v AS DOUBLE) AS value_shifted FROM s a LEFT JOIN s b ON b.period = CAST(a.period - INTERVAL 12 MONTH AS DATE)")
def _(spark, sf):
    return money(tim.same_period_last_year(_orders(spark, sf), F.sum(F.expr(PRICE)), "o_orderdate"), "value", "value_shifted").withColumn("period", F.col("period").cast("string"))


@query("tim_dates_between", "SELECT count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-31' AND DATE '1997-03-01'")
def _(spark, sf):
    day = lambda x: F.lit(x).cast("date")
    return tim.dates_between(_orders(spark, sf), "o_orderdate", day("1997-01-31"), day("1997-03-01")).agg(F.count("*").alias("n"))


@query("tim_dates_in_period", "SELECT count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-07-16' AND DATE '1997-08-15'")
def _(spark, sf):
    return tim.dates_in_period(_orders(spark, sf), "o_orderdate", F.lit("1997-08-15").cast("date"), -1, "month").agg(F.count("*").alias("n"))


@query(
    "tim_adjacent_periods",
    " UNION ALL ".join(
        f"SELECT '{side} {unit}' AS member, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) >= CAST(date_trunc('{unit}', DATE '{AS_OF}') {op} INTERVAL 1 {unit} AS DATE) AND CAST(o_orderdate AS DATE) < CAST(date_trunc('{unit}', DATE '{AS_OF}') {op} INTERVAL 1 {unit} + INTERVAL 1 {unit} AS DATE)"
        for side, op in (("previous", "-"), ("next", "+"))
        for unit in ("day", "month", "quarter", "year")
    ),
)
def _(spark, sf):
    day, rows = F.to_date("o_orderdate"), _orders(spark, sf)
    members = [f"{s} {u}" for s in ("previous", "next") for u in ("day", "month", "quarter", "year")]
    counts = rows.agg(*[F.count(F.when(day.between(*tim.adjacent(m, AS_OF)), 1)).alias(m) for m in members])
    return counts.unpivot([], members, "member", "n")


@query("tim_first_last_date", "SELECT o_orderstatus, CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first_date, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_date FROM orders GROUP BY 1")
def _(spark, sf):
    d = F.to_date("o_orderdate")
    return _orders(spark, sf).groupBy("o_orderstatus").agg(F.min(d).cast("string").alias("first_date"), F.max(d).cast("string").alias("last_date"))


@query("tim_calendar_auto", "SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS d, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, CAST(weekofyear(d) AS INT) AS iso_week, CAST(isodow(d) AS INT) AS iso_weekday FROM (SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)), date_trunc('year', max(o_orderdate)) + INTERVAL 12 MONTH - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders)")
def _(spark, sf):
    return tim.calendar_auto(_orders(spark, sf), "o_orderdate").withColumn("d", F.col("d").cast("string"))


@query("tim_timeframes", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS f_date, CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS f_week, strftime(o_orderdate, '%Y-%m') AS f_month, CAST(CAST(date_trunc('quarter', o_orderdate) AS DATE) AS VARCHAR) AS f_quarter, CAST(year(o_orderdate) AS INT) AS f_year, CAST(isodow(o_orderdate) - 1 AS INT) AS f_dow, CAST(dayofyear(o_orderdate) AS INT) AS f_doy, 'Q' || quarter(o_orderdate) AS f_qoy FROM orders")
def _(spark, sf):
    frames = {"date": "f_date", "week": "f_week", "month": "f_month", "quarter": "f_quarter", "year": "f_year", "day_of_week_index": "f_dow", "day_of_year": "f_doy", "quarter_of_year": "f_qoy"}
    out = tim.timeframes(_orders(spark, sf), "o_orderdate", list(frames))
    text = {"f_date", "f_week", "f_quarter"}
    return out.select("o_orderkey", *[(F.col(f"o_orderdate_{k}").cast("string") if v in text else F.col(f"o_orderdate_{k}")).alias(v) for k, v in frames.items()])


@query("tim_edge_days", "SELECT CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first_date, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_date, " + ", ".join(f"CAST(CAST(date_trunc('{u}', min(o_orderdate)) AS DATE) AS VARCHAR) AS start_of_{u}, CAST(CAST(date_trunc('{u}', max(o_orderdate)) + INTERVAL {n} MONTH - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS end_of_{u}" for u, n in (("month", 1), ("quarter", 3), ("year", 12))) + " FROM orders")
def _(spark, sf):
    out = tim.edge_days(_orders(spark, sf), "o_orderdate")
    return out.select(*[F.col(c).cast("string").alias(c) for c in out.columns])


@query("tim_duration_group", "SELECT o_orderkey, l_linenumber, l_shipdate, " + ", ".join(f"date_diff('{u}', o_orderdate, l_shipdate) AS {u}s_between" for u in ("second", "minute", "hour", "day", "month", "quarter", "year")) + ", CAST(date_diff('day', date_trunc('week', o_orderdate), date_trunc('week', l_shipdate)) / 7 AS BIGINT) AS weeks_between FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def _(spark, sf):
    from metricspark.functions.columns import duration

    joined = table(spark, sf, "lineitem").join(_orders(spark, sf), F.col("l_orderkey") == F.col("o_orderkey"))
    out = duration(joined, "o_orderdate", "l_shipdate")
    return out.select("o_orderkey", "l_linenumber", "l_shipdate", *[F.col(c).cast("long").alias(c) for c in out.columns if c.endswith("s_between")])


@query("tim_calendar", "SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS d, CAST(isodow(d) AS INT) AS iso_weekday, count(o_orderkey) AS n FROM (SELECT unnest(generate_series(TIMESTAMP '1998-01-01', TIMESTAMP '1998-12-31', INTERVAL 1 DAY)) AS d) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY 1, 2")
def _(spark, sf):
    day = lambda x: F.lit(x).cast("date")
    days = tim.calendar(spark, day("1998-01-01"), day("1998-12-31"))
    counts = _orders(spark, sf).groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("n"))
    return days.join(counts, "d", "left").select(F.col("d").cast("string").alias("d"), "iso_weekday", F.coalesce("n", F.lit(0)).alias("n"))
