"""Column helpers: value rules and scalar functions that Spark has under another name or meaning."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.lineage import cut

# --- value rules -----------------------------------------------------------------------------


def safe_ratio(a: Column, b: Column) -> Column:
    """Ratio for display: 0.0 on null, zero, NaN or infinity."""
    x, y = a.cast("double"), b.cast("double")
    r = F.try_divide(x, y)
    return F.when(r.isNull() | F.isnan(r) | (F.abs(r) == float("inf")), F.lit(0.0)).otherwise(r)


# Name parts that decide a field's kind, in the order they are tried.
KIND_PATTERNS = (
    ("label", r"date|month|quarter|year|period|timestamp|_id$|_name$|_code$|level\d?"),
    ("percent", r"growth|pct|percent|share|ratio|attainment|margin"),
    ("count", r"quantity|units|count|rows|orders"),
    ("currency", r"amount|sales|booking|booked|revenue|backlog|usd|cost|price"),
)
# Fixed value: what a formatter shows for a missing value or one that is no number.
MISSING = "--"


def field_kind(name: Column) -> Column:
    """Label, percent, count, currency or number, by name alone and in that order."""
    out = F.lit("number")
    for kind, pattern in reversed(KIND_PATTERNS):
        out = F.when(F.lower(name).rlike(pattern), kind).otherwise(out)
    return out


def _shown(v: Column, text: Column) -> Column:
    x = v.try_cast("double")
    return F.when(x.isNull() | F.isnan(x), MISSING).otherwise(text)


def _digits(v: Column, n: int) -> Column:
    """Fixed digits without thousands separators."""
    return F.translate(F.format_number(v, n), ",", "")


def compact_currency(v: Column, sign: str = "$") -> Column:
    """``$1.2B``, ``$3.4M``, ``$6K`` or ``$789``, minus sign first; ``--`` for no number."""
    x = v.try_cast("double")
    a = F.abs(x)
    part = lambda d, n, s: F.concat(_digits(a / d, n), F.lit(s))
    text = F.when(a >= 1e9, part(1e9, 1, "B")).when(a >= 1e6, part(1e6, 1, "M")).when(a >= 1e3, part(1e3, 0, "K")).otherwise(F.format_number(a, 0))
    return _shown(v, F.concat(F.when(x < 0, "-").otherwise(""), F.lit(sign), text))


def _percent(v: Column) -> Column:
    x = v.try_cast("double")
    return F.when(F.abs(x) <= 5, x * 100).otherwise(x)


def signed_percent(v: Column) -> Column:
    """``+12.3%``; values up to 5 are fractions; ``--`` for no number."""
    return _shown(v, F.concat(F.when(_percent(v) >= 0, "+").otherwise("-"), _digits(F.abs(_percent(v)), 1), F.lit("%")))


def unsigned_share(v: Column) -> Column:
    """``12.3%`` without a plus sign; ``--`` for no number."""
    return _shown(v, F.concat(_digits(_percent(v), 1), F.lit("%")))


def count_format(v: Column) -> Column:
    """Whole number with thousands separators; ``--`` for no number."""
    return _shown(v, F.format_number(v.try_cast("double"), 0))


def divide(a: Column, b: Column) -> Column:
    """Null on a zero or null divisor."""
    return F.try_divide(a, b)


# --- logic -------------------------------------------------------------------------------------


def switch(value: Column, pairs: Sequence[tuple], default: Column | None = None) -> Column:
    """First matching value's result."""
    out = F.when(value == F.lit(pairs[0][0]), F.lit(pairs[0][1]))
    for k, v in pairs[1:]:
        out = out.when(value == F.lit(k), F.lit(v))
    return out if default is None else out.otherwise(default)


def if_error(value: Column, alternate: Column) -> Column:
    """Alternate where a try-expression gave null."""
    return F.coalesce(value, alternate)


def zn(value: Column) -> Column:
    """Null as zero."""
    return F.coalesce(value, F.lit(0))


def decode(value: Column, *args) -> Column:
    """Pairs of value and result with an optional default; null matches null."""
    pairs, default = [(args[i], args[i + 1]) for i in range(0, len(args) - 1, 2)], args[-1] if len(args) % 2 else None
    out = F.when(value.eqNullSafe(F.lit(pairs[0][0])), F.lit(pairs[0][1]))
    for k, v in pairs[1:]:
        out = out.when(value.eqNullSafe(F.lit(k)), F.lit(v))
    return out.otherwise(F.lit(default))


def tier(value: Column, edges: Sequence[float]) -> Column:
    """Label of the half-open bin ``[a, b)`` a value falls in, null for null."""
    out = F.when(value < edges[0], f"below {edges[0]}")
    for a, b in zip(edges, edges[1:], strict=False):
        out = out.when(value < b, f"{a} to {b}")
    return out.when(value >= edges[-1], f"{edges[-1]} or above")


def bin_floor(value: Column, size: float) -> Column:
    """Lower edge of the value's bin."""
    return F.floor(value / size) * size


# --- text ----------------------------------------------------------------------------------------


def mid(text: Column, start: int, n: int) -> Column:
    """``n`` characters from a 1-based place."""
    return F.substring(text, start, n)


def replace_at(text: Column, start: int, n: int, new: str) -> Column:
    """Replacement by position."""
    return F.overlay(text, F.lit(new), F.lit(start), F.lit(n))


def search(part: str, text: Column) -> Column:
    """1-based place ignoring case, null if absent."""
    return F.nullif(F.locate(part.lower(), F.lower(text)), F.lit(0))


def find(part: str, text: Column) -> Column:
    """1-based place, null if absent."""
    return F.nullif(F.locate(part, text), F.lit(0))


def find_nth(text: Column, part: str, n: int) -> Column:
    """Place of the n-th occurrence of a part, 0 if there are fewer."""
    before = F.substring_index(text, part, n)
    enough = (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part) >= n
    return F.when(enough, F.length(before) + 1).otherwise(0)


def extract_nth(text: Column, pattern: str, n: int) -> Column:
    """The n-th match of a pattern, null if there are fewer."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.lit(n - 1))


def exact(a: Column, b: Column) -> Column:
    """Case-sensitive equality."""
    return a == b


# --- dates ------------------------------------------------------------------------------------------


def date_diff(unit: str, start: Column, end: Column) -> Column:
    """Boundaries of the unit crossed from start to end (weeks begin on Monday)."""
    months = lambda d: F.year(d) * 12 + F.month(d)
    seconds = lambda d: F.unix_timestamp(d.cast("timestamp"))
    steps = {"hour": 3600, "minute": 60, "second": 1}
    if unit == "year":
        return F.year(end) - F.year(start)
    if unit == "quarter":
        return (F.year(end) * 4 + F.quarter(end)) - (F.year(start) * 4 + F.quarter(start))
    if unit == "month":
        return months(end) - months(start)
    if unit == "week":
        monday = lambda d: F.to_date(F.date_trunc("week", d))
        return (F.datediff(monday(end), monday(start)) / 7).cast("int")
    if unit == "day":
        return F.datediff(end, start)
    n = steps[unit]
    return F.floor(seconds(end) / n) - F.floor(seconds(start) / n)


def duration(df: DataFrame, start: str, end: str, units: Sequence[str] = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")) -> DataFrame:
    """One column per unit between two timestamps."""
    return df.withColumns({f"{u}s_between": date_diff(u, F.col(start), F.col(end)) for u in units})


def date_plus(unit: str, d: Column, n: Column | int) -> Column:
    """A date or timestamp moved by whole units."""
    n = F.lit(n) if isinstance(n, int) else n
    months = {"month": 1, "quarter": 3, "year": 12}
    if unit in months:
        return F.add_months(d, n * months[unit])
    if unit in ("day", "week"):
        return F.date_add(d, n * (7 if unit == "week" else 1))
    part = {"hour": {"hours": n}, "minute": {"mins": n}, "second": {"secs": n}}[unit]
    return d + F.make_dt_interval(**part)


def first_of_month(d: Column) -> Column:
    """First day of the month."""
    return F.trunc(d, "month")


def end_of_month(d: Column, n: int = 0) -> Column:
    """Last day of the month ``n`` months on."""
    return F.last_day(F.add_months(d, n))


def weekday_number(d: Column, first: str = "sunday") -> Column:
    """1 to 7 from Sunday or Monday."""
    return F.dayofweek(d) if first == "sunday" else F.weekday(d) + 1


def iso_parts(d: Column) -> dict[str, Column]:
    """ISO year, week, weekday and quarter."""
    return {
        "iso_year": F.extract(F.lit("YEAROFWEEK"), d),
        "iso_week": F.weekofyear(d),
        "iso_weekday": F.weekday(d) + 1,
        "iso_quarter": F.quarter(d),
    }


def is_date(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Whether a text parses as a date."""
    return F.try_to_timestamp(text, F.lit(fmt)).isNotNull()


def business_days(start: Column, end: Column) -> Column:
    """Weekdays from start to the day before end; negative when end comes first."""
    # weekdays before a day, counted from a Monday
    def upto(d: Column) -> Column:
        days = F.datediff(d, F.lit("1900-01-01").cast("date"))
        return F.floor(days / 7) * 5 + F.least(F.pmod(days, F.lit(7)), F.lit(5))

    return (upto(end) - upto(start)).cast("int")


# --- numbers -------------------------------------------------------------------------------------------


def round_up(v: Column, digits: int = 0) -> Column:
    """Away from zero."""
    k = 10.0**digits
    return F.signum(v) * F.ceil(F.abs(v) * k) / k


def round_down(v: Column, digits: int = 0) -> Column:
    """Towards zero."""
    k = 10.0**digits
    return F.signum(v) * F.floor(F.abs(v) * k) / k


def ceiling_to(v: Column, multiple: float) -> Column:
    """Up to a multiple."""
    return F.ceil(v / multiple) * multiple


def floor_to(v: Column, multiple: float) -> Column:
    """Down to a multiple."""
    return F.floor(v / multiple) * multiple


def mround(v: Column, multiple: float) -> Column:
    """Nearest multiple, halves away from zero."""
    return F.round(v / multiple) * multiple


def even(v: Column) -> Column:
    """Away from zero to an even number."""
    return (F.signum(v) * F.ceil(F.abs(v) / 2) * 2).cast("long")


def odd(v: Column) -> Column:
    """Away from zero to an odd number; zero gives 1."""
    return F.when(v == 0, F.lit(1)).otherwise(F.signum(v) * (F.ceil((F.abs(v) + 1) / 2) * 2 - 1)).cast("long")


def quotient(a: Column, b: Column) -> Column:
    """Whole part of a division, null on zero."""
    r = F.try_divide(a.cast("double"), b.cast("double"))
    return (F.signum(r) * F.floor(F.abs(r))).cast("long")


def log_base(v: Column, base: float) -> Column:
    """Logarithm to a base, null below or at zero."""
    return F.when(v > 0, F.log(v) / F.log(F.lit(float(base))))


def rand_between(lo: int, hi: int, *key: Column, seed: int = 0) -> Column:
    """Whole number between two bounds from a hash of a row key, so reruns agree."""
    return F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(hi - lo + 1)) + lo


def currency(v: Column) -> Column:
    """Fixed-point money, null where the text is no number."""
    return v.try_cast("decimal(19,4)")


def is_number(text: Column) -> Column:
    """Whether a text is a number."""
    return text.try_cast("double").isNotNull()


def is_type(df: DataFrame, column: str, *kinds: str) -> bool:
    """Whether a column's declared type is one of the named ones."""
    return df.schema[column].dataType.typeName() in kinds


def fixed(v: Column, digits: int = 2) -> Column:
    """Number with thousands separators and fixed digits."""
    return F.format_number(v, digits)


# --- finance and statistics ------------------------------------------------------------------------------


def pmt(rate: float, n: int, pv: Column, fv: float = 0.0, due: int = 0) -> Column:
    """Payment per period."""
    if rate == 0:
        return -(pv + fv) / n
    k = (1 + rate) ** n
    return -(pv * k + fv) * rate / ((k - 1) * (1 + rate * due))


def pv(rate: float, n: int, payment: Column, fv: float = 0.0, due: int = 0) -> Column:
    """Present value."""
    if rate == 0:
        return -(payment * n + fv)
    k = (1 + rate) ** n
    return -(payment * (1 + rate * due) * (k - 1) / rate + fv) / k


def fv(rate: float, n: int, payment: Column, present: float = 0.0, due: int = 0) -> Column:
    """Future value."""
    if rate == 0:
        return -(payment * n + present)
    k = (1 + rate) ** n
    return -(present * k + payment * (1 + rate * due) * (k - 1) / rate)


# Coefficients of Hart's rational approximation of the normal tail (numerator and denominator, highest power first).
_TAIL = (
    (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376),
    (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752),
)


def norm_dist(x: Column, mean: float, sd: float, cumulative: bool = True) -> Column:
    """Normal distribution; the cumulative form by a rational approximation, as Spark has no error function."""
    z = ((x - mean) / sd).cast("double")
    if not cumulative:
        return F.exp(-z * z / 2) / (sd * (2 * pi) ** 0.5)
    a = F.abs(z)
    ratio = [reduce(lambda sum_, c: sum_ * a + c, rest, F.lit(first)) for first, *rest in _TAIL]
    fraction = reduce(lambda below, k: a + k / below, (4, 3, 2, 1), a + 0.65)
    tail = F.exp(-a * a / 2) * F.when(a < 5 * 2**0.5, ratio[0] / ratio[1]).otherwise(1 / (fraction * (2 * pi) ** 0.5))
    tail = F.when(a > 37, F.lit(0.0)).otherwise(tail)
    return F.when(z > 0, 1 - tail).otherwise(tail)


# --- parent-child paths --------------------------------------------------------------------------------------


def paths(df: DataFrame, id_col: str, parent_col: str, sep: str = "|") -> DataFrame:
    """``id, path, depth`` from the root to each node, level by level until a level is empty.

    Rows in a cycle or without a root have no path.  An id that stands under
    itself on a way from a root is an error.
    """
    nodes = df.select(F.col(id_col).alias("id"), F.col(parent_col).alias("up"))
    level = nodes.filter("up is null").select("id", F.col("id").cast("string").alias("path"), F.lit(1).alias("depth"))
    out, children, depth, most = level, nodes.filter("up is not null"), 1, nodes.count()
    while depth <= most:
        depth += 1
        above = level.select(F.col("id").alias("up"), "path")
        level = cut(children.join(above, "up").select("id", F.concat_ws(sep, "path", F.col("id").cast("string")).alias("path"), F.lit(depth).alias("depth")))
        if level.isEmpty():
            return out
        out = out.union(level)
        if depth % 8 == 0:  # keeps the plan of a long walk short
            out = cut(out)
    raise RuntimeError("an id stands under itself")


def path_item(path: Column, n: int, sep: str = "|") -> Column:
    """The n-th item from the root, null beyond the end."""
    return F.nullif(F.split_part(path, F.lit(sep), F.lit(n)), F.lit(""))


def path_item_reverse(path: Column, n: int, sep: str = "|") -> Column:
    """The n-th item from the node, null beyond the root."""
    return F.nullif(F.split_part(path, F.lit(sep), F.lit(-n)), F.lit(""))


def path_length(path: Column, sep: str = "|") -> Column:
    """Number of items of a path."""
    return F.size(F.split(path, f"[{sep}]"))


def series(spark, lo: int, hi: int, step: int = 1) -> DataFrame:
    """Whole numbers from ``lo`` to ``hi`` inclusive."""
    return spark.range(lo, hi + (1 if step > 0 else -1), step).withColumnRenamed("id", "value")


def row_number_limit(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Row-number limit with an explicit order."""
    return df.orderBy(*order).limit(n)

