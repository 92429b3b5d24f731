"""Relative-time windows and time intelligence.

Windows are inclusive day ranges around ``as_of``.  Timestamps are cut to days
before they are compared, so the last day counts whole.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNITS = {"month": 1, "quarter": 3, "year": 12}


def _day(as_of) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def _start(d: Column, unit: str) -> Column:
    return F.to_date(F.date_trunc("week", d)) if unit == "week" else F.trunc(d, unit)


def _move(d: Column, unit: str, n: int) -> Column:
    return F.date_add(d, 7 * n) if unit == "week" else F.add_months(d, UNITS[unit] * n)


def _to_date(d: Column, unit: str, back_months: int = 0, back_weeks: int = 0) -> tuple[Column, Column]:
    low, high = _start(d, unit), d
    if back_weeks:
        return F.date_sub(low, 7 * back_weeks), F.date_sub(high, 7 * back_weeks)
    return (F.add_months(low, -back_months), F.add_months(high, -back_months)) if back_months else (low, high)


def _full(d: Column, unit: str, back: int, then_months: int = 0) -> tuple[Column, Column]:
    """The whole unit ``back`` units ago, moved back by further months."""
    low = F.add_months(_start(d, unit), -then_months) if then_months else _start(d, unit)
    low = _move(low, unit, -back)
    return low, F.date_sub(_move(low, unit, 1), 1)


def _bounds() -> dict:
    named = {
        "week to date": lambda d: _to_date(d, "week"),
        "prior week to date": lambda d: _to_date(d, "week", back_weeks=1),
        "month to date": lambda d: _to_date(d, "month"),
        "prior month to date": lambda d: _to_date(d, "month", 1),
        "quarter to date": lambda d: _to_date(d, "quarter"),
        "prior quarter to date": lambda d: _to_date(d, "quarter", 3),
        "prior year quarter to date": lambda d: _to_date(d, "quarter", 12),
        "year to date": lambda d: _to_date(d, "year"),
        "prior year to date": lambda d: _to_date(d, "year", 12),
        "last week": lambda d: _full(d, "week", 1),
        "last month": lambda d: _full(d, "month", 1),
        "previous month": lambda d: _full(d, "month", 2),
        "last quarter": lambda d: _full(d, "quarter", 1),
        "previous quarter": lambda d: _full(d, "quarter", 2),
        "prior to previous quarter": lambda d: _full(d, "quarter", 3),
        "last year": lambda d: _full(d, "year", 1),
        "previous year": lambda d: _full(d, "year", 2),
        "last quarter last year": lambda d: _full(d, "quarter", 1, 12),
        "last month last year": lambda d: _full(d, "month", 1, 12),
    }
    for n in (3, 6, 12):
        named[f"last {n} months"] = lambda d, n=n: (F.add_months(d, -n), d)
        named[f"previous {n} months"] = lambda d, n=n: (F.add_months(d, -2 * n), F.date_sub(F.add_months(d, -n), 1))
    return named


BOUNDS = _bounds()
#: ``5 mon``: the whole month that many months back, however many.
N_MONTHS = re.compile(r"(\d+)\s*mon(?:th)?s?")
#: Other spellings of the same windows.
ALIASES = {
    "wtd": "week to date",
    "mtd": "month to date",
    "qtd": "quarter to date",
    "ytd": "year to date",
    "prior wtd": "prior week to date",
    "prior mtd": "prior month to date",
    "prior qtd": "prior quarter to date",
    "prior ytd": "prior year to date",
    "py qtd": "prior year quarter to date",
    "py ytd": "prior year to date",
}


def bounds(member: str, as_of=None) -> tuple[Column, Column]:
    """First and last day of a named window."""
    name = member.strip().lower()
    name = ALIASES.get(name, name)
    back = N_MONTHS.fullmatch(name)
    if back and int(back[1]):
        return _full(_day(as_of), "month", int(back[1]))
    if name not in BOUNDS:
        raise ValueError(f"no window named {member!r}")
    return BOUNDS[name](_day(as_of))


def window_table(df_or_spark, members: Sequence[str], as_of=None) -> DataFrame:
    """``member, first_day, last_day`` of named windows."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    rows = F.array(*[F.struct(F.lit(m).alias("member"), *[b.alias(n) for b, n in zip(bounds(m, as_of), ("first_day", "last_day"), strict=True)]) for m in members])
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def column_name(member: str) -> str:
    """Column name of a window: lower case, underscores."""
    return "_".join(member.strip().lower().split())


def window_sums(df: DataFrame, measure: Column, date_col: str, members: Sequence[str], by: Sequence[str] = (), as_of=None, prune: bool = False) -> DataFrame:
    """Sum of the measure in each window, all in one pass; an empty window is 0.

    ``prune`` adds the range that covers all windows as a filter for the scan;
    groups without a row in it then disappear.
    """
    day = F.to_date(date_col)
    ranges = {m: bounds(m, as_of) for m in members}
    if prune:
        lows, highs = [r[0] for r in ranges.values()], [r[1] for r in ranges.values()]
        low = F.least(*lows) if len(lows) > 1 else lows[0]
        high = F.greatest(*highs) if len(highs) > 1 else highs[0]
        df = df.filter((F.col(date_col) >= low) & (F.col(date_col) < F.date_add(high, 1)))
    sums = [
        F.coalesce(F.sum(F.when(day.between(low, high), measure).otherwise(measure * 0)), F.lit(0)).alias(column_name(m))
        for m, (low, high) in ranges.items()
    ]
    return df.groupBy(*by).agg(*sums)


def fiscal_sums(df: DataFrame, measure: Column, offsets: Mapping[str, tuple[str, int]], as_of, calendar: DataFrame, date_col: str, day_col: str = "d", by: Sequence[str] = ()) -> DataFrame:
    """Sums over fiscal periods: rows whose fiscal id is the current one plus an offset.

    ``offsets`` maps a name to ``(id column, offset)``; the calendar gives each
    day's ids and the current ones are those of ``as_of``.
    """
    if calendar is None:
        raise ValueError("fiscal windows need a calendar")
    ids = sorted({c for c, _ in offsets.values()})
    now = calendar.filter(F.col(day_col) == F.lit(as_of).cast("date")).agg(*[F.max(c).alias(f"now_{c}") for c in ids])
    dated = df.join(calendar.select(day_col, *ids), F.to_date(date_col) == F.col(day_col), "left")
    dated = dated.join(F.broadcast(now), F.lit(True), "left")  # one row
    return dated.groupBy(*by).agg(
        *[F.coalesce(F.sum(F.when(F.col(c) == F.col(f"now_{c}") + k, measure)), F.lit(0)).alias(n) for n, (c, k) in offsets.items()]
    )


def change(a: Column, b: Column) -> Column:
    """Difference of two windows."""
    return a - b


def growth(a: Column, b: Column, base: Column | None = None) -> Column:
    """Relative change; null on a zero base."""
    return (a - b) / F.nullif(b if base is None else base, F.lit(0))


def rate(a: Column, div: float = 1, mul: float = 1) -> Column:
    """A window scaled by its definition's trailing arithmetic."""
    return a / div * mul


def dates_between(df: DataFrame, date_col: str, low: Column, high: Column) -> DataFrame:
    """Rows of an inclusive day range."""
    return df.filter(F.to_date(date_col).between(low, high))


def dates_in_period(df: DataFrame, date_col: str, end: Column, n: int, unit: str) -> DataFrame:
    """Rows of ``n`` units (negative: back) from a day, that day included."""
    other = F.date_add(end, n) if unit == "day" else F.add_months(end, UNITS[unit] * n)
    low, high = (F.date_add(other, 1), end) if n < 0 else (end, F.date_sub(other, 1))
    return dates_between(df, date_col, low, high)


def period_shift(df: DataFrame, measure: Column, date_col: str, unit: str, n: int, by: Sequence[str] = (), name: str = "value") -> DataFrame:
    """Each period's value with that of the period ``n`` units away, joined on the shifted key so gaps stay gaps."""
    sums = df.groupBy(F.trunc(date_col, unit).alias("period"), *by).agg(measure.alias(name))
    other = sums.select(F.add_months("period", -UNITS[unit] * n).alias("period"), *by, F.col(name).alias(f"{name}_shifted"))
    return sums.join(other, ["period", *by], "left")


def same_period_last_year(df: DataFrame, measure: Column, date_col: str, unit: str = "month", by: Sequence[str] = (), name: str = "value") -> DataFrame:
    """Each period beside the same one a year before."""
    return period_shift(df, measure, date_col, unit, {"month": -12, "quarter": -4, "year": -1}[unit], by, name)


def running_in_period(df: DataFrame, measure: Column, date_col: str, period: str = "year", by: Sequence[str] = ()) -> DataFrame:
    """Running total by day that restarts with each period (to-date totals for every day)."""
    days = df.groupBy(F.to_date(date_col).alias("d"), *by).agg(measure.alias("value"))
    w = Window.partitionBy(*by, F.trunc("d", period)).orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    return days.withColumn("to_date", F.sum("value").over(w))


def adjacent(member: str, as_of) -> tuple[Column, Column]:
    """Range of ``previous day`` ... ``next year`` around a day."""
    side, unit = member.lower().split()
    d, n = _day(as_of), -1 if side == "previous" else 1
    if unit == "day":
        return F.date_add(d, n), F.date_add(d, n)
    low = _move(_start(d, unit), unit, n)
    return low, F.date_sub(_move(low, unit, 1), 1)


def calendar(spark, low: Column, high: Column) -> DataFrame:
    """One row per day of an inclusive range, with its calendar parts."""
    days = spark.range(1).select(F.explode(F.sequence(low, high, F.expr("interval 1 day"))).alias("d"))
    return with_parts(days)


def calendar_auto(df: DataFrame, date_col: str) -> DataFrame:
    """Calendar over whole years from the first to the last date in the data."""
    ends = df.agg(F.trunc(F.min(date_col), "year").alias("lo"), F.max(date_col).alias("hi"))
    last = F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1)
    return with_parts(ends.select(F.explode(F.sequence("lo", last, F.expr("interval 1 day"))).alias("d")))


def with_parts(days: DataFrame) -> DataFrame:
    """Year, quarter, month, ISO week and weekday of a day column ``d``."""
    return days.select(
        "d",
        F.year("d").alias("year"),
        F.quarter("d").alias("quarter"),
        F.month("d").alias("month"),
        F.weekofyear("d").alias("iso_week"),
        (F.weekday("d") + 1).alias("iso_weekday"),
    )


def timeframes(df: DataFrame, ts_col: str, frames: Sequence[str]) -> DataFrame:
    """Derived columns ``<column>_<frame>`` of a timestamp."""
    c = F.col(ts_col)
    make = {
        "date": lambda: F.to_date(c),
        "week": lambda: F.to_date(F.date_trunc("week", c)),
        "month": lambda: F.date_format(c, "yyyy-MM"),
        "quarter": lambda: F.trunc(c, "quarter"),
        "year": lambda: F.year(c),
        "hour": lambda: F.date_trunc("hour", c),
        "minute": lambda: F.date_trunc("minute", c),
        "hour_of_day": lambda: F.hour(c),
        "day_of_week_index": lambda: F.weekday(c),
        "day_of_month": lambda: F.dayofmonth(c),
        "day_of_year": lambda: F.dayofyear(c),
        "week_of_year": lambda: F.weekofyear(c),
        "month_num": lambda: F.month(c),
        "quarter_of_year": lambda: F.concat(F.lit("Q"), F.quarter(c)),
    }
    return df.withColumns({f"{ts_col}_{f}": make[f]() for f in frames})


def edge_days(df: DataFrame, date_col: str) -> DataFrame:
    """First and last day of month, quarter and year of the dates in scope."""
    lo, hi = F.min(F.to_date(date_col)), F.max(F.to_date(date_col))
    out = [lo.alias("first_date"), hi.alias("last_date")]
    for unit, n in UNITS.items():
        out += [F.trunc(lo, unit).alias(f"start_of_{unit}"), F.date_sub(F.add_months(F.trunc(hi, unit), n), 1).alias(f"end_of_{unit}")]
    return df.agg(*out)
