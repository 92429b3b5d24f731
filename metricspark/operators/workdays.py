"""Working days by calendars with holidays.

Each calendar is a table of its days with a running number of working days, so a
difference is two look-ups and moving by working days is two more.  A calendar has
one row per day; facts are joined to it by equality.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def index(calendars: DataFrame, holidays: DataFrame, weekend: Sequence[int] = (5, 6)) -> DataFrame:
    """``calendar, day, is_working, before``: all days of ``calendars(calendar, first_day, last_day)``, with the working days before each.

    ``holidays(calendar, day)`` may repeat and may fall on weekends; ``weekend``
    counts from Monday as 0.  Windows run over one calendar's days.
    """
    days = calendars.select("calendar", F.explode(F.sequence(F.to_date("first_day"), F.to_date("last_day"))).alias("day"))
    off = holidays.select("calendar", F.to_date("day").alias("day"), F.lit(True).alias("off")).distinct()
    marked = days.join(off, ["calendar", "day"], "left").withColumn("is_working", ~F.weekday("day").isin(*weekend) & F.col("off").isNull())
    earlier = Window.partitionBy("calendar").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return marked.select("calendar", "day", "is_working", F.coalesce(F.sum(F.col("is_working").cast("int")).over(earlier), F.lit(0)).alias("before"))


def _looked_up(df: DataFrame, days: DataFrame, calendar: str, day: Column, name: str) -> DataFrame:
    """Rows with ``name_before`` and ``name_working`` of a day; a day that its calendar does not hold is an error."""
    side = days.select(F.col("calendar").alias(f"{name}_calendar"), F.col("day").alias(f"{name}_day"), F.col("before").alias(f"{name}_before"), F.col("is_working").alias(f"{name}_working"))
    joined = df.withColumn(f"{name}_at", F.to_date(day)).join(side, (F.col(calendar) == F.col(f"{name}_calendar")) & (F.col(f"{name}_at") == F.col(f"{name}_day")), "left")
    outside = F.col(f"{name}_at").isNotNull() & F.col(calendar).isNotNull() & F.col(f"{name}_day").isNull()
    message = F.concat(F.lit("no such day: calendar "), F.col(calendar).cast("string"), F.lit(", "), F.col(f"{name}_at").cast("string"))
    found = F.when(outside, F.raise_error(message).cast("long")).otherwise(F.col(f"{name}_before"))
    return joined.withColumn(f"{name}_before", found).drop(f"{name}_calendar", f"{name}_day")


def between(df: DataFrame, days: DataFrame, calendar: str, start: str, end: str, name: str = "workdays") -> DataFrame:
    """Working days from ``start`` to the day before ``end``; the negative number back where ``end`` comes first; null for null days."""
    rows = _looked_up(_looked_up(df, days, calendar, F.col(start), "from"), days, calendar, F.col(end), "to")
    return rows.select(*df.columns, (F.col("to_before") - F.col("from_before")).alias(name))


def add(df: DataFrame, days: DataFrame, calendar: str, start: str, n: str, name: str = "workday") -> DataFrame:
    """The ``n``-th working day after ``start``, or before it for a negative ``n``; for 0 the day itself or the next working day.

    Null days or numbers give null; leaving the calendar is an error.
    """
    rows = _looked_up(df, days, calendar, F.col(start), "from")
    step = F.col(n).cast("long")
    wanted = F.col("from_before") + step + F.when(step > 0, F.col("from_working").cast("int") - 1).otherwise(0)
    working = days.filter("is_working").select(F.col("calendar").alias("on_calendar"), F.col("before").alias("on_number"), F.col("day").alias("on_day"))
    joined = rows.withColumn("wanted", wanted).join(working, (F.col(calendar) == F.col("on_calendar")) & (F.col("wanted") == F.col("on_number")), "left")
    left = F.col("wanted").isNotNull() & F.col("on_day").isNull()
    message = F.concat(F.lit("outside calendar "), F.col(calendar).cast("string"))
    return joined.select(*df.columns, F.when(left, F.raise_error(message).cast("date")).otherwise(F.col("on_day")).alias(name))
