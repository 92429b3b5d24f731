"""Working days, exact percentiles, distinct states, bucketed upserts, level of detail and node paths."""

from __future__ import annotations

import datetime as dt
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from metricspark.operators import aggregates, ranges, rollups, workdays
from metricspark.streaming import upserts


@pytest.fixture(scope="module")
def days(spark):
    calendars = spark.createDataFrame([("a", "2024-01-01", "2024-03-31"), ("b", "2024-01-01", "2024-01-31")], "calendar string, first_day string, last_day string")
    holidays = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-01"), ("a", "2024-01-06"), ("a", "2024-01-10"), ("b", "2024-01-02")], "calendar string, day string")
    return workdays.index(calendars, holidays).cache()


def working(calendar: str) -> list[dt.date]:
    off = {"a": {"2024-01-01", "2024-01-10"}, "b": {"2024-01-02"}}[calendar]
    every = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(91 if calendar == "a" else 31)]
    return [d for d in every if d.weekday() < 5 and d.isoformat() not in off]


def test_working_days_between_any_two_days(spark, days):
    rng = random.Random(1)
    rows = [(k, "a", dt.date(2024, 1, 1) + dt.timedelta(rng.randint(0, 90)), dt.date(2024, 1, 1) + dt.timedelta(rng.randint(0, 90))) for k in range(60)]
    rows += [(100, "b", dt.date(2024, 1, 1), dt.date(2024, 1, 3)), (101, "a", None, dt.date(2024, 1, 3)), (102, None, dt.date(2024, 1, 1), dt.date(2024, 1, 3))]
    got = {r.k: r.workdays for r in workdays.between(spark.createDataFrame(rows, "k int, c string, s date, e date"), days, "c", "s", "e").collect()}
    for k, c, s, e in rows:
        if s is None or c is None:
            assert got[k] is None
        else:
            n = sum(min(s, e) <= d < max(s, e) for d in working(c))
            assert got[k] == (n if s <= e else -n)


def test_moving_by_working_days(spark, days):
    rng = random.Random(2)
    rows = [(k, dt.date(2024, 2, 1) + dt.timedelta(rng.randint(0, 28)), rng.randint(-15, 15)) for k in range(60)] + [(100, dt.date(2024, 2, 1), None)]
    frame = spark.createDataFrame(rows, "k int, s date, n int").withColumn("c", F.lit("a"))
    got = {r.k: r.workday for r in workdays.add(frame, days, "c", "s", "n").collect()}
    for k, s, n in rows:
        if n is None:
            assert got[k] is None
        elif n > 0:
            assert got[k] == [d for d in working("a") if d > s][n - 1]
        elif n < 0:
            assert got[k] == [d for d in working("a") if d < s][n]
        else:
            assert got[k] == next(d for d in working("a") if d >= s)


@pytest.mark.parametrize("day", ["2023-12-31", "2024-02-01"])
def test_days_outside_the_calendar_are_an_error(spark, days, day):
    frame = spark.createDataFrame([("b", day, 1)], "c string, s string, n int")
    with pytest.raises(Exception, match="no such day: calendar b"):
        workdays.between(frame, days, "c", "s", "s").collect()
    with pytest.raises(Exception, match="outside calendar b"):
        workdays.add(frame.withColumn("s", F.lit("2024-01-31")), days, "c", "s", "n").collect()


def test_percentiles_of_odd_groups(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1.0, 2.0, 2.0, 5.5, None]), rng.choice([*range(50), None])) for _ in range(200)] + [("empty", None, None), ("one", 3.0, 4)]
    got = ranges.percentiles(spark.createDataFrame(rows, "g string, x double, y int"), ["g"], {"mx": ("x", 0.5), "py": ("y", 0.9), "my": ("y", 0.5), "top": ("x", 1.0)})
    groups = defaultdict(list)
    for g, x, y in rows:
        groups[g].append((x, y))

    def at(values, p):
        values = sorted(v for v in values if v is not None)
        if not values:
            return None
        k = p * (len(values) - 1)
        return values[int(k)] + (values[min(int(k) + 1, len(values) - 1)] - values[int(k)]) * (k - int(k))

    for r in got.collect():
        xs, ys = zip(*groups.pop(r.g), strict=True)
        for value, want in ((r.mx, at(xs, 0.5)), (r.py, at(ys, 0.9)), (r.my, at(ys, 0.5)), (r.top, at(xs, 1.0))):
            assert value == pytest.approx(want) if want is not None else value is None
    assert not groups
    everything = ranges.percentiles(spark.createDataFrame(rows, "g string, x double, y int"), [], {"m": ("y", 0.5)}).collect()
    assert [r.m for r in everything] == [statistics.median(y for _, _, y in rows if y is not None)]
    assert ranges.percentiles(spark.createDataFrame([], "x double"), [], {"m": ("x", 0.5)}).first().m is None


def test_distinct_states_merge_to_every_level(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.choice(["x", "y", None]), rng.choice([*"pqrstuv", None])) for _ in range(150)]
    df = aggregates.dense_ids(spark.createDataFrame(rows, "a string, b string, who string"), "who", "n")
    far = df.withColumn("n", F.col("n") * 40_000)  # several ranges of numbers
    for frame in (df, far):
        states = aggregates.distinct_states(frame, ["a", "b"], "n", "people")
        got = {(r.a, r.b, r.grouping_id): r.people for r in aggregates.merged_distinct(states, [[], ["a"], ["a", "b"]], "people").collect()}
        want = defaultdict(set)
        for a, b, who in rows:
            for key in ((None, None, 3), (a, None, 1), (a, b, 0)):
                want[key] |= {who} - {None}
        assert got == {k: len(v) for k, v in want.items()}
    with pytest.raises(ValueError, match="no source"):
        aggregates.aggregate_aware([df], ["a"], "people")


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.lit("same").alias("w"))
    write = upserts.upsert_batches(path, rows, ["k"], ["seq"], buckets=16)
    files = lambda: {(r.bucket_, r.f) for r in spark.read.parquet(path).select("bucket_", F.input_file_name().alias("f")).distinct().collect()}
    before = files()
    batch = spark.createDataFrame([(5, -1, 2), (5, -5, 1), (777, -7, 1)], "k long, v long, seq int")
    for _ in range(2):  # a batch that runs again changes nothing
        write(batch, 0)
        table = {r.k: (r.v, r.w) for r in upserts.current(spark, path, rows.schema).collect()}
        assert len(table) == 201 and table[5] == (-5, "same") and table[777] == (-7, None) and table[6] == (12, "same")
    touched = {r[0] for r in batch.select(upserts.bucket(["k"], 16)).distinct().collect()}
    assert {b for b, f in before ^ files()} == touched
    write(batch.limit(0), 1)
    upserts.upsert_batches(path, rows, ["k"], ["seq"], buckets=16)  # a restart goes on with the table
    assert upserts.current(spark, path, rows.schema).filter("v < 0").count() == 2


def test_level_of_detail_has_no_window(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5)], "g string, v int")
    for fixed, want in ((["g"], {1: 3, 2: 3, 5: 5}), ([], {1: 8, 2: 8, 5: 8})):
        out = aggregates.lod(df, F.sum("v"), fixed, "s")
        assert {r.v: r.s for r in out.collect()} == want
        assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_labels_with_the_separator_are_nodes_of_their_own(spark):
    df = spark.createDataFrame([("A / B", None, 1), ("A", "B", 2), ("A", None, 4)], "p string, q string, v int")
    nodes = rollups.hierarchy_nodes(df, ["p", "q"], "v")
    shares = {tuple(r.path): (r.value, r.share_of_parent) for r in rollups.node_share(nodes).collect()}
    assert shares == {("A / B",): (1, 1 / 7), ("A",): (6, 6 / 7), ("A", "B"): (2, 2 / 6)}
    assert rollups.node_share(nodes).count() == 3
