"""The star generator and moving percentiles: distributions, wiring, edges and refusals."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricspark.operators import moving
from metricspark.sources import star
from metricspark.sources.star import Domain, Table


def schema(rows: int = 3000) -> list[Table]:
    return [
        Table("sale", rows, "sale_id", {"amount": star.domain_of("amount", "number"), "sold_on": star.domain_of("sold_on", "date"), "paid_on": Domain(after="sold_on", spread=5), "buyer_email": star.domain_of("buyer_email", "text")}, {"shop_id": "shop", "seller_id": "person"}, {"shop_id": 3.0}),
        Table("person", 50, "person_id", {"name": star.domain_of("name", "text"), "is_new": star.domain_of("is_new", "boolean")}, {"boss_id": "person", "home_id": "shop"}),
        Table("shop", 8, "shop_id", {"status": star.domain_of("status", "text")}),
    ]


def test_parents_come_first_and_rings_are_refused(spark):
    assert [t.name for t in star.in_order(schema())] == ["shop", "person", "sale"]
    with pytest.raises(ValueError, match="in a ring: a, b"):
        star.in_order([Table("a", 1, "k", parents={"x": "b"}), Table("b", 1, "k", parents={"y": "a"})])
    with pytest.raises(ValueError, match="no table nowhere"):
        star.in_order([Table("a", 1, "k", parents={"x": "nowhere"})])


def test_tables_are_wired_and_the_same_for_any_partitions(spark):
    made = star.generate(spark, schema(), seed=5)
    sale = made["sale"]
    assert sale.agg(F.count_distinct("sale_id"), F.min("sale_id"), F.max("sale_id")).first() == (3000, 1, 3000)
    assert sale.join(made["shop"], "shop_id", "left_anti").count() == sale.join(made["person"], sale.seller_id == made["person"].person_id, "left_anti").count() == 0
    assert sale.filter("paid_on < sold_on or datediff(paid_on, sold_on) > 5").count() == 0
    assert sale.filter("shop_id = 1").count() > 1200 > 3 * sale.filter("shop_id = 8").count()
    assert sale.filter("buyer_email = concat('user', sale_id, '@example.com')").count() == 3000
    again = star.generate(spark, schema(), seed=5)["sale"].repartition(7)
    assert sale.exceptAll(again).count() == 0
    assert star.generate(spark, schema(), seed=6)["sale"].exceptAll(sale).count() > 2000
    assert star.generate(spark, schema(0))["sale"].count() == 0


def test_domains_keep_a_distribution(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a"] * 6 + ["b"] * 3 + ["c"]), rng.expovariate(0.1), k % 50) for k in range(4000)] + [(None, None, None)]
    found = star.profile(spark.createDataFrame(rows, "label string, x double, n int"), ["x", "n"], ["label"])
    made = star.generate(spark, [Table("t", 20_000, "id_", found)])["t"].toPandas()
    assert made["label"].value_counts(normalize=True).to_dict() == pytest.approx({"a": 0.6, "b": 0.3, "c": 0.1}, abs=0.03)
    given = [x for _, x, _ in rows if x is not None]
    assert np.quantile(made["x"], [0.1, 0.5, 0.9]) == pytest.approx(np.quantile(given, [0.1, 0.5, 0.9]), rel=0.08)
    assert made["n"].between(0, 49).all() and made["n"].mean() == pytest.approx(24.5, abs=1)


def test_names_decide_before_types():
    assert star.domain_of("price_total", "number").digits == 2
    assert star.domain_of("order_count", "number").kind == "long"
    assert star.domain_of("status", "number") == star.TYPED["number"]
    assert star.domain_of("anything", "text") == star.TYPED["text"]
    assert star.domain_of("has_card", "boolean").kind == "boolean"


@pytest.mark.parametrize(("preceding", "following", "p"), [(0, 0, 0.5), (3, 0, 0.5), (2, 5, 0.25), (50, 50, 0.9), (0, 4, 1.0), (4, 0, 0.0)])
def test_moving_percentiles(spark, preceding, following, p):
    rng = random.Random(preceding)
    rows = [(rng.choice(["a", "b", None]), k, rng.choice([rng.random(), 0.5, None])) for k in range(150)]
    out = moving.moving_percentile(spark.createDataFrame(rows, "g string, k int, v double").repartition(4), ["g"], [F.col("k")], "v", p, preceding, following, block=16)
    got = {r.k: r.moving for r in out.collect()}
    for g in ("a", "b", None):
        mine = [(k, v) for h, k, v in rows if h == g]
        for i, (k, _) in enumerate(mine):
            frame = [v for _, v in mine[max(0, i - preceding) : i + following + 1] if v is not None]
            assert got[k] == (pytest.approx(np.quantile(frame, p)) if frame else None)


def test_moving_percentiles_of_no_rows(spark):
    df = spark.createDataFrame([], "k int, v double")
    assert moving.moving_percentile(df, [], [F.col("k")], "v", 0.5, 3).count() == 0


def test_a_wide_frame_is_fast():
    values = np.random.default_rng(0).random(200_000)
    began = time.perf_counter()
    found = moving.sliding(values, 0, len(values), 500, 500, 0.5)
    assert time.perf_counter() - began < 5
    assert found[1000] == np.median(values[500:1501])
