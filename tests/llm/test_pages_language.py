"""Language of pages: markup, address suffix and host fused with the main text, against the fusion by hand."""

from __future__ import annotations

from urllib.parse import urlsplit

import numpy as np
from pyspark.sql import functions as F
from test_operators import brute_posteriors

from metricspark.llm import html_text, langid


def test_pages_against_brute_force(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in langid.identify_pages(pages).collect()}
    rows = html_text.main_text(pages, declared=langid.declared_in_markup(F.col("html")))
    model = langid.fit_text_model(rows, "declared", "text", "page_id", folds=2)
    seen = rows.select(
        "page_id", "text", "declared", langid.address_suffix(F.col("url")).alias("suffix"), langid.host_of(F.col("url")).alias("host"), "url", langid._fold(langid._hash("page_id", "text"), 2).alias("fold")
    ).orderBy("page_id").collect()
    assert {r.declared for r in seen} == set(model.languages) and len({r.host for r in seen}) > 20
    assert all(r.host == urlsplit(r.url).hostname for r in seen)
    scores = []
    for r in seen:
        bucket = langid._trigrams(np.frombuffer(f" {r.text} ".encode(), dtype=np.uint8))[0]
        raw = [float(model.tables[r.fold, k][bucket].astype(float).mean()) * min(len(bucket), langid.MOST_TRIGRAMS) * langid.WEIGHT for k in range(len(model.languages))]
        scores.append([x - max(raw) for x in raw])
    columns = [[r[c] for r in seen] for c in ("declared", "suffix", "host")]
    for r, (best, sure) in zip(seen, brute_posteriors(scores, *columns), strict=True):
        assert got[r.page_id].lang == model.languages[best] and abs(got[r.page_id].confidence - sure) < 1e-3


def test_pages_without_text_or_address(spark):
    rows = [(1, "http://a.example.de/x", None), (1, None, ""), (None, "no address", "<html lang='fr'><p>Le chat dort, le chien mange et la souris danse.</p>"), (4, "https://b.example.fr/", "<p>...</p>")]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = langid.identify_pages(pages).collect()
    assert sorted((r.page_id is None, r.page_id, r.kept) for r in got if not r.kept) == [(False, 1, False), (False, 1, False), (False, 4, False)]
    assert langid.identify_pages(pages.limit(0)).count() == 0
