"""The corpus pipeline, each stage judged on its own input."""

from __future__ import annotations

import re
from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    from metricspark.llm.staging import stage

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frames = [docs]
    for name, step in corpus_pipeline.STAGES:
        frames.append(stage(step(spark, frames[-1], sf_dir), name))
    return frames


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]
    assert all(f.columns == stages[0].columns for f in stages[:5])


def test_language_stage_keeps_clean_documents(stages):
    assert stages[1].count() == stages[0].count()


def test_near_dedup_stage_keeps_one_of_each_group(stages, spark):
    from metricspark.llm.near_dup import near_duplicates

    before = {r.doc_id: r.component_id for r in near_duplicates(stages[1]).collect()}
    after = [r.doc_id for r in stages[2].collect()]
    assert Counter(before[d] for d in after) == Counter(set(before.values()))


def test_decontamination_stage_drops_exactly_the_leaks(stages, spark, sf_dir):
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before = {r.doc_id: r.text for r in stages[2].collect()}
    assert {r.doc_id for r in stages[3].collect()} == {d for d, t in before.items() if not any(i in t for i in items)}


def test_mixing_stage_takes_pieces_of_documents(stages):
    texts = {r.doc_id: r.text for r in stages[3].collect()}
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    taken = Counter()
    for r in stages[4].collect():
        assert r.text in texts[r.doc_id] and r.n_chars == len(r.text)
        taken[r.doc_id] += words(r.text)
    assert all(n <= 2 * words(texts[d]) for d, n in taken.items())
    total = sum(map(words, texts.values()))
    assert abs(sum(taken.values()) - 1.5 * total) < 0.1 * total


def test_sharding_stage_keeps_all_rows(stages):
    rows = stages[5].collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in stages[4].collect())
    slots: dict[int, list[int]] = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_equals_the_stages(spark, sf_dir, stages):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert Counter(map(tuple, rows.collect())) == Counter(map(tuple, stages[5].collect()))
