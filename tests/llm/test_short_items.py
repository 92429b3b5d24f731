"""Benchmark items of few tokens: short templates, exact tokens, weak hits, ids of any type."""

from __future__ import annotations

import random

import pytest
from test_operators import brute_template

from metricspark.llm import decontam

BENCH = "item_id {}, text string"


def hits_of(spark, docs: list[str], items: list[str], **more) -> dict[int, set]:
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), BENCH.format("long"))
    out: dict[int, set] = {}
    for r in decontam.contaminated(frame, bench, **more).collect():
        out.setdefault(r.doc_id, set()).add((r.item_id, r.changed, *([r.weak] if "weak" in r.__fields__ else [])))
    return out


def test_reparameterised_short_questions_are_found(spark):
    docs = [
        "Some intro text here. What is 8 plus 9 ? More text after.",
        "Some intro text here. What is 5 plus 7 ? More text after.",
        "It is 8 plus 9 in all.",
        "What is 5 plus 5 ?",
        "name the capital of spain",
        "Please name the capital of Spain now",
        "so what is 5 plus 7",
    ]
    got = hits_of(spark, docs, ["What is 5 plus 7 ?", "Name the capital of France."])
    assert got == {0: {(0, True)}, 1: {(0, False)}, 3: {(0, True)}, 5: {(1, True)}, 6: {(0, False)}}


def test_equal_slots_of_a_short_item_stay_equal(spark):
    assert hits_of(spark, ["Why is 4 like 4 then", "Why is 4 like 5 then"], ["Why is 7 like 7 then"]) == {0: {(0, True)}}


def test_weak_hits_are_asked_for(spark):
    docs, items = ["Yes.", "Yes, it is.", "No way", "Rome 12"], ["yes", "Rome 12"]
    assert hits_of(spark, docs, items) == {0: {(0, False)}, 3: {(1, False)}}
    assert hits_of(spark, docs + ["in Rome 12 men"], items, weak=True) == {0: {(0, False, False)}, 1: {(0, False, True)}, 3: {(1, False, False)}, 4: {(1, False, True)}}
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), BENCH.format("long"))
    assert {r.doc_id for r in decontam.decontaminate(frame, bench).collect()} == {1, 2}


def brute(doc: str, item: str) -> bool:
    """Whether a document has the short item as a template with consistent values, or by its exact tokens."""
    worded = lambda t: [(x[1] if x[2] else x[0], x[1]) for x in t]
    own, text = worded(brute_template(item)), worded(brute_template(doc))
    n = len(own)
    for at in range(len(text) - n + 1):
        part = text[at : at + n]
        if [a[0] for a in own] == [b[0] for b in part]:
            bound: dict[str, set] = {}
            for a, b in zip(own, part, strict=True):
                if a[0][0] == "<":
                    bound.setdefault(a[1], set()).add(b[1])
            if all(len(v) == 1 for v in bound.values()):
                return True
    low = lambda t: f" {' '.join(w for w in ''.join(c if c.isalnum() else ' ' for c in t.lower()).split())} "
    return low(item) in low(doc)


@pytest.mark.parametrize("seed", range(3))
def test_items_of_two_to_seven_tokens_against_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["is", "plus", "of", "Tom", "Ann", "5", "7", "red", "how"]
    items = []
    while len(items) < 25:
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(2, 7)))
        t = [(x[1] if x[2] else x[0]) for x in brute_template(text)]
        words = sum(x[0] != "<" for x in t)
        if len(t) < 8 and words >= 2 and 2 * words >= len(t):
            items.append(text)
    docs = [". ".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 9))) for _ in range(3)) for _ in range(60)]
    got = {d: {i for i, *_ in h} for d, h in hits_of(spark, docs, items).items()}
    classes: dict[tuple, int] = {}
    first = {}
    for k, item in enumerate(items):  # items that differ in values only are one class, named by the smallest
        t = [(x[1] if x[2] else x[0], x[1]) for x in brute_template(item)]
        seen: dict[str, int] = {}
        first[k] = classes.setdefault((tuple(a for a, _ in t), tuple(seen.setdefault(v, len(seen)) for a, v in t if a[0] == "<")), k)
    want = {d: found for d, doc in enumerate(docs) if (found := {first[k] for k, item in enumerate(items) if brute(doc, item)})}
    assert got == want


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("a", "What is 8 plus 9 ?"), (None, "clean text"), ("c", None)], "doc_id string, text string")
    bench = spark.createDataFrame([("q1", "What is 5 plus 7 ?"), (None, "yes")], BENCH.format("string"))
    hits = decontam.contaminated(docs, bench)
    assert [(r.doc_id, r.item_id) for r in hits.collect()] == [("a", "q1")]
    assert decontam.contaminated_documents(hits).first().item_ids == ["q1"]
    assert {r.doc_id for r in decontam.decontaminate(docs, bench).collect()} == {None, "c"}
