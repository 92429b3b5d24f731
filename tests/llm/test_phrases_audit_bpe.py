"""Phrases, filter audit and byte-level BPE against brute force and the library, and on odd input."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter
from itertools import permutations
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows_of
from test_operators import SCHEMA, odd_rows

from metricspark.llm import byte_bpe, filter_audit, oracles, phrases

LABELS = "doc_id long, quality int, toxic int, text string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---------------------------------------------------------------- phrases


def fold(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def pieces_of(text: str | None) -> list[list[str]]:
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", fold(text))]


def best_phrases(rows: list[tuple[str | None, str | None]], least: int, best: int) -> set[tuple]:
    """``lang, rank, phrase, a, l, r, n, score`` by counting every phrase where it stands."""
    out = set()
    for lang in {"und" if lang is None else lang for lang, _ in rows}:
        counts = Counter()
        for _, text in (r for r in rows if (r[0] if r[0] is not None else "und") == lang):
            for words in pieces_of(text):
                for n in range(1, 5):
                    counts.update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
        n = sum(f for p, f in counts.items() if " " not in p)
        frequent = {p: f for p, f in counts.items() if f >= least}
        found = []
        for p, a in frequent.items():
            words = p.split(" ")
            if len(words) == 1:
                continue
            if any(f" {p} " in f" {q} " and q != p and 100 * f >= 80 * a for q, f in frequent.items()):
                continue
            cuts = [(counts[" ".join(words[:k])], counts[" ".join(words[k:])]) for k in range(1, len(words))]
            score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
            found.append((-score, -a, p.encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:best], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n, -score))
    return out


def invented(seed: int, texts: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)] + ["É", "ß", "naïve", "\x1cx", "a\x00b", " "]
    passage = " ".join(rng.choice(vocabulary) for _ in range(70))
    rows = []
    for k in range(texts):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        text = "".join(w.upper() + rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n", ".", " ;\t"]) for w in words)
        lang = rng.choice(["en", "en", "en", "fr", None, ""])
        rows.append((k, text + passage if k % 3 == 0 else text, lang))
    return rows


def test_phrases_equal_brute_force(spark):
    rows = invented(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = {tuple(r) for r in phrases.collocations(docs, least=5, best=40).collect()}
    assert got == best_phrases([(lang, text) for _, text, lang in rows], 5, 40)
    assert len(got) > 60


def test_phrases_of_odd_rows(odd):
    rows = [(r.lang, r.text) for r in odd.collect()]
    got = {tuple(r) for r in phrases.collocations(odd, least=3).collect()}
    assert got == best_phrases(rows, 3, 2000)
    assert any(r[2] == "word word word word" for r in got)  # one chunk of a text that never (or always) cuts


def test_phrases_of_no_rows(empty):
    assert phrases.collocations(empty).collect() == []


def test_phrases_without_frequent_ones(spark):
    docs = spark.createDataFrame([(1, "one two three", "en")], "doc_id long, text string, lang string")
    assert phrases.collocations(docs).collect() == []


@pytest.mark.parametrize("longest", [2, 3, 4, 5])
def test_every_occurrence_belongs_to_one_chunk(longest):
    rng = random.Random(longest)
    for _ in range(30):
        text = phrases.normal(" ".join(rng.choice("abcde,") for _ in range(rng.randint(0, 200))).encode())
        chunks = list(phrases.parse(text, longest - 1, every=4))
        words = phrases.Words([(last, c, 1) for last, c in chunks], longest - 1) if chunks else None
        got = Counter()
        if words is not None:
            for _, found, weights in phrases.weigh(words, [1], phrases._lang_key("x"), None):
                got.update(dict(zip(found, weights.tolist(), strict=True)))
            everything = np.full(1 << 13, 255, dtype=np.uint8)
            for sizes in ([2], range(3, longest + 1)):
                for _, found, weights in phrases.weigh(words, sizes, phrases._lang_key("x"), everything) if len(sizes) else ():
                    got.update(dict(zip(found, weights.tolist(), strict=True)))
        want = Counter(b" ".join(p.split(b" ")[i : i + n]) for p in text.split(b"\n") if p for n in range(1, longest + 1) for i in range(len(p.split(b" ")) - n + 1))
        assert got == want


def test_equal_passages_share_their_chunks():
    rng = random.Random(3)
    passage = [str(rng.randint(0, 999)) for _ in range(400)]
    chunks = [set(phrases.parse(" ".join([f"x{k}"] * k + passage).encode())) for k in (1, 5, 9)]
    assert len(set.intersection(*chunks)) >= max(map(len, chunks)) - 3


def test_scores_are_exact_beyond_64_bits(spark):
    big = 6_000_000_000_000_001
    rows = [("en", 2, "a b", big), ("en", 1, "a", big), ("en", 1, "b", big + 2), ("en", 0, "", 3 * big)]
    got = phrases.scores(spark.createDataFrame(rows, "lang string, size int, phrase string, f long")).first()
    assert got.score == 2_000_000 * big // (2 * big + 2)


def test_phrases_equal_their_sql(spark, sf_dir, duck):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert rows_of(phrases.collocations(docs).toPandas()) == rows_of(duck.execute(oracles.phrases_sql()).df())


# ---------------------------------------------------------------- filter audit


def walk(rows: list[tuple], labels: list[tuple]) -> set[tuple]:
    """Every order walked document by document; rows are ``id, text, part``."""
    texts: dict[str, int] = {}
    for i, text, _ in rows:
        if i is not None:
            texts[text or ""] = min(i, texts.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    docs = []
    for i, text, part in rows:
        t = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and i > texts[t],
        }
        docs.append((part or "", {f for f, x in failed.items() if x}, i in good and i is not None, i in toxic and i is not None))
    out, removed_of = [], Counter()
    for part in {p for p, *_ in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed_of[part, f] += len(gone)
                redundant = sum(f in d[1] for d in mine) - len(gone)
                only = sum(d[1] == {f} for d in mine)
                out.append((part, "".join(order), step, len(left), len(gone), redundant, only, sum(d[2] for d in gone), sum(d[3] for d in gone), f))
    return {(*r[:-1], removed_of[r[0], r[-1]]) for r in out}


def audited(frame) -> set[tuple]:
    columns = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = [tuple(r) for r in frame.select(*columns).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_audit_of_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    plenty = " ".join(f"word{k}" for k in range(300))
    more = [(20, plenty, "a"), (21, plenty, None), (22, plenty + " #", ""), (22, plenty + " #", "a"), (23, plenty.upper(), "b"), (24, plenty.upper() + "|", "b")]
    docs = odd.unionByName(spark.createDataFrame(more, "doc_id long, text string, source string"), allowMissingColumns=True)
    labels = [(1, 1, 0), (1, 0, 1), (3, 1, None), (22, None, 1), (23, 0, 0), (None, 1, 1), (99, 1, 1)]
    frame = spark.createDataFrame([(*r, "t", "s") for r in labels], LABELS)
    assert audited(filter_audit.audit(docs, frame)) == walk(rows + more, labels)


def test_audit_of_no_rows(spark, odd, empty):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(empty, none).collect() == []
    assert audited(filter_audit.audit(odd, none)) == walk([(r.doc_id, r.text, r.source) for r in odd.collect()], [])


def test_audit_measures_long_texts_in_pieces():
    text = ("Some words stand here " * 60_000).encode()
    assert filter_audit.failures(text) == (False, True, True, False)
    assert filter_audit.failures(b"x" * (3 << 20)) == (True, False, False, False)
    assert list(filter_audit._pieces(b"")) == []
    assert b"".join(filter_audit._pieces(text)) == text


def test_audit_shuffles_no_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    keyed, relations = filter_audit.failing_ids(docs)
    assert set(relations) == set("ABCDE")
    assert all(set(r.columns) == {"row_1", "row_2"} for r in relations.values())
    assert relations["E"].count() == docs.selectExpr("doc_id - min(doc_id) over (partition by text) as d").filter("d > 0").count()
    assert "text" not in keyed.columns


def test_audit_equals_its_sql(spark, sf_dir, duck):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    assert rows_of(filter_audit.audit(docs, labels).toPandas()) == rows_of(duck.execute(oracles.audit_sql()).df())


# ---------------------------------------------------------------- byte-level BPE


@pytest.fixture(scope="module")
def stated():
    pytest.importorskip("public_tokenizers")
    return byte_bpe.vocabulary()


@pytest.fixture(scope="module")
def library():
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers as public

    ranks = byte_bpe.read_ranks(public.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("library", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_of_odd_rows(odd, stated, library):
    texts = Counter((r.doc_id, r.text) for r in odd.collect())
    encoded = byte_bpe.encode(odd, stated)
    want = Counter()
    for (i, text), n in texts.items():
        want[i, tuple(library.encode_ordinary(text or ""))] += n
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == want
    decoded = byte_bpe.decode(encoded, stated)
    assert Counter((r.doc_id, bytes(r.decoded).decode()) for r in decoded.collect()) == Counter((r.doc_id, r.text or "") for r in odd.collect())


def test_bpe_digests(odd, empty, stated, library):
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(odd, stated), stated)).collect()}
    want = set()
    for r in odd.collect():
        ids = library.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == want
    assert byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(empty, stated), stated)).collect() == []


def test_bpe_equals_the_library_on_any_characters(stated, library):
    rng = random.Random(5)
    codec = byte_bpe.ByteBpe(stated, entries=50)  # the cache turns over all the time
    kinds = [(0, 127), (128, 0x6FF), (0x700, 0xD7FF), (0xE000, 0x3FFFF)]
    texts = []
    for _ in range(1500):
        text = ""
        for _ in range(rng.randint(0, 40)):
            text += chr(rng.choice([rng.randint(*rng.choice(kinds)), 32, 10, 0x1C, 0x85, 0xA0, 0x2581, *stated.unassigned[:2]]))
        texts.append(text)
    texts += ["'s it's 'S we'll'll", " " * 5000 + "a", "\n \n\n  b", "<|endoftext|>", "x" * 100_000, ""]
    want = [library.encode_ordinary(t) for t in texts]
    assert [codec.encode(t).tolist() for t in texts] == want
    assert [x.tolist() for x in codec.encode_all(texts)] == want
    assert [codec.decode(ids).decode() for ids in want] == texts


def test_bpe_blocks_of_long_texts(stated, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LONG", 50)
    monkeypatch.setattr(byte_bpe, "BLOCK", 7)
    codec = byte_bpe.ByteBpe(stated)
    text = "Words, numbers 12345 and  spaces \n\n go on it's. " * 30
    assert codec.encode(text).tolist() == library.encode_ordinary(text)


def test_bpe_refuses_a_vocabulary_without_bytes():
    with pytest.raises(ValueError, match="single bytes"):
        byte_bpe.serialise({b"a": 0})


def test_bpe_keeps_ranks_with_gaps():
    ranks = {bytes([b]): 2 * b for b in range(256)} | {b"ab": 1001, b"bc": 1000, b"abc": 2000}
    codec = byte_bpe.ByteBpe(byte_bpe.Vocabulary(byte_bpe.serialise(ranks), tuple(sorted(ranks.values())), r"\S+|\s", ()))
    assert codec.encode("abc abd abcd").tolist() == [2000, 64, 1001, 200, 64, 2000, 200]
    assert codec.decode(codec.encode("abd xyz").tolist()) == b"abd xyz"


def test_bpe_decodes_without_an_object_for_each_id(stated):
    n = 400_000
    ids = pa.array([np.tile(np.arange(1000, 41_000), n // 40_000)], pa.list_(pa.int32()))
    codec = byte_bpe.ByteBpe(stated)
    want = b"".join(map(codec.decode, ([i] for i in range(1000, 41_000)))) * (n // 40_000)
    run = byte_bpe._decode_batches(SimpleNamespace(value=stated))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), ids], ["doc_id", "ids"])
    byte_bpe._codec(stated)  # made before memory is measured
    tracemalloc.start()
    (got,) = run([batch])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.column("decoded").to_pylist() == [want]
    assert peak < 24 * n  # a list of Python numbers takes 40 bytes an id


@pytest.mark.parametrize("gap", [1, 3])
def test_bpe_decodes_lists_as_they_stand(gap):
    ranks = {bytes([b]): gap * b for b in range(256)} | {b"ab": gap * 256, "ü".encode(): gap * 256 + 1}
    codec = byte_bpe.ByteBpe(byte_bpe.Vocabulary(byte_bpe.serialise(ranks), tuple(sorted(ranks.values())), r"\S+|\s", ()))
    lists = [[gap * 97], None, [], [gap * 256, gap * 256 + 1, gap * 195], [], None, [0] * 300]
    want = [b"a", None, b"", "abü".encode() + b"\xc3", b"", None, bytes(300)]
    ids = pa.array(lists, pa.list_(pa.int32()))
    assert codec.decode_all(ids).to_pylist() == want
    assert [codec.decode_all(ids.slice(i, 2)).to_pylist() for i in range(len(lists))] == [want[i : i + 2] for i in range(len(lists))]
    for wrong in (-1, gap * 256 + 2, 2**31 - 1):
        with pytest.raises(KeyError, match=str(wrong)):
            codec.decode([gap, wrong])
    with pytest.raises(ValueError, match="null"):
        codec.decode_all(pa.array([[gap, None]], pa.list_(pa.int32())))


def test_weights_beyond_exact_floats():
    big = (1 << 53) + 1
    words = phrases.Words([(True, b"a b a", big), (True, b"a b", 2), (True, b"c", 3)], 3)
    found = {p: int(w) for s, ps, ws in phrases.weigh(words, [1], np.uint64(0), None) for p, w in zip(ps, ws, strict=True)}
    assert found == {b"a": 2 * big + 2, b"b": big + 2, b"c": 3}
