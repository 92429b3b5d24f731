"""Phrase collocations, counted on a prefix-free parse of the texts.

The words of a text are parsed into chunks: a chunk ends with the first window of
``longest - 1`` words whose hash says so, and the next chunk starts with that same
window.  Where chunks end depends on the words alone, so equal passages give equal
chunks wherever they stand.  The distinct chunks are a dictionary with the number
of times each occurs, and phrases are counted inside the distinct chunks, weighted
by that number.  An occurrence that starts in the window that two chunks share
belongs to the later one, and as no phrase is longer than the window and a word,
every occurrence lies whole in the one chunk it belongs to.

Counts are exact: keys are the phrases themselves.  Only words, then pairs, that
are frequent can be part of a longer frequent phrase; a Bloom filter of bounded
size lets no others into the shuffle but a few, which the exact counts then drop.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricspark.llm.decontam import _held as held
from metricspark.llm.decontam import key_filter
from metricspark.llm.staging import stage
from metricspark.llm.textops import hash_spans, mix64, slices, window_hashes, word_spans

#: Words of the longest phrase, least occurrences of a candidate, percent of them that a longer phrase must cover, phrases per language.
LONGEST, LEAST, COVERED, BEST = 4, 30, 80, 2000
#: One window of words in so many ends a chunk.
CHUNK_WORDS = 32
#: Bytes of chunks that are counted together.
GROUP = 4 << 20
_FOLD = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 9 + b" ")


def normal(data: bytes) -> bytes:
    """A text in lower case, its words apart by one space, its pieces by one line feed."""
    pieces = (b" ".join(p.split()) for p in data.translate(_FOLD).split(b"\n"))
    return b"\n".join(filter(None, pieces))


def parse(data: bytes, overlap: int = LONGEST - 1, every: int = CHUNK_WORDS) -> Iterator[tuple[bool, bytes]]:
    """Chunks of a normal text, and whether each is the text's last."""
    buf = np.frombuffer(data, dtype=np.uint8)
    starts, ends = word_spans(buf)
    if not len(starts):
        return
    windows = window_hashes(hash_spans(buf, starts, ends), overlap)
    cuts = np.flatnonzero(windows % np.uint64(every) == 0)
    cuts = cuts[cuts > 0]
    begins, stops = np.append(0, cuts), np.append(cuts + overlap - 1, len(starts) - 1)
    last = len(cuts)
    for k, (begin, end) in enumerate(zip(starts[begins].tolist(), ends[stops].tolist(), strict=True)):
        yield k == last, data[begin:end]


def _parse_batches(overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            tally: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tally[lang].update(parse(normal(text), overlap))
            rows = [(lang, last, chunk, n) for lang, chunks in tally.items() for (last, chunk), n in chunks.items()]
            if rows:
                columns = zip(*rows, strict=True)
                kinds = (pa.string(), pa.bool_(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "last", "chunk", "n"])

    return run


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST) -> DataFrame:
    """``lang, last, chunk, n``: the distinct chunks of each language's parse and how often each occurs."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    parsed = docs.select(lang, text).mapInArrow(_parse_batches(longest - 1), "lang string, last boolean, chunk binary, n long")
    return parsed.groupBy("lang", "last", "chunk").agg(F.sum("n").alias("n"))


class Words:
    """The words of some distinct chunks, each with an exact number, its weight as a start, and whether its piece goes on."""

    def __init__(self, chunks: Sequence[tuple[bool, bytes, int]], overlap: int):
        self.data = b"\n".join([c for _, c, _ in chunks])
        buf = np.frombuffer(self.data, dtype=np.uint8)
        self.starts, self.ends = word_spans(buf)
        self.ids = np.array(list(map({}.setdefault, self.data.split(), count())), dtype=np.int64)
        edges = np.cumsum([0] + [len(c) + 1 for _, c, _ in chunks])
        first = np.searchsorted(self.starts, edges)
        sizes = np.diff(first)
        at = np.arange(len(self.starts)) - np.repeat(first[:-1], sizes)
        mine = np.where([last for last, _, _ in chunks], sizes, sizes - overlap)
        self.weights = np.repeat(np.array([n for _, _, n in chunks], dtype=np.int64), sizes)
        self.weights[at >= np.repeat(mine, sizes)] = 0  # starts in the window that the next chunk begins with
        self.goes_on = np.append(buf[self.ends[:-1]] == 0x20, False)

    def keys(self, size: int, at: np.ndarray) -> np.ndarray:
        """Hashes of the phrases of ``size`` words that start at ``at`` (ascending)."""
        buf = np.frombuffer(self.data, dtype=np.uint8)
        return hash_spans(buf, self.starts[at], self.ends[at + size - 1])

    def phrases(self, size: int, at: np.ndarray) -> list[bytes]:
        return [self.data[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at + size - 1].tolist(), strict=True)]

    def totals(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A place of each phrase numbered in ``code``, and its summed weight where that is above 0; numbers are places, -1 is none."""
        at = np.flatnonzero(code >= 0)
        weights = self.weights[at]
        if weights.sum(dtype=float) < 1 << 52:  # sums below 2**53 are exact as floats
            total = np.bincount(code[at], weights=weights, minlength=1).astype(np.int64)
        else:
            total = np.zeros(len(self.ids), dtype=np.int64)
            np.add.at(total, code[at], weights)
        places = np.flatnonzero(total)
        return places, total[places]


def _numbered(code: np.ndarray, following: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The phrases at ``at``, each a numbered phrase and the word behind it, numbered by the place of one occurrence; -1 elsewhere."""
    exact = code[at] * n + following[at]  # both are places, so the product stays exact
    order = np.argsort(exact)
    ranked = exact[order]
    first = np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)]
    out = np.full(len(following), -1, dtype=np.int64)
    out[at[order]] = at[order[np.flatnonzero(first)]][np.cumsum(first) - 1] if len(at) else 0
    return out


def _passed(words: Words, size: int, code: np.ndarray, lang: np.uint64, bitmap: np.ndarray) -> np.ndarray:
    """Where the filter lets the phrase through; each distinct one is looked up once."""
    found = np.zeros(len(words.ids) + 1, dtype=bool)  # the last for -1
    places = np.flatnonzero(np.bincount(code[code >= 0], minlength=1))
    if len(places):
        found[places[held(bitmap, mix64(words.keys(size, places) ^ lang))]] = True
    return found[code]


def _lang_key(lang: str) -> np.uint64:
    data = np.frombuffer(b"\0" + lang.encode(), dtype=np.uint8)
    return hash_spans(data, np.array([0]), np.array([len(data)]))[0]


def weigh(words: Words, sizes: Sequence[int], lang: np.uint64, bitmap: np.ndarray | None) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """Phrases of each of the given sizes and their weights.

    ``bitmap`` holds the frequent phrases of one word less than the first size;
    phrases are looked at only where all their parts of that length pass.
    """
    n, known = len(words.ids), sizes[0] - 1
    code, frequent = words.ids, np.ones(n, dtype=bool)
    for size in range(1, min(sizes[-1], n) + 1):
        if size > 1:
            ok = (code[:-1] >= 0) & words.goes_on[size - 2 : n - 1]
            if size > known > 0:
                ok &= frequent[size - known :][: len(ok)]
            code = _numbered(code, words.ids[size - 1 :], np.flatnonzero(ok), n)
        if size == known:
            frequent = _passed(words, size, code, lang, bitmap)
            code = np.where(frequent, code, -1)
        if size in sizes:
            places, weights = words.totals(code)
            if len(places):
                yield size, words.phrases(size, places), weights


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[bool, bytes, int]]]]:
    """Chunks of one language, about ``GROUP`` bytes of chunks of all languages at a time."""
    chunks, size = defaultdict(list), 0
    for batch in slices(batches):
        for lang, *chunk in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            chunks[lang].append(chunk)
            size += len(chunk[1])
            if size >= GROUP:
                yield from chunks.items()
                chunks, size = defaultdict(list), 0
    yield from chunks.items()


def _count_batches(sizes: Sequence[int], overlap: int, bitmap=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, chunks in _groups(batches):
            words = Words(chunks, overlap)
            found = weigh(words, sizes, _lang_key(lang), bitmap.value if bitmap else None)
            if sizes[0] == 1:  # size 0 stands for all words
                found = [(0, [b""], words.weights.sum(keepdims=True)), *found]
            for size, phrases, weights in found:
                for at in range(0, len(phrases), 1 << 16):
                    part = pa.array(phrases[at : at + (1 << 16)], pa.binary())
                    same = [pa.array([v] * len(part), k) for v, k in ((lang, pa.string()), (size, pa.int32()))]
                    yield pa.RecordBatch.from_arrays([*same, part.cast(pa.string()), pa.array(weights[at : at + (1 << 16)])], ["lang", "size", "phrase", "f"])

    return run


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1 << 16):
        phrases = batch.column(1).to_pylist()
        ends = np.cumsum([len(p) for p in phrases])
        starts = np.append(0, ends[:-1])
        langs = {lang: _lang_key(lang) for lang in set(batch.column(0).to_pylist())}
        of = np.array([langs[lang] for lang in batch.column(0).to_pylist()], dtype=np.uint64)
        keys = mix64(hash_spans(np.frombuffer(b"".join(phrases), dtype=np.uint8), starts, ends) ^ of)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])


def frequent_phrases(chunks: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``lang, size, phrase, f``: all phrases of up to ``longest`` words that occur ``least`` times; size 0 has the number of words.

    ``chunks`` is a stored :func:`dictionary` of the same ``longest``.  Three passes:
    words, pairs of frequent words, then longer phrases of frequent pairs.
    """
    context = chunks.sparkSession.sparkContext

    def counts(sizes: Sequence[int], parts: DataFrame | None) -> DataFrame:
        bitmap = None
        if parts is not None:
            bitmap = context.broadcast(key_filter(parts.select("lang", F.col("phrase").cast("binary")).mapInArrow(_key_batches, "key long")))
        found = chunks.select("lang", "last", "chunk", "n").mapInArrow(_count_batches(sizes, longest - 1, bitmap), "lang string, size int, phrase string, f long")
        total = found.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
        return stage(total.filter(f"size = 0 or f >= {least}"), f"phrases-{sizes[0]}")

    words = counts([1], None)
    pairs = counts([2], words.filter("size = 1"))
    out = words.unionByName(pairs)
    return out.unionByName(counts(range(3, longest + 1), pairs)) if longest > 2 else out


def scores(frequent: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of every frequent phrase of several words, at its lowest-scoring cut (ties: the first).

    Products are decimals of 38 digits and divisions whole, so scores are exact.
    """
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = frequent.filter("size > 1").select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), "size")
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("first"), F.expr("substring_index(phrase, ' ', k - size)").alias("rest"))
    parts = frequent.filter("size > 0")
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    scored = scored.withColumn("top", exact("a") * F.lit(2_000_000).cast("decimal(7,0)")).withColumn("bottom", exact("l") + exact("r"))
    scored = scored.withColumn("score", F.expr("top div bottom"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def uncovered(candidates: DataFrame, frequent: DataFrame, covered: int = COVERED) -> DataFrame:
    """Candidates that no longer phrase contains in ``covered`` percent of their occurrences or more."""
    words = F.split("phrase", " ")
    spans = F.expr("flatten(transform(sequence(2, size - 1), n -> transform(sequence(1, size - n + 1), i -> array_join(slice(words, i, n), ' '))))")
    longer = frequent.filter("size > 2").select("lang", "size", "f", words.alias("words"))
    inside = longer.select("lang", "f", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    joined = candidates.join(inside, ["lang", "phrase"], "left")
    share = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * covered
    return joined.filter(~F.coalesce(share, F.lit(False))).drop("longer")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, best: int = BEST
) -> DataFrame:
    """The best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Null languages are ``und``, null texts are empty.  Repeated rows count each
    time.  A language without a frequent phrase has no rows.  Other columns are
    ignored, whatever their names.
    """
    frequent = frequent_phrases(stage(dictionary(docs, text_col, lang_col, longest), "chunks"), longest, least)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = uncovered(scores(frequent), frequent, covered).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    totals = frequent.filter("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
