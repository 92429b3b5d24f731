"""Benchmark decontamination over canonical templates.

Numbers, names and units become typed placeholders, so a question asked again
with other values has the same template.  Windows of the template tokens of all
documents meet the windows of the benchmark in a hash join; the matches of one
document and item on one alignment are then checked for slot consistency: each
placeholder value of the item must stand for one value throughout.  A document
is contaminated by an item when consistent matches cover enough of the item's
windows, or a long enough passage of it.

An item shorter than a window is one window of its own length, in which the words
that open sentences stand for themselves, if half of its tokens are words; it is
looked for by its exact tokens as well.  Items that are mostly placeholders say too
little as templates and are looked for by their exact tokens alone.  Of these, ones
of very few tokens stand in many texts by chance: a text that is nothing else holds
them, and a text that has them among others is a weak hit, which the caller may ask
for.

Items that differ in their values only form one class and are compared once.
Documents drop windows that no item has by a Bloom filter of bounded size before
anything is shuffled; the join is exact whatever the filter lets through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.llm.staging import stage
from metricspark.llm.textops import PIECE, hash_spans, mix64, slices, to_bytes, window_hashes

WINDOW = 8
#: A template window needs this many tokens that are no placeholder.
WORDS_IN_WINDOW = 4
#: Percent of an item's windows that must match consistently, or else this many windows.
COVERAGE, LONG_MATCH = 50, 6
#: An item without a template and with fewer tokens than this is a weak hit in documents that have other tokens.
LEAST_CONTAINED = 5
#: Bits of the filter per benchmark window, and the most bits in all (powers of two).
FILTER_BITS, MOST_FILTER_BITS = 16, 28

# Unit words.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
    "percent degree degrees dollar dollars cent cents euro euros usd eur gbp mph kmh hz khz mhz ghz kb mb gb tb watt watts volt volts"
).split()

_LETTER, _DIGIT, _UPPER, _STOP = (np.zeros(256, dtype=bool) for _ in range(4))
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT[48:58] = True
_UPPER[65:91] = True
_STOP[[ord(c) for c in '.!?\n:;"']] = True
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[ord("$"), ord("%")]] = True
_NUMBER, _UNIT, _NAME = (np.uint64(k) for k in (1, 2, 3))


@dataclass
class Template:
    """Template tokens of a byte string: hashes (placeholders below 4), where they start, and the byte spans of their values.

    ``opens`` marks names that start at the start of a sentence; ``exact`` and
    ``exact_starts`` are the tokens with their values, names not joined.
    """

    tokens: np.ndarray
    starts: np.ndarray
    value_starts: np.ndarray
    value_ends: np.ndarray
    opens: np.ndarray
    exact: np.ndarray
    exact_starts: np.ndarray
    folded: bytes

    def worded(self) -> np.ndarray:
        """The tokens with the words that open sentences as themselves."""
        out = self.tokens.copy()
        out[self.opens] = self.exact[np.searchsorted(self.exact_starts, self.starts[self.opens])]
        return out

    def value(self, token: int) -> str:
        return self.folded[self.value_starts[token] : self.value_ends[token]].decode("utf-8", "replace")


def _fold(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case of ASCII and Latin-1 letters, and where capitals stood."""
    upper = _UPPER[raw]
    folded = raw + upper.astype(np.uint8) * np.uint8(32)
    if len(raw) > 1:
        second = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        folded[1:][second] += np.uint8(32)
        upper[:-1] |= second
    return folded, upper


def canonical(data: bytes) -> Template:
    """Template of a text: runs of letters and of digits, the latter with inner points and commas.

    A number is one placeholder, a unit word or currency or percent sign
    another; a capitalised word is a name, and names that follow each other after
    one space are one, but for a word that opens a sentence; the last word is the
    value of such a name.  Any other word stands for itself, lower case in ASCII and
    Latin-1.
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    folded, upper = _fold(raw)
    kind = _LETTER[raw] * np.int8(1) + _DIGIT[raw] * np.int8(2) + _SIGN[raw] * np.int8(3)
    if len(raw) > 2:  # inner points of numbers, apostrophes of words
        inner = ((raw[1:-1] == 46) | (raw[1:-1] == 44)) & (kind[:-2] == 2) & (kind[2:] == 2)
        kind[1:-1][inner] = 2
        inner = (raw[1:-1] == 39) & (kind[:-2] == 1) & (kind[2:] == 1)
        kind[1:-1][inner] = 1
    edge = np.concatenate([[True], kind[1:] != kind[:-1], [True]]) if len(raw) else np.array([True])
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    word = kind[starts] > 0 if len(starts) else np.empty(0, dtype=bool)
    starts, ends = starts[word], ends[word]
    if not len(starts):
        none = np.empty(0, dtype=np.uint64)
        return Template(none, starts, starts, ends, np.empty(0, dtype=bool), none, starts, data)
    kinds = kind[starts]
    tokens = hash_spans(folded, starts, ends) | np.uint64(4)
    exact = tokens.copy()
    stops = np.concatenate([[0], np.cumsum(_STOP[raw])])
    opening = np.ones(len(starts), dtype=bool)
    opening[1:] = stops[starts[1:]] > stops[ends[:-1]]
    unit = (kinds == 3) | ((kinds == 1) & np.isin(tokens, _UNIT_HASHES))
    name = (kinds == 1) & upper[starts] & ~unit
    tokens[name], tokens[unit], tokens[kinds == 2] = _NAME, _UNIT, _NUMBER
    joined = np.zeros(len(starts), dtype=bool)
    joined[1:] = name[1:] & name[:-1] & ~opening[:-1] & (starts[1:] == ends[:-1] + 1) & (raw[ends[:-1]] == 32)
    keep = np.flatnonzero(~joined)
    last = np.append(keep[1:] - 1, len(ends) - 1)
    return Template(tokens[keep], starts[keep], starts[last], ends[last], (name & opening)[keep], exact, starts, folded.tobytes())


def _unit_hashes() -> np.ndarray:
    data = " ".join(UNITS).encode()
    ends = np.cumsum([len(u) + 1 for u in UNITS]) - 1
    starts = ends - [len(u) for u in UNITS]
    return np.sort(hash_spans(np.frombuffer(data, dtype=np.uint8), starts, ends) | np.uint64(4))


_UNIT_HASHES = _unit_hashes()


def _groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about a piece together."""
    at = 0
    while at < len(texts):
        end, size = at + 1, len(texts[at])
        while end < len(texts) and size + len(texts[end]) < PIECE:
            size += len(texts[end]) + 1
            end += 1
        yield at, end
        at = end


@dataclass
class Windows:
    """Windows of a group of texts: text, key, first token in the text and in the group (-1 for exact ones), and its length in tokens (below 0 with opening words as themselves)."""

    template: Template
    text: np.ndarray
    key: np.ndarray
    at: np.ndarray
    token: np.ndarray
    length: np.ndarray

    def slots(self, row: int) -> list[str]:
        """Values of the window's placeholders."""
        first, length = int(self.token[row]), int(self.length[row])
        if first < 0:
            return []
        placed = self.template.tokens[first : first + abs(length)] < 4
        if length < 0:
            placed &= ~self.template.opens[first : first - length]
        return [self.template.value(first + int(k)) for k in np.flatnonzero(placed)]

    def take(self, rows: np.ndarray) -> Windows:
        return Windows(self.template, self.text[rows], self.key[rows], self.at[rows], self.token[rows], self.length[rows])


def _says_enough(words: int | np.ndarray, size: int) -> bool | np.ndarray:
    """Whether a short template has words enough: two at least, and half of its tokens."""
    return (words >= 2) & (2 * words >= size)


def _short_keys(worded: np.ndarray, size: int) -> np.ndarray:
    """Keys of the windows of a short template's length."""
    return mix64(window_hashes(mix64(worded), size) + np.uint64(0x9FB21C651E98DF25) + np.uint64(size))


def _owners(starts: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of tokens that start at ``starts``: the text of each, and first token and token count of each text."""
    first = np.searchsorted(starts, edges)
    counts = np.diff(first)
    return np.repeat(np.arange(len(counts)), counts), first[:-1], counts


def _exact_key(tokens: np.ndarray, size: int) -> np.ndarray:
    return mix64(window_hashes(mix64(tokens), size) + np.uint64(size))


def windows_of(texts: Sequence[bytes], window: int, sizes: Sequence[int] = ()) -> Windows:
    """Template windows with words enough, and those of the given sizes: exact ones; short templates (the size below 0); 0 stands for texts of few tokens, whole."""
    template = canonical(b"\n".join(texts))
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])
    owner, first, _ = _owners(template.starts, edges)
    words = np.concatenate([[0], np.cumsum(template.tokens >= 4)])
    keys = window_hashes(mix64(template.tokens), window)
    at = np.flatnonzero(owner[: len(keys)] == owner[window - 1 :]) if len(keys) else np.empty(0, dtype=np.int64)
    at = at[words[at + window] - words[at] >= WORDS_IN_WINDOW]
    parts = [(owner[at], keys[at], at - first[owner[at]], at, np.full(len(at), window))]
    if any(size < 0 for size in sizes):
        worded = template.worded()
        words = np.concatenate([[0], np.cumsum(worded >= 4)])
        for size in (-size for size in sizes if size < 0):
            keys = _short_keys(worded, size)
            at = np.flatnonzero(owner[: len(keys)] == owner[size - 1 :]) if len(keys) else np.empty(0, dtype=np.int64)
            at = at[_says_enough(words[at + size] - words[at], size)]
            parts.append((owner[at], keys[at], at - first[owner[at]], at, np.full(len(at), -size)))
    if any(size >= 0 for size in sizes):
        owner, first, counts = _owners(template.exact_starts, edges)
        for size in sizes:
            if size > 0:
                keys = _exact_key(template.exact, size)
                at = np.flatnonzero(owner[: len(keys)] == owner[size - 1 :]) if len(keys) else np.empty(0, dtype=np.int64)
                parts.append((owner[at], keys[at], at - first[owner[at]], np.full(len(at), -1), np.full(len(at), size)))
            elif size == 0:
                few = np.flatnonzero((counts > 0) & (counts < LEAST_CONTAINED))
                whole = [_whole_key(template.exact[first[k] : first[k] + counts[k]]) for k in few]
                parts.append((few, np.array(whole, dtype=np.uint64), np.zeros(len(few), dtype=np.int64), np.full(len(few), -1), counts[few]))
    return Windows(template, *(np.concatenate(c) for c in zip(*parts, strict=True)))


def _whole_key(tokens: np.ndarray) -> np.uint64:
    return mix64(_exact_key(tokens, len(tokens)) + np.uint64(0x5851F42D4C957F2D))[0]


def _digest(values: Sequence) -> int:
    """Order-dependent 63-bit digest of token hashes and small numbers."""
    row = np.array([int(v) & 0xFFFFFFFFFFFFFFFF for v in values] or [0], dtype=np.uint64)
    return int(window_hashes(mix64(row + np.uint64(len(values))), len(row))[0] >> np.uint64(1))


_ITEM = "class long, size int, key long, at int, n_windows int, weak boolean, slot_ids array<int>, slots array<string>"


def _item_rows(item_id, text: bytes, window: int) -> list[tuple]:
    """Windows of one item: of its template if most of them have words enough, of a short template and its exact tokens, else of its exact tokens.

    Slots of one value have one number.  A value that only opens sentences may be
    a plain word and is not checked for consistency: its number is 0.
    """
    found = windows_of([text], window)
    t = found.template
    whole = len(t.tokens) - window + 1
    if len(found.key) and 2 * len(found.key) >= whole:
        placed = np.flatnonzero(t.tokens < 4)
        values = {int(k): t.value(int(k)) for k in placed}
        checked = {values[int(k)] for k in placed if not t.opens[k]}
        seen: dict[str, int] = {}
        number = {k: seen.setdefault(v, len(seen) + 1) if v in checked else 0 for k, v in values.items()}
        group = _digest([*t.tokens, 0, *number.values()])
        out = []
        for row in range(len(found.key)):
            first = int(found.token[row])
            inside = [first + int(k) for k in np.flatnonzero(t.tokens[first : first + window] < 4)]
            slots = [number[k] for k in inside], [values[k] for k in inside]
            out.append((item_id, group, -1, int(found.key[row].view(np.int64)), int(found.at[row]), len(found.key), False, *slots))
        return out
    n = len(t.exact)
    if not n:
        return []
    as_int = lambda key: int(key.view(np.int64))
    worded = t.worded()
    size = len(worded)
    if size < window and _says_enough(int((worded >= 4).sum()), size):
        slots = [t.value(int(k)) for k in np.flatnonzero(worded < 4)]
        seen = {}
        number = [seen.setdefault(v, len(seen) + 1) for v in slots]
        group = _digest([2, *worded, 0, *number])
        return [
            (item_id, group, -size, as_int(_short_keys(worded, size)[0]), 0, 1, False, number, slots),
            (item_id, group, n, as_int(_exact_key(t.exact, n)[0]), 0, 1, False, [], []),
        ]
    group = _digest([1, *t.exact])
    if n < LEAST_CONTAINED:
        return [
            (item_id, group, 0, as_int(_whole_key(t.exact)), 0, 1, False, [], []),
            (item_id, group, n, as_int(_exact_key(t.exact, n)[0]), 0, 1, True, [], []),
        ]
    size = min(n, window)
    keys = _exact_key(t.exact, size).view(np.int64)
    return [(item_id, group, size, int(k), i, len(keys), False, [], []) for i, k in enumerate(keys)]


def _item_batches(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [r for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for r in _item_rows(i, to_bytes(t), window)]
            kinds = [batch.column(0).type, pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.string())]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["item_id", "class", "size", "key", "at", "n_windows", "weak", "slot_ids", "slots"]
            )

    return run


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """``item_id, class, size, key, at, n_windows, weak, slot_ids, slots`` of all items; ``size`` is -1 for template windows, less for short templates."""
    kind = benchmark.schema[item_col].dataType.simpleString()
    return benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).mapInArrow(_item_batches(window), f"item_id {kind}, {_ITEM}")


_CHUNK = 1 << 16


def _chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunks: dict[int, np.ndarray] = {}
    for batch in batches:
        at = batch.column(0).to_numpy(zero_copy_only=False)
        for chunk in np.unique(at // _CHUNK):
            bits = chunks.setdefault(int(chunk), np.zeros(_CHUNK, dtype=bool))
            bits[at[at // _CHUNK == chunk] % _CHUNK] = True
    for chunk, bits in chunks.items():
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([np.packbits(bits).tobytes()], pa.binary())], ["chunk", "bits"])


def key_filter(items: DataFrame) -> np.ndarray:
    """Bloom filter of the items' window keys, two bits a key, as a bitmap of at most ``2 ** MOST_FILTER_BITS`` bits."""
    n = max(1, items.count())
    log = min(MOST_FILTER_BITS, max(16, ceil(log2(n * FILTER_BITS))))
    mask = (1 << log) - 1
    probes = F.array(F.expr(f"key & {mask}L"), F.expr(f"shiftrightunsigned(key, 32) & {mask}L"))
    at = items.select(F.explode(probes).alias("at"))
    chunks = at.repartition(F.col("at") % (1 << log) / _CHUNK).mapInArrow(_chunk_batches, "chunk long, bits binary")
    out = np.zeros((1 << log) // 8, dtype=np.uint8)
    for row in chunks.toLocalIterator():  # as many rows as the bitmap has pieces
        begin = row.chunk * _CHUNK // 8
        out[begin : begin + _CHUNK // 8] |= np.frombuffer(row.bits, dtype=np.uint8)
    return out


def _held(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Positions of the keys that the filter lets through."""
    mask = np.uint64(len(bitmap) * 8 - 1)
    found = np.ones(len(keys), dtype=bool)
    for probe in (keys & mask, (keys >> np.uint64(32)) & mask):
        found &= (bitmap[(probe >> np.uint64(3)).astype(np.int64)] >> (7 - (probe & np.uint64(7))).astype(np.uint8)) & 1 == 1
    return np.flatnonzero(found)


def _window_batches(window: int, sizes: Sequence[int], bitmap):
    """Rows of the windows of each text that the filter lets through; all columns but the last go along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [to_bytes(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            for begin, end in _groups(texts):
                found = windows_of(texts[begin:end], window, sizes)
                found = found.take(_held(bitmap.value, found.key))
                if not len(found.key):
                    continue
                rows = batch.take(pa.array(found.text + begin))
                yield pa.RecordBatch.from_arrays(
                    [
                        *rows.columns[:-1],
                        pa.array(found.key.view(np.int64)),
                        pa.array(found.at.astype(np.int32)),
                        pa.array([found.slots(k) for k in range(len(found.key))], pa.list_(pa.string())),
                    ],
                    [*batch.schema.names[:-1], "key", "at", "slots"],
                )

    return run


def _row_keys(id_col: str, text_col: str) -> list[Column]:
    """Two hashes that name a row by its id and text."""
    return [F.xxhash64(id_col, text_col).alias("row_1"), F.xxhash64(text_col, id_col, F.lit(1)).alias("row_2")]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    coverage: int = COVERAGE,
    long_match: int = LONG_MATCH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    weak: bool = False,
) -> DataFrame:
    """Documents that hold benchmark items, one row per document and class of items.

    ``doc_id, item_id, n_matched, n_windows, changed[, weak], row_1, row_2``: the item's
    windows found on one alignment with consistent slots, of how many, and whether
    some value is not one of an item (a re-parameterised question).  ``item_id``
    is the smallest of the items that differ in values only; ids may be of any
    type.  With ``weak``, hits that say little come too, marked: an item of very
    few tokens and no template that a document has among others.  A document is a row:
    ``row_1, row_2`` hash its id and text, so null and repeated ids are judged by
    their own texts, and rows equal in both count once.  Null and empty texts hold
    nothing; null, empty and wordless items are in nothing; items may repeat or
    have a null id; either table may be empty; other columns are not read.
    """
    spark = docs.sparkSession
    items = item_windows(benchmark, item_col, item_text_col, window)
    items = stage(items if weak else items.where("not weak"), "items")
    sizes = sorted(r["size"] for r in items.where("size <> -1").select("size").distinct().collect())  # lengths of short items
    bitmap = spark.sparkContext.broadcast(key_filter(items))
    rows = docs.select(F.col(id_col).alias("doc_id"), *_row_keys(id_col, text_col), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = rows.mapInArrow(
        _window_batches(window, sizes, bitmap), f"doc_id {kind}, row_1 long, row_2 long, key long, at int, slots array<string>"
    )

    classes = items.groupBy("class", "key", F.col("at").alias("item_at")).agg(
        F.min("item_id").alias("item_id"), F.first("n_windows").alias("n_windows"), F.first("slot_ids").alias("slot_ids"), F.min("weak").alias("weak")
    )
    values = items.select("class", F.col("at").alias("item_at"), F.xxhash64("slots").alias("values"), F.lit(True).alias("known")).distinct()
    pairs = stage(rows.join(classes, "key"), "template-matches")
    pairs = (
        pairs.withColumn("values", F.xxhash64("slots"))
        .join(values, ["class", "item_at", "values"], "left")
        .withColumn("bound", F.filter(F.arrays_zip("slot_ids", "slots"), lambda z: z["slot_ids"] != 0))
    )
    # one row per document, class and alignment; what it gathers is bounded by the item
    runs = pairs.groupBy("doc_id", "row_1", "row_2", "class", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.size(F.collect_set("item_at")).cast("long").alias("n_matched"),
        F.first("n_windows").cast("long").alias("n_windows"),
        F.min("item_id").alias("item_id"),
        F.array_distinct(F.flatten(F.collect_set("bound"))).alias("bound"),
        F.max(F.col("known").isNull()).alias("changed"),
        F.min("weak").alias("weak"),
    )
    sound = runs.where(F.size("bound") == F.size(F.array_distinct(F.transform("bound", lambda z: z["slot_ids"]))))
    return (
        sound.where(f"100 * n_matched >= {coverage} * n_windows or n_matched >= {long_match}")
        .groupBy("doc_id", "row_1", "row_2", "class")
        .agg(F.max(F.struct("n_matched", (~F.col("changed")).alias("same"), "n_windows", "item_id")).alias("best"), F.min("weak").alias("weak"))
        .select("doc_id", "best.item_id", "best.n_matched", "best.n_windows", (~F.col("best.same")).alias("changed"), *(["weak"] if weak else []), "row_1", "row_2")
    )


def contaminated_documents(hits: DataFrame) -> DataFrame:
    """One row per contaminated document: ``doc_id, item_ids, n_items, share, changed, kept`` (never kept)."""
    return (
        hits.groupBy("doc_id", "row_1", "row_2")
        .agg(
            F.sort_array(F.collect_set("item_id")).alias("item_ids"),
            F.count("*").alias("n_items"),
            F.max(F.col("n_matched") / F.col("n_windows")).alias("share"),
            F.max("changed").alias("changed"),
            F.lit(False).alias("kept"),
        )
        .drop("row_1", "row_2")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns; each row is judged by its own text."""
    names = ["row_1", "row_2"]
    while set(names) & set(docs.columns):
        names = [n + "_" for n in names]
    hits = contaminated(docs, benchmark, id_col=id_col, text_col=text_col, **options).select(
        F.col("row_1").alias(names[0]), F.col("row_2").alias(names[1])
    )
    keyed = docs.withColumns(dict(zip(names, _row_keys(id_col, text_col), strict=True)))
    return keyed.join(hits.distinct(), names, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
