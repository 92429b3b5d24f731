"""Near-duplicate documents by banded MinHash, odd sketches and exact sets.

Every text becomes its set of distinct five-word shingles.  MinHash samples of
the set give band keys (candidates) and are folded into an odd sketch, a parity
bitmap whose XOR population count estimates high similarities; candidates that
pass the sketch are confirmed on the full shingle sets.

Equal sets are collapsed to one representative first.  The first pass takes only
the samples that the bands need; sketches and full sets are made for documents
that share a bucket.  Candidates come in two sweeps over the band buckets, neither
of which lists all pairs of a bucket: the first compares members with the
bucket's smallest document.  The second takes the members that its links left
outside the bucket's largest component.  It compares them with a few members of
that component, other ones each turn, which joins most of a family, and
then those still apart with all members of other components, evaluating the
sketches inside the join so that only promising pairs become rows.  Large buckets
are split into tiles for it, so their work spreads over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricspark.llm.graph import connected_components
from metricspark.llm.staging import Scratch, stage
from metricspark.llm.textops import mix64, slices, to_bytes, window_hashes, words_by_text

SHINGLE_WORDS = 5
SAMPLES = 768
BANDS, ROWS = 48, 6
SKETCH_BITS = 2048
#: Standard deviations below the threshold at which a sketch still passes.
SKETCH_Z = 4.0
#: Turns of the second sweep before its end, and members of a bucket's largest component that each turn compares with.
TURNS, PIVOTS = 1, 8
#: Members of a bucket that meet in one group at the end of the second sweep.
TILE = 256


@lru_cache(maxsize=2)
def _permutations(samples: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    a = rng.integers(1, 1 << 32, samples, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    return a, rng.integers(0, 1 << 32, samples, dtype=np.uint64).astype(np.uint32)


def shingle_set(words: np.ndarray, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes; a short text is one shingle, an empty one none."""
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(n, len(words))))


def minhash(shingles: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """Minimum of each of the first ``samples`` hash functions over a non-empty set."""
    a, b = (x[:samples] for x in _permutations(SAMPLES))
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(samples, np.uint32(0xFFFFFFFF))
    for k in range(0, len(x), 256):
        np.minimum(low, (x[k : k + 256, None] * a + b).min(axis=0), out=low)
    return low


def band_keys(sample: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` samples."""
    table = sample[: bands * rows].reshape(bands, rows).astype(np.uint64)
    key = mix64(np.arange(1, bands + 1, dtype=np.uint64))
    for r in range(rows):
        key = mix64(key * np.uint64(0x9FB21C651E98DF25) + table[:, r])
    return key


def odd_sketch(sample: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmap of the (position, sample) pairs as 64-bit words."""
    at = mix64(sample.astype(np.uint64) + (np.arange(len(sample), dtype=np.uint64) << np.uint64(32)))
    parity = np.bincount((at % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def sketch_limit(threshold: float, samples: int = SAMPLES, bits: int = SKETCH_BITS, z: float = SKETCH_Z) -> int:
    """Largest XOR population count that a pair at ``threshold`` reaches, ``z`` deviations out."""
    m = 2 * samples * (1 - threshold)
    decay = np.exp(-2 * m / bits)
    sampling = 4 * samples * threshold * (1 - threshold) * decay**2
    folding = bits / 4 * (1 - decay**2) - m * decay**2
    return int(bits * (1 - decay) / 2 + z * np.sqrt(sampling + max(folding, 0)))


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    edges = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(values.view(np.int64), type=kind))


def _band_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    empty = np.empty(0, dtype=np.int64)
    for batch in slices(batches):
        texts = [to_bytes(t).lower() for t in batch.column(1).to_pylist()]
        n, high, low, bands = [], [], [], []
        for words in words_by_text(texts):
            shingles = shingle_set(words)
            n.append(len(shingles))
            # two order-free sums of independent mixes identify the set
            high.append(int(mix64(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)))
            low.append(int(mix64(shingles).sum(dtype=np.uint64).view(np.int64)))
            bands.append(band_keys(minhash(shingles, BANDS * ROWS)).view(np.int64) if len(shingles) else empty)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()),
                pa.array(n, pa.int64()),
                pa.array(high, pa.int64()),
                pa.array(low, pa.int64()),
                _lists(bands, pa.int64()),
            ],
            ["doc_id", "n_shingles", "set_high", "set_low", "bands"],
        )


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [to_bytes(t).lower() for t in batch.column(1).to_pylist()]
        rows = [shingle_set(w) for w in words_by_text(texts)]
        samples = [minhash(r) if len(r) else None for r in rows]
        none = np.empty(0, dtype=np.int64)
        bands = [none if s is None else band_keys(s).view(np.int64) for s in samples]
        sketches = [none if s is None else odd_sketch(s) for s in samples]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), _lists(rows, pa.int64()), _lists(bands, pa.int64()), _lists(sketches, pa.int64())],
            ["doc_id", "shingles", "bands", "sketch"],
        )


def document_bands(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, set_high, set_low, bands)`` of each row, in one pass."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _band_batches, "doc_id long, n_shingles long, set_high long, set_low long, bands array<long>"
    )


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, shingles, bands, sketch)`` of each row: sorted distinct shingle hashes, their band keys and odd sketch."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _set_batches, "doc_id long, shingles array<long>, bands array<long>, sketch array<long>"
    )


def _xor_bits(words: int = SKETCH_BITS // 64) -> str:
    return " + ".join(f"bit_count(a.sketch[{k}] ^ b.sketch[{k}])" for k in range(words))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(u, v)`` whose full sets meet the threshold."""
    left = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("su"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("sv"))
    return (
        pairs.join(left, "u")
        .join(right, "v")
        .withColumn("common", F.size(F.array_intersect("su", "sv")))
        .where(f"100 * common >= {percent} * (size(su) + size(sv) - common)")
        .select("u", "v")
    )


def _open_members(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that hold several components: ``key, doc_id, component, major, n, n_major``."""
    named = shared.where("n > 2").join(labels.withColumnRenamed("vertex", "doc_id"), "doc_id", "left")
    named = named.select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    parts = named.groupBy("key", "component").agg(F.count("*").alias("c"))
    open_ = parts.groupBy("key").agg(F.max(F.struct("c", "component")).alias("top"), F.sum("c").alias("n"), F.count("*").alias("k")).where("k > 1")
    return named.join(open_.select("key", F.col("top.component").alias("major"), "n", F.col("top.c").alias("n_major")), "key")


def _pivot_pairs(members: DataFrame, sketched: DataFrame, sizes: str, near: str, turn: int) -> DataFrame:
    """Near pairs ``(u, v)`` of members outside their bucket's largest component with ``PIVOTS`` members of it."""
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("doc_id", F.lit(turn)), "doc_id"))
    pivots = members.where("component = major").withColumn("place", place).where(f"place <= {PIVOTS}").select("key", F.col("doc_id").alias("v"))
    met = members.where("component <> major").select("key", F.col("doc_id").alias("u")).join(pivots, "key").select("u", "v").distinct()
    return (
        met.join(sketched.alias("a"), F.col("u") == F.col("a.doc_id"))
        .join(sketched.alias("b"), (F.col("v") == F.col("b.doc_id")) & F.expr(sizes) & F.expr(near))
        .select("u", "v")
    )


def _tile_pairs(members: DataFrame, banded: DataFrame, sizes: str, near: str) -> DataFrame:
    """All near pairs ``(u, v)`` of bucket members in different components.

    Of two such members one at least is outside the bucket's largest component,
    so those are one side of the join and all members the other.  Both sides are
    dealt into tiles of about ``TILE`` members, every tile of one meets every tile
    of the other, and the join key names the two tiles.
    """
    rows = members.join(banded, "doc_id")
    rows = rows.withColumn("all_tiles", F.expr(f"(n + {TILE - 1}) div {TILE}")).withColumn("minor_tiles", F.expr(f"(n - n_major + {TILE - 1}) div {TILE}"))
    first_shared = "array_position(zip_with(a.bands, b.bands, (x, y) -> x = y), true)"
    all_tile, minor_tile = F.pmod(F.xxhash64("doc_id"), F.col("all_tiles")), F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("minor_tiles"))
    every = lambda tiles: F.explode(F.sequence(F.lit(0).cast("long"), F.col(tiles) - 1))
    a = rows.where("component <> major").select("*", minor_tile.alias("i"), every("all_tiles").alias("j"))
    b = rows.select("*", all_tile.alias("j"), every("minor_tiles").alias("i"))
    met = (
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.i") == F.col("b.i"))
        & (F.col("a.j") == F.col("b.j"))
        & (F.col("a.component") != F.col("b.component"))
        & ((F.col("b.component") == F.col("b.major")) | (F.col("a.doc_id") < F.col("b.doc_id")))
        & F.expr(sizes)
        & F.expr(near)
        & F.expr(f"a.bands[int({first_shared}) - 1] = a.key")  # a pair that shares buckets is met in the first
    )
    pairs = a.alias("a").join(b.alias("b"), met)
    return pairs.select(F.least("a.doc_id", "b.doc_id").alias("u"), F.greatest("a.doc_id", "b.doc_id").alias("v")).distinct()


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links: the components that they join become one, named by its smallest member."""
    ends = links.select(F.explode(F.array("u", "v")).alias("vertex"))
    known = labels.union(ends.select("vertex", F.col("vertex").alias("component"))).groupBy("vertex").agg(F.min("component").alias("component"))
    left, right = (labels.select(F.col("vertex").alias(c), F.col("component").alias(f"c{c}")) for c in "uv")
    between = links.join(left, "u", "left").join(right, "v", "left").select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    joined = connected_components(between.where("u <> v").distinct()).select(F.col("vertex").alias("component"), F.col("component").alias("joined"))
    return known.join(joined, "component", "left").select("vertex", F.coalesce("joined", "component").alias("component"))


def near_duplicates(
    docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Documents link when ``100 * intersection >= percent * union`` of their
    shingle sets; a component's id is its smallest doc_id and that document is
    kept.  Null and wordless texts have no shingles and link with nothing.  Rows
    that share a doc_id count as one document whose links are pooled.  Rows with
    a null doc_id link with nothing that has an id: they get a null component
    and are kept.  Other columns, whatever their names, are not read.
    """
    digest = stage(document_bands(docs, id_col, text_col), "bands")
    linked = digest.where("doc_id is not null and n_shingles > 0")
    classes = stage(linked.groupBy("set_high", "set_low").agg(F.min("doc_id").alias("rep")), "classes")
    reps = classes.select(F.col("rep").alias("doc_id")).distinct()
    scratch = Scratch()

    keyed = linked.join(reps, "doc_id", "left_semi").select("doc_id", F.explode("bands").alias("key"))
    keyed = scratch.stage(keyed, "keys")
    buckets = keyed.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    shared = scratch.stage(keyed.join(buckets.where("pivot < last"), "key").select("key", "doc_id", "pivot", "n"), "buckets")
    members = scratch.stage(shared.select("doc_id").distinct(), "members")
    named_texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = scratch.stage(shingle_sets(named_texts.join(members, "doc_id", "left_semi")).withColumn("n_shingles", F.size("shingles")), "sets")
    slim = sets.select("doc_id", "n_shingles", "sketch")
    banded = sets.select("doc_id", "n_shingles", "sketch", "bands")

    near = f"{_xor_bits()} <= {sketch_limit(percent / 100)}"
    sizes = f"100L * least(a.n_shingles, b.n_shingles) >= {percent}L * greatest(a.n_shingles, b.n_shingles)"
    star = shared.where("doc_id <> pivot").select(F.col("pivot").alias("u"), F.col("doc_id").alias("v")).distinct()
    star = (
        star.join(slim.alias("a"), F.col("u") == F.col("a.doc_id"))
        .join(slim.alias("b"), (F.col("v") == F.col("b.doc_id")) & F.expr(sizes) & F.expr(near))
        .select("u", "v")
    )
    links = scratch.stage(_confirmed(star.distinct(), sets, percent), "links")
    labels = connected_components(links)

    # Members that are still apart meet some of their bucket's largest component, a few each turn, then all that is left.
    for turn in range(TURNS + 1):
        members = scratch.stage(_open_members(shared, labels), "open")
        last = turn == TURNS
        pairs = _tile_pairs(members, banded, sizes, near) if last else _pivot_pairs(members, slim, sizes, near, turn)
        more = scratch.stage(_confirmed(pairs, sets, percent), "links")
        if more.limit(1).count():
            labels = stage(_merged(labels, more), "labels")
    scratch.drop()

    found = classes.join(labels.withColumnRenamed("vertex", "rep"), "rep", "left").select(
        "set_high", "set_low", F.coalesce("component", "rep").alias("component_id")
    )
    pooled = (
        linked.select("doc_id", "set_high", "set_low")
        .join(found, ["set_high", "set_low"])
        .groupBy("doc_id")
        .agg(F.min("component_id").alias("component_id"))
    )
    out = digest.select("doc_id", "n_shingles").join(pooled, "doc_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def deduplicate(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` with one document of each near-duplicate group, all columns.

    Rows with equal doc_id and text (both may be null) stay once; rows of one
    doc_id with different texts share its verdict.
    """
    names = ["row_1", "row_2", "copies"]
    while set(names) & set(docs.columns):
        names = [n + "_" for n in names]
    one, two, copies = names
    verdict = near_duplicates(docs, percent, id_col, text_col)
    gone = verdict.where("not kept").select(F.col("doc_id").alias(id_col)).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.join(gone, id_col, "left_anti").select(*columns, F.xxhash64(id_col, text_col).alias(one), F.xxhash64(text_col, id_col, F.lit(1)).alias(two))
    # texts move only where a row stands more than once
    twice = stage(keyed.groupBy(one, two).agg(F.count("*").alias(copies)).where(F.col(copies) > 1).select(one, two), "repeated-rows")
    if not twice.limit(1).count():
        return keyed.select(*columns)
    single = keyed.join(twice, [one, two], "left_anti").select(*columns)
    return single.union(keyed.join(twice, [one, two], "left_semi").dropDuplicates([one, two]).select(*columns))
