"""Mixing sources to target weights over fixed-length blocks of words.

Each source's documents are packed end to end, in hash order, into one stream of
words cut into fixed-length blocks.  A source's target fixes how many block
slots it gets.  Every output shard draws its slots' sources from one multinomial
distribution over the targets, seeded by the shard's number.  Prefix sums over
the draws number each source's slots; as the draws miss the targets by about the
square root of a source's slots, the few slots beyond a source's share pass, in
order, to the sources that came out short.  The n-th slot of a source takes the
block that a pseudorandom permutation of the source's block indices gives for n,
a new permutation for each pass over the source, and blocks join their documents
by index.

The driver holds the mixture itself (one row per source, of checked number) and
nothing that grows with the documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricspark.llm.staging import stage
from metricspark.llm.textops import mix64

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 64
SHARD_SLOTS = 1024
#: Prefix sums go over runs of about so many documents or shards first, then inside each run.
RUN_ROWS, RUN_SHARDS = 4096, 256
#: A mixture of more sources than this is an error: the driver holds one row for each.
MOST_SOURCES = 65_536


@dataclass(frozen=True)
class Component:
    """One source of the mixture: its size and target in words, its blocks and slots, its packing runs."""

    sid: int
    source: str | None
    size: int
    target: float
    blocks: int
    slots: int
    runs: int


def fill_targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Share ``total`` by weight, no target above ``most`` times its size, excess reshared."""
    open_, out, left = set(range(len(sizes))), [0.0] * len(sizes), total
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] >= most * sizes[i]]
        for i in full or open_:
            out[i] = most * sizes[i] if full else unit * weights[i]
            left -= out[i] if full else 0
        open_ = open_ - set(full) if full else set()
    return out


def permute(index: np.ndarray, size: int | np.ndarray, key: int | np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of ``range(size)`` under ``key`` at ``index``: a Feistel network, cycle-walked.

    Size and key may differ from one index to the next.
    """
    size = np.broadcast_to(np.asarray(size, dtype=np.int64), index.shape)
    key = np.broadcast_to(np.asarray(key, dtype=np.uint64), index.shape)
    half = np.maximum(1, (np.frexp(np.maximum(size, 2) - 1)[1] + 1) // 2).astype(np.uint64)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    with np.errstate(over="ignore"):
        while len(todo):
            shift, at = half[todo], key[todo] * np.uint64(4)
            mask = (np.uint64(1) << shift) - np.uint64(1)
            left, right = out[todo] >> shift, out[todo] & mask
            for r in range(4):
                salt = (at + np.uint64(r + 1)) * np.uint64(0x9E3779B97F4A7C15)
                left, right = right, left ^ (mix64(right + salt) & mask)
            out[todo] = left << shift | right
            todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _mixture(sized: DataFrame, weights: Sequence[float], share: float, most: float, block_words: int) -> list[Component]:
    grouped = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("size"), F.count("*").alias("n"))
    rows = grouped.orderBy(F.asc_nulls_last("source")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"a mixture of more than {MOST_SOURCES} sources")
    sizes = [r["size"] for r in rows]
    targets = fill_targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], share * sum(sizes), most)
    out = []
    for i, (r, target) in enumerate(zip(rows, targets, strict=True)):
        blocks = -(-r["size"] // block_words)
        slots = round(target * blocks / r["size"]) if blocks else 0
        out.append(Component(i, r["source"], r["size"], target, blocks, slots, -(-r["n"] // RUN_ROWS)))
    return out


def draw_shard(quota: np.ndarray, capacity: int, shard: int, seed: int) -> np.ndarray:
    """Slots of each source in one shard: a multinomial draw over the sources' shares of all slots."""
    total = int(quota.sum())
    room = min(capacity, total - shard * capacity)
    return np.random.default_rng([seed, shard]).multinomial(room, quota / total)


def _draws(quota: np.ndarray, capacity: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            drawn = [draw_shard(quota, capacity, int(k), seed) for k in batch["id"]]
            sids = [np.flatnonzero(d) for d in drawn]  # a shard holds no more sources than slots
            yield pd.DataFrame({"shard": batch["id"], "sids": [s.tolist() for s in sids], "counts": [d[s].tolist() for d, s in zip(drawn, sids, strict=True)]})

    return run


def settle(sid: int, nth: np.ndarray, quota: np.ndarray, drawn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Source and number of the drawn slots ``nth`` of a source, after slots beyond the quotas passed to sources in want."""
    source, number = np.full(len(nth), sid), nth.copy()
    beyond = np.flatnonzero(nth >= quota[sid])
    if len(beyond):
        spare, want = np.maximum(drawn - quota, 0), np.maximum(quota - drawn, 0)
        rank = int(spare[:sid].sum()) + nth[beyond] - quota[sid]
        ends = np.cumsum(want)
        to = np.searchsorted(ends, rank, side="right")
        source[beyond] = to
        number[beyond] = drawn[to] + rank - (ends[to] - want[to])
    return source, number


def _slots(mixture: list[Component], drawn: np.ndarray, seed: int):
    quota = np.array([c.slots for c in mixture], dtype=np.int64)
    blocks = np.array([c.blocks for c in mixture], dtype=np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, parts in zip(batch["shard"], batch["parts"], strict=True):
                settled = [settle(p["sid"], np.arange(p["before"], p["before"] + p["n"]), quota, drawn) for p in parts]
                sid, nth = (np.concatenate(c) for c in zip(*settled, strict=True))
                turn, index = np.divmod(nth, blocks[sid])  # the pass over the source, and the place in it
                block = permute(index, blocks[sid], (seed << 40) + (sid << 8) + turn)
                place = permute(np.arange(len(nth)), len(nth), seed ^ int(shard) << 20)
                yield pd.DataFrame({"shard": shard, "slot": place, "sid": sid, "block": block})

    return run


def _dealt_slots(spark: SparkSession, mixture: list[Component], shard_slots: int, seed: int) -> DataFrame:
    """``shard, slot, sid, block`` of every slot of the mixture."""
    quota = np.array([c.slots for c in mixture], dtype=np.int64)
    shards = -(-int(quota.sum()) // shard_slots)
    tasks = max(1, min(shards // 64, 65_536))
    ids = spark.range(0, shards, 1, tasks)
    draws = stage(ids.mapInPandas(_draws(quota, shard_slots, seed), "shard long, sids array<int>, counts array<long>"), "mix-draws")
    each = draws.select("shard", F.expr(f"shard div {RUN_SHARDS}").alias("run"), F.inline(F.arrays_zip("sids", "counts")).alias("sid", "n"))
    runs = each.groupBy("sid", "run").agg(F.sum("n").alias("in_run"))
    totals = {r["sid"]: r["n"] for r in runs.groupBy("sid").agg(F.sum("in_run").alias("n")).collect()}
    drawn = np.array([totals.get(c.sid, 0) for c in mixture], dtype=np.int64)
    earlier = Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("sid", "run", F.coalesce(F.sum("in_run").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("sid", "run").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    numbered = each.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(runs, ["sid", "run"])
    parts = F.sort_array(F.collect_list(F.struct("sid", "n", (F.col("base") + F.col("within")).alias("before"))))
    # a shard is a small row but makes many slots, so the number of tasks is stated
    dealt = numbered.groupBy("shard").agg(parts.alias("parts")).repartition(tasks, "shard")
    # Staged, so that the join sees the table's size: a plan over the shard numbers alone looks small enough to broadcast.
    return stage(dealt.mapInPandas(_slots(mixture, drawn, seed), "shard long, slot long, sid int, block long"), "mix-slots")


@dataclass(frozen=True)
class Mix:
    """A drawn mixture: placed documents, slots, and the spans that fill the slots.

    ``documents``: ``doc_id, source, size, key_1, key_2, sid, source_size, target,
    start``, one row per input row; ``(sid, start)``, the first word in the
    source's stream, names a row that has words; rows equal in the columns that
    the keys hash are alike.  ``slots``: ``shard, slot, sid, block``.  ``pieces``:
    ``sid, block, start, first_word, n_words``, the words of each document in each
    block.  ``spans``: slots with the pieces that fill them.
    """

    mixture: list[Component]
    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame
    block_words: int

    @property
    def spans(self) -> DataFrame:
        return self.slots.join(self.pieces, ["sid", "block"])

    @property
    def times(self) -> DataFrame:
        """``sid, block, times``: how often each drawn block is taken."""
        return self.slots.groupBy("sid", "block").agg(F.count("*").alias("times"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    key_cols: Sequence[str] | None = None,
) -> Mix:
    """Draw a mixture of ``share`` times all words, sources weighted in code point order (null last).

    Weights repeat along the ordered sources.  No document is taken more than
    ``most`` times (a whole number), because no block is.  Null and wordless
    texts have size 0 and are never taken; a null source is a source; ids may
    repeat or be null; an empty table gives empty tables; columns not named are
    not read.  ``key_cols`` (id, text and source by default) tell rows apart; rows
    equal in all of them are counted first and placed side by side, so the same
    rows give the same draw however they are partitioned.
    """
    spark = docs.sparkSession
    named = [F.col(f"`{c}`") for c in key_cols or (id_col, text_col, source_col)]
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(*named).alias("key_1"),
        F.xxhash64(F.lit(1), *reversed(named)).alias("key_2"),
    )
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    rows = stage(rows, "mix-rows")
    mixture = _mixture(rows, weights, share, most, block_words)
    table = spark.createDataFrame(
        [(c.sid, c.source, c.size, c.target, c.runs) for c in mixture], "sid int, src string, source_size long, target double, runs long"
    )
    rows = rows.join(F.broadcast(table), rows.source.eqNullSafe(table.src)).withColumn("run", F.pmod("key_1", "runs")).drop("src", "runs")

    words = F.col("size") * F.col("copies")
    runs = rows.groupBy("sid", "run").agg(F.sum(words).alias("words"))
    before = Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("sid", "run", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("sid", "run").orderBy("key_1", "key_2", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumn("through", F.sum(words).over(inside))
        .join(runs, ["sid", "run"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("start", F.col("first") + F.col("through") - words + F.col("copy") * F.col("size"))
        .select("doc_id", "source", "size", "key_1", "key_2", "sid", "source_size", "target", "start")
    )
    placed = stage(placed, "mix-placed")
    pieces = (
        placed.where("size > 0")
        .withColumn("block", F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")))
        .withColumn("first_word", F.greatest(F.lit(0), F.col("block") * block_words - F.col("start")))
        .withColumn("n_words", F.least(F.col("size"), (F.col("block") + 1) * block_words - F.col("start")) - F.col("first_word"))
        .select("sid", "block", "start", "first_word", "n_words")
    )
    return Mix(mixture, placed, _dealt_slots(spark, mixture, shard_slots, seed), pieces, block_words)


def taken_words(mix: Mix) -> DataFrame:
    """Per input row: ``doc_id, size, source_size, target, taken, source``."""
    taken = mix.pieces.join(mix.times, ["sid", "block"]).groupBy("sid", F.col("start").alias("key")).agg(F.sum(F.col("n_words") * F.col("times")).alias("taken"))
    rows = mix.documents.withColumn("key", F.when(F.col("size") > 0, F.col("start")))
    return rows.join(taken, ["sid", "key"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "source"
    )


def mixed_documents(docs: DataFrame, block_words: int = 2048, **options) -> DataFrame:
    """The mix as whole documents, with ``docs``' columns: each row as often as the block that it starts in is drawn.

    A pass over a source takes each of its documents once, so targets are met as
    they are by blocks and no text is cut or read twice.  Rows without words are
    in no block and do not appear.  Rows equal in all columns share their takes
    as evenly as they can.
    """
    names = ["key_1", "key_2", "nth", "takes", "copies", "copy"]
    while set(names) & set(docs.columns):
        names = [n + "_" for n in names]
    key_1, key_2, nth, takes, copies, copy = names
    drawn = mix_sources(docs, block_words=block_words, key_cols=docs.columns, **options)
    whole = drawn.documents.where("size > 0").withColumn("block", F.expr(f"start div {block_words}"))
    wanted = (
        whole.join(drawn.times, ["sid", "block"], "left")
        .groupBy(F.col("key_1").alias(key_1), F.col("key_2").alias(key_2))
        .agg(F.coalesce(F.sum("times"), F.lit(0)).alias(takes), F.count("*").alias(copies))
        .where(F.col(takes) > 0)
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(*columns, F.xxhash64(*columns).alias(key_1), F.xxhash64(F.lit(1), *reversed(columns)).alias(key_2))
    keyed = keyed.withColumn(nth, F.row_number().over(Window.partitionBy(key_1, key_2).orderBy(key_1)))
    share = F.expr(f"{takes} div {copies}") + F.when(F.col(nth) <= F.col(takes) % F.col(copies), 1).otherwise(0)
    out = keyed.join(wanted, [key_1, key_2]).withColumn(copy, F.explode(F.array_repeat(F.lit(1), share.cast("int"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
