"""Token-id files with keyed access through a minimal perfect hash.

A shard is a pair of files: the raw ids of its documents end to end, and an
index with the documents' keys and offsets plus a minimal perfect hash from key
to record that stores a fingerprint per slot, so a lookup costs one hash
evaluation and one comparison whatever the shard's size.

The hash is built level by level: at each level a key alone at its position sets
that bit, the others go on to the next, smaller level; the rank of the set bit is
the slot.  Shards are written by the tasks of one Spark job under names of their
own; the manifest table lists the files of the attempts that succeeded, so
retried or lost tasks leave nothing that a reader sees.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricspark.llm.staging import new_folder, stage
from metricspark.llm.textops import mix64, to_bytes
from metricspark.llm.tokens import encoder

END_ID = 2
GAMMA = 2.0
MANIFEST = "shard int, payload string, index string, first_key long, last_key long, n_docs long, n_ids long"


def _level_hash(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((level + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
    return (mix64(keys.view(np.uint64) ^ salt) % np.uint64(size)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    """32 stored bits of each key, independent of the level hashes."""
    return (mix64(keys.view(np.uint64) + np.uint64(0x632BE59BD9B4E019)) >> np.uint64(32)).astype(np.uint32)


@dataclass
class PerfectHash:
    """Levels of bits: ``sizes`` in bits, all ``words`` end to end, set bits before each word in ``ranks``."""

    sizes: list[int]
    words: np.ndarray
    ranks: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct int64 keys."""
        sizes, words, left = [], [], keys
        while len(left):
            size = max(64, -(-int(GAMMA * len(left)) // 64) * 64)
            at = _level_hash(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[at]]
        joined = np.concatenate(words) if words else np.empty(0, dtype="<u8")
        ones = np.bitwise_count(joined).astype(np.int64)
        return cls(sizes, joined, np.cumsum(ones) - ones)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where a key surely is not stored."""
        out = np.full(len(keys), -1, dtype=np.int64)
        todo, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = _level_hash(keys[todo], level, size)
            word, bit = base + (at >> 6), (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[hit]] = (self.ranks[word] + np.bitwise_count(below))[hit]
            todo, base = todo[~hit], base + size // 64
        return out


_PARTS = (("offsets", "<i8"), ("keys", "<i8"), ("words", "<u8"), ("prints", "<u4"), ("first", "<i8"), ("run", "<i8"))


def _write_index(out, ids_type: str, nulls: int, keys: np.ndarray, offsets: np.ndarray) -> None:
    distinct, first, run = np.unique(keys[nulls:], return_index=True, return_counts=True)
    hashed = PerfectHash.build(distinct)
    slot = hashed.slots(distinct)
    by_slot = np.argsort(slot)
    parts = {
        "offsets": offsets,
        "keys": keys,
        "words": hashed.words,
        "prints": fingerprints(distinct[by_slot]),
        "first": first[by_slot] + nulls,
        "run": run[by_slot],
    }
    head = {"ids": ids_type, "nulls": nulls, "levels": hashed.sizes, "lengths": {k: len(v) for k, v in parts.items()}}
    line = json.dumps(head).encode()
    out.write(len(line).to_bytes(8, "little") + line)
    for name, kind in _PARTS:
        out.write(parts[name].astype(kind).tobytes())


#: Bytes of neighbouring records that are read together.
READ_BYTES = 4 << 20


class ShardReader:
    """One shard's index in memory; payload ranges are read on demand."""

    def __init__(self, folder: str, payload: str, index: str):
        self._files, root = fs.FileSystem.from_uri(folder)
        self._payload = self._files.open_input_file(f"{root}/{payload}")
        with self._files.open_input_stream(f"{root}/{index}") as f:
            data = f.read()
        size = int.from_bytes(data[:8], "little")
        head = json.loads(data[8 : 8 + size])
        at, parts = 8 + size, {}
        for name, kind in _PARTS:
            parts[name] = np.frombuffer(data, dtype=kind, count=head["lengths"][name], offset=at)
            at += parts[name].nbytes
        ones = np.bitwise_count(parts["words"]).astype(np.int64)
        self._hash = PerfectHash(head["levels"], parts["words"], np.cumsum(ones) - ones)
        self.ids_type, self.nulls = np.dtype(head["ids"]), head["nulls"]
        self.keys, self.offsets = parts["keys"], parts["offsets"]
        self._prints, self._first, self._run = parts["prints"], parts["first"], parts["run"]

    def records(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key; (-1, 0) for keys not stored."""
        keys = np.ascontiguousarray(keys, dtype=np.int64)
        slot = self._hash.slots(keys)
        known = slot >= 0
        known[known] = self._prints[slot[known]] == fingerprints(keys[known])
        first, run = np.full(len(keys), -1, dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        first[known], run[known] = self._first[slot[known]], self._run[slot[known]]
        return first, run

    def ids(self, record: int) -> np.ndarray:
        """The ids of one record."""
        begin, end = int(self.offsets[record]), int(self.offsets[record + 1])
        width = self.ids_type.itemsize
        self._payload.seek(begin * width)
        return np.frombuffer(self._payload.read((end - begin) * width), dtype=self.ids_type)

    def each(self, records: np.ndarray, most: int = READ_BYTES) -> Iterator[np.ndarray]:
        """The ids of each record; records that follow each other are read together, up to ``most`` bytes at a time."""
        width, at = self.ids_type.itemsize, 0
        while at < len(records):
            begin, end = int(self.offsets[records[at]]), at + 1
            while end < len(records) and records[end] == records[end - 1] + 1 and (int(self.offsets[records[end] + 1]) - begin) * width <= most:
                end += 1
            stop = int(self.offsets[records[end - 1] + 1])
            self._payload.seek(begin * width)
            data = np.frombuffer(self._payload.read((stop - begin) * width), dtype=self.ids_type)
            for r in records[at:end]:
                yield data[self.offsets[r] - begin : self.offsets[r + 1] - begin]
            at = end

    def close(self) -> None:
        self._payload.close()


def _writer(folder: str, tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        files, root = fs.FileSystem.from_uri(folder)
        name = f"shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        end, keys, nulls, lengths, out = np.array([END_ID], dtype=coder.dtype).tobytes(), [], 0, [0], None
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or files.open_output_stream(f"{root}/{name}.ids")
            ids = batch.column(0)
            nulls += ids.null_count
            keys.append(ids.fill_null(0).to_numpy(zero_copy_only=False))
            for at in range(0, batch.num_rows, 256):
                for text in batch.column(1).slice(at, 256).to_pylist():
                    packed = coder.encode(to_bytes(text))
                    out.write(packed + end)
                    lengths.append(len(packed) // coder.dtype.itemsize + 1)
        if out is None:
            return
        out.close()
        keys, offsets = np.concatenate(keys), np.cumsum(np.array(lengths, dtype=np.int64))
        with files.open_output_stream(f"{root}/{name}.index") as f:
            _write_index(f, coder.dtype.str, nulls, keys, offsets)
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "shard": TaskContext.get().partitionId(),
                    "payload": f"{name}.ids",
                    "index": f"{name}.index",
                    "first_key": int(keys[nulls]) if nulls < len(keys) else None,
                    "last_key": int(keys[-1]) if nulls < len(keys) else None,
                    "n_docs": len(keys),
                    "n_ids": int(offsets[-1]),
                }
            ],
            pa.schema([("shard", pa.int32()), ("payload", pa.string()), ("index", pa.string())] + [(c, pa.int64()) for c in ("first_key", "last_key", "n_docs", "n_ids")]),
        )

    return run


@dataclass(frozen=True)
class TokenFiles:
    """A written corpus: its folder and its manifest table, one row per shard."""

    folder: str
    manifest: DataFrame


def write_token_files(
    docs: DataFrame, tokenizer: str, folder: str | None = None, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> TokenFiles:
    """Encode every text and write the shards in ascending id order.

    Null ids come first and have no key; a repeated id is one key whose records
    follow each other in the order of their texts' hashes; a null or empty text
    is the end id alone; an empty table has no shard.  ``folder`` is one that
    all executors share, by default a new one in the checkpoint folder; there are
    as many shards as the input has partitions, at least the session's shuffle
    partitions.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    count = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    ordered = rows.repartitionByRange(count, "key", "tie").sortWithinPartitions("key", "tie", "text")
    manifest = ordered.select("key", "text").mapInArrow(_writer(folder, tokenizer), MANIFEST)
    return TokenFiles(folder, stage(manifest, "token-manifest"))


def _digester(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                shard = ShardReader(folder, row.payload, row.index_file)
                keys = np.unique(shard.keys[shard.nulls :])
                first, count = shard.records(keys)
                nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                records = np.concatenate([np.arange(shard.nulls), np.repeat(first, count) + nth])
                named = pd.concat([pd.Series([None] * shard.nulls, dtype="Int64"), pd.Series(np.repeat(keys, count), dtype="Int64")])
                for at in range(0, len(records), 10_000):
                    part = records[at : at + 10_000]
                    digests = [(len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for ids in shard.each(part)]
                    yield pd.DataFrame(
                        {
                            "shard": row.shard,
                            "doc_id": named.iloc[at : at + 10_000].array,
                            "local": shard.offsets[part],
                            "n_tokens": [n for n, _ in digests],
                            "ids_crc32": [crc for _, crc in digests],
                        }
                    )
                shard.close()

    return run


def read_digests(written: TokenFiles) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, by keyed reads of the files.

    ``start`` counts the ids of all documents before it in file order.
    """
    manifest = written.manifest
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    bases = manifest.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    files = manifest.select("shard", "payload", F.col("index").alias("index_file"))
    count = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = files.repartition(count, "shard").mapInPandas(
        _digester(written.folder), "shard int, doc_id long, local long, n_tokens long, ids_crc32 long"
    )
    return read.join(F.broadcast(bases), "shard").select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def _shard_range(first: np.ndarray, last: np.ndarray):
    """Column function: positions of the first and the last shard whose key range holds a key."""

    @F.pandas_udf("lo int, hi int")
    def run(keys: pd.Series) -> pd.DataFrame:
        found = keys.to_numpy(dtype=np.int64)
        return pd.DataFrame({"lo": np.searchsorted(last, found, "left"), "hi": np.searchsorted(first, found, "right") - 1}, dtype="int32")

    return run


def _fetcher(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, reading = None, None
        for batch in batches:
            for (payload, index), part in batch.groupby(["payload", "index_file"], sort=False):
                if reading != index:
                    if shard is not None:
                        shard.close()
                    shard, reading = ShardReader(folder, payload, index), index
                keys = part.key.to_numpy(dtype=np.int64)
                first, count = shard.records(keys)
                rows: list[tuple] = []
                for k, f, n in zip(keys, first, count, strict=True):
                    for i in range(n):
                        rows.append((int(k), shard.ids(int(f) + i).tolist()))
                        if len(rows) == 256:
                            yield pd.DataFrame(rows, columns=["key", "ids"])
                            rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=["key", "ids"])
        if shard is not None:
            shard.close()

    return run


def lookup(written: TokenFiles, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """``(key, ids)`` for each stored record of the wanted keys, read through the hash index.

    Null keys and keys not stored give no row; a key wanted twice is answered
    once; a repeated stored key gives all its records, also from several shards.
    The driver holds two numbers per shard.
    """
    manifest = written.manifest.where("first_key is not null")
    wanted = keys.select(F.col(key_col).cast("long").alias("key")).where("key is not null").distinct()
    edges = manifest.select("shard", "first_key", "last_key").orderBy("shard").toPandas()
    first, last = (edges[c].to_numpy(dtype=np.int64) for c in ("first_key", "last_key"))
    places = manifest.sparkSession.createDataFrame(
        [(i, int(s)) for i, s in enumerate(edges["shard"])], "place int, shard int"
    ).join(manifest.select("shard", "payload", F.col("index").alias("index_file")), "shard")
    ranged = wanted.withColumn("r", _shard_range(first, last)("key")).where("r.lo <= r.hi")
    placed = ranged.select("key", F.explode(F.sequence("r.lo", "r.hi")).alias("place")).join(F.broadcast(places), "place")
    # a shard's keys go to a few tasks, each of which opens its index once
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(8))).repartition("shard", "part").sortWithinPartitions("shard", "key")
    return dealt.select("key", "payload", "index_file").mapInPandas(_fetcher(written.folder), "key long, ids array<long>")
