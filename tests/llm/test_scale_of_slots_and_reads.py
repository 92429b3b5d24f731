"""Rows of the slot deal follow the slots, not shards times sources; payload reads are bounded and shared by neighbours."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from metricspark.llm import mixing, token_files
from metricspark.llm.tokens import public_tokenizer


def test_many_sources_in_small_shards(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one two three four five").alias("text"), F.concat(F.lit("s"), F.col("id") % 900).alias("source"))
    mix = mixing.mix_sources(rows, block_words=2, shard_slots=64)
    drawn = next(mixing._draws(np.array([c.slots for c in mix.mixture]), 64, 17)(iter([pd.DataFrame({"id": [0, 1]})])))
    assert drawn["sids"].map(len).max() <= 64 and drawn["counts"].map(sum).tolist() == [64, 64]
    slots = mix.slots.groupBy("sid").agg(F.count("*").alias("n")).collect()
    assert {r.sid: r.n for r in slots} == {c.sid: c.slots for c in mix.mixture if c.slots}
    taken = mixing.taken_words(mix).agg(F.sum("taken"), F.max(F.col("taken") - 2 * F.col("size"))).first()
    assert abs(taken[0] - 1.5 * 15_000) <= 2 * 900 and taken[1] <= 0


def test_neighbours_are_read_together(spark, tmp_path):
    texts = ["a b c " * k for k in range(60)] + ["long text " * 20_000, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    written = token_files.write_token_files(docs, public_tokenizer("word_bpe_49k.json"), f"file://{tmp_path}/t", shards=1)
    row = written.manifest.first()
    shard = token_files.ShardReader(written.folder, row["payload"], row["index"])
    first, count = shard.records(np.arange(len(texts)))
    assert (count == 1).all()
    reads = []

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def seek(self, at):
            self.inner.seek(at)

        def read(self, n):
            reads.append(n)
            return self.inner.read(n)

        def close(self):
            self.inner.close()

    shard._payload = Counted(shard._payload)
    want = [shard.ids(int(r)).tolist() for r in first]
    reads.clear()
    assert [x.tolist() for x in shard.each(first)] == want and len(reads) == 1
    for most in (1, 300, 1 << 20):
        reads.clear()
        assert [x.tolist() for x in shard.each(first, most)] == want
        longest = max(len(w) for w in want) * shard.ids_type.itemsize
        assert max(reads) <= max(most, longest)
    assert [x.tolist() for x in shard.each(first[::-2])] == want[::-2]
    assert list(shard.each(first[:0])) == []
    shard.close()
