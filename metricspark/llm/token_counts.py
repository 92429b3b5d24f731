"""Exact token-length histogram of a corpus and what its suffix sums answer.

Documents are encoded once and aggregated by encoded length.  The histogram has
one row per distinct length, and its suffix sums give totals, quantiles and
truncated totals for every context limit without reading a text again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricspark.llm.textops import to_bytes
from metricspark.llm.tokens import encoder


def _length_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            counts: dict[int, int] = {}
            for at in range(0, batch.num_rows, 256):
                for text in batch.column(0).slice(at, 256).to_pylist():
                    n = len(coder.encode(to_bytes(text))) // coder.dtype.itemsize
                    counts[n] = counts.get(n, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())], ["n_tokens", "n_docs"]
            )

    return run


def length_histogram(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``n_tokens, n_docs`` over all rows; a null or empty text has 0 tokens; an empty table has no row.

    Tasks send counts, not documents, so the shuffle is as large as the number of distinct lengths.
    """
    partial = docs.select(F.col(text_col).alias("text")).mapInArrow(_length_batches(tokenizer), "n_tokens long, n_docs long")
    return partial.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """Add to each length the documents and tokens at or above it, and the corpus size truncated to it.

    ``truncated_total`` is the sum of ``min(length, limit)`` when the limit is
    the row's length.  A suffix sum is the total less the prefix sum, so both
    windows are linear; they run over distinct lengths only, no more rows than
    the longest text has tokens.
    """
    order = Window.orderBy("n_tokens")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    tokens = F.col("n_tokens") * F.col("n_docs")
    out = histogram.select(
        "n_tokens",
        "n_docs",
        F.sum("n_docs").over(whole).alias("all_docs"),
        F.sum(tokens).over(whole).alias("all_tokens"),
        F.coalesce(F.sum("n_docs").over(below), F.lit(0)).alias("docs_below"),
        F.coalesce(F.sum(tokens).over(below), F.lit(0)).alias("tokens_below"),
    )
    out = out.select(
        "n_tokens",
        "n_docs",
        (F.col("all_docs") - F.col("docs_below")).alias("docs_from"),
        (F.col("all_tokens") - F.col("tokens_below")).alias("tokens_from"),
        "docs_below",
        "tokens_below",
    )
    return out.withColumn("truncated_total", F.col("tokens_below") + F.col("n_tokens") * F.col("docs_from"))


def truncated_totals(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``context_limit, total_tokens, kept_tokens, n_cut`` for each wanted limit."""
    limits_column = F.array(*[F.lit(int(x)).cast("long") for x in limits])
    spread = sums.withColumn("context_limit", F.explode(limits_column))
    beyond = F.col("n_tokens") > F.col("context_limit")
    return spread.groupBy("context_limit").agg(
        F.sum(F.col("n_tokens") * F.col("n_docs")).alias("total_tokens"),
        F.sum(F.least("n_tokens", "context_limit") * F.col("n_docs")).alias("kept_tokens"),
        F.sum(F.when(beyond, F.col("n_docs")).otherwise(0)).alias("n_cut"),
    )


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share, n_tokens``: the smallest length that at least that share of the documents does not exceed."""
    spread = sums.withColumn("share", F.explode(F.array(*[F.lit(float(x)) for x in shares])))
    reached = F.col("docs_below") + F.col("n_docs") >= F.col("share") * (F.col("docs_below") + F.col("docs_from"))
    return spread.where(reached).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
