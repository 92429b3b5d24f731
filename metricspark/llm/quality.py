"""Rule bitmask ledger: every quality rule evaluated once, policies applied to the bits.

One pass over the texts stores each document's measurements and one failure bit
per rule.  A policy is a versioned mask of enforced rules, so changing a policy
or asking what a rule costs never reads a text again: ablations are bitwise
tests over the grouped bit patterns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.llm.textops import slices, to_bytes, window_hashes, words_by_text

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    """A named failure condition over the measurements, with its place in the mask."""

    bit: int
    name: str
    fails: str


#: Failure conditions in SQL over the measurements.  Bits are never reused.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 3 * n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 25 * n_words"),
)
BASE = 0b11
#: Enforced rules of each policy version.
POLICIES = {1: BASE, 2: 0b111111}


_SPACES, _SYMBOLS = b" \t\n\r\x0b\x0c", b"#*$%&|<>"


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [to_bytes(t) for t in batch.column(1).to_pylist()]
        rows = []
        for data, words in zip(texts, words_by_text(texts), strict=True):
            symbols = sum(data.count(bytes([c])) for c in _SYMBOLS)
            spaces = sum(data.count(bytes([c])) for c in _SPACES)
            points = len(data.decode("utf-8", "surrogatepass")) if not data.isascii() else len(data)
            lines = [x for x in data.split(b"\n") if x.strip(_SPACES)]
            windows = window_hashes(words, 3)
            repeated = 0
            if len(windows):
                order = np.argsort(windows)
                same = windows[order[1:]] == windows[order[:-1]]
                found = np.zeros(len(words), dtype=bool)
                for side in (order[1:][same], order[:-1][same]):
                    for k in range(3):
                        found[side + k] = True
                repeated = int(found.sum())
            rows.append((len(words), points - spaces, symbols, len(lines) - len(set(lines)), repeated, len(lines)))
        columns = zip(*rows, strict=True) if rows else [()] * len(MEASURES)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *MEASURES]
        )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the measurements and ``fail_bits``, one row per input row.

    Null and empty texts measure zero everywhere; ids may repeat or be null;
    only the id and text columns are read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    measured = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _measure_batches, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES)
    )
    bits = " | ".join(f"if({r.fails}, {1 << r.bit}L, 0L)" for r in RULES)
    return measured.withColumn("fail_bits", F.expr(bits))


def apply_policy(rows: DataFrame, version: int) -> DataFrame:
    """Add ``kept``: no rule that the policy enforces failed."""
    return rows.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(POLICIES[version])) == 0)


def ablations(rows: DataFrame, version: int) -> DataFrame:
    """What each enforced rule costs: ``rule, n_failed, n_only, n_kept_without``.

    Works on the counts of the distinct bit patterns, at most ``2 ** len(RULES)``.
    """
    mask = POLICIES[version]
    patterns = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    enforced = [r for r in RULES if mask >> r.bit & 1]
    per_rule = F.array(
        *(
            F.struct(
                F.lit(r.name).alias("rule"),
                F.expr(f"if(fail_bits & {1 << r.bit}L <> 0, n, 0L)").alias("failed"),
                F.expr(f"if(fail_bits & {mask}L = {1 << r.bit}L, n, 0L)").alias("only"),
                F.expr(f"if(fail_bits & {mask & ~(1 << r.bit)}L = 0, n, 0L)").alias("kept"),
            )
            for r in enforced
        )
    )
    return (
        patterns.select(F.explode(per_rule).alias("r"))
        .groupBy("r.rule")
        .agg(F.sum("r.failed").alias("n_failed"), F.sum("r.only").alias("n_only"), F.sum("r.kept").alias("n_kept_without"))
    )
