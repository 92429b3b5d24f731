"""Byte-balanced shards by minimax contiguous partition, in DataFrame and SQL functions only.

Documents with equal texts form an atomic group.  Groups are ordered by a text
hash and laid into ``2**CELL_BITS`` hash cells, so that a cell is an atomic
group of bounded number whatever the input; its size is a plain aggregate.  The
smallest capacity for which greedy filling needs no more than the wanted shards
is found by binary search over that ordered list (one row of at most 65,536
numbers).  The cells are cut at that capacity, each part ending at its even
share of the rest where the parts after it still fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricspark.llm.staging import stage

CELL_BITS = 16
#: Slot numbers are dealt in runs of about this many rows, so no task numbers a whole shard.
RUN_ROWS = 2048


def _capacity(sizes: str, shards: int) -> Column:
    """Smallest capacity at which greedy filling of the ordered ``sizes`` needs at most ``shards`` parts."""
    parts = (
        f"aggregate({sizes}, named_struct('parts', 1, 'load', 0L), (a, x) -> "
        "if(a.load + x <= {c}, named_struct('parts', a.parts, 'load', a.load + x), "
        "named_struct('parts', a.parts + 1, 'load', x)), a -> a.parts)"
    )
    middle = "((b.lo + b.hi) div 2)"
    search = (
        "aggregate(sequence(1, 62), named_struct('lo', lo, 'hi', hi), (b, i) -> "
        "case when b.lo >= b.hi then b "
        f"when {parts.format(c=middle)} <= {shards} then named_struct('lo', b.lo, 'hi', {middle}) "
        f"else named_struct('lo', {middle} + 1L, 'hi', b.hi) end, b -> b.lo)"
    )
    return F.expr(search)


def partition_cells(cells: DataFrame, shards: int) -> DataFrame:
    """``(cell, shard)`` for a table ``(cell, bytes)`` of at most ``2**CELL_BITS`` ordered cells."""
    one = cells.agg(
        F.sort_array(F.collect_list(F.struct("cell", "bytes"))).alias("cells"),
        F.max("bytes").alias("largest"),
        F.sum("bytes").alias("total"),
    ).where("largest is not null")
    mean = f"((total + {shards - 1}L) div {shards}L)"
    one = one.select(
        "cells",
        "total",
        F.expr("transform(cells, c -> c.bytes)").alias("sizes"),
        F.expr(f"greatest(largest, {mean})").alias("lo"),
        F.expr(f"{mean} + largest").alias("hi"),
    )
    # Each step is staged (one row): inlined into the next one's lambda it would run again for every cell.
    one = stage(one, "cell-sizes")
    one = stage(one.withColumn("capacity", _capacity("sizes", shards)), "cell-capacity")
    # starts[m - 1]: first cell of the last m parts when they are filled from the end
    starts = (
        "aggregate(reverse(sizes), named_struct('load', 0L, 'at', size(sizes), 'starts', cast(array() as array<int>)), (a, x) -> "
        "if(a.load + x <= capacity, named_struct('load', a.load + x, 'at', a.at - 1, 'starts', a.starts), "
        "named_struct('load', x, 'at', a.at - 1, 'starts', array_append(a.starts, a.at))), a -> a.starts)"
    )
    # A part ends where it must, or where it has its even share of the rest and what follows still fits.
    share = f"(a.rest div ({shards} - size(a.cuts)))"
    fits = f"a.at >= coalesce(get(starts, {shards} - 2 - size(a.cuts)), 0)"
    ends = (
        f"size(a.cuts) < {shards} - 1 and a.load > 0 and "
        f"(a.load + c.bytes > capacity or (a.load + c.bytes div 2 >= {share} and {fits}))"
    )
    cuts = (
        "aggregate(cells, named_struct('at', 0, 'load', 0L, 'rest', total, 'cuts', cast(array() as array<bigint>)), (a, c) -> "
        f"if({ends}, named_struct('at', a.at + 1, 'load', c.bytes, 'rest', a.rest - a.load, 'cuts', array_append(a.cuts, c.cell)), "
        "named_struct('at', a.at + 1, 'load', a.load + c.bytes, 'rest', a.rest, 'cuts', a.cuts)), a -> a.cuts)"
    )
    one = stage(one.withColumn("starts", F.expr(starts)), "cell-starts")
    return (
        one.withColumn("cuts", F.expr(cuts))
        .select(F.explode("cells").alias("c"), "cuts")
        .select("c.cell", F.expr("cast(size(filter(cuts, x -> x <= c.cell)) as int)").alias("shard"))
    )


def shard_by_bytes(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", carry: bool = False
) -> DataFrame:
    """Put every row into a shard ``0 .. shards - 1`` so that shard bytes are near equal.

    A row weighs its text's UTF-8 bytes plus 8.  Rows with equal texts share a
    shard (a null text counts as an empty one, with checksum 0).  ``slot``
    numbers the rows of a shard from 0 without gaps; rows that are equal in id
    and text may take each other's slot.  Ids may repeat or be null.  An empty table
    gives an empty result.  With ``carry`` the row itself follows as the struct
    ``document``, so clashing column names do no harm.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard[, document]``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    runs_per_shard = max(1, docs.count() // (shards * RUN_ROWS))
    digest = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - CELL_BITS).alias("cell"),
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(7)), F.lit(runs_per_shard)).cast("int").alias("run"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")] if carry else []),
    )
    if not carry:
        digest = stage(digest, "shard-digest")
    cells = digest.groupBy("cell").agg(F.sum("size").alias("bytes"))
    placed = stage(partition_cells(cells, shards), "shard-cells")  # at most 2**CELL_BITS rows
    rows = digest.join(F.broadcast(placed), "cell")
    runs = rows.groupBy("shard", "run").agg(F.count("*").alias("n"))  # a row for some 2,048
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("shard", "run").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("at", F.row_number().over(order))
        .join(runs, ["shard", "run"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("at") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            *(["document"] if carry else []),
        )
    )
