"""Interaction of document filters, from relations of failing ids.

One scan of the texts measures every document and stores one table of failing
ids per filter.  All orders of the filters have prefixes in common: what an order
has removed before a step depends only on the set of filters before it.  Left-anti
joins of the documents with the id tables give the survivors of every such set;
a left-semi join with a filter's own table, then left-anti joins with the others',
give what the filter removes behind every set, and which labels that costs.

Both chains keep one row per document and set.  A join looks at a row only where
the set holds its filter, so all sets go through one join per filter, and all
joins are on the row's key: documents and id tables are shuffled once.  Rows are
a key, a part and two flags; texts are never shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.llm.staging import stage
from metricspark.llm.textops import slices

FILTERS = ("A", "B", "C", "D", "E")
#: A: words of a document; B: percent of distinct words; C: percent of capitals among code points; D: symbols.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 2, b"#$%&*|"
#: Rows of copies of one text are dealt to this many tasks.
SALTS = 64
_CAPITALS, _SPACES = bytes(range(65, 91)), frozenset(b" \t\n\x0b\x0c\r")
_CONTINUED = bytes(range(0x80, 0xC0))
_PIECE = 1 << 20
_KEY = ("row_1", "row_2")


def _pieces(data: bytes) -> Iterator[bytes]:
    """A text in pieces of about a megabyte, cut at white space."""
    at = 0
    while at < len(data):
        end = min(at + _PIECE, len(data))
        while end < len(data) and data[end] not in _SPACES:
            end += 1
        yield data[at:end]
        at = end


def failures(data: bytes) -> tuple[bool, bool, bool, bool]:
    """Which of the filters A to D a text fails."""
    n_words, distinct = 0, set()
    for piece in _pieces(data):
        words = piece.split()
        n_words += len(words)
        distinct.update(words)
    points = len(data.translate(None, _CONTINUED))
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    return (
        n_words < LEAST_WORDS,
        100 * len(distinct) < LEAST_DISTINCT * n_words,
        100 * capitals > MOST_CAPITALS * points,
        len(data.translate(None, SYMBOLS)) < len(data),
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        failed = [failures(t or b"") for t in batch.column(batch.num_columns - 1).to_pylist()]
        columns = [pa.array([f[k] for f in failed], pa.bool_()) for k in range(4)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], "a", "b", "c", "d"])


def measured(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """Keys, id, part and failures of A to D of every document, staged, with two hashes of its text.

    A row is named by two hashes of its id and text, so null and repeated ids
    are no trouble: rows equal in both fail the same filters.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.xxhash64(id_col, text).alias("row_1"),
        F.xxhash64(text, id_col, F.lit(1)).alias("row_2"),
        F.xxhash64(text).alias("text_1"),
        F.xxhash64(F.lit(1), text, F.length(text)).alias("text_2"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text.cast("binary").alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    keys = f"row_1 long, row_2 long, text_1 long, text_2 long, id {kind}, part string"
    return stage(rows.mapInArrow(_measure, f"{keys}, a boolean, b boolean, c boolean, d boolean"), "measured")


def repeats(rows: DataFrame) -> DataFrame:
    """Keys of the rows whose text stands under a smaller id as well.

    Copies of one text are dealt to ``SALTS`` tasks; each finds its least id, the
    least of these is the text's, and only texts with several ids are joined back.
    """
    copies = rows.filter("id is not null").select(*_KEY, "text_1", "text_2", "id").distinct()
    copies = copies.withColumn("salt", F.pmod(F.xxhash64("row_1"), F.lit(SALTS)))
    dealt = copies.groupBy("text_1", "text_2", "salt").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    several = dealt.groupBy("text_1", "text_2").agg(F.min("least").alias("first"), F.sum("n").alias("n")).filter("n > 1").drop("n")
    places = dealt.drop("least", "n").join(several, ["text_1", "text_2"])
    return copies.join(places, ["text_1", "text_2", "salt"]).filter("id > first").select(*_KEY)


def failing_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> tuple[DataFrame, dict[str, DataFrame]]:
    """The documents' keys, ids and parts, and one stored relation of failing keys per filter.

    Null texts are empty ones.  A row with a null id has no smaller id and is no
    smaller id of another.
    """
    rows = measured(docs, id_col, text_col, part_col)
    relations = {f: stage(rows.filter(F.col(f.lower())).select(*_KEY).distinct(), f"failing-{f}") for f in FILTERS[:4]}
    relations["E"] = stage(repeats(rows), "failing-E")
    return rows.select(*_KEY, "id", "part"), relations


def with_labels(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows with ``good`` and ``toxic``: whether any label row of the id says so; rows equal in all become one with their number ``n``."""
    said = labels.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    alike = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    unnamed = alike.filter("id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    return alike.filter("id is not null").join(said, "id", "left").unionByName(unnamed).na.fill(0, ["good", "toxic"])


def _bit(f: str, filters: Sequence[str]) -> int:
    return 1 << list(filters).index(f)


def survivors(rows: DataFrame, relations: Mapping[str, DataFrame], names: Sequence[str], filters: Sequence[str]) -> DataFrame:
    """One row per row and set of the filters ``names`` that it survives, the set as a bit mask in ``before``."""
    out = rows.withColumn("before", F.lit(0))
    for f in names:
        failing = relations[f].select(*[F.col(k).alias(f"f_{k}") for k in _KEY])
        out = out.withColumn("applied", F.explode(F.array(F.lit(False), F.lit(True))))
        out = out.join(failing, [*[F.col(k) == F.col(f"f_{k}") for k in _KEY], F.col("applied")], "left_anti")
        out = out.withColumn("before", F.col("before") + F.when(F.col("applied"), _bit(f, filters)).otherwise(0)).drop("applied")
    return out


def prefix_counts(rows: DataFrame, relations: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``part, before, kept`` of every set of filters, and ``part, filter, before, removed, good_lost, toxic_lost`` of every filter behind every set."""
    filters = sorted(relations)
    kept = survivors(rows, relations, filters, filters).groupBy("part", "before").agg(F.sum("n").alias("kept"))
    removed = []
    for f in filters:
        failing = rows.join(relations[f], list(_KEY), "left_semi")
        left = survivors(failing, relations, [o for o in filters if o != f], filters)
        lost = [F.sum(F.col("n") * F.col(c)).alias(f"{c}_lost") for c in ("good", "toxic")]
        removed.append(left.groupBy("part", "before").agg(F.sum("n").alias("removed"), *lost).withColumn("filter", F.lit(f)))
    return kept, reduce(DataFrame.unionByName, removed)


def steps_of(filters: Sequence[str]) -> list[tuple[str, int, str, int]]:
    """``filter_order, step, filter, before`` of every step of every order of the filters."""
    out = []
    for order in permutations(filters):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(order), step, f, before))
            before |= _bit(f, filters)
    return out


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Every step of every order of the filters, per part.

    ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley``.  Parts are the values of ``part_col``, null as the empty
    string; each has a row for each step, with zeros where nothing is removed.  No
    documents, no rows.  Labels that say nothing of a document cost nothing; an id
    with several label rows counts as good (toxic) where any of them says so.
    """
    keyed, relations = failing_ids(docs, id_col, text_col, part_col)
    rows = stage(with_labels(keyed, labels, id_col).drop("id"), "labelled")
    kept, removed = (stage(x, name) for x, name in zip(prefix_counts(rows, relations), ("kept", "removed"), strict=True))

    filters = sorted(relations)
    whole = (1 << len(filters)) - 1
    behind = Counter((f, before) for _, _, f, before in steps_of(filters))  # in how many orders a filter stands right behind a set
    cells = F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(b).alias("before"), F.lit(b | _bit(f, filters)).alias("after"), F.lit(n).cast("long").alias("n_orders")) for (f, b), n in behind.items()])
    grid = rows.select("part").distinct().select("part", F.inline(cells))
    after = kept.withColumnRenamed("before", "after")
    grid = grid.join(removed, ["part", "filter", "before"], "left").join(after, ["part", "after"], "left").na.fill(0)
    totals = grid.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("failing"),
        F.sum(F.when(F.col("after") == whole, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * F.col("n_orders")).alias("shapley"),
    )
    steps = docs.sparkSession.createDataFrame(steps_of(filters), "filter_order string, step int, filter string, before int")
    out = grid.join(totals, ["part", "filter"]).join(F.broadcast(steps), ["filter", "before"])  # five filters have 600 steps
    redundant = (F.col("failing") - F.col("removed")).alias("redundant")
    return out.select("part", "filter_order", "step", "kept", "removed", redundant, "unique_fails", "good_lost", "toxic_lost", "shapley")
