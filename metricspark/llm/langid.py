"""Language identification by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior per document: the text under a
byte-trigram model of each language, the language its markup declares, the
suffix of its address, and a prior of its host.  Declared languages, suffixes
and hosts are reliable only as far as the corpus shows, so their tables are
counted over all documents by grouped aggregation, each document contributing
its text posterior; host priors are smoothed towards the parent domain and that
towards the corpus.

Where declarations are also the labels that the text model is fitted on, the
documents fall into two folds by hash and each is scored by the model of the
other fold, so that text and declaration are independent evidence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricspark.llm.html_text import main_text
from metricspark.llm.staging import stage
from metricspark.llm.textops import PIECE, slices, to_bytes

#: Labelled texts of each language and fold that the trigram model is fitted on, at most; those of smallest hash.
SAMPLE_PER_LANGUAGE = 1000
#: Candidates of the sample are cut by hash to so many times its size before they are ranked.
SPARE = 1.5
#: More labels than this are an error: models and driver hold a table of each.
MOST_LANGUAGES = 1000
BUCKETS = 1 << 16
#: Share of a language's probability that is spread evenly over all trigrams.
UNSEEN = 0.02
#: Trigrams overlap, so a text counts as a third of them, and as no more than this many.
WEIGHT, MOST_TRIGRAMS = 1 / 3, 600
#: Pseudo-counts of the smoothed tables.
HOST_STRENGTH, TABLE_STRENGTH = 10.0, 1.0
#: A document is rejected below this posterior, or with no trigram of letters.
LEAST_CONFIDENCE = 0.5

_CLASS = np.full(256, 32, dtype=np.uint8)
for _c in (*range(97, 123), *range(128, 256)):
    _CLASS[_c] = _c
for _c in range(65, 91):
    _CLASS[_c] = _c + 32


def _trigrams(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams with two letters at least, and where they start."""
    if len(raw) < 3:
        return np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64)
    c = _CLASS[raw].astype(np.uint32)
    letters = (c != 32).astype(np.uint8)
    at = np.flatnonzero(letters[:-2] + letters[1:-1] + letters[2:] >= 2)
    mixed = (c[at] * np.uint32(0x9E3779B1)) ^ (c[at + 1] * np.uint32(0x85EBCA77)) ^ (c[at + 2] * np.uint32(0xC2B2AE3D))
    mixed ^= mixed >> np.uint32(15)
    return mixed * np.uint32(0x27D4EB2F) >> np.uint32(16), at


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for label, fold, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            bucket, n = np.unique(_trigrams(np.frombuffer(b" " + to_bytes(text) + b" ", dtype=np.uint8))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([label] * len(bucket), pa.string()),
                    pa.array([fold] * len(bucket), pa.int32()),
                    pa.array(bucket.astype(np.int32)),
                    pa.array(n.astype(np.int64)),
                ],
                ["label", "fold", "bucket", "n"],
            )


@dataclass(frozen=True)
class TextModel:
    """Log probabilities of the trigram buckets under each language, for documents of each fold."""

    languages: tuple[str, ...]
    tables: np.ndarray  # folds x languages x BUCKETS, float32

    @property
    def folds(self) -> int:
        return len(self.tables)


def _hash(id_col: str, text_col: str) -> Column:
    return F.xxhash64(id_col, text_col)


def _fold(h: Column, folds: int) -> Column:
    return F.pmod(h, F.lit(folds)).cast("int")


def fit_text_model(
    docs: DataFrame, label_col: str, text_col: str, id_col: str, sample: int = SAMPLE_PER_LANGUAGE, folds: int = 1
) -> TextModel:
    """Fit on at most ``sample`` different labelled rows of each language and fold, those of smallest hash of id and text.

    With more than one fold, documents of a fold get the model of the other
    folds.  Rows with a null label or text are not drawn; every label is a
    language; without labels the model has none.
    """
    h = _hash(id_col, text_col)
    keyed = docs.select(F.col(label_col).alias("label"), h.alias("h"), _fold(h, folds).alias("fold"), F.col(text_col).alias("text"))
    keyed = keyed.where("label is not null and text is not null")
    rows = keyed.groupBy("label", "fold").agg(F.approx_count_distinct("h").alias("n"))
    # hashes below a share of their range are about as large a share of the rows; few are left to be ranked
    share = F.least(F.lit(1.0), F.lit(SPARE * sample + 100) / F.col("n"))
    rows = stage(rows.select("label", "fold", (F.lit(-(2.0**63)) + share * 2.0**64).alias("cut")), "language-cuts")
    languages = tuple(r.label for r in rows.select("label").distinct().orderBy("label").limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labels")
    tables = np.full((folds, len(languages), BUCKETS), 0.0)
    if languages:
        near = keyed.join(F.broadcast(rows), ["label", "fold"]).where(F.col("h") <= F.col("cut"))
        ranked = near.groupBy("label", "fold", "h").agg(F.count("*").alias("alike"))
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("label", "fold").orderBy("h"))).where(f"rank <= {sample}")
        picked = stage(ranked.select("label", "fold", "h"), "language-sample")
        chosen = near.select("label", "fold", "h", "text").join(F.broadcast(picked), ["label", "fold", "h"], "left_semi")
        chosen = chosen.dropDuplicates(["label", "fold", "h"]).select("label", "fold", "text")
        counts = chosen.mapInArrow(_count_batches, "label string, fold int, bucket int, n long")
        counts = counts.groupBy("label", "fold", "bucket").agg(F.sum("n").alias("n"))
        place = {label: k for k, label in enumerate(languages)}
        for r in counts.toLocalIterator():  # folds x languages x BUCKETS at most
            tables[r.fold, place[r.label], r.bucket] += r.n
    if folds > 1:
        tables = tables.sum(axis=0, keepdims=True) - tables
    shares = tables / np.maximum(tables.sum(axis=2, keepdims=True), 1)
    known = tables.sum(axis=2, keepdims=True) > 0
    mixed = np.where(known, (1 - UNSEEN) * shares + UNSEEN / BUCKETS, 1 / BUCKETS)
    return TextModel(languages, np.log(mixed).astype(np.float32))


def _score_batches(model):
    """Trigram count and scaled log likelihoods of each text; columns are the carried ones, the fold and the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.value.tables
        kinds = len(model.value.languages)
        for batch in slices(batches):
            texts = [b" " + to_bytes(t) + b" " for t in batch.column(batch.num_columns - 1).to_pylist()]
            fold = batch.column(batch.num_columns - 2).to_numpy(zero_copy_only=False)
            sums, counts = np.zeros((len(texts), kinds)), np.zeros(len(texts), dtype=np.int64)
            begin = 0
            while begin < len(texts):
                end, size = begin + 1, len(texts[begin])
                while end < len(texts) and size + len(texts[end]) < PIECE:
                    size += len(texts[end])
                    end += 1
                data = np.frombuffer(b"".join(texts[begin:end]), dtype=np.uint8)
                edges = np.cumsum([0] + [len(t) for t in texts[begin:end]])
                for low in range(0, len(data), PIECE):  # a long text goes piece by piece
                    bucket, at = _trigrams(data[low : low + PIECE + 2])
                    owner = np.searchsorted(edges, at + low, side="right") - 1
                    counts[begin:end] += np.bincount(owner, minlength=end - begin)
                    group = fold[begin:end][owner]
                    for k in range(kinds):
                        weights = tables[0, k][bucket] if len(tables) == 1 else tables[:, k][group, bucket]
                        sums[begin:end, k] += np.bincount(owner, weights=weights, minlength=end - begin)
                begin = end
            scaled = sums / np.maximum(counts, 1)[:, None] * (np.minimum(counts, MOST_TRIGRAMS) * WEIGHT)[:, None]
            if kinds:
                scaled -= scaled.max(axis=1, keepdims=True)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(counts), *(pa.array(scaled[:, k]) for k in range(kinds))],
                [*batch.schema.names[:-2], "n_trigrams", *(f"l{k}" for k in range(kinds))],
            )

    return run


def _argmax(columns: list[Column], names: tuple[str, ...]) -> Column:
    """Name of the largest column, the first on ties."""
    best = F.greatest(*columns) if len(columns) > 1 else columns[0]
    return F.coalesce(*[F.when(c == best, F.lit(n)) for c, n in zip(columns, names, strict=True)])


def host_of(address: Column) -> Column:
    """Lower-case host of an address, null without one."""
    return F.lower(F.nullif(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit("")))


def address_suffix(address: Column) -> Column:
    """Country or language hint of an address: a two-letter first path part, else the top-level domain."""
    path = F.nullif(F.lower(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([A-Za-z]{2})(?:[/?#._-]|$)", 1)), F.lit(""))
    return F.coalesce(F.concat(F.lit("/"), path), F.nullif(F.regexp_extract(host_of(address), r"(\.[a-z]{2,})$", 1), F.lit("")))


def declared_in_markup(html: Column) -> Column:
    """Primary language subtag of the ``html`` element's ``lang``, null without one."""
    return F.nullif(F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)), F.lit(""))


def _smoothed(sums: DataFrame, key: str, kinds: int, strength: float, towards: list[Column], prefix: str) -> DataFrame:
    """``key`` and its smoothed language shares; ``towards``: prior share of each language among the grouped rows."""
    counts = [F.sum(f"t{k}") for k in range(kinds)]
    total = reduce(lambda a, b: a + b, counts)
    return sums.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[((counts[k] + strength * towards[k]) / (total + strength)).alias(f"{prefix}{k}") for k in range(kinds)]
    )


def identify(
    docs: DataFrame,
    model: TextModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared: Column | None = None,
    suffix: Column | None = None,
    host: Column | None = None,
    fold_id_col: str | None = None,
) -> DataFrame:
    """``doc_id, lang, confidence, text_lang, kept`` of every row.

    Evidence that is null adds nothing.  ``kept`` is false for a text without a
    letter trigram (null and empty ones) and for a posterior below
    ``LEAST_CONFIDENCE``; with no language modelled all rows are kept, with null
    languages.  Ids may repeat or be null; an empty table gives an empty one;
    clashing column names do no harm.  ``fold_id_col`` names the id column that
    the model was fitted with, where it is another one.
    """
    kinds, names = len(model.languages), model.languages
    none = F.lit(None).cast("string")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (none if declared is None else declared).alias("declared"),
        (none if suffix is None else suffix).alias("suffix"),
        (none if host is None else host).alias("host"),
        _fold(_hash(fold_id_col or id_col, text_col), model.folds).alias("fold"),
        F.col(text_col).alias("text"),
    )
    if not kinds:
        return rows.select("doc_id", none.alias("lang"), F.lit(0.0).alias("confidence"), none.alias("text_lang"), F.lit(True).alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # folds x languages x BUCKETS numbers
    head = f"doc_id {docs.schema[id_col].dataType.simpleString()}, declared string, suffix string, host string"
    scored = rows.mapInArrow(_score_batches(shared), f"{head}, n_trigrams long, " + ", ".join(f"l{k} double" for k in range(kinds)))
    norm = reduce(lambda a, b: a + b, [F.exp(f"l{k}") for k in range(kinds)])
    scored = scored.select("*", *[(F.exp(f"l{k}") / norm).alias(f"t{k}") for k in range(kinds)])
    scored = stage(scored, "language-scores")

    # All tables come from the text posteriors summed by what the documents say; their rows are few.
    votes = [F.sum(f"t{k}").alias(f"t{k}") for k in range(kinds)]
    voters = scored.where("n_trigrams > 0").groupBy("declared", "suffix", "host").agg(*votes, F.count("*").alias("n"))
    voters = stage(voters, "language-votes")
    whole = voters.agg(*[(F.sum(f"t{k}") / F.sum("n")).alias(f"g{k}") for k in range(kinds)]).first()
    corpus = [float(x) if x is not None else 1 / kinds for x in whole]
    flat = [F.lit(x) for x in corpus]
    hosts = voters.where("host is not null").groupBy("host").agg(*votes)
    hosts = hosts.withColumn("parent", F.coalesce(F.nullif(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), F.lit("")), F.col("host")))
    parents = _smoothed(hosts, "parent", kinds, HOST_STRENGTH, flat, "q")
    hosts = _smoothed(hosts.join(parents, "parent"), "host", kinds, HOST_STRENGTH, [F.max(f"q{k}") for k in range(kinds)], "h")
    # how often each declared language or suffix goes with each language: share of a language given the value
    said = _smoothed(voters, "declared", kinds, TABLE_STRENGTH, flat, "d")
    ended = _smoothed(voters, "suffix", kinds, TABLE_STRENGTH, flat, "s")
    fused = scored.join(hosts, "host", "left").join(said, "declared", "left").join(ended, "suffix", "left")

    def log_post(k: int) -> Column:
        prior = F.coalesce(f"h{k}", flat[k])
        lift = [F.coalesce(F.log(F.col(f"{p}{k}") / corpus[k]), F.lit(0.0)) for p in ("d", "s")]
        return F.col(f"l{k}") + F.log(prior) + lift[0] + lift[1]

    fused = fused.select("*", *[log_post(k).alias(f"p{k}") for k in range(kinds)])
    posts = [F.col(f"p{k}") for k in range(kinds)]
    best = F.greatest(*posts) if kinds > 1 else posts[0]
    confidence = F.round(1 / reduce(lambda a, b: a + b, [F.exp(p - best) for p in posts]), 6)
    known = F.col("n_trigrams") > 0
    return fused.select(
        "doc_id",
        _argmax(posts, names).alias("lang"),
        confidence.alias("confidence"),
        F.when(known, _argmax([F.col(f"l{k}") for k in range(kinds)], names)).alias("text_lang"),
        (known & (confidence >= LEAST_CONFIDENCE)).alias("kept"),
    )


def _judged(docs: DataFrame, id_col: str) -> DataFrame:
    model = fit_text_model(docs, "lang", "text", "doc_id", folds=2)
    return identify(
        docs, model, id_col, declared=F.col("lang"), suffix=address_suffix(F.col("source")), host=F.coalesce(host_of(F.col("source")), F.col("source")), fold_id_col="doc_id"
    )


def identify_documents(docs: DataFrame) -> DataFrame:
    """Languages of ``documents``: ``lang`` is the declaration, ``source`` the address or else the host."""
    return _judged(docs, "doc_id")


def identify_pages(pages: DataFrame) -> DataFrame:
    """``page_id, lang, confidence, text_lang, kept`` of ``pages`` from their main texts, markup, addresses and hosts."""
    rows = stage(main_text(pages, declared=declared_in_markup(F.col("html"))), "page-texts")
    model = fit_text_model(rows, "declared", "text", "page_id", folds=2)
    return identify(
        rows, model, "page_id", "text", F.col("declared"), address_suffix(F.col("url")), host_of(F.col("url"))
    ).withColumnRenamed("doc_id", "page_id")


def reject_unidentified(docs: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose language is identified, all columns.

    Rows are matched to their verdicts by a hash of id, text, declaration and
    source, so null and repeated ids are judged by their own texts.
    """
    key = "row_key"
    while key in docs.columns:
        key += "_"
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text", "lang", "source"))
    gone = _judged(keyed, key).where("not kept").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(gone, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
