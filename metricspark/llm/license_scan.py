"""License scan by an exact set-similarity join, in DataFrame and SQL functions only.

A block is a window of words half as long again as the template, a new one every
half template, so a passage as long as the template lies whole inside one.  A
block meets a template when it contains enough of the template's distinct words.
Template words are ordered by the number of texts that hold them, rarest first.
Only blocks around a word of the template's prefix can meet the threshold (prefix
filter); a block must hold words enough (length filter), and enough must be left
from its first template word on (positional filter).  Surviving pairs are
verified by intersection.

The texts are split into words once.  What that pass keeps of a text is the
distinct template and phrase words it holds, and the words in order only where a
template or phrase is possible.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricspark.llm.license_texts import NOTICES
from metricspark.llm.staging import stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PERCENT = 80

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Template:
    """A notice: its distinct words, how many of them a block must hold, and its blocks in words."""

    label: str
    words: tuple[str, ...]
    need: int
    stride: int
    window: int


def templates_of(notices: dict[str, str], percent: int = PERCENT) -> list[Template]:
    """Templates of whole notices; a notice has a word at least."""
    out = []
    for label, text in sorted(notices.items()):
        words = re.findall(WORD, text.translate({c: c + 32 for c in range(65, 91)}))
        distinct, stride = tuple(sorted(set(words))), ceil(len(words) / 2)
        out.append(Template(label, distinct, ceil(percent * len(distinct) / 100), stride, len(words) + stride))
    return out


def parts_of(text: Column) -> Column:
    """Words of a text in order, A-Z folded, with an empty one where a separator opens or closes the text.

    ``lower`` folds other letters too, which makes no difference to words that no
    template or phrase has; the one sign that it turns into a letter of A-Z, the
    Kelvin sign, is replaced first.
    """
    kept = F.when(F.contains(text, F.lit("\u212a")), F.replace(text, F.lit("\u212a"), F.lit("\u00e5"))).otherwise(text)
    return F.split(F.lower(F.coalesce(kept, F.lit(""))), SEPARATOR)


def _trimmed(parts: str) -> Column:
    """The array of parts without empty ends."""
    lead, trail = f"if({parts}[0] = '', 1, 0)", f"if(size({parts}) > 1 and element_at({parts}, -1) = '', 1, 0)"
    return F.expr(f"slice({parts}, 1 + {lead}, size({parts}) - {lead} - {trail})")


def _array(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def ordered_templates(spark: SparkSession, held: DataFrame, templates: list[Template]) -> DataFrame:
    """``label, tokens, prefix, need, stride, window``: each template's words, rarest in ``held(held)`` first, and its prefix."""
    rows = [(t.label, w) for t in templates for w in t.words]
    tokens = spark.createDataFrame(rows, "label string, token string")
    counts = held.select(F.explode("held").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    ranked = tokens.join(counts, "token", "left").select("label", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token").alias("t"))
    shapes = spark.createDataFrame([(t.label, t.need, t.stride, t.window) for t in templates], "label string, need int, stride int, window int")
    ordered = ranked.groupBy("label").agg(F.transform(F.sort_array(F.collect_list("t")), lambda x: x.token).alias("tokens")).join(shapes, "label")
    return ordered.withColumn("prefix", F.expr("slice(tokens, 1, size(tokens) - need + 1)"))


def matching_blocks(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """``key_1, key_2, block, label, containment`` of every block that meets a template.

    ``docs``: ``key_1, key_2, words, may``, the labels of templates a text may
    hold; ``templates`` as :func:`ordered_templates` gives them.
    """
    rows = docs.select("key_1", "key_2", "words", F.explode("may").alias("label")).join(F.broadcast(templates), "label")
    rows = rows.withColumn("hits", F.expr("filter(sequence(0, size(words) - 1), i -> array_contains(prefix, words[i]))"))
    # blocks that reach a hit: those begun at most a window before it
    near = "flatten(transform(hits, i -> array(i div stride - 2, i div stride - 1, i div stride)))"
    rows = rows.withColumn("block", F.explode(F.expr(f"filter(array_distinct({near}), b -> b >= 0)")))
    rows = rows.withColumn("held", F.expr("array_intersect(tokens, slice(words, cast(block * stride as int) + 1, window))"))
    rows = rows.where("size(held) >= need").where("size(tokens) - array_position(tokens, held[0]) + 1 >= need")
    return rows.select("key_1", "key_2", "block", "label", (F.size("held") / F.size("tokens")).alias("containment"))


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """License phrases and notices of every whole text, one row per input row.

    ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score``: the phrase counts are exact places; ``labels`` adds the notices
    met; ``score`` is the best containment, 1 where a phrase stands.  Null and
    empty texts have no words and empty label strings; ids may repeat or be
    null; an empty table gives an empty one; only the id and text columns are
    read.
    """
    spark, templates = docs.sparkSession, templates_of(notices, percent)
    vocabulary = sorted({w for t in templates for w in t.words} | {w for p in phrases for w in p.split()})
    parted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), parts_of(F.col(text_col)).alias("parts"))
    worded = parted.select("doc_id", "text", _trimmed("parts").alias("words"))
    holding = worded.select("*", F.array_intersect(_array(vocabulary), F.col("words")).alias("held"))
    may = F.array_compact(F.array(*[F.when(F.size(F.array_intersect(F.col("held"), _array(t.words))) >= t.need, F.lit(t.label)) for t in templates]))
    phrased = F.lit(False)
    for p in phrases:
        one = F.lit(True)
        for w in p.split():
            one = one & F.array_contains("held", w)
        phrased = phrased | one
    judged = holding.select("*", F.when(F.size("held") > 0, may).otherwise(F.array().cast("array<string>")).alias("may"), phrased.alias("phrased"))
    digest = stage(
        judged.select(
            "doc_id",
            F.xxhash64("doc_id", "text").alias("key_1"),
            F.xxhash64("text", "doc_id", F.lit(1)).alias("key_2"),
            F.size("words").cast("long").alias("n_words"),
            "held",
            "may",
            F.when((F.size("may") > 0) | F.col("phrased"), F.col("words")).alias("words"),
        ),
        "license-digest",
    )
    ordered = stage(ordered_templates(spark, digest, templates), "license-templates")
    found = stage(
        matching_blocks(digest.where("size(may) > 0").select("key_1", "key_2", "words", "may"), ordered)
        .groupBy("key_1", "key_2")
        .agg(F.collect_set("label").alias("met"), F.max("containment").alias("best")),
        "license-blocks",
    )

    def places(phrase: str) -> Column:
        tests = " and ".join(f"get(words, i + {k}) = '{w}'" for k, w in enumerate(phrase.split()))
        return F.expr(f"filter(positions, i -> {tests})")

    positions = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1))
    placed = digest.withColumn("positions", positions).select(
        "doc_id", "key_1", "key_2", "n_words", *[F.coalesce(places(p), F.array().cast("array<int>")).alias(f"p{k}") for k, p in enumerate(phrases)]
    )
    spots = [F.col(f"p{k}") for k in range(len(phrases))]
    base = F.filter(F.array(*[F.when(F.size(s) > 0, F.lit(label)) for s, label in zip(spots, phrases.values(), strict=True)]), lambda x: x.isNotNull())
    n_base = sum((F.size(s).cast("long") for s in spots), F.lit(0).cast("long"))
    joined = placed.join(found, ["key_1", "key_2"], "left")
    return joined.select(
        "doc_id",
        "n_words",
        n_base.alias("n_base"),
        F.least(*[F.array_min(s).cast("long") for s in spots]).alias("first_word"),
        F.greatest(*[F.array_max(s).cast("long") for s in spots]).alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat(base, F.coalesce("met", F.array().cast("array<string>"))))), ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(n_base > 0, 1.0).otherwise(0.0)).alias("score"),
    )
