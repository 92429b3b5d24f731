"""Definition analytics: reuse, duplicates, similarity, coverage, readiness and domains.

``defs`` has ``kind, name, tbl, expr, page_name`` and an ``ord`` that orders
rows; ``dashboard_name``, ``widget_name`` and ``source_file`` may be there too.
Pages, dashboards and widgets are comma-separated labels.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricspark.lineage import cut
from metricspark.operators.windows import over


def normalised_expression(expr: Column) -> Column:
    """Lower case, white space collapsed, table prefixes and quotes removed; ``${...}`` references stay."""
    text = F.regexp_replace(F.trim(F.lower(F.coalesce(expr, F.lit("")))), r"\s+", " ")
    text = F.regexp_replace(text, r"(?<![$][{])\b[a-z_]\w*\.(?![^}]*[}])", "")
    return F.regexp_replace(text, "[\"'`]", "")


def reuse_stats(defs: DataFrame) -> DataFrame:
    """One row: definitions, distinct ones, reuse percent, and names with several expressions."""
    keys = ["kind", "name", "tbl", "expr"]
    per = defs.groupBy(*keys).agg(F.count("*").alias("n"))
    totals = per.agg(
        F.sum("n").alias("n_definitions"), F.count("*").alias("n_distinct"), F.sum(F.when(F.col("n") > 1, F.col("n") - 1).otherwise(0)).alias("n_repeats")
    )
    names = per.groupBy("kind", "name").agg(F.count_distinct("expr").alias("n_expr")).agg(F.count(F.when(F.col("n_expr") > 1, 1)).alias("n_inconsistent_names"))
    joined = totals.join(F.broadcast(names), F.lit(True), "left")  # one row each
    return joined.withColumn("reuse_pct", F.round(F.col("n_repeats") * 100.0 / F.col("n_definitions"), 1))


def most_reused(defs: DataFrame, n: int = 20) -> DataFrame:
    """The most repeated definitions."""
    keys = ["kind", "name", "tbl", "expr"]
    return defs.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").orderBy(F.desc("n"), *keys).limit(n)


def expression_groups(defs: DataFrame) -> DataFrame:
    """``norm_expr, n_items, n_kinds, n_names`` of expressions that two or more definitions share."""
    rows = defs.withColumn("norm_expr", normalised_expression(F.col("expr"))).filter("norm_expr <> ''")
    return (
        rows.groupBy("norm_expr")
        .agg(F.count("*").alias("n_items"), F.count_distinct("kind").alias("n_kinds"), F.count_distinct("name").alias("n_names"))
        .filter("n_items >= 2")
    )


def name_tokens(name: Column) -> Column:
    """Distinct lower-case tokens of a name."""
    return F.array_distinct(F.filter(F.split(F.lower(name), r"[^a-z0-9]+"), lambda x: x != ""))


#: Distinct token sets of a group that are compared in one task.
TILE = 512


def _tile_sum(rows: pd.DataFrame) -> pd.DataFrame:
    """Weighted Jaccard sum over the pairs of the two tiles (or of the one) of a task."""
    first = rows.iloc[0]
    tokens = {t: k for k, t in enumerate(sorted({t for ts in rows["tokens"] for t in ts}))}
    held = np.zeros((len(rows), len(tokens)), dtype=np.float32)
    for k, ts in enumerate(rows["tokens"]):
        held[k, [tokens[t] for t in ts]] = 1
    weight, left = rows["w"].to_numpy(dtype=float), rows["tile"].to_numpy() == first["tile_a"]
    right = left if first["tile_a"] == first["tile_b"] else ~left
    both = held[left] @ held[right].T
    size = held.sum(axis=1)
    either = size[left][:, None] + size[right][None, :] - both
    jaccard = np.divide(both, either, out=np.zeros_like(both), where=either > 0).astype(float)
    total = weight[left] @ jaccard @ weight[right]
    if right is left:
        total = (total - (weight[left] ** 2 * np.diag(jaccard)).sum()) / 2
    return pd.DataFrame({"norm_expr": [first["norm_expr"]], "s": [total]})


def pair_sums(sets: DataFrame, tile: int = TILE) -> DataFrame:
    """``norm_expr, s``: the sum over pairs of different token sets of a group of the product of their weights and their Jaccard similarity.

    ``sets`` has ``norm_expr, tokens, w``, each set of a group once.  Groups of at
    most ``tile`` sets are joined with themselves; the sets of larger ones are
    dealt into tiles by hash, and every two tiles are compared in a task of their own.
    """
    sizes = sets.groupBy("norm_expr").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    sized = cut(sets.join(sizes, "norm_expr"))
    small = sized.filter("tiles = 1").withColumn("set", F.array_join(F.array_sort("tokens"), " "))
    a, b = (small.select("norm_expr", *[F.col(c).alias(f"{c}_{side}") for c in ("set", "tokens", "w")]) for side in "ab")
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    jaccard = both / (F.size("tokens_a") + F.size("tokens_b") - both)
    joined = a.join(b, "norm_expr").filter("set_a < set_b").groupBy("norm_expr").agg(F.sum(F.col("w_a") * F.col("w_b") * jaccard).alias("s"))
    large = sized.filter("tiles > 1").withColumn("tile", F.pmod(F.xxhash64("tokens"), F.col("tiles")).cast("int"))
    dealt = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("norm_expr", "tokens", "w", "tile", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"))
    tiled = dealt.groupBy("norm_expr", "tile_a", "tile_b").applyInPandas(_tile_sum, "norm_expr string, s double")
    return joined.unionByName(tiled.groupBy("norm_expr").agg(F.sum("s").alias("s")))


def categorise(defs: DataFrame, duplicate_above: float = 0.85) -> DataFrame:
    """``norm_expr, n_items, name_similarity, category, is_actionable`` of expression groups.

    Similarity is the mean over pairs of items of the Jaccard similarity of their
    names' tokens.  Items with equal tokens are counted, not paired: pairs run
    over distinct token sets, weighted by their counts.
    """
    rows = defs.withColumn("norm_expr", normalised_expression(F.col("expr"))).filter("norm_expr <> ''")
    groups = rows.groupBy("norm_expr").agg(F.count("*").alias("n_items"), F.count_distinct("kind").alias("n_kinds")).filter("n_items >= 2")
    tokens = F.array_sort(name_tokens(F.col("name"))).alias("tokens")
    sets = rows.join(groups.select("norm_expr"), "norm_expr", "left_semi").groupBy("norm_expr", tokens).agg(F.count("*").cast("double").alias("w"))
    same = sets.groupBy("norm_expr").agg(F.sum(F.col("w") * (F.col("w") - 1) / 2).alias("eq"))
    pairs = F.col("n_items") * (F.col("n_items") - 1) / 2.0
    out = groups.join(same, "norm_expr").join(pair_sums(sets), "norm_expr", "left")
    similarity = F.round((F.col("eq") + F.coalesce("s", F.lit(0.0))) / pairs, 4)
    return out.select(
        "norm_expr",
        "n_items",
        similarity.alias("name_similarity"),
        F.when(similarity > duplicate_above, "duplicate").otherwise("semantic_overlap").alias("category"),
        (F.col("n_kinds") == 1).alias("is_actionable"),
    )


def similar_names(defs: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Pairs of names of one table with token Jaccard at the threshold and different expressions.

    A pair can only reach the threshold if a token of the rarer prefix is shared,
    so rows meet on (table, prefix token) and not on the table alone.
    """
    rows = defs.groupBy("tbl", "name").agg(F.array_sort(F.collect_set(normalised_expression(F.col("expr")))).alias("exprs"))
    rows = rows.withColumn("tokens", name_tokens(F.col("name"))).filter(F.size("tokens") > 0)
    spread = rows.select("tbl", "name", F.explode("tokens").alias("token"))
    freq = spread.groupBy("tbl", "token").agg(F.count("*").alias("n"))
    ordered = spread.join(freq, ["tbl", "token"]).groupBy("tbl", "name").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "token"))), lambda x: x.token).alias("ranked"))
    prefix = ordered.select("tbl", "name", F.explode(F.expr(f"slice(ranked, 1, size(ranked) - cast(ceil({threshold} * size(ranked)) as int) + 1)")).alias("token"))
    pairs = (
        prefix.alias("a")
        .join(prefix.alias("b"), (F.col("a.tbl") == F.col("b.tbl")) & (F.col("a.token") == F.col("b.token")) & (F.col("a.name") < F.col("b.name")))
        .select(F.col("a.tbl").alias("tbl"), F.col("a.name").alias("name_a"), F.col("b.name").alias("name_b"))
        .distinct()
    )
    left = rows.select("tbl", F.col("name").alias("name_a"), F.col("tokens").alias("ta"), F.col("exprs").alias("ea"))
    right = rows.select("tbl", F.col("name").alias("name_b"), F.col("tokens").alias("tb"), F.col("exprs").alias("eb"))
    both = F.size(F.array_intersect("ta", "tb"))
    joined = pairs.join(left, ["tbl", "name_a"]).join(right, ["tbl", "name_b"]).withColumn("similarity", both / (F.size("ta") + F.size("tb") - both))
    return joined.filter((F.col("similarity") >= threshold) & (F.col("ea") != F.col("eb"))).select("tbl", "name_a", "name_b", F.round("similarity", 4).alias("similarity"))


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: smallest node reachable over ``edges(src, dst)``, by passing minima on.

    Each round also replaces a label by its label's label, so chains halve; it
    ends when no label moves.  Labels are checkpointed after each round.
    """
    both = cut(edges.select("src", "dst").union(edges.select("dst", "src")).distinct())
    labels = cut(both.groupBy(F.col("src").alias("node")).agg(F.least(F.col("src"), F.min("dst")).alias("component")))
    while True:
        near = both.join(labels, both.dst == labels.node).groupBy("src").agg(F.min("component").alias("low"))
        lower = labels.join(near, labels.node == near.src).select("node", F.least("component", "low").alias("component"), F.col("component").alias("before"))
        up = lower.select(F.col("node").alias("mid"), F.col("component").alias("up"))
        after = cut(lower.join(up, lower.component == up.mid).select("node", F.least("component", "up").alias("component"), "before"))
        settled = after.filter("component <> before").isEmpty()
        labels = after.select("node", "component")
        if settled:
            return labels


def parallel_definitions(defs: DataFrame, threshold: float = 0.85) -> DataFrame:
    """``tbl, group_id, n_names, names``: clusters of similar names of one table (connected components)."""
    pairs = similar_names(defs, threshold)
    key = lambda c: F.concat_ws("\u0001", "tbl", c)
    linked = components(pairs.select(key("name_a").alias("src"), key("name_b").alias("dst")))
    parts = linked.select(F.split("node", "\u0001").alias("p"), "component")
    return parts.groupBy(F.col("p")[0].alias("tbl"), F.split("component", "\u0001")[1].alias("group_id")).agg(
        F.count("*").alias("n_names"), F.array_join(F.array_sort(F.collect_list(F.col("p")[1])), ",").alias("names")
    )


def is_calculated(expr: Column) -> Column:
    """Whether an expression computes something, rather than naming a column."""
    return F.coalesce(expr, F.lit("")).rlike(r"(?i)[-+*/]|\b(sum|avg|count|min|max|case|if|coalesce|nullif)\b\s*\(?")


MODEL_ONLY = "(model-only)"


def _labels(defs: DataFrame, column: str) -> Column:
    """The labels of a comma-separated column, none where the column is missing."""
    if column not in defs.columns:
        return F.array().cast("array<string>")
    return F.filter(F.transform(F.split(F.coalesce(column, F.lit("")), ","), lambda p: F.trim(p)), lambda p: p != "")


def field_pages(defs: DataFrame) -> DataFrame:
    """Distinct ``field, tbl, kind, page`` of definitions that name a page; field is table and name."""
    return defs.select(F.concat_ws(".", "tbl", "name").alias("field"), "tbl", "kind", F.explode(_labels(defs, "page_name")).alias("page")).distinct()


def field_labels(defs: DataFrame) -> DataFrame:
    """Distinct ``field, kind, page`` of all definitions: their pages, else their dashboard, else their file, else ``(model-only)``."""
    named = [F.nullif(F.trim(c), F.lit("")) for c in ("dashboard_name", "source_file") if c in defs.columns]
    other = F.array(F.coalesce(*named, F.lit(MODEL_ONLY)))
    pages = _labels(defs, "page_name")
    return defs.select(F.concat_ws(".", "tbl", "name").alias("field"), "kind", F.explode(F.when(F.size(pages) > 0, pages).otherwise(other)).alias("page")).distinct()


def coverage_by_dashboard(defs: DataFrame) -> DataFrame:
    """``page, n_fields, n_unique, n_shared`` and fields by kind, of every label: unique fields stand under no other label."""
    kinds = field_labels(defs)
    by_kind = kinds.groupBy("page").agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}s") for k in ("dimension", "fact", "metric")])
    use = kinds.select("field", "page").distinct()
    spread = use.groupBy("field").agg(F.count("*").alias("n_pages"))
    fields = use.join(spread, "field").groupBy("page").agg(
        F.count("*").alias("n_fields"), F.count(F.when(F.col("n_pages") == 1, 1)).alias("n_unique"), F.count(F.when(F.col("n_pages") > 1, 1)).alias("n_shared")
    )
    return fields.join(by_kind, "page")


def similarity(defs: DataFrame, zero_pairs: bool = False) -> DataFrame:
    """``page_a, page_b, n_shared, shared_fields, jaccard`` of labels with a common field; all other pairs on request.

    The shared fields are a sorted array (a list for a report).
    """
    use = field_labels(defs).select("field", "page").distinct()
    sizes = use.groupBy("page").agg(F.count("*").alias("n"))
    common = (
        use.alias("a")
        .join(use.alias("b"), (F.col("a.field") == F.col("b.field")) & (F.col("a.page") < F.col("b.page")))
        .groupBy(F.col("a.page").alias("page_a"), F.col("b.page").alias("page_b"))
        .agg(F.count("*").alias("n_shared"), F.array_sort(F.collect_list("a.field")).alias("shared_fields"))
    )
    a = sizes.select(F.col("page").alias("page_a"), F.col("n").alias("size_a"))
    b = sizes.select(F.col("page").alias("page_b"), F.col("n").alias("size_b"))
    if zero_pairs:  # labels only: as many rows as the answer has
        pairs = a.join(b, F.col("page_a") < F.col("page_b")).join(common, ["page_a", "page_b"], "left")
    else:
        pairs = common.join(a, "page_a").join(b, "page_b")
    n = F.coalesce("n_shared", F.lit(0))
    shared = F.coalesce("shared_fields", F.array().cast("array<string>")).alias("shared_fields")
    return pairs.select("page_a", "page_b", n.alias("n_shared"), shared, F.round(n / (F.col("size_a") + F.col("size_b") - n), 4).alias("jaccard"))


def similarity_summary(defs: DataFrame) -> DataFrame:
    """One row: labels, pairs, average similarity over all pairs and the largest; pairs without a common field count as 0 unlisted."""
    pairs = similarity(defs).agg(F.coalesce(F.sum("jaccard"), F.lit(0.0)).alias("total"), F.coalesce(F.max("jaccard"), F.lit(0.0)).alias("largest"))
    labels = field_labels(defs).agg(F.count_distinct("page").alias("n_pages"))
    n = F.col("n_pages")
    joined = labels.join(F.broadcast(pairs), F.lit(True)).withColumn("n_pairs", (n * (n - 1) / 2).cast("long"))  # one row each
    average = F.when(F.col("n_pairs") > 0, F.round(F.col("total") / F.col("n_pairs"), 4)).otherwise(F.lit(0.0))
    return joined.select("n_pages", "n_pairs", average.alias("average"), "largest")


def page_profiles(defs: DataFrame) -> DataFrame:
    """Fields, metrics, other fields (``n_facts``) and tables of each page, with its tables, widgets and dashboards as sorted arrays."""
    use = field_pages(defs)
    n = lambda metric: F.count_distinct(F.when((F.col("kind") == "metric") == metric, F.col("field")))
    counts = use.groupBy("page").agg(
        F.count_distinct("field").alias("n_fields"), n(False).alias("n_facts"), n(True).alias("n_metrics"), F.count_distinct("tbl").alias("n_tables"), F.array_sort(F.collect_set("tbl")).alias("tables")
    )
    listed = defs.select(F.explode(_labels(defs, "page_name")).alias("page"), _labels(defs, "widget_name").alias("w"), _labels(defs, "dashboard_name").alias("d"))
    for name, column in (("widgets", "w"), ("dashboards", "d")):
        one = listed.select("page", F.explode(column).alias("x")).filter(F.col("x") != "unknown" if name == "widgets" else F.lit(True))
        counts = counts.join(one.groupBy("page").agg(F.array_sort(F.collect_set("x")).alias(name)), "page", "left")
    return counts.withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in ("widgets", "dashboards")})


def active_vs_model(defs: DataFrame, top: int = 10) -> DataFrame:
    """``tbl, n_fields, n_active, n_unused`` of the tables with most unused fields."""
    fields = defs.select(F.concat_ws(".", "tbl", "name").alias("field"), "tbl").distinct()
    active = field_pages(defs).select("field", F.lit(1).alias("on_page")).distinct()
    joined = fields.join(active, "field", "left").groupBy("tbl").agg(F.count("*").alias("n_fields"), F.count("on_page").alias("n_active"))
    return joined.withColumn("n_unused", F.col("n_fields") - F.col("n_active")).orderBy(F.desc("n_unused"), "tbl").limit(top)


def reuse_distribution(defs: DataFrame, core_from: int = 5) -> DataFrame:
    """``n_pages, n_fields, is_core``: how many fields are on how many pages."""
    per = field_pages(defs).groupBy("field").agg(F.count_distinct("page").alias("n_pages"))
    return per.groupBy("n_pages").agg(F.count("*").alias("n_fields")).withColumn("is_core", F.col("n_pages") >= core_from)


def consolidation(defs: DataFrame, threshold: float = 0.8, listed: int = 10) -> DataFrame:
    """Labels alike enough to merge, with the number of fields each has alone and the first ``listed`` of their names."""
    sim = similarity(defs).filter((F.col("jaccard") >= threshold) & (F.col("page_a") != MODEL_ONLY) & (F.col("page_b") != MODEL_ONLY))
    use = field_labels(defs).select("field", "page").distinct()
    out = sim.select("page_a", "page_b", "n_shared", "jaccard", F.col("shared_fields").alias("shared_"))
    for side in ("a", "b"):
        fields = use.groupBy(F.col("page").alias(f"page_{side}")).agg(F.collect_set("field").alias("fields"))
        out = out.join(fields, f"page_{side}").withColumn(f"alone_{side}", F.array_except("fields", "shared_")).drop("fields")
    names = lambda c: F.slice(F.array_sort(F.transform(c, lambda f: F.substring_index(f, ".", -1))), 1, listed)
    return out.select(
        "page_a", "page_b", "n_shared", "jaccard", *[F.size(f"alone_{x}").cast("long").alias(f"n_only_{x}") for x in "ab"], *[names(f"alone_{x}").alias(f"only_in_{x}") for x in "ab"]
    )


def conflict_fields(defs: DataFrame) -> DataFrame:
    """Fields with several distinct expressions."""
    keyed = defs.select(F.concat_ws(".", "tbl", "name").alias("field"), normalised_expression(F.col("expr")).alias("e"))
    return keyed.groupBy("field").agg(F.count_distinct("e").alias("n_expr")).filter("n_expr > 1").select("field")


def conflict_coverage(defs: DataFrame, conflicts: DataFrame) -> DataFrame:
    """``page, n_fields, n_conflicts, conflict_ratio``."""
    use = field_pages(defs).select("field", "page").distinct()
    marked = use.join(conflicts.select("field").distinct().withColumn("bad", F.lit(1)), "field", "left")
    out = marked.groupBy("page").agg(F.count("*").alias("n_fields"), F.count("bad").alias("n_conflicts"))
    return out.withColumn("conflict_ratio", F.round(F.col("n_conflicts") / F.col("n_fields"), 4))


def priorities(defs: DataFrame, conflicts: DataFrame, core_from: int = 5) -> DataFrame:
    """``bucket, n_fields``: core without conflict P1, core with conflict blocked, on a page P2, else P3."""
    fields = defs.select(F.concat_ws(".", "tbl", "name").alias("field")).distinct()
    pages = field_pages(defs).groupBy("field").agg(F.count_distinct("page").alias("n_pages"))
    bad = conflicts.select("field").distinct().withColumn("bad", F.lit(1))
    joined = fields.join(pages, "field", "left").join(bad, "field", "left")
    core = F.coalesce("n_pages", F.lit(0)) >= core_from
    bucket = F.when(core & F.col("bad").isNull(), "P1").when(core, "blocked").when(F.col("n_pages") > 0, "P2").otherwise("P3")
    return joined.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n_fields"))


def readiness(defs: DataFrame, conflicts: DataFrame, core_from: int = 5) -> DataFrame:
    """``page, conflict_ratio, n_core, tier``: ready, nearly ready, needs work or blocked."""
    pages = field_pages(defs).select("field", "page").distinct()
    counts = pages.groupBy("field").agg(F.count("*").alias("k"))
    core = pages.join(counts.filter(F.col("k") >= core_from), "field").groupBy("page").agg(F.count("*").alias("n_core"))
    out = conflict_coverage(defs, conflicts).join(core, "page", "left").withColumn("n_core", F.coalesce("n_core", F.lit(0)))
    ratio = F.col("conflict_ratio")
    tier = F.when((ratio == 0) & (F.col("n_core") > 0), "ready").when(ratio <= 0.1, "nearly_ready").when(ratio <= 0.3, "needs_work").otherwise("blocked")
    return out.select("page", "conflict_ratio", "n_core", tier.alias("tier"))


def domains(defs: DataFrame) -> DataFrame:
    """``tbl, domain``: tables whose pages share tables form one domain, named by its smallest page; else Other."""
    use = field_pages(defs).select("page", "tbl").distinct()
    edges = use.select(F.concat(F.lit("p:"), "page").alias("src"), F.concat(F.lit("t:"), "tbl").alias("dst"))
    linked = components(edges).filter("node like 't:%'").select(F.expr("substring(node, 3)").alias("tbl"), F.expr("substring(component, 3)").alias("domain"))
    return defs.select("tbl").distinct().join(linked, "tbl", "left").select("tbl", F.coalesce("domain", F.lit("Other")).alias("domain"))


def prefix_domains(tables: DataFrame, least: int = 2) -> DataFrame:
    """``tbl, domain`` by name prefix; prefixes of fewer tables are General."""
    prefix = F.regexp_extract(F.upper("tbl"), r"^([A-Z0-9]+)_", 1)
    rows = tables.select("tbl", F.nullif(prefix, F.lit("")).alias("prefix"))
    sizes = rows.groupBy("prefix").agg(F.count("*").alias("n"))
    joined = rows.join(sizes, "prefix", "left")
    return joined.select("tbl", F.when(F.col("n") >= least, F.col("prefix")).otherwise("General").alias("domain"))


def bridges(domain: DataFrame, rel: DataFrame) -> DataFrame:
    """``domain_a, domain_b, n_links, shared``: joins that cross domains and the targets both use."""
    left = domain.select(F.col("tbl").alias("from_tbl"), F.col("domain").alias("df"))
    right = domain.select(F.col("tbl").alias("to_tbl"), F.col("domain").alias("dt"))
    crossing = rel.join(left, "from_tbl").join(right, "to_tbl").filter("df <> dt")
    return crossing.groupBy(F.least("df", "dt").alias("domain_a"), F.greatest("df", "dt").alias("domain_b")).agg(
        F.count("*").alias("n_links"), F.array_join(F.array_sort(F.collect_set("to_tbl")), ",").alias("shared")
    )


def within_budget(tables: DataFrame, budget: int = 100) -> DataFrame:
    """Tables a bridge can take: essential ones always, extras smallest first while they fit.

    ``tables``: ``bridge, tbl, n_columns, is_essential``.  Sizes ascend, so
    skipping what does not fit is the same as stopping; repeats count once.
    """
    one = tables.groupBy("bridge", "tbl").agg(F.max("n_columns").alias("n_columns"), F.max("is_essential").alias("is_essential"))
    base = F.sum(F.when(F.col("is_essential"), F.col("n_columns")).otherwise(0)).over(over(["bridge"]))
    extra = F.sum(F.when(~F.col("is_essential"), F.col("n_columns")).otherwise(0)).over(
        over(["bridge"], F.col("is_essential"), F.col("n_columns"), F.col("tbl")).rowsBetween(Window.unboundedPreceding, 0)
    )
    return one.withColumn("used", base + extra).filter(F.col("is_essential") | (F.col("used") <= budget)).select("bridge", "tbl", "n_columns", "is_essential")


def context_split(ctx_tables: DataFrame, review_above: float = 0.8) -> DataFrame:
    """``context, n_tables, overlap, verdict``: share of a context's tables that others have too."""
    one = ctx_tables.select("context", "tbl").distinct()
    spread = one.groupBy("tbl").agg(F.count("*").alias("k"))
    out = one.join(spread, "tbl").groupBy("context").agg(F.count("*").alias("n_tables"), F.count(F.when(F.col("k") > 1, 1)).alias("n_shared"))
    overlap = F.col("n_shared") / F.col("n_tables")
    verdict = F.when(overlap > review_above, "review").when(F.col("n_shared") > 0, "shared_dims").otherwise("one_to_one")
    return out.select("context", "n_tables", F.round(overlap, 4).alias("overlap"), verdict.alias("verdict"))


def valid_contexts(refs: DataFrame, ctx_tables: DataFrame) -> DataFrame:
    """``object, status, contexts``: contexts that hold all tables an object refers to.

    ``refs(object, tbl)``: an object with a null table refers to none and is
    valid in all; one that no context holds is unmapped.
    """
    one = ctx_tables.select("context", "tbl").distinct()
    wanted = refs.filter("tbl is not null").select("object", "tbl").distinct()
    needs = wanted.groupBy("object").agg(F.count("*").alias("need"))
    held = wanted.join(one, "tbl").groupBy("object", "context").agg(F.count("*").alias("have"))
    good = held.join(needs, "object").filter("have = need").groupBy("object").agg(F.array_join(F.array_sort(F.collect_list("context")), ",").alias("contexts"))
    rows = refs.select("object").distinct().join(needs, "object", "left").join(good, "object", "left")
    status = F.when(F.col("need").isNull(), "all").when(F.col("contexts").isNull(), "unmapped").otherwise("mapped")
    return rows.select("object", status.alias("status"), F.coalesce("contexts", F.lit("")).alias("contexts"))


def table_roles(tables: DataFrame, rel: DataFrame, fact_keys: int = 3) -> DataFrame:
    """``tbl, role``: fact by name prefix or by outgoing keys, else dimension."""
    out = rel.groupBy(F.col("from_tbl").alias("tbl")).agg(F.count_distinct("to_tbl").alias("n_keys"))
    joined = tables.select("tbl").distinct().join(out, "tbl", "left")
    fact = F.upper("tbl").rlike("^FACT") | (F.coalesce("n_keys", F.lit(0)) >= fact_keys)
    return joined.select("tbl", F.when(fact, "fact").otherwise("dimension").alias("role"))


def key_candidates(cols: DataFrame) -> DataFrame:
    """Best key column of each table of ``cols(tbl, name, is_key, data_type)``: flag, then name, then type."""
    place = F.when(F.col("is_key"), 0).when(F.upper("name").rlike("(_ID|_KEY|KEY|ID)$"), 1).when(F.lower("data_type").isin("number", "integer", "long"), 2).otherwise(3)
    ranked = cols.withColumn("place", place).withColumn("rn", F.row_number().over(over(["tbl"], F.col("place"), F.col("name"))))
    return ranked.filter("rn = 1 and place < 3").select("tbl", F.col("name").alias("key_column"))


def answer(df: DataFrame, pattern: str, measure: Column, dim: str | None = None, period: str | None = None, n: int = 10) -> DataFrame:
    """Template questions: total by dimension, over time, ranking, overall."""
    value = F.sum(measure).alias("value")
    if pattern == "total_by_dimension":
        return df.groupBy(dim).agg(value)
    if pattern == "over_time":
        return df.groupBy(period).agg(value).orderBy(period)
    if pattern == "ranking":
        return df.groupBy(dim).agg(value).orderBy(F.desc("value"), dim).limit(n)
    if pattern == "overall":
        return df.agg(value)
    raise ValueError(f"no question pattern {pattern!r}")
