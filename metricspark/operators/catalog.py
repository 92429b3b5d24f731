"""Catalog views over metric estates: glossary, lineage, security, risk, coverage and quality.

Inputs are DataFrames keyed by ``source_system, source_model``.  Sides are
aggregated before they are joined, so nothing fans out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricspark.lineage import cut
from metricspark.sources.inventory import stable_id

MODEL = ("source_system", "source_model")
ENTITY = (*MODEL, "entity_name")
CLONE = r"_FY\d{2}$"


def canonical_name(name: Column) -> Column:
    """A name without its fiscal-year suffix."""
    return F.regexp_replace(F.upper(name), CLONE, "")


def clone_variant(name: Column) -> Column:
    """The fiscal-year suffix of a name, null without one."""
    return F.nullif(F.regexp_extract(F.upper(name), r"_(FY\d{2})$", 1), F.lit(""))


def glossary(term: DataFrame, entity: DataFrame, metric: DataFrame) -> DataFrame:
    """Terms with their entity's object, and metrics, as one list; model-only without a column."""
    bound = entity.select(*ENTITY, "physical_object")
    terms = term.join(bound, list(ENTITY), "left").select(
        *MODEL,
        F.lit("TERM").alias("term_kind"),
        F.col("term_name").alias("business_term"),
        F.col("entity_name").alias("subject_area"),
        F.col("term_role").alias("classification"),
        "physical_object",
        "physical_column",
        F.col("physical_column").isNull().alias("is_model_only"),
        "expression",
    )
    metrics = metric.select(
        *MODEL,
        F.lit("METRIC").alias("term_kind"),
        F.col("metric_canonical").alias("business_term"),
        F.lit("Metrics").alias("subject_area"),
        F.col("metric_kind").alias("classification"),
        F.lit(True).alias("is_model_only"),
        "expression",
    )
    return terms.unionByName(metrics, allowMissingColumns=True)


def readiness() -> Column:
    """Deploy readiness of a metric row."""
    return (
        F.when(F.coalesce("translated_expr", F.lit("")) == "", "not_convertible")
        .when(F.col("requires_fiscal_calendar"), "needs_fiscal_binding")
        .when(F.col("metric_kind") == "unsupported", "not_convertible")
        .otherwise("ready")
    )


def metric_library(metric: DataFrame) -> DataFrame:
    """Metrics with their deploy readiness."""
    return metric.withColumn("deploy_readiness", readiness())


def hierarchy_tree_view(hierarchy: DataFrame, level: DataFrame) -> DataFrame:
    """Levels with their hierarchy and a display path."""
    keys = [*MODEL, "dimension_name", "hierarchy_name"]
    joined = level.join(hierarchy, keys)
    return joined.withColumn("display_path", F.concat_ws(" > ", "dimension_name", "hierarchy_name", "level_name"))


def impact(edges: DataFrame, start: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``node, depth``: everything reached from ``start(node)`` along ``edges(src, dst)``, at its least depth.

    One join per level until a level reaches nothing new; levels are
    checkpointed, so lineage stays short.  Going deeper than ``max_depth``, where
    given, is an error.
    """
    seen = start.select("node", F.lit(0).alias("depth")).distinct()
    frontier, depth = seen, 0
    while True:
        depth += 1
        reached = edges.join(frontier, edges.src == frontier.node).select(F.col("dst").alias("node")).distinct()
        frontier = cut(reached.join(seen, "node", "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            return seen
        if max_depth is not None and depth > max_depth:
            raise RuntimeError(f"nodes are deeper than {max_depth}")
        seen = seen.union(frontier)
        if depth % 8 == 0:  # keeps the plan of a long walk short
            seen = cut(seen)


AGGREGATE_CALL = r"(?i)\b(SUM|AVG|COUNT|MIN|MAX|MEDIAN|STDDEV|VARIANCE)\s*\("


def expression_refs(df: DataFrame, expr: str = "expr") -> DataFrame:
    """Aggregates used, ``table.column`` references and whether a filter occurs."""
    text = F.coalesce(F.col(expr), F.lit(""))
    return (
        df.withColumn("aggregates", F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(AGGREGATE_CALL), F.lit(1)), lambda x: F.upper(x)))))
        .withColumn("refs", F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b([A-Za-z_]\w*\.[A-Za-z_]\w*)\b"), F.lit(1)))))
        .withColumn("has_filter", text.rlike(r"(?i)\b(WHERE|FILTER|CASE\s+WHEN)\b"))
    )


def security_patterns(mapping: DataFrame) -> DataFrame:
    """Column-name patterns (trailing digits as ``#``) with distinct principals, values and grants."""
    pattern = F.regexp_replace("column_name", r"\d+$", "#")
    return mapping.groupBy(pattern.alias("pattern")).agg(
        F.count_distinct("principal").alias("n_principals"), F.count_distinct("column_value").alias("n_values"), F.count("*").alias("n_grants")
    )


def security_counts(rule: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rules, principals and mapping rows per model; the policy count is not known here."""
    rules = rule.groupBy(*MODEL).agg(F.count("*").alias("n_rules"), F.count_distinct("principal").alias("n_principals"))
    rows = mapping.groupBy(*MODEL).agg(F.count("*").alias("n_mapping_rows"))
    return rules.join(rows, list(MODEL), "left").select(
        *MODEL, "n_rules", "n_principals", F.coalesce("n_mapping_rows", F.lit(0)).alias("n_mapping_rows"), F.lit(None).cast("long").alias("n_policies")
    )


def normal_column(name: Column) -> Column:
    """Upper-case name of a security column, other characters as one underscore, a trailing number without its separator."""
    canonical = F.trim(F.regexp_replace(F.upper(F.coalesce(name, F.lit(""))), "[^A-Z0-9]+", "_"), F.lit("_"))
    return F.regexp_replace(canonical, r"_(\d+)$", "$1")


def general_column(name: Column) -> Column:
    """A normal name with the number of a level as ``#``."""
    return F.regexp_replace(normal_column(name), r"^(.+_LEVEL)\d+$", "$1#")


def _role(role: str) -> Column:
    return F.coalesce(F.nullif(role, F.lit("")), F.lit("(none)"))


def security_shapes(rules: DataFrame, general: bool = False) -> DataFrame:
    """``shape, n_rules, n_principals``: column sets of ``rules(principal, columns)``, or patterns of them with level numbers as ``#``."""
    name = general_column if general else normal_column
    shape = F.array_join(F.array_sort(F.array_distinct(F.transform("columns", name))), ",")
    return rules.groupBy(shape.alias("shape")).agg(F.count("*").alias("n_rules"), F.count_distinct("principal").alias("n_principals"))


def security_by_role(rules: DataFrame) -> DataFrame:
    """``role_group, n_rules, n_principals, levels``: rules of each role and the numbered levels they use."""
    used = rules.select(_role("role_group").alias("role_group"), F.explode(F.transform("columns", normal_column)).alias("c")).filter(F.col("c").rlike(r"^.+_LEVEL\d+$"))
    levels = used.groupBy("role_group").agg(F.array_sort(F.collect_set("c")).alias("levels"))
    counts = rules.groupBy(_role("role_group").alias("role_group")).agg(F.count("*").alias("n_rules"), F.count_distinct("principal").alias("n_principals"))
    return counts.join(levels, "role_group", "left").withColumn("levels", F.coalesce("levels", F.array().cast("array<string>")))


def security_values(predicates: DataFrame) -> DataFrame:
    """``column, n_values, is_hierarchical`` of ``predicates(column_name, column_value)``: more than 80 % of a column's distinct values are dotted paths."""
    named = predicates.filter("coalesce(column_name, '') <> '' and coalesce(column_value, '') <> ''")
    values = named.select(normal_column(F.col("column_name")).alias("column"), "column_value").distinct()
    dotted = F.avg(F.col("column_value").rlike(r"(?i)^[A-Z0-9_]+(\.[A-Z0-9_]+)+$").cast("int"))
    return values.groupBy("column").agg(F.count("*").alias("n_values"), (dotted > 0.8).alias("is_hierarchical"))


def clone_families(objects: DataFrame) -> DataFrame:
    """Families of ``objects(kind, name)`` with more than one variant: canonical name, members, sorted variants."""
    keyed = objects.select(*MODEL, "kind", canonical_name(F.col("name")).alias("canonical"), clone_variant(F.col("name")).alias("variant"), "name").distinct()
    return (
        keyed.groupBy(*MODEL, "kind", "canonical")
        .agg(F.count("*").alias("n_members"), F.array_join(F.array_sort(F.collect_list(F.coalesce("variant", F.lit("(base)")))), ",").alias("variants"))
        .filter("n_members > 1")
    )


def clone_stats(objects: DataFrame) -> DataFrame:
    """Definitions per canonical pattern and cloned objects, in one row per model and kind."""
    return objects.groupBy(*MODEL, "kind").agg(
        F.count("*").alias("n_definitions"),
        F.count_distinct(canonical_name(F.col("name"))).alias("n_patterns"),
        F.round(F.count("*") / F.count_distinct(canonical_name(F.col("name"))), 2).alias("clone_ratio"),
        F.count(clone_variant(F.col("name"))).alias("n_cloned"),
    )


def aggregation_risk(entity: DataFrame, grain: DataFrame, rule: DataFrame) -> DataFrame:
    """Grains, risky grains and semi-additive measures of each entity, and whether it needs review."""
    grains = grain.groupBy(*ENTITY).agg(
        F.count_distinct("grain_name").alias("n_grains"),
        F.count_distinct(F.when(F.col("double_count_risk"), F.col("grain_name"))).alias("n_risky"),
    )
    rules = rule.groupBy(*ENTITY).agg(F.count_distinct(F.when(F.col("is_semi_additive"), F.col("term_name"))).alias("n_semi_additive"))
    joined = entity.select(*ENTITY).join(grains, list(ENTITY), "left").join(rules, list(ENTITY), "left").na.fill(0, ["n_grains", "n_risky", "n_semi_additive"])
    return joined.withColumn("needs_review", (F.col("n_risky") > 0) | (F.col("n_semi_additive") > 0))


def grain_risk(grain: DataFrame) -> DataFrame:
    """Risk reasons of grains: groupable though not the row grain, or a row grain of several columns."""
    reasons = F.filter(
        F.array(
            F.when(F.col("is_groupable") & ~F.col("is_row_grain"), F.lit("groupable grain above the row grain")),
            F.when(F.col("is_row_grain") & (F.size("key_columns") > 1), F.lit("composite row grain")),
        ),
        lambda x: x.isNotNull(),
    )
    return grain.withColumn("risk_reason", F.nullif(F.concat_ws("; ", reasons), F.lit(""))).withColumn("double_count_risk", F.size(reasons) > 0)


def grain_coverage(grain: DataFrame, scope: DataFrame) -> DataFrame:
    """``entity, has_grain, n_grains, n_risky`` of the scope, matched on canonical names."""
    wanted = scope.select(canonical_name(F.col("entity_name")).alias("entity")).distinct()
    have = grain.groupBy(canonical_name(F.col("entity_name")).alias("entity")).agg(
        F.count("*").alias("n_grains"), F.count(F.when(F.col("double_count_risk"), 1)).alias("n_risky")
    )
    joined = wanted.join(have, "entity", "left")
    return joined.select("entity", F.col("n_grains").isNotNull().alias("has_grain"), F.coalesce("n_grains", F.lit(0)).alias("n_grains"), F.coalesce("n_risky", F.lit(0)).alias("n_risky"))


def grain_scope(grain: DataFrame, scope: DataFrame) -> DataFrame:
    """One row: grains in and outside the scope, entities of the scope with and without a grain, and risky grains in it."""
    wanted = scope.select(canonical_name(F.col("entity_name")).alias("entity")).distinct()
    rows = grain.select(canonical_name(F.col("entity_name")).alias("entity"), "double_count_risk").join(wanted.withColumn("inside", F.lit(True)), "entity", "left")
    counts = rows.agg(
        F.count("inside").alias("n_in_scope"), F.count(F.when(F.col("inside").isNull(), 1)).alias("n_out_of_scope"),
        F.count(F.when(F.col("inside") & F.col("double_count_risk"), 1)).alias("n_risky"), F.count_distinct(F.when(F.col("inside"), F.col("entity"))).alias("n_with_grain"),
    )
    size = wanted.agg(F.count("*").alias("n_entities"))
    return counts.join(size).withColumn("n_without_grain", F.col("n_entities") - F.col("n_with_grain"))  # one row each


def coverage(models: DataFrame, parts: Mapping[str, tuple[DataFrame, Column | None]]) -> DataFrame:
    """Counts per model, one per part: all rows of a table, or those that meet a condition."""
    out = models.select(*MODEL)
    for name, (df, condition) in parts.items():
        counted = F.count("*") if condition is None else F.count(F.when(condition, 1))
        out = out.join(df.groupBy(*MODEL).agg(counted.alias(name)), list(MODEL), "left")
    return out.na.fill(0, list(parts))


def physical_binding(entity: DataFrame, term: DataFrame) -> DataFrame:
    """Bound entities with term, measure, key and attribute counts."""
    role = lambda r, n: F.count(F.when(F.col("term_role") == r, 1)).alias(n)
    counts = term.groupBy(*ENTITY).agg(
        F.count("term_name").alias("term_count"), role("measure", "measure_count"), role("identifier", "key_count"), role("attribute", "attribute_count")
    )
    bound = entity.filter("physical_object is not null").select(*ENTITY, "physical_object")
    return bound.join(counts, list(ENTITY), "left").na.fill(0, ["term_count", "measure_count", "key_count", "attribute_count"])


def measure_quality(term: DataFrame, rule: DataFrame) -> DataFrame:
    """Declared measures whose name or aggregate says identifier: four verdicts and a safe flag."""
    keys = [*ENTITY, "term_name"]
    joined = term.filter("term_role = 'measure'").join(rule.select(*keys, "regular_aggregate"), keys, "left")
    by_name = F.upper("term_name").rlike(r"_(ID|NUMBER|CODE|KEY)$")
    by_agg = F.coalesce(F.col("regular_aggregate").isin("count", "countdistinct", "min", "max"), F.lit(False))
    verdict = (
        F.when(by_name & by_agg, "almost_certainly_identifier").when(by_name, "probably_identifier").when(by_agg, "possibly_identifier").otherwise("genuine_measure")
    )
    return joined.select(*keys, "regular_aggregate", verdict.alias("verdict"), (~(by_name | by_agg)).alias("is_safe"))


def safe_measures(term: DataFrame, rule: DataFrame, entity: DataFrame) -> DataFrame:
    """Safe measures of bound entities."""
    bound = physical_binding(entity, term).select(*ENTITY, "physical_object")
    return measure_quality(term, rule).filter("is_safe").join(bound, list(ENTITY)).select(*ENTITY, "term_name", "regular_aggregate", "physical_object")


def issues(flagged: DataFrame, rel: DataFrame, metric: DataFrame, packages: DataFrame | None = None, listed: int = 40) -> DataFrame:
    """Issue ledger with stable ids.

    ``flagged(model columns, name, reason, expression)``: a metric without an
    expression is a defect of the source and a risk, one on the fiscal calendar
    blocks until it is decided, the rest are risks.  Relationships that the source
    does not call valid are one risk per model, with how many of them are simple
    equality joins and the first ``listed`` by name; models whose metrics
    (``metric_name``) repeat a pattern get a note.
    """

    def rows(df: DataFrame, severity: Column | str, category: Column | str, kind: Column | str, name: Column, issue: Column, detail: Column) -> DataFrame:
        text = lambda c: F.lit(c) if isinstance(c, str) else c
        return df.select(
            *MODEL, text(severity).alias("severity"), text(category).alias("category"), text(kind).alias("object_kind"), name.alias("object_name"), issue.alias("issue"), F.coalesce(detail, F.lit("")).alias("detail")
        )

    reason = F.coalesce("reason", F.lit(""))
    empty, fiscal = reason.contains("empty expression"), reason.contains("fiscal calendar")
    of = lambda a, b, c: F.when(empty, a).when(fiscal, b).otherwise(c)
    found = rows(
        flagged, of("risk", "blocker", "risk"), of("source_model_defect", "needs_decision", "unconvertible"), of("metric", "metric", "term"), F.col("name"),
        of(F.lit("Metric has no expression in the source model"), F.lit("Metric depends on the fiscal calendar"), reason), F.when(empty, reason).otherwise(F.col("expression")),
    )
    stale = F.coalesce(F.col("source_status"), F.lit("")).isin("", "valid")
    joins = rel.groupBy(*MODEL).agg(
        F.count("*").alias("n_all"), F.count(F.when(~stale, 1)).alias("n_stale"), F.count(F.when(~stale & F.col("is_simple_equality"), 1)).alias("n_sound")
    )
    text = F.concat("left_entity", F.lit("->"), "right_entity", F.lit(" ["), "source_status", F.lit("]"))
    numbered = rel.filter(~stale).withColumn("rn", F.row_number().over(Window.partitionBy(*MODEL).orderBy("relationship_name"))).filter(F.col("rn") <= listed)
    first = numbered.groupBy(*MODEL).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", text.alias("t")))), lambda x: x.t), "; ").alias("first"))
    joins = joins.filter("n_stale > 0").join(first, list(MODEL))
    stale_rows = rows(
        joins, "risk", "stale_metadata", "relationship", F.format_string("%d relationships", "n_stale"), F.format_string("%d of %d relationships are not flagged valid by the source tool", "n_stale", "n_all"),
        F.concat(F.format_string("%d simple equality joins; ", "n_sound"), "first"),
    )
    clones = clone_stats(metric.select(*MODEL, F.lit("metric").alias("kind"), F.col("metric_name").alias("name"))).filter("n_definitions > n_patterns")
    shared = role_packages(packages) if packages is not None else None
    counts = clones.join(shared.groupBy(*MODEL).agg(F.sum("n_packages").alias("n_packages")), list(MODEL), "left") if shared is not None else clones.withColumn("n_packages", F.lit(0).cast("long"))
    notes = rows(
        counts, "note", "source_model_defect", "model", F.col("source_model"),
        F.concat(F.format_string("%d metrics collapse to %d distinct patterns (", "n_definitions", "n_patterns"), F.col("clone_ratio").cast("string"), F.lit("x duplication)")),
        F.format_string("%d cloned objects; %d role-based package exports", "n_cloned", F.coalesce("n_packages", F.lit(0))),
    )
    out = found.unionByName(stale_rows).unionByName(notes)
    return out.withColumn("issue_id", stable_id(*[F.col(c) for c in out.columns]))


def role_packages(packages: DataFrame) -> DataFrame:
    """Packages that were exported for a role, by folder: ``packages(model columns, package_name, folder_path, is_role_based)``."""
    return packages.filter("is_role_based").groupBy(*MODEL, F.coalesce("folder_path", F.lit("")).alias("folder_path")).agg(F.count("*").alias("n_packages"))


def issue_order() -> Column:
    """Blockers first, then risks, then the rest."""
    return F.when(F.col("severity") == "blocker", 0).when(F.col("severity") == "risk", 1).otherwise(2)


def issues_ordered(issue: DataFrame) -> DataFrame:
    """Issues by severity, category and object."""
    return issue.orderBy(issue_order(), "category", "object_name")


def business_glossary(term: DataFrame, entity: DataFrame, metric: DataFrame, rule: DataFrame) -> DataFrame:
    """Glossary with calculation logic, semantic risk, definition source and draft status.

    Metrics are deduplicated by canonical name before they join.
    """
    logic = (
        metric.withColumn("rn", F.row_number().over(Window.partitionBy(*MODEL, "metric_canonical").orderBy("metric_name")))
        .filter("rn = 1")
        .select(*MODEL, F.col("metric_canonical").alias("business_term"), F.col("translated_expr").alias("calculation_logic"))
    )
    risk = rule.groupBy(*ENTITY).agg(F.max(F.col("is_semi_additive").cast("int")).alias("semi"))
    risk = risk.withColumnRenamed("entity_name", "subject_area")
    rows = glossary(term, entity, metric).join(logic, [*MODEL, "business_term"], "left").join(risk, [*MODEL, "subject_area"], "left")
    return rows.select(
        *MODEL,
        "term_kind",
        "business_term",
        "subject_area",
        F.when(F.col("term_kind") == "METRIC", F.col("calculation_logic")).otherwise(F.col("expression")).alias("calculation_logic"),
        F.when(F.col("semi") == 1, "semi_additive").otherwise("none").alias("semantic_risk"),
        F.when(F.col("is_model_only"), "bi_model").otherwise("warehouse").alias("definition_source"),
        F.lit("DRAFT").alias("status"),
    )


def risk_tags(term: DataFrame, rule: DataFrame, existing: DataFrame) -> DataFrame:
    """One risk tag per existing column: misdeclared measure first, then semi-additive, else none."""
    keys = [*ENTITY, "term_name"]
    wrong = measure_quality(term, rule).filter("not is_safe").select(*keys, F.lit(0).alias("p"))
    semi = rule.filter("is_semi_additive").select(*keys, F.lit(1).alias("p"))
    tags = wrong.union(semi).groupBy(*keys).agg(F.min("p").alias("p"))
    rows = term.filter("physical_column is not null").select(*keys, "physical_column").join(tags, keys, "left")
    rows = rows.join(existing.select("physical_column").distinct(), "physical_column", "left_semi")
    return rows.select(*keys, "physical_column", F.when(F.col("p") == 0, "misdeclared_measure").when(F.col("p") == 1, "semi_additive").otherwise("none").alias("risk"))


def ontology_classes(entity: DataFrame, term: DataFrame) -> DataFrame:
    """Bound entities as fact (measures and keys) or dimension."""
    b = physical_binding(entity, term)
    return b.select(*ENTITY, F.when((F.col("measure_count") > 0) & (F.col("key_count") > 0), "fact").otherwise("dimension").alias("entity_class"))


def ontology_joins(rel: DataFrame) -> DataFrame:
    """Simple equality joins between entities that are no clones."""
    clone = F.col("left_entity").rlike(CLONE) | F.col("right_entity").rlike(CLONE)
    return rel.filter(F.col("is_simple_equality") & ~clone)


def ontology_drills(level: DataFrame) -> DataFrame:
    """Hierarchies with at least two levels below the root: ordered level names."""
    keys = [*MODEL, "dimension_name", "hierarchy_name"]
    kept = level.filter("not is_all_level")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("level_ordinal", "level_name"))), lambda x: x.level_name)
    return kept.groupBy(*keys).agg(F.count("*").alias("depth"), F.array_join(ordered, " > ").alias("drill_path")).filter("depth >= 2")


def classify_columns(df: DataFrame, overrides: DataFrame, key_patterns: str = r"(?i)(_id|_key|_code|id|key)$", time_patterns: str = r"(?i)(date|time|_ts|_at)$") -> DataFrame:
    """Role of each of ``df(name, tag, expr, data_type)``: override, catalog tag, aggregate output, name, type."""
    from_expr = F.when(F.coalesce("expr", F.lit("")).rlike(AGGREGATE_CALL), "measure")
    from_name = F.when(F.col("name").rlike(time_patterns), "time").when(F.col("name").rlike(key_patterns), "identifier")
    from_type = F.when(F.lower("data_type").isin("number", "double", "decimal", "float"), "measure").otherwise("dimension")
    joined = df.join(overrides.select("name", F.col("role").alias("override")), "name", "left")
    tag = F.when(F.lower("tag").isin("measure", "dimension", "identifier", "time"), F.lower("tag"))
    return joined.withColumn("role", F.coalesce("override", tag, from_expr, from_name, from_type)).drop("override")


def complexity(df: DataFrame, manual: str, translate: str, expr: str = "expr") -> DataFrame:
    """Tier of each definition: first of manual, needs_translation, simple that matches."""
    text = F.coalesce(F.col(expr), F.lit(""))
    return df.withColumn("tier", F.when(text.rlike(manual), "manual").when(text.rlike(translate), "needs_translation").otherwise("simple"))


def complexity_tally(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Definitions per tier."""
    tiers = ("simple", "needs_translation", "manual")
    return df.groupBy(*by).agg(*[F.count(F.when(F.col("tier") == t, 1)).alias(f"n_{t}") for t in tiers])


def default_include(df: DataFrame) -> DataFrame:
    """Whether a definition is taken over: conflict is Review, simple and active Yes, translatable Review, else No."""
    out = (
        F.when(F.col("has_conflict"), "Review")
        .when((F.col("tier") == "simple") & F.col("is_active"), "Yes")
        .when(F.col("tier").isin("simple", "needs_translation"), "Review")
        .otherwise("No")
    )
    return df.withColumn("include", out)


def source_audit(entity: DataFrame, sources: DataFrame, platforms: Mapping[str, str]) -> DataFrame:
    """Objects per connection, platform by name pattern, and names that mention another platform."""
    counts = entity.groupBy("connection").agg(F.count("*").alias("n_objects"))
    joined = sources.select("connection", "declared_platform").join(counts, "connection", "full_outer")
    named = F.lit(None).cast("string")
    for platform, pattern in reversed(list(platforms.items())):
        named = F.when(F.lower("connection").rlike(pattern), platform).otherwise(named)
    return joined.select(
        "connection",
        "declared_platform",
        F.coalesce("n_objects", F.lit(0)).alias("n_objects"),
        named.alias("named_platform"),
        F.coalesce(named != F.col("declared_platform"), F.lit(False)).alias("is_misleading"),
    )
