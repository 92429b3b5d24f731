"""Lineage of metric estates: resolved references, traces in both directions, cycles and reach.

Edges point at what something is made from: entities bind to objects, terms bind
to columns and derive from terms, metrics aggregate terms.  References are
resolved to one term before they become edges, so a chain through calculated
terms ends at its columns.  ``from_id`` and ``to_id`` name the nodes of an edge.

The loops below join once per round until a round finds nothing new, checkpoint
every round and count on the driver only.  Cycles are no trouble: a pair of nodes
is met once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.lineage import cut
from metricspark.operators.catalog import MODEL, canonical_name
from metricspark.sources.inventory import stable_id

_EDGE = ("from_kind", "from_name", "from_entity", "to_kind", "to_name", "to_entity", "edge_type")


def _exists(c: str) -> Column:
    return F.col(c).isNotNull()


def resolve(refs: DataFrame, term: DataFrame) -> DataFrame:
    """``refs(from_kind, from_name, from_entity, ref_object, ref_item)`` with the term each one means.

    Scopes from the nearest: the named entity, else the reference's own, by exact
    name; the whole model by exact name; the model by name without a fiscal-year
    suffix.  The nearest scope with a match decides: ``resolution`` is ``entity``,
    ``model`` or ``canonical`` with one match, ``ambiguous`` with several (their
    number in ``n_matches``, no entity) and ``missing`` without any.  Terms are
    counted by name before they are joined, so a reference stays one row however
    many entities share the name.
    """
    scope = F.coalesce(F.nullif("ref_object", F.lit("")), F.nullif("from_entity", F.lit("")))
    named = term.select(*MODEL, "entity_name", "term_name").distinct()
    own = named.select(*MODEL, F.col("entity_name").alias("scope"), F.col("term_name").alias("ref_item"), F.col("entity_name").alias("own_entity"))

    def by_name(key: Column, key_name: str, prefix: str) -> DataFrame:
        """Matches of a name in a model; entity and name of the match where it is the only one."""
        one = lambda c: F.when(F.count("*") == 1, F.min(c))
        return named.groupBy(*MODEL, key.alias(key_name)).agg(F.count("*").alias(f"{prefix}_n"), one("entity_name").alias(f"{prefix}_entity"), one("term_name").alias(f"{prefix}_term"))

    rows = refs.withColumns({"scope": scope, "canonical": canonical_name(F.col("ref_item"))})
    rows = rows.join(own, [*MODEL, "scope", "ref_item"], "left")
    rows = rows.join(by_name(F.col("term_name"), "ref_item", "model"), [*MODEL, "ref_item"], "left")
    rows = rows.join(by_name(canonical_name(F.col("term_name")), "canonical", "canonical"), [*MODEL, "canonical"], "left")
    n = F.when(_exists("own_entity"), 1).otherwise(F.coalesce("model_n", "canonical_n", F.lit(0)))
    scopes = F.when(_exists("own_entity"), "entity").when(_exists("model_n"), "model").otherwise("canonical")
    entity = F.when(_exists("own_entity"), F.col("own_entity")).when(_exists("model_n"), F.col("model_entity")).otherwise(F.col("canonical_entity"))
    name = F.when(_exists("own_entity") | _exists("model_n"), F.col("ref_item")).otherwise(F.coalesce("canonical_term", "ref_item"))
    return rows.select(
        *refs.columns,
        entity.alias("to_entity"),
        name.alias("to_name"),
        n.cast("long").alias("n_matches"),
        F.when(n == 0, "missing").when(n > 1, "ambiguous").otherwise(scopes).alias("resolution"),
    )


def node_id(kind: Column, name: Column, entity: Column) -> Column:
    """Name of a node within all models."""
    return stable_id(*[F.col(c) for c in MODEL], kind, entity, name)


def lineage_edges(entity: DataFrame, term: DataFrame, term_refs: DataFrame, metric_refs: DataFrame) -> DataFrame:
    """All edges of a catalog, each once, with hashed ids and how their reference was resolved.

    ``term_refs(model columns, term_name, entity_name, ref_object, ref_item)`` and
    ``metric_refs(model columns, metric_name, ref_object, ref_item)`` hold what
    expressions refer to.  A reference that is ambiguous or missing keeps the
    object it names, and points at a term that nothing else leads on from.
    """
    none = F.lit("")
    objects = entity.filter("coalesce(physical_object, '') <> ''").select(
        *MODEL, F.lit("entity").alias("from_kind"), F.col("entity_name").alias("from_name"), F.col("entity_name").alias("from_entity"),
        F.lit("physical_object").alias("to_kind"), F.col("physical_object").alias("to_name"), none.alias("to_entity"), F.lit("binds_to").alias("edge_type"),
    )
    columns = term.filter("coalesce(physical_column, '') <> ''").select(
        *MODEL, F.lit("term").alias("from_kind"), F.col("term_name").alias("from_name"), F.col("entity_name").alias("from_entity"),
        F.lit("physical_column").alias("to_kind"), F.col("physical_column").alias("to_name"), F.col("entity_name").alias("to_entity"), F.lit("binds_to").alias("edge_type"),
    )
    of_terms = term_refs.select(*MODEL, F.lit("term").alias("from_kind"), F.col("term_name").alias("from_name"), F.col("entity_name").alias("from_entity"), "ref_object", "ref_item")
    of_metrics = metric_refs.select(*MODEL, F.lit("metric").alias("from_kind"), F.col("metric_name").alias("from_name"), none.alias("from_entity"), "ref_object", "ref_item")
    refs = of_terms.unionByName(of_metrics).filter("coalesce(ref_item, '') <> ''").distinct()
    uses = resolve(refs, term).select(
        *MODEL, "from_kind", "from_name", "from_entity", F.lit("term").alias("to_kind"), "to_name", F.coalesce("to_entity", "ref_object", none).alias("to_entity"),
        F.when(F.col("from_kind") == "term", "derives_from").otherwise("aggregates").alias("edge_type"), "resolution", "n_matches",
    )
    bound = objects.unionByName(columns).withColumns({"resolution": F.lit("bound"), "n_matches": F.lit(1).cast("long")})
    # two references may mean one term
    edges = bound.unionByName(uses).groupBy(*MODEL, *_EDGE).agg(F.min("resolution").alias("resolution"), F.max("n_matches").alias("n_matches"))
    return edges.withColumns(
        {
            "edge_id": stable_id(*[F.col(c) for c in _EDGE]),
            "from_id": node_id(F.col("from_kind"), F.col("from_name"), F.col("from_entity")),
            "to_id": node_id(F.col("to_kind"), F.col("to_name"), F.col("to_entity")),
        }
    )


def lineage_view(edges: DataFrame, entity: DataFrame) -> DataFrame:
    """Edges with the object of the target entity, else of the source entity."""
    bound = entity.select(*MODEL, F.col("entity_name").alias("target_entity"), "physical_object")
    keyed = edges.withColumn("target_entity", F.coalesce(F.nullif("to_entity", F.lit("")), "from_entity"))
    joined = keyed.join(bound, [*MODEL, "target_entity"], "left")
    full = F.when((F.col("to_kind") == "physical_column") & F.col("physical_object").isNotNull(), F.concat_ws(".", "physical_object", "to_name"))
    return joined.withColumn("fully_qualified_target", full)


def graph(edges: DataFrame, backward: bool = False) -> DataFrame:
    """``src, dst`` of the edges, turned around where the question is what depends on something."""
    ends = ("to_id", "from_id") if backward else ("from_id", "to_id")
    return edges.select(F.col(ends[0]).alias("src"), F.col(ends[1]).alias("dst")).distinct()


def trace(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """``start, node, depth``: what each of ``starts(node)`` reaches over ``edges(src, dst)``, at its least depth, itself at 0."""
    edges = cut(edges.select("src", "dst").distinct())
    seen = frontier = cut(starts.select(F.col("node").alias("start"), "node", F.lit(0).alias("depth")).distinct())
    depth = 0
    while True:
        depth += 1
        step = frontier.select("start", F.col("node").alias("src")).join(edges, "src").select("start", F.col("dst").alias("node")).distinct()
        frontier = cut(step.join(seen, ["start", "node"], "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            return seen
        seen = cut(seen.union(frontier)) if depth % 8 == 0 else seen.union(frontier)


def nodes(edges: DataFrame) -> DataFrame:
    """Every edge's names of its two nodes, one row per node."""
    ends = [edges.select(*MODEL, F.col(f"{e}_id").alias("node"), *[F.col(f"{e}_{c}").alias(c) for c in ("kind", "name", "entity")]) for e in ("from", "to")]
    return ends[0].unionByName(ends[1]).distinct()


def origins(edges: DataFrame) -> DataFrame:
    """Where metrics and terms come from: ``from_kind, from_name, from_entity, column_entity, column_name, depth``, one row per column reached."""
    named = cut(nodes(edges))
    columns = named.filter("kind = 'physical_column'")
    reached = trace(graph(edges, backward=True), columns.select("node"))
    source = columns.select(F.col("node").alias("start"), F.col("entity").alias("column_entity"), F.col("name").alias("column_name"))
    users = named.filter("kind in ('metric', 'term')").select(*MODEL, "node", F.col("kind").alias("from_kind"), F.col("name").alias("from_name"), F.col("entity").alias("from_entity"))
    return users.join(reached, "node").join(source, "start").drop("start", "node")


def breaks(edges: DataFrame, changed: DataFrame) -> DataFrame:
    """What breaks when columns change: metrics and terms that depend on ``changed(model columns, entity, name)``, with their least depth."""
    named = cut(nodes(edges))
    starts = named.filter("kind = 'physical_column'").join(changed.select(*MODEL, "entity", "name").distinct(), [*MODEL, "entity", "name"], "left_semi")
    reached = trace(graph(edges, backward=True), starts.select("node")).groupBy("node").agg(F.min("depth").alias("depth"))
    return named.filter("kind in ('metric', 'term')").join(reached, "node").drop("node")


def _trimmed(edges: DataFrame) -> DataFrame:
    """Edges between nodes that have edges in and out: what is on no cycle nor between two falls away round by round."""
    n = edges.count()
    while n:
        inner = edges.select(F.col("src").alias("node")).intersect(edges.select(F.col("dst").alias("node")))
        kept = edges.join(inner.withColumnRenamed("node", "src"), "src", "left_semi").join(inner.withColumnRenamed("node", "dst"), "dst", "left_semi")
        edges = cut(kept.select("src", "dst"))
        before, n = n, edges.count()
        if n == before:
            break
    return edges


def strong_components(edges: DataFrame) -> DataFrame:
    """``node, component``: nodes that reach each other over ``edges(src, dst)`` share the smallest of them.

    Edges on no cycle are trimmed.  Of the rest every node takes the greatest node
    that reaches it as its colour; what reaches a colour's own node without leaving
    the colour is that node's component.  Components found are taken out and the
    rest goes on, so rounds depend on the cycles and not on the whole graph.
    """
    edges = cut(edges.select("src", "dst").distinct())
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    live, found = _trimmed(edges.filter("src <> dst")), None
    while not live.isEmpty():
        colour = cut(live.select("src", F.col("src").alias("colour")).union(live.select("dst", "dst")).distinct().toDF("node", "colour"))
        while True:  # forward: the greatest node that reaches each
            coming = live.join(colour.withColumnRenamed("node", "src"), "src").groupBy(F.col("dst").alias("node")).agg(F.max("colour").alias("coming"))
            after = colour.join(coming, "node").select("node", F.greatest("colour", "coming").alias("colour"), (F.col("coming") > F.col("colour")).alias("moved"))
            after = cut(after)
            moved = not after.filter("moved").isEmpty()
            colour = after.select("node", "colour")
            if not moved:
                break
        inside = live.join(colour.toDF("src", "colour"), "src").join(colour.toDF("dst", "colour_2"), "dst").filter("colour = colour_2").select("src", "dst", "colour")
        inside = cut(inside)
        frontier = reached = cut(colour.filter("node = colour"))
        while True:  # backward: what reaches the colour's node inside the colour
            step = inside.join(frontier.toDF("dst", "colour"), ["dst", "colour"]).select(F.col("src").alias("node"), "colour").distinct()
            frontier = cut(step.join(reached, ["node", "colour"], "left_anti"))
            if frontier.isEmpty():
                break
            reached = cut(reached.union(frontier))
        found = reached if found is None else found.union(reached)
        gone = reached.select("node")
        rest = live.join(gone.withColumnRenamed("node", "src"), "src", "left_anti").join(gone.withColumnRenamed("node", "dst"), "dst", "left_anti")
        live = _trimmed(cut(rest.select("src", "dst")))
    if found is None:
        return nodes.withColumn("component", F.col("node"))
    least = found.groupBy("colour").agg(F.min("node").alias("component"))
    return nodes.join(found.join(least, "colour").select("node", "component"), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def reach(edges: DataFrame) -> DataFrame:
    """``node, component, component_size, n_reached``: how many other nodes each node reaches, exactly.

    Cycles are condensed first: the closure is taken over components, whose sizes
    are then summed, so a cycle's nodes are not paired with each other.
    """
    edges = cut(edges.select("src", "dst").distinct())
    components = cut(strong_components(edges))
    sizes = components.groupBy("component").agg(F.count("*").alias("size"))
    of = lambda end: components.select(F.col("node").alias(end), F.col("component").alias(f"{end}_component"))
    between = edges.join(of("src"), "src").join(of("dst"), "dst").filter("src_component <> dst_component")
    steps = cut(between.select(F.col("src_component").alias("src"), F.col("dst_component").alias("dst")).distinct())
    closure = frontier = steps
    rounds = 0
    while True:
        rounds += 1
        onward = frontier.select("src", F.col("dst").alias("mid")).join(steps.select(F.col("src").alias("mid"), "dst"), "mid").select("src", "dst").distinct()
        frontier = cut(onward.join(closure, ["src", "dst"], "left_anti"))
        if frontier.isEmpty():
            break
        closure = cut(closure.union(frontier)) if rounds % 8 == 0 else closure.union(frontier)
    below = closure.join(sizes.withColumnRenamed("component", "dst"), "dst").groupBy(F.col("src").alias("component")).agg(F.sum("size").alias("below"))
    out = components.join(sizes, "component").join(below, "component", "left")
    return out.select("node", "component", F.col("size").alias("component_size"), (F.coalesce("below", F.lit(0)) + F.col("size") - 1).alias("n_reached"))
