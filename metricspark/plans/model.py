"""The metrics model: datasets, declared joins and declared metrics, queried as lazy DataFrames.

Declarations are plain Python and are checked when a model is built, without a
Spark job.  Nothing is inferred: a metric without an aggregate, a join to
undeclared key columns or a second path between two datasets is an error.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.operators.predicates import secure
from metricspark.operators.ranges import percentiles


class ModelError(ValueError):
    """A declaration that the model refuses."""


@dataclass(frozen=True)
class Field:
    """A row-level expression over source columns, under a name of its own."""

    name: str
    expr: str | None = None

    def column(self) -> Column:
        return F.expr(self.expr if self.expr is not None else f"`{self.name}`").alias(self.name)


#: Declared aggregate names and what they build from a Column (and a parameter).
AGGREGATES: dict[str, Callable[..., Column]] = {
    "sum": F.sum,
    "total": F.sum,
    "avg": F.avg,
    "average": F.avg,
    "min": F.min,
    "minimum": F.min,
    "max": F.max,
    "maximum": F.max,
    "count": F.count,
    "count_distinct": F.count_distinct,
    "stddev": F.stddev_samp,
    "stddev_pop": F.stddev_pop,
    "variance": F.var_samp,
    "variance_pop": F.var_pop,
    "median": F.median,
    "percentile": lambda c, p: F.percentile(c, F.lit(p)),
    "corr": F.corr,
    "covar_pop": F.covar_pop,
    "covar_samp": F.covar_samp,
    "list": lambda c, *_: c,  # see Metric.column
}

_AGGREGATE_CALL = re.compile(r"\b(sum|avg|min|max|count|stddev\w*|var\w*|median|percentile\w*|corr|covar\w*)\s*\(", re.I)


@dataclass(frozen=True)
class Metric:
    """A declared aggregate of an expression, or arithmetic over aggregates (``kind='expr'``).

    ``where`` restricts the rows the measure sees.  A composite must contain an
    aggregate and neither ``count(*)`` nor a window.  The arguments of ``list``
    are the SQL to order by, without which it is refused, then the separator
    (a comma) and ``"distinct"`` where each value is listed once; distinct values
    are in their own order.  The argument of ``percentile`` is a share; medians
    and percentiles interpolate between values.
    """

    name: str
    kind: str
    expr: str
    where: str | None = None
    args: tuple = ()

    def __post_init__(self) -> None:
        if self.kind == "expr":
            if not _AGGREGATE_CALL.search(self.expr):
                raise ModelError(f"{self.name}: a composite metric needs an aggregate")
            if re.search(r"count\s*\(\s*\*", self.expr, re.I) or re.search(r"\bover\b", self.expr, re.I):
                raise ModelError(f"{self.name}: count(*) and windows are not allowed")
            if self.where is not None:
                raise ModelError(f"{self.name}: put the condition inside the aggregates")
        elif self.kind not in AGGREGATES:
            raise ModelError(f"{self.name}: no aggregate named {self.kind!r}")
        elif self.expr.strip() == "*":
            raise ModelError(f"{self.name}: count a key, not rows")
        elif self.kind == "list" and not self.args:
            raise ModelError(f"{self.name}: a list needs an order")

    def column(self) -> Column:
        if self.kind == "expr":
            return F.expr(self.expr).alias(self.name)
        if self.kind == "list":
            order, sep, distinct = (*self.args, *(",", "")[len(self.args) - 1 :])
            value = f"cast({f'case when {self.where} then {self.expr} end' if self.where else self.expr} as string)"
            if distinct:
                return F.nullif(F.array_join(F.array_sort(F.collect_set(F.expr(value))), sep), F.lit("")).alias(self.name)
            sep = sep.replace("\\", "\\\\").replace("'", "\\'")
            return F.expr(f"listagg({value}, '{sep}') within group (order by {order})").alias(self.name)
        value = F.expr(self.expr)
        if self.where is not None:
            value = F.when(F.expr(self.where), value)
        args = [F.expr(a) if self.kind in ("corr", "covar_pop", "covar_samp") else a for a in self.args]
        return AGGREGATES[self.kind](value, *args).alias(self.name)


@dataclass(frozen=True)
class Dataset:
    """A source DataFrame with renamed or derived fields, a declared key and row filters.

    Filters are on source columns and apply before the projection, so they reach
    the scan.  ``rules`` map roles to predicates; see ``secure``.
    """

    name: str
    source: DataFrame
    fields: Sequence[Field] = ()
    key: Sequence[str] = ()
    filters: Sequence[str] = ()
    metrics: Sequence[Metric] = ()
    rules: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        names = [f.name.lower() for f in self.all_fields()]
        if len(set(names)) < len(names):
            raise ModelError(f"{self.name}: field names collide")
        missing = [k for k in self.key if k.lower() not in names]
        if missing:
            raise ModelError(f"{self.name}: key columns {missing} are not fields")

    def all_fields(self) -> list[Field]:
        return list(self.fields) or [Field(c) for c in self.source.columns]

    def frame(self, roles: Sequence[str] | None = None) -> DataFrame:
        """The bound rows: filters first, then row security, then the projection."""
        df = self.source
        for f in self.filters:
            df = df.filter(f"({f})")
        if self.rules:
            df = secure(df, self.rules, roles or ())
        return df.select(*[f.column() for f in self.all_fields()])


@dataclass(frozen=True)
class Relationship:
    """Equal column lists between two datasets; always resolved to point at the one side."""

    name: str
    left: str
    right: str
    on: Sequence[tuple[str, str]]
    cardinality: str = "many_to_one"
    join_type: str | None = None
    active: bool = True
    role: str | None = None

    @property
    def label(self) -> str:
        """Name of the one side when it is reached through this relationship."""
        return self.role or self.right


@dataclass(frozen=True)
class Node:
    """A dataset in the role that a path of relationships gives it; the same dataset on two paths is two nodes."""

    base: str
    path: tuple[Relationship, ...] = ()

    @property
    def dataset(self) -> str:
        return self.path[-1].right if self.path else self.base

    def answers(self, tokens: Sequence[str]) -> bool:
        """Whether the tokens name this node: the last one its role or dataset, the others steps on the way, in order."""
        steps = [{self.base}] + [{r.label, r.right} for r in self.path]
        if tokens[-1] not in steps[-1]:
            return False
        before = iter(steps[:-1])
        return all(any(t in step for step in before) for t in tokens[:-1])


def _aggregated(rows: DataFrame, by: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """Metrics at a grain; medians and percentiles are ranked in sorted runs and joined to the others."""
    ranked = {m.name: m for m in metrics if m.kind in ("median", "percentile")}
    if not ranked:
        return rows.groupBy(*by).agg(*[m.column() for m in metrics])
    value = lambda m: f"case when {m.where} then {m.expr} end" if m.where else m.expr
    sources = {v: f"ranked_{k}" for k, v in enumerate(dict.fromkeys(value(m) for m in ranked.values()))}
    rows = rows.withColumns({c: F.expr(v) for v, c in sources.items()})
    out = percentiles(rows, by, {m.name: (sources[value(m)], 0.5 if m.kind == "median" else m.args[0]) for m in ranked.values()})
    others = [m.column() for m in metrics if m.name not in ranked]
    if others:
        side = rows.groupBy(*[F.col(b).alias(f"by_{b}") for b in by]).agg(*others)
        out = out.join(side, [F.col(b).eqNullSafe(F.col(f"by_{b}")) for b in by] or F.lit(True))
    return out.select(*by, *[m.name for m in metrics])


class Model:
    """Datasets and the many-to-one joins between them, unfolded from a base dataset into one node per path.

    A field is named ``dataset.field`` where one path leads to the dataset, else
    by a role or by steps on the way: ``ship_date.year``, ``customer.nation.name``
    and ``supplier.nation.name`` in one query.
    """

    def __init__(self, datasets: Sequence[Dataset], relationships: Sequence[Relationship] = ()):
        self.datasets = {d.name: d for d in datasets}
        if len(self.datasets) < len(datasets):
            raise ModelError("two datasets share a name")
        self.relationships = [self._resolved(r) for r in relationships]

    def _resolved(self, r: Relationship) -> Relationship:
        if r.left not in self.datasets or r.right not in self.datasets:
            raise ModelError(f"{r.name}: unknown dataset")
        if not r.on or any(len(p) != 2 for p in r.on):
            raise ModelError(f"{r.name}: column lists differ in length")
        if r.join_type not in (None, "left_outer"):
            raise ModelError(f"{r.name}: only left outer joins are declared")
        if r.cardinality == "one_to_many":
            if r.join_type is not None:
                raise ModelError(f"{r.name}: a join type cannot be turned around")
            r = Relationship(r.name, r.right, r.left, [(b, a) for a, b in r.on], "many_to_one", None, r.active, r.role)
        if r.cardinality not in ("many_to_one", "one_to_one"):
            raise ModelError(f"{r.name}: cardinality {r.cardinality!r}")
        one = {b.lower() for _, b in r.on}
        if one != {k.lower() for k in self.datasets[r.right].key}:
            raise ModelError(f"{r.name}: the one side's columns are not the key of {r.right}")
        if r.cardinality == "one_to_one" and {a.lower() for a, _ in r.on} != {k.lower() for k in self.datasets[r.left].key}:
            raise ModelError(f"{r.name}: a one-to-one join needs both keys")
        return r

    def _nodes(self, base: str, via: Mapping[str, str], named: set[str]) -> list[Node]:
        """All nodes that paths from ``base`` reach.

        A relationship is followed if it is active, or if its role is among the
        names a query uses; ``via`` picks one relationship for a dataset or role
        and leaves the others out.
        """
        found: list[Node] = []

        def walk(node: Node) -> None:
            found.append(node)
            for r in self.relationships:
                wanted = via.get(r.label, via.get(r.right))
                usable = r.name == wanted if wanted is not None else r.active or r.role in named
                if r.left != node.dataset or not usable:
                    continue
                if r.role is not None and r.role in {p.role for p in node.path}:
                    continue  # a role is played once on a path
                if r.role is None and r.right in {base, *(p.right for p in node.path)}:
                    raise ModelError(f"cycle through {r.right}")
                walk(Node(base, (*node.path, r)))

        walk(Node(base))
        return found

    def _find(self, nodes: Sequence[Node], tokens: Sequence[str]) -> Node:
        """The one node that the tokens name."""
        found = [n for n in nodes if n.answers(tokens)]
        if len(found) != 1:
            choice = f"; name one of {', '.join(sorted(self._name(nodes, n) for n in found))}" if found else ""
            raise ModelError(f"{len(found)} paths from {nodes[0].base} to {'.'.join(tokens)}{choice}")
        return found[0]

    @staticmethod
    def _name(nodes: Sequence[Node], node: Node) -> str:
        """The shortest name that only this node answers to."""
        labels = [r.label for r in node.path] or [node.base]
        tries = [labels[-1:]] + [[step, labels[-1]] for step in reversed(labels[:-1])] + [[node.base, *labels]]
        return ".".join(next((t for t in tries if sum(n.answers(t) for n in nodes) == 1), labels))

    def _unfolded(self, base: str, names: Sequence[str], via: Mapping[str, str] | None) -> tuple[list[Node], dict[str, Node]]:
        """All nodes of a base, and the node that each dotted name stands for."""
        if base not in self.datasets:
            raise ModelError(f"unknown dataset {base}")
        nodes = self._nodes(base, via or {}, {t for name in names for t in name.split(".")})
        return nodes, {name: self._find(nodes, name.split(".")) for name in dict.fromkeys(names)}

    def joined(
        self, base: str, wanted: Sequence[str], roles: Sequence[str] | None = None, via: Mapping[str, str] | None = None
    ) -> DataFrame:
        """Base rows enriched with ``dataset.field`` columns; each base row stays once.

        Columns are named ``dataset__field``, with the role or the steps that tell
        the dataset apart where several paths reach it (``customer__nation__name``).
        Catalyst prunes what is not used.
        """
        nodes, named = self._unfolded(base, [w.rpartition(".")[0] or w for w in wanted], via)
        df = self.datasets[base].frame(roles)
        df = df.select(*[F.col(c).alias(f"{base}__{c}") for c in df.columns])
        prefix = {(): base}
        for node in named.values():
            for step in range(1, len(node.path) + 1):
                path = node.path[:step]
                r, names = path[-1], tuple(p.name for p in path)
                if names in prefix:
                    continue
                prefix[names] = self._name(nodes, Node(base, path)).replace(".", "__")
                side = self.datasets[r.right].frame(roles)
                side = side.select(*[F.col(c).alias(f"{prefix[names]}__{c}") for c in side.columns])
                on = [F.col(f"{prefix[names[:-1]]}__{a}") == F.col(f"{prefix[names]}__{b}") for a, b in r.on]
                df = df.join(side, on, "left")
        return df

    def query(
        self,
        metrics: Sequence[str],
        dims: Sequence[str] = (),
        where: str | None = None,
        having: str | None = None,
        order: Sequence[Column] | None = None,
        limit: int | None = None,
        roles: Sequence[str] | None = None,
        via: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Metrics of one dataset by ``dataset.field`` dimensions, at exactly that grain.

        A dimension keeps its field's name; where another dimension or a field of
        the metrics' dataset has it too, the columns are named ``dataset__field``.
        ``where`` is over ``dataset__field`` columns, steps joined by two
        underscores.  ``limit`` without ``order`` is refused.
        """
        owners = {m.split(".")[0] for m in metrics}
        if len(owners) != 1:
            raise ModelError("metrics of one dataset at a time")
        base = owners.pop()
        if base not in self.datasets:
            raise ModelError(f"unknown dataset {base}")
        declared = {m.name: m for m in self.datasets[base].metrics}
        chosen = []
        for m in metrics:
            name = m.split(".")[1]
            if name not in declared:
                raise ModelError(f"{m} is not declared")
            chosen.append(declared[name])
        labels = {*self.datasets, *(r.label for r in self.relationships)}
        touched = [t.replace("__", ".") for t in re.findall(r"\b(\w+)__\w+", where or "") if labels.issuperset(t.split("__"))]
        owned = [d.rpartition(".")[::2] for d in dims]
        nodes, named = self._unfolded(base, [*(o for o, _ in owned), *touched], via)
        prefix = {name: self._name(nodes, node).replace(".", "__") for name, node in named.items()}
        df = self.joined(base, [f"{name}.x" for name in named], roles, via)
        if where is not None:
            spelled = lambda m: f"{prefix.get(m[1].replace('__', '.'), m[1])}__{m[2]}"
            df = df.filter(re.sub(r"\b(\w+)__(\w+)", spelled, where))
        plain = {c: c.split("__", 1)[1] for c in df.columns if c.startswith(f"{base}__")}
        columns = [F.col(c).alias(p) for c, p in plain.items()]
        names = []
        for owner, name in owned:
            column = f"{prefix[owner]}__{name}"
            if column not in df.columns:
                raise ModelError(f"unknown field {owner}.{name}")
            mine = not named[owner].path
            alone = sum(n == name for _, n in owned) == 1 and (mine or name not in plain.values())
            names.append(name if alone or mine else column)
            if not mine:
                columns.append(F.col(column).alias(names[-1]))
        if len(set(names)) < len(names):
            raise ModelError("a dimension is named twice")
        out = _aggregated(df.select(*columns), names, chosen)
        if having is not None:
            out = out.filter(having)
        if order is not None:
            out = out.orderBy(*order)
        if limit is not None:
            if order is None:
                raise ModelError("a limit needs an order")
            out = out.limit(limit)
        return out
