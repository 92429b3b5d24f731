"""Running aggregates of large groups and conditions between rows of one group.

``running`` is a running aggregate without a one-task window: rows are dealt into
sorted ranges, windows run inside the ranges, and the totals of the earlier ranges
of the same group (one row per range) are put before them.

``peers`` answers nested row context: for every row an aggregate over the rows of
its group that meet inequalities with it.  The points of all groups are numbered
by group and first column, so a condition becomes an interval of numbers, and an
interval is the union of few dyadic blocks (two per power of two).  Blocks inside
a chunk of consecutive numbers are built and looked up in the chunk's task
(``chunks``), larger ones are aggregated once and looked up by an equality join;
a second condition is a running aggregate inside the blocks.  No pair of rows is
ever compared, so nothing grows with the square of a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from metricspark.lineage import cut
from metricspark.operators import chunks

#: Rows of a sorted range; copies of a block, as a power of two, that its probes are dealt to.
RANGE_ROWS, SALT_BITS = 1 << 21, 10
#: Points of a chunk, as a power of two, and intervals of it that one task takes at a time.
CHUNK_BITS, CHUNK_ASKS = 16, 1 << 18

_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_PUT = {"count": lambda a, b: a + b, "sum": lambda a, b: a + b, "min": F.least, "max": F.greatest}


def running(df: DataFrame, by: Sequence[str], order: Sequence[Column], values: Mapping[str, tuple[str, str]], parts: int | None = None) -> DataFrame:
    """Rows with running aggregates of their group up to and with themselves, in ``order``, which should leave no ties.

    ``values`` maps an output name to ``(sum, min or max, column)``.  A row's range
    is stored with it, so that a task that runs again finds the same ranges.
    """
    if parts is None:
        parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // RANGE_ROWS + 1)
    placed = cut(df.repartitionByRange(parts, *by, *order).withColumn("range_", F.spark_partition_id()))
    inside = Window.partitionBy(*by, "range_").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*by).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy(*by, "range_").agg(*[_MERGE[kind](c).alias(f"all_{name}") for name, (kind, c) in values.items()])
    starts = ranges.select(*[F.col(b).alias(f"start_{b}") for b in by], F.col("range_").alias("start_"), *[_MERGE[kind](f"all_{name}").over(earlier).alias(f"before_{name}") for name, (kind, _) in values.items()])
    same = [F.col("range_") == F.col("start_"), *[F.col(b).eqNullSafe(F.col(f"start_{b}")) for b in by]]
    joined = placed.withColumns({f"run_{name}": _MERGE[kind](c).over(inside) for name, (kind, c) in values.items()}).join(starts, same, "left")
    run, before = (lambda name: F.col(f"run_{name}")), (lambda name: F.col(f"before_{name}"))
    out = [F.coalesce(_PUT[kind](run(name), before(name)), run(name), before(name)).alias(name) for name, (kind, _) in values.items()]
    return joined.select(*df.columns, *out)


def percentiles(df: DataFrame, by: Sequence[str], wanted: Mapping[str, tuple[str, float]]) -> DataFrame:
    """``by`` and one double per entry of ``wanted``, which maps a name to ``(column, share)``: the interpolated percentile of a column.

    All columns are counted by value in one pass and ranked in one sorted run, so
    no buffer holds a group's values.  Nulls are left out; a group without values
    has nulls.
    """
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(c).cast("double").alias("v")) for k, c in enumerate(columns)])
    keys = [f"by_{b}" for b in by]
    spread = df.select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], F.inline(pairs)).filter("v is not null")
    counts = spread.groupBy(*keys, "metric", "v").agg(F.count("*").alias("c"))
    ranked = running(counts, [*keys, "metric"], [F.col("v")], {"through": ("sum", "c")})
    sizes = ranked.groupBy(*keys, "metric").agg(F.max("through").alias("n")).select(*[F.col(k).alias(f"of_{k}") for k in keys], F.col("metric").alias("of_metric"), "n")
    same = [F.col("metric") == F.col("of_metric"), *[F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]]
    placed = ranked.join(sizes, same)
    out = []
    for name, (c, share) in wanted.items():
        at = F.lit(float(share)) * (F.col("n") - 1)
        held = lambda r: (F.col("metric") == columns.index(c)) & (F.col("through") - F.col("c") <= r) & (r < F.col("through"))  # noqa: B023, E731
        low, high = (F.max(F.when(held(f(at)), F.col("v"))) for f in (F.floor, F.ceil))
        part = F.max(F.when(F.col("metric") == columns.index(c), at - F.floor(at)))
        out.append((low * (1 - part) + high * part).alias(name))
    found = placed.groupBy(*keys).agg(*out)
    groups = df.groupBy(*[F.col(b).alias(f"all_{b}") for b in by]).agg(F.count("*").alias("rows_"))
    joined = groups.join(found, [F.col(f"all_{b}").eqNullSafe(F.col(k)) for b, k in zip(by, keys, strict=True)] or F.lit(True), "left")
    return joined.select(*[F.col(f"all_{b}").alias(b) for b in by], *wanted)


@dataclass(frozen=True)
class Span:
    """A peer's ``column`` from ``low`` to ``high``, each SQL over the row itself or left out; ends belong to it unless open."""

    column: str
    low: str | None = None
    high: str | None = None
    low_open: bool = False
    high_open: bool = False

    def __post_init__(self) -> None:
        if self.low is None and self.high is None:
            raise ValueError(f"{self.column}: a span has an end")


def _dyadic(levels: int) -> Column:
    """The blocks ``(level, block)`` that the numbers from ``first`` to before ``stop`` consist of."""
    piece = lambda block: f"named_struct('level', k, 'block', {block})"
    first, stop = "shiftright(first + shiftleft(1L, k) - 1, k)", "shiftright(stop, k)"
    odd = lambda x: f"({x}) % 2 = 1"
    return F.expr(
        f"flatten(transform(sequence(0, {levels}), k -> case when {first} >= {stop} then array() else concat("
        f"case when {odd(first)} then array({piece(first)}) else array() end, case when {odd(stop)} then array({piece(f'{stop} - 1')}) else array() end) end))"
    )


def _numbered(points: DataFrame, probes: DataFrame, span: Span, parts: int) -> tuple[DataFrame, DataFrame]:
    """The points with numbers in the order of groups and values, and the probes with the interval ``first`` to before ``stop`` that their span holds.

    The numbers run on from group to group, so that small groups share a chunk.
    """
    piece = lambda name, at, behind: F.struct(F.lit(at).alias("at"), F.col(f"q.{name}").alias("v"), F.lit(2 if behind else 0).alias("tie"))
    ends = [piece("low_1", "first", span.low_open)] if span.low is not None else []
    ends += [piece("high_1", "stop", not span.high_open)] if span.high is not None else []
    asked = probes.select("g", "q", F.inline(F.array(*ends))).withColumn("w", F.lit(0))
    events = points.withColumns({"tie": F.lit(1), "w": F.lit(1)}).unionByName(asked, allowMissingColumns=True)
    order = [F.col(c) for c in ("g", "v", "tie", *(["u"] if "u" in points.columns else []))] + [F.xxhash64("q")]
    placed = cut(running(events, [], order, {"place": ("sum", "w")}, parts))
    numbers = placed.filter("tie = 1").select(*points.columns, (F.col("place") - 1).alias("number"))
    at = lambda name: F.max(F.when(F.col("at") == name, F.col("place"))).alias(name)
    found = placed.filter("tie <> 1")
    if len(ends) == 2:
        out = found.groupBy("g", "q").agg(at("first"), at("stop"))
    else:
        low = span.low is not None
        other = numbers.groupBy("g").agg(F.max("number") + 1 if low else F.min("number")).toDF("of_g", "stop" if low else "first")
        out = found.withColumnRenamed("place", "first" if low else "stop").join(other, F.col("g") == F.col("of_g"))
    return numbers, out.filter("first < stop").select("g", "q", "first", "stop")


def peers(df: DataFrame, by: Sequence[str], spans: Sequence[Span], values: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Every row with aggregates over the rows of its group that lie in one or two spans around it.

    ``values`` maps an output name to ``(count, sum, min or max, column)``.  A row
    whose span has a null end has no peers, a peer with a null column meets no
    span; counts without peers are 0 and other aggregates null.  The minimum and
    the maximum take one end of a second span, not both.
    """
    if not 1 <= len(spans) <= 2 or any(kind not in _MERGE for kind, _ in values.values()):
        raise ValueError("peers take one or two spans, and count, sum, min or max")
    second = spans[1] if len(spans) == 2 else None
    if second and second.low and second.high and any(kind in ("min", "max") for kind, _ in values.values()):
        raise ValueError("a minimum or maximum takes one end of the second span")
    ends = {f"{end}_{k}": getattr(s, end) for k, s in enumerate(spans, 1) for end in ("low", "high") if getattr(s, end) is not None}
    asked, columns = values, {}
    # an interval's sum is 0 where no peer has a value, so values are counted too
    values = {**values, **{f"{name}_values": ("count", c) for name, (kind, c) in values.items() if kind == "sum"}}
    keyed = df.withColumn("g", F.struct(*[F.col(b) for b in by]) if by else F.struct(F.lit(0).alias("all")))
    for k, (span, name) in enumerate(zip(spans, "vu", strict=False), 1):  # a column and its ends in the widest of their types
        mine = {n: F.expr(e) for n, e in ends.items() if n.endswith(str(k))}
        wide = df.select(F.coalesce(F.col(span.column), *mine.values())).schema[0].dataType
        keyed = keyed.withColumns({n: e.cast(wide) for n, e in mine.items()})
        columns[name] = F.col(span.column).cast(wide).alias(name)
    keyed = keyed.withColumn("q", F.struct(*ends))
    probes = keyed.select("g", "q", *ends).dropna(subset=list(ends)).select("g", "q").distinct()
    if second and second.low and second.high:  # an empty second span takes nothing
        low, high = F.col("q.low_2"), F.col("q.high_2")
        probes = probes.filter(low < high if second.low_open or second.high_open else low <= high)
    measured = keyed.dropna(subset=[s.column for s in spans]).groupBy("g", *columns.values())
    points = measured.agg(*[(F.count(c) if kind == "count" else _MERGE[kind](c)).alias(name) for name, (kind, c) in values.items()])
    events = (1 + sum(e.endswith("1") for e in ends)) * df.count()
    points, placed = _numbered(points, probes, spans[0], max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), events // RANGE_ROWS + 1))
    found = _met(points, cut(placed), second, {name: kind for name, (kind, _) in values.items()})
    merged = [_MERGE[kind](name).alias(name) for name, (kind, _) in values.items()]
    result = found.groupBy("g", "q").agg(*merged).withColumnsRenamed({"g": "of_g", "q": "of_q"})
    joined = keyed.join(result, (F.col("g") == F.col("of_g")) & (F.col("q") == F.col("of_q")), "left")
    out = []
    for name, (kind, _) in asked.items():
        if kind == "count":
            out.append(F.coalesce(name, F.lit(0)).alias(name))
        elif kind == "sum":
            out.append(F.when(F.col(f"{name}_values") > 0, F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    return joined.select(*df.columns, *out)


def _met(points: DataFrame, placed: DataFrame, second: Span | None, kinds: Mapping[str, str]) -> DataFrame:
    """``g``, ``q`` and aggregates over parts of each interval: its ends inside their chunks, and what lies between by blocks of whole chunks."""
    chunk = lambda c: F.shiftright(c, CHUNK_BITS)
    head, tail = chunk(F.col("first")), chunk(F.col("stop") - 1)
    part = lambda at, first, stop: F.struct(at.alias("chunk"), first.alias("first"), stop.alias("stop"))
    full = lambda at: F.shiftleft(at, CHUNK_BITS)
    parts = F.when(head == tail, F.array(part(head, F.col("first"), F.col("stop")))).otherwise(F.array(part(head, F.col("first"), full(head + 1)), part(tail, full(tail), F.col("stop"))))
    asks = placed.select("g", "q", F.inline(parts))
    numbered = points.withColumn("chunk", chunk(F.col("number")))
    counts = asks.groupBy("chunk").agg(F.count("*").alias("n"))
    size = placed.agg(F.max(tail - head)).crossJoin(counts.agg(F.max("n"))).first()
    longest, most = size[0] or 0, size[1] or 0
    key = ["chunk"]
    if most > CHUNK_ASKS:  # many spans that end in one chunk are dealt to copies of it
        key = ["chunk", "salt"]
        copies = counts.select(F.col("chunk"), F.floor(F.col("n") / CHUNK_ASKS + 1).cast("int").alias("copies"))
        asks = asks.join(copies, "chunk").withColumn("salt", F.pmod(F.xxhash64("q", "g"), F.col("copies")).cast("int")).drop("copies")
        numbered = numbered.join(copies, "chunk").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    shape = second and (second.low is not None, second.low_open, second.high is not None, second.high_open)
    fields = [placed.schema["g"], placed.schema["q"], *[points.schema[name] for name in kinds]]
    held = numbered.select(*key, "number", *(["u"] if second else []), *kinds).groupBy(*key)
    found = held.cogroup(asks.groupBy(*key)).applyInArrow(chunks.aggregator(kinds, CHUNK_BITS, shape), StructType([StructField(f.name, f.dataType) for f in fields]))
    if longest < 2:
        return found
    levels = (longest - 1).bit_length()
    merged = [_MERGE[kind](name).alias(name) for name, kind in kinds.items()]
    level = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")
    inner = ["u"] if second else []
    whole = points.withColumn("chunk", chunk(F.col("number"))).groupBy("chunk", *inner).agg(*merged).select("*", level).withColumn("block", F.expr("shiftright(chunk, level)"))
    blocks = whole.groupBy("level", "block", *inner).agg(*merged)
    pieces = placed.select("g", "q", (head + 1).alias("first"), tail.alias("stop")).filter("first < stop")
    pieces = pieces.select("g", "q", F.explode(_dyadic(levels)).alias("piece")).select("g", "q", "piece.*")
    if second:
        return found.unionByName(_second(blocks, pieces, second, kinds))
    copies = F.expr(f"shiftleft(1, least(level + 4, {SALT_BITS}))")  # a block of twice the numbers has twice the probes
    dealt = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    met = pieces.withColumn("salt", F.pmod(F.xxhash64("q", "g"), copies).cast("int")).join(dealt, ["level", "block", "salt"])
    return found.unionByName(met.select("g", "q", *kinds))


def _second(points: DataFrame, pieces: DataFrame, span: Span, kinds: Mapping[str, str]) -> DataFrame:
    """Aggregates of the pieces over the points of their block that lie in the second span, by running aggregates inside the blocks."""
    key = ["level", "block"]
    down = span.high is None  # from the top down to the low end
    rows = points.withColumns({"tie": F.lit(1), "sign": F.lit(0)})
    for end, sign in (("low", 1 if down else -1), ("high", 1)):
        if getattr(span, end) is None:
            continue
        behind = span.low_open if end == "low" else not span.high_open
        if down:
            behind = not span.low_open
        at = pieces.select(*key, "g", "q", F.col(f"q.{end}_2").alias("u"), F.lit(2 if behind else 0).alias("tie"), F.lit(sign).alias("sign"))
        rows = rows.unionByName(at, allowMissingColumns=True)
    order = [F.desc("u") if down else F.asc("u"), F.col("tie"), F.col("sign"), F.xxhash64("q", "g")]
    run = running(rows, key, order, {f"run_{name}": (k, name) for name, k in kinds.items()}).filter("tie <> 1")
    signed = {name: F.col(f"run_{name}") * F.col("sign") if k in ("count", "sum") else F.col(f"run_{name}") for name, k in kinds.items()}
    return run.select("g", "q", *[c.alias(name) for name, c in signed.items()])
