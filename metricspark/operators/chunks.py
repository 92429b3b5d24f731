"""Aggregates over intervals of numbered points within one chunk, for :func:`metricspark.operators.ranges.peers`.

A chunk holds so many consecutive points as one task takes at a time.  An
interval is the union of few dyadic blocks; each level of blocks is built from
the chunk by array operations and answers all intervals that need it.  Where a
second column counts, the points of each block are sorted by it and accumulated
inside the block, so a condition on it is one search.  No pair is compared and
no sum is a difference, except between the two ends of a second span.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MERGE = {"count": np.add, "sum": np.add, "min": np.minimum, "max": np.maximum}
_WORD = 1 << 64


def _one(column: pa.ChunkedArray) -> pa.Array:
    out = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pa.concat_arrays(out.chunks) if isinstance(out, pa.ChunkedArray) else out


def _whole(column: pa.Array) -> np.ndarray:
    """Integers or unscaled decimals, null as 0: as 64-bit integers where any sum of them fits, else as Python's."""
    if pa.types.is_decimal(column.type):
        column = pa.concat_arrays([column])
        pairs = np.frombuffer(column.buffers()[1], dtype="<i8").reshape(-1, 2)[column.offset : column.offset + len(column)]
        low, high = pairs[:, 0].copy(), pairs[:, 1].copy()
        missing = column.is_null().to_numpy(zero_copy_only=False)
        low[missing] = high[missing] = 0
        out = low if (high == low >> 63).all() else high.astype(object) * _WORD + low.view("<u8").astype(object)
    else:
        out = pc.fill_null(column.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
    if out.dtype != object and len(out) and max(abs(int(out.min())), abs(int(out.max()))) * len(out) >= 1 << 62:
        out = out.astype(object)
    return out


def _numbers(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The inverse of :func:`_whole`."""
    if not pa.types.is_decimal(kind):
        return pa.array(values.tolist() if values.dtype == object else values, kind)
    if values.dtype == object:
        low = np.array([int(v) % _WORD for v in values], dtype="<u8").view("<i8")
        high = np.array([int(v) // _WORD for v in values], dtype="<i8")
    else:
        low, high = values, values >> 63
    return pa.Array.from_buffers(kind, len(values), [None, pa.py_buffer(np.stack([low, high], axis=1).astype("<i8").tobytes())])


def _ranked(*columns: pa.Array) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct values of columns of one type in order, and each column as places among them, -1 for null."""
    columns = [pc.add(c, pa.scalar(0.0, c.type)) if pa.types.is_floating(c.type) else c for c in columns]  # no negative zero
    values = pc.unique(pa.concat_arrays(columns)).drop_null()
    values = values.take(pc.sort_indices(values))
    return values, [pc.fill_null(pc.index_in(c, value_set=values), -1).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]


class _Value:
    """One aggregate: an array over the points, what an empty interval has, and its way back to a column."""

    def __init__(self, kind: str, column: pa.Array):
        self.merge, self.type, self.values = _MERGE[kind], column.type, None
        if kind in ("min", "max"):
            self.values, (self.points,) = _ranked(column)
            self.none = len(self.values) if kind == "min" else -1
            self.points[self.points < 0] = self.none
        else:
            floating = pa.types.is_floating(column.type)
            self.points = pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False) if floating else _whole(column)
            self.none = 0

    def column(self, found: np.ndarray) -> pa.Array:
        if self.values is not None:
            return self.values.take(pa.array(found, mask=(found < 0) | (found >= len(self.values))))
        return pa.array(found, self.type) if pa.types.is_floating(self.type) else _numbers(found, self.type)


def _padded(points: np.ndarray, size: int, none: int) -> np.ndarray:
    out = np.full(size, none, dtype=points.dtype)
    out[: len(points)] = points
    return out


def _blocks(first: np.ndarray, stop: np.ndarray):
    """By level: the level, and the intervals that need a block of it with the block of each, for either end."""
    first, stop, level = first.copy(), stop.copy(), 0
    while (open_ := first < stop).any():
        low = np.flatnonzero(open_ & (first & 1 == 1))
        low_blocks = first[low]
        first[low] += 1
        high = np.flatnonzero((first < stop) & (stop & 1 == 1))
        stop[high] -= 1
        yield level, np.concatenate([low, high]), np.concatenate([low_blocks, stop[high]])
        first >>= 1
        stop >>= 1
        level += 1


def _put(value: _Value, found: np.ndarray, rows: np.ndarray, got: np.ndarray) -> None:
    """Merge what blocks have into intervals; an interval may be there twice, once for either end."""
    value.merge.at(found, rows, got)


def aggregator(kinds: Mapping[str, str], bits: int, second: tuple[bool, bool, bool, bool] | None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A function of a chunk's points and of the intervals in it: the intervals' ``g`` and ``q`` with one aggregate for each of ``kinds``.

    ``second`` tells of a second span whether it has a low end, whether that is
    open, whether it has a high end, and whether that is open.
    """

    def run(points: pa.Table, asks: pa.Table) -> pa.Table:
        if not asks.num_rows or not points.num_rows:
            none = asks.slice(0, 0).select(["g", "q"])
            for name in kinds:
                none = none.append_column(name, pa.array([], points.schema.field(name).type))
            return none
        points = points.take(pc.sort_indices(points["number"]))
        start = (points["number"][0].as_py() >> bits) << bits
        first, stop = (asks[c].to_numpy() - start for c in ("first", "stop"))
        m = int(stop.max())
        if m > points.num_rows:
            raise RuntimeError(f"a chunk has {points.num_rows} points, {m} were asked for")
        size = 1 << max(points.num_rows - 1, 0).bit_length()
        values = {name: _Value(kind, _one(points[name])) for name, kind in kinds.items()}
        level_of = {name: _padded(v.points, size, v.none) for name, v in values.items()}
        found = {name: np.full(asks.num_rows, v.none, dtype=v.points.dtype) for name, v in values.items()}
        if second is None:
            at_level = 0
            for level, rows, blocks in _blocks(first, stop):
                while at_level < level:
                    level_of = {name: values[name].merge(t[0::2], t[1::2]) for name, t in level_of.items()}
                    at_level += 1
                for name, v in values.items():
                    _put(v, found[name], rows, level_of[name][blocks])
        else:
            ends = _second_ends(points, asks, second)
            rank = _padded(ends[0], size, ends[1])
            for level, rows, blocks in _blocks(first, stop):
                if len(rows):
                    _accumulate(values, level_of, found, rank, ends, level, rows, blocks)
        out = asks.select(["g", "q"])
        for name, v in values.items():
            out = out.append_column(name, v.column(found[name]))
        return out

    return run


def _second_ends(points: pa.Table, asks: pa.Table, second: tuple[bool, bool, bool, bool]):
    """Ranks of the points by the second column, the number of ranks, and the rank up to which each interval takes and leaves out points."""
    has_low, low_open, has_high, high_open = second
    q = _one(asks["q"])
    bounds = [_one(pc.struct_field(q, name)) for name, has in (("low_2", has_low), ("high_2", has_high)) if has]
    values, (u, *places) = _ranked(_one(points["u"]), *bounds)
    n = len(values)
    if not has_high:  # from the top down to the low end
        return n - 1 - u, n, n - 1 - places[0] + (not low_open), None
    high = places[-1] + (not high_open)
    return u, n, high, np.minimum(places[0] + low_open, high) if has_low else None


def _accumulate(values, level_of, found, rank, ends, level, rows, blocks) -> None:
    """Add one level: the points of each block in the order of the second column, accumulated inside the block."""
    _, n, upto, without = ends
    keys = (np.arange(len(rank)) >> level) * (n + 1) + rank
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    start = blocks << level
    through = np.searchsorted(keys, blocks * (n + 1) + upto[rows])
    before = np.searchsorted(keys, blocks * (n + 1) + without[rows]) if without is not None else None
    for name, v in values.items():
        total = v.merge.accumulate(level_of[name][order].reshape(-1, 1 << level), axis=1).ravel()
        held = lambda at, total=total, none=v.none: np.where(at > start, total[np.maximum(at - 1, 0)], none)
        _put(v, found[name], rows, held(through) if before is None else held(through) - held(before))
