"""Moving medians and percentiles over rows."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.operators.ranges import running


def sliding(values: np.ndarray, first: int, last: int, preceding: int, following: int, p: float) -> np.ndarray:
    """Interpolated percentile of the frame around each of the places ``first`` to before ``last``; nan where the frame has no value.

    The frame is a sorted list into which the entering value goes by bisection and
    from which the leaving one goes the same way.
    """
    out = np.full(last - first, np.nan)
    frame: list[float] = []
    low = high = max(0, first - preceding)
    for k in range(first, last):
        stop, start = min(len(values), k + following + 1), max(0, k - preceding)
        while high < stop:
            if values[high] == values[high]:
                insort(frame, values[high])
            high += 1
        while low < start:
            if values[low] == values[low]:
                del frame[bisect_left(frame, values[low])]
            low += 1
        if frame:
            at = p * (len(frame) - 1)
            i = int(at)
            out[k - first] = frame[i] if at == i else frame[i] + (frame[i + 1] - frame[i]) * (at - i)
    return out


def moving_percentile(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], value: str, p: float, preceding: int, following: int = 0, name: str = "moving", block: int = 1 << 16
) -> DataFrame:
    """Rows with the percentile of ``value`` over the rows from ``preceding`` before to ``following`` after them in their group.

    ``order`` should leave no ties.  Rows are numbered in sorted ranges and dealt
    in blocks of at least ``block`` numbers with the rows next to them, so a group
    of any size goes through many tasks, each of one block and its frame.  Null
    values are left out of frames; a frame without values gives null.
    """
    size = max(block, preceding + following + 1)
    numbered = running(df.withColumn("one_", F.lit(1).cast("long")), by, order, {"place_": ("sum", "one_")}).drop("one_")
    near = F.sequence(F.floor((F.col("place_") - following) / size), F.floor((F.col("place_") + preceding) / size))
    dealt = numbered.withColumn("block_", F.explode(near)).withColumn("value_", F.col(value).cast("double"))
    columns = df.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place_", kind="stable")
        places = rows["place_"].to_numpy()
        mine = rows["block_"].iloc[0]
        first, last = np.searchsorted(places, [mine * size, (mine + 1) * size])
        found = sliding(rows["value_"].to_numpy(dtype=float), int(first), int(last), preceding, following, p)
        own = rows.iloc[first:last][columns].copy()
        own[name] = pd.Series([None if v != v else v for v in found], index=own.index, dtype=object)
        return own

    return dealt.groupBy(*by, "block_").applyInPandas(work, f"{fields}, {name} double")
