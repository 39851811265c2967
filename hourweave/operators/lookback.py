"""Partitioning for look-back (window) operators.

A plain ``Window.partitionBy(series).orderBy(time)`` puts a whole series into one
task: with few long series (or one series holding a third of the rows) that caps
parallelism and makes one task buffer the series.  Instead, rows are keyed by
(series, chunk) where a chunk spans ``chunk_hours`` hours, and every row within
``halo`` hours of its chunk's end is also copied into the next chunk (flagged
``_halo``).  A look-back of up to ``halo`` rows then sees the same predecessors as
on the unchunked series; halo copies are dropped after the window.  The overhead is
``halo / chunk_hours`` extra rows (24 / 168 = 14 % by default).

Unbounded look-backs (forward fill) cannot use a halo; they use a two-step carry
(``forward_fill`` in preprocess.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..config import PanelSpec
from ..functions.exprs import epoch_hours, hours
from ..session import dealt, task_count

PART = "_part"
HALO = "_halo"
CHUNK = "_chunk"
GAP = "_gap"


def chunk_of(spec: PanelSpec) -> Column:
    if spec.chunk_hours is None:
        return F.lit(0).cast("long")
    return F.floor(epoch_hours(spec.time) / F.lit(spec.chunk_hours)).cast("long")


def with_chunk(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.withColumn(CHUNK, chunk_of(spec))


def lookback_parts(df: DataFrame, spec: PanelSpec, halo: int) -> DataFrame:
    """Add ``_part`` (window partition chunk) and ``_halo`` (copy from the previous chunk)."""
    if spec.chunk_hours is None:
        return df.withColumn(PART, F.lit(0).cast("long")).withColumn(HALO, F.lit(False))
    if halo > spec.chunk_hours:
        raise ValueError(f"look-back of {halo} hours exceeds chunk_hours={spec.chunk_hours}")
    eh = epoch_hours(spec.time)
    chunk = F.floor(eh / F.lit(spec.chunk_hours)).cast("long")
    pos = eh - chunk * F.lit(spec.chunk_hours)
    parts = F.when(pos >= F.lit(spec.chunk_hours - halo), F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    out = df.withColumn(CHUNK, chunk).withColumn(PART, F.explode(parts))
    return out.withColumn(HALO, F.col(PART) != F.col(CHUNK)).drop(CHUNK)


def with_lookback_parts(df: DataFrame, spec: PanelSpec, halo: int) -> DataFrame:
    """``lookback_parts``, dealt over as many tasks as the rows need, and ``_gap`` (1 unless the row before it in the
    partition is exactly one hour earlier)."""
    x = dealt(lookback_parts(df, spec, halo), lookback_tasks(df, spec, halo), spec.station, PART)
    return with_gaps(x, spec, lookback_window(spec))


def lookback_tasks(df: DataFrame, spec: PanelSpec, halo: int) -> int:
    """Tasks for the rows of ``df`` and their halo copies."""
    return task_count(df, 1 + halo / spec.chunk_hours if spec.chunk_hours else 1)


def with_gaps(df: DataFrame, spec: PanelSpec, win: WindowSpec) -> DataFrame:
    before = F.lag(spec.time, 1).over(win)
    return df.withColumn(GAP, F.when(before == F.col(spec.time) - hours(1), 0).otherwise(1))


def lookback_window(spec: PanelSpec) -> WindowSpec:
    return Window.partitionBy(spec.station, PART).orderBy(spec.time)


def series_window(spec: PanelSpec) -> WindowSpec:
    """(series, chunk) window without halo, for operators that combine with a carry."""
    return Window.partitionBy(spec.station, CHUNK).orderBy(spec.time)
