"""Hourly panels derived from the driver's ``events`` table.

The driver data has no sensor panel, so one is derived the way a user would
build an hourly panel from an event log:

* Panel A: one series per ``event_type`` (few, long series).
* Panel B: one series per ``user_id`` (many series, mostly empty hours).

Per (series, hour): ``y`` = mean value (the target), ``vmax``, ``vmin``, ``vsum``,
``n`` = events, ``users`` = distinct partners (users for Panel A, event types for
Panel B), ``k`` = mean of ``props.k`` and ``wd`` = a wind-like compass code chosen by
``sum(k) mod 18``.  Hours without events exist as rows with NULLs, from each series' first
hour to its last, which is what the fill operators need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EVENT_WIND_CODES, EVENTS_SPEC, PanelSpec
from ..functions.exprs import epoch_hours
from ..session import dealt, task_count

PANEL_KEYS = {"A": ("event_type", "user_id"), "B": ("user_id", "event_type")}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hourly_events(spark: SparkSession, sf_dir: str, panel: str = "A") -> DataFrame:
    key, other = PANEL_KEYS[panel]
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col(key).cast("string").alias("station"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("datetime"),
        F.col("value").cast("double").alias("value"),
        F.col(other).cast("string").alias("_other"),
        F.get_json_object("props", "$.k").cast("long").alias("_k"),
    )


VALUE_COLS = ("y", "vmax", "vmin", "vsum", "_n", "_u", "k", "_ksum")


def hourly_aggregate(spark: SparkSession, sf_dir: str, panel: str = "A") -> DataFrame:
    """Sparse panel: one row per (series, hour) with events.

    Events are counted per (series, hour, partner), then per (series, hour).  Cells are nearly as many as events and
    an aggregate holds all cells of its task, so both steps of many events are dealt over as many tasks as the events need.
    """
    ev = hourly_events(spark, sf_dir, panel)
    tasks = task_count(ev)
    value = F.col("value").cast("decimal(18,2)")
    partners = dealt(ev, tasks, "station", "datetime", "_other").groupBy("station", "datetime", "_other").agg(
        F.sum(value).alias("_v"), F.count("value").alias("_n"), F.max("value").alias("vmax"), F.min("value").alias("vmin"),
        F.sum("_k").alias("_ksum"), F.sum(F.col("_k").cast("double")).alias("_kd"), F.count("_k").alias("_kn"))
    return dealt(partners, tasks, "station", "datetime").groupBy("station", "datetime").agg(
        # a decimal sum is exact, so the mean does not depend on the summation order
        (F.sum("_v").cast("double") / F.sum("_n")).alias("y"),
        F.max("vmax").alias("vmax"),
        F.min("vmin").alias("vmin"),
        F.sum("_v").cast("double").alias("vsum"),
        F.sum("_n").alias("_n"),
        F.count("_other").alias("_u"),
        (F.sum("_kd") / F.sum("_kn")).alias("k"),
        F.sum("_ksum").alias("_ksum"),
    )


def densify_panel(sparse: DataFrame, spec: PanelSpec = EVENTS_SPEC) -> DataFrame:
    """Every hour of each series from its first to its last one.

    Observed cells are gathered per (series, chunk), at most ``chunk_hours`` of them, and the chunk's hours are
    written out inside the task, so only observed cells are shuffled and no task holds a whole series.  Chunks
    without a cell come from the series' range, a list of (series, chunk) that is spread over the tasks, as many as
    the cells need.
    """
    size = spec.chunk_hours or 24 * 28
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    tasks = task_count(sparse)
    cells = sparse.withColumn("_c", F.floor(epoch_hours("datetime") / size).cast("long"))
    cells = dealt(cells, tasks, "station", "_c").groupBy("station", "_c").agg(F.map_from_entries(F.collect_list(
        F.struct("datetime", F.struct(*VALUE_COLS).alias("v")))).alias("_m"))
    ends = sparse.groupBy("station").agg(F.min(epoch_hours("datetime")).alias("_a"), F.max(epoch_hours("datetime")).alias("_b"))
    chunks = ends.select("station", "_a", "_b", F.explode(F.sequence(
        F.floor(F.col("_a") / size).cast("long"), F.floor(F.col("_b") / size).cast("long"))).alias("_c"))
    whole = dealt(chunks, tasks, "station", "_c").join(cells, ["station", "_c"], "left").select(
        "station", "_m", F.explode(F.sequence(F.greatest(F.col("_a"), F.col("_c") * size),
                                              F.least(F.col("_b"), F.col("_c") * size + size - 1))).alias("_h"))
    whole = whole.withColumn("datetime", F.timestamp_add("HOUR", F.col("_h"), zero))
    return whole.select("station", "datetime", F.try_element_at("_m", F.col("datetime")).alias("v")).select(
        "station", "datetime", "v.*")


def panel_columns(agg: DataFrame, with_datetime: bool = False) -> DataFrame:
    """Aggregate -> raw panel layout (year, month, day, hour, station, numerics, wd)."""
    codes = F.array(*[F.lit(c) for c in EVENT_WIND_CODES])
    t = F.col("datetime")
    return agg.select(
        F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day"), F.hour(t).alias("hour"),
        "station",
        "y", "vmax", "vmin", "vsum",
        F.when(F.col("_n") > 0, F.col("_n").cast("double")).alias("n"),
        F.when(F.col("_u") > 0, F.col("_u").cast("double")).alias("users"),
        "k",
        F.when(F.col("_ksum").isNotNull(), F.element_at(
            codes, (F.pmod(F.col("_ksum"), F.lit(len(EVENT_WIND_CODES))) + 1).cast("int"))).alias("wd"),
        *([t] if with_datetime else []),
    )


def events_panel(spark: SparkSession, sf_dir: str, panel: str = "A", spec: PanelSpec = EVENTS_SPEC,
                 with_datetime: bool = False, densify: bool = True, sparse: DataFrame | None = None) -> DataFrame:
    """Raw hourly panel (CSV-like layout: year, month, day, hour, station, numerics, wd).

    Events are aggregated per (series, hour) (``hourly_aggregate``) and, unless
    ``densify=False``, densified over each series' range.  Pass a written ``sparse``
    aggregate to read the events only once.
    """
    agg = sparse if sparse is not None else hourly_aggregate(spark, sf_dir, panel)
    if densify:
        agg = densify_panel(agg, spec)
    return panel_columns(agg, with_datetime)
