"""Window / sequence operators (look-back windows of ``w`` hours per series).

A window for target hour *t* is the rows *t-w ... t-1* of the same series.  All
operators here run on (series, chunk) partitions with a ``w``-hour halo (see
lookback.py) and share one window specification, so Catalyst plans one Exchange,
one Sort and one Window node for all lags and frames of an operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..config import DELTA_HOURS, ROLLING_STATS, SPLITS, PanelSpec
from ..functions.exprs import epoch_hours, hours
from ..functions.permutation import permuted
from ..session import dealt
from .lookback import (CHUNK, GAP, HALO, PART, chunk_of, lookback_parts, lookback_tasks, lookback_window, with_gaps,
                       with_lookback_parts)

#: Hours from which block sides are cheaper than an array of the window per row (1.1 million rows with 7 inputs on 8 cores:
#: arrays 2.2 s for 24 hours and 6.6 s for 168, block sides 4.9 s and 4.7 s).
LONG_WINDOW = 96
#: Windows in a chunk of block sides: the halo copies one part in so many of the rows.
SIDE_CHUNK = 4

SEQUENCE_COLUMNS = ("sequence_id", "station", "split", "window_start_datetime", "window_end_datetime",
                    "target_datetime", "target")


def _valid_target(spec: PanelSpec, w: int, win: WindowSpec | None = None) -> Column:
    """Not a halo copy, ``w`` predecessors one hour apart (no gap, no repeated hour), observed target."""
    win = win or lookback_window(spec)
    start = F.lag(spec.time, w).over(win)
    return (
        ~F.col(HALO)
        & start.isNotNull()
        & (start == F.col(spec.time) - hours(w))
        & (F.sum(GAP).over(win.rowsBetween(1 - w, 0)) == 0)
        & F.col(spec.observed_target).isNotNull()
    )


def stored_order(df: DataFrame, order_cols: list[str], name: str) -> DataFrame:
    """``df`` written once in the total order, with ``_pid`` (range partition) and ``_mid`` (position) as columns.

    Bounds of a range partitioning are sampled anew for every plan, so counts and rows must come from the same
    written rows: whatever is derived from this table agrees, with or without exchange reuse and after retries.
    """
    from ..session import materialize

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
         .withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()))
    return materialize(x.withColumn("_mid", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)), name)


def _partition_offsets(x: DataFrame, amount: Column, name: str) -> DataFrame:
    """Sum of ``amount`` over all earlier range partitions (one row per partition)."""
    sums = x.groupBy("_pid").agg(amount.alias("_ps"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("_pid", F.coalesce(F.sum("_ps").over(before), F.lit(0)).alias(name))


def prefix_sum(df: DataFrame, order_cols: list[str], value: str, name: str) -> DataFrame:
    """Exclusive running sum of ``value`` in the total order ``order_cols``, distributed.

    The frame is written once in order; sums per range partition (a table with at most
    ``spark.sql.shuffle.partitions`` rows) give partition offsets, and the running sum inside each partition is
    added.  No single-partition window over the rows.
    """
    x = stored_order(df, order_cols, "prefix_sum")
    offs = _partition_offsets(x, F.sum(value), "_po")
    local = F.coalesce(F.sum(value).over(Window.partitionBy("_pid").orderBy("_mid").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    return x.join(F.broadcast(offs), "_pid").withColumn(name, F.col("_po") + local).drop("_pid", "_mid", "_po")


def dense_sequence_id(df: DataFrame, spec: PanelSpec, order_col: str, name: str = "sequence_id",
                      chunk_col: str | None = None) -> DataFrame:
    """0-based id in (series, time) order without a single-partition window over rows.

    Counts per (series, chunk) -> per-series totals; the running offset over series
    is a distributed prefix sum over the series table, the offset of each chunk
    within its series a running sum on the (series, chunk) table partitioned by series.  Rows then
    only need a ``row_number`` inside their (series, chunk).  Passing the ``_part``
    column of a look-back window as ``chunk_col`` reuses that window's partitioning,
    so the rows are not shuffled again.
    """
    from ..session import materialize

    st = spec.station
    ck = chunk_col or CHUNK
    x = df if chunk_col else df.withColumn(CHUNK, chunk_of(spec.with_(time=order_col)))
    # the count table (one row per series and chunk) is written once: the range
    # sampling of the prefix sum and the offsets then read it instead of re-running
    # the rows' upstream plan (e.g. a look-back window) for every job
    counts = materialize(x.groupBy(st, ck).agg(F.count(F.lit(1)).alias("_cnt")), "sequence_counts")
    totals = counts.groupBy(st).agg(F.sum("_cnt").alias("_tot"))
    series_off = prefix_sum(totals, [st], "_tot", "_soff").select(st, "_soff")
    chunk_off = counts.select(
        st, ck,
        F.coalesce(F.sum("_cnt").over(Window.partitionBy(st).orderBy(ck)
                                      .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_coff"))
    offsets = chunk_off.join(series_off, st)
    rn = F.row_number().over(Window.partitionBy(st, ck).orderBy(order_col))
    y = x.join(offsets, [st, ck])
    return y.withColumn(name, (F.col("_soff") + F.col("_coff") + rn - 1).cast("long")).drop(ck, "_soff", "_coff")


# ---------------------------------------------------------------- W1, W2, W3, W6


def sequence_index(processed: DataFrame, spec: PanelSpec, window: int | None = None,
                   with_id: bool = True) -> DataFrame:
    """One row per usable target; the split is the split of the *target* row."""
    w = window or spec.window
    x = with_lookback_parts(processed.select(spec.station, spec.time, spec.observed_target, "split"), spec, w)
    x = x.withColumn("_ok", _valid_target(spec, w)).filter("_ok")
    t = F.col(spec.time)
    idx = x.select(
        PART,
        F.col(spec.station).alias("station"),
        "split",
        (t - hours(w)).alias("window_start_datetime"),
        (t - hours(1)).alias("window_end_datetime"),
        t.alias("target_datetime"),
        F.col(spec.observed_target).cast("double").alias("target"),
    )
    if not with_id:
        return idx.drop(PART)
    # the look-back window runs once: counts and rows of the ids both come from the written rows
    from ..session import materialize

    idx = materialize(idx, "sequence_rows")
    # non-halo rows sit in their own chunk, so _part is the chunk of the target
    idx = dense_sequence_id(idx, spec.with_(station="station", time="target_datetime"), "target_datetime",
                            chunk_col=PART)
    return idx.select(*SEQUENCE_COLUMNS)


def filter_split(df: DataFrame, split: str) -> DataFrame:
    """W3."""
    if split not in SPLITS:
        raise ValueError(f"unknown split {split!r}; expected one of {SPLITS}")
    return df.filter(F.col("split") == split)


def resize_windows(index: DataFrame, window: int, source_window: int) -> DataFrame:
    """Keep the targets, keep only the last ``window`` hours of each window."""
    if window <= 0:
        raise ValueError("window must be positive")
    if window > source_window:
        raise ValueError(f"cannot grow windows from {source_window} to {window} hours")
    return index.withColumn("window_start_datetime", F.col("target_datetime") - hours(window))


# ---------------------------------------------------------------- W8-W12


def tabular_feature_names(spec: PanelSpec, feature_cols: list[str], window: int) -> list[str]:
    names = [f"latest_{c}" for c in feature_cols]
    names += [f"{spec.target}_lag_{k}" for k in range(window, 0, -1)]
    for stat in ROLLING_STATS:
        names += [f"{c}_{stat}_{window}" for c in spec.numeric]
    names += [f"{spec.target}_change_{h}h" for h in DELTA_HOURS if h < window]
    return names


def _field(c: str):
    return lambda r: r[c]


def _sq_dev(mean: Column):
    return lambda a, v: a + (v - mean) * (v - mean)


def history_features(h: DataFrame, keys: list, spec: PanelSpec, feature_cols: list[str], w: int,
                     full: int | None = None, latest: str | None = "_latest", hist: str = "_hist") -> DataFrame:
    """W8-W11 from an array column ``hist`` of the ``full`` (>= w) preceding rows, oldest first.

    ``hist`` needs the numeric columns only; ``latest`` names the struct of all model
    features at *t-1* (None: the newest element of ``hist``).  Only the last ``w``
    elements are used, so one array of the largest window serves every smaller size.

    Three projections: (1) one value array per numeric column, (2) its mean,
    (3) the two-pass population variance.  Each intermediate is referenced twice, so
    the optimiser keeps it as a column instead of re-evaluating it inside the
    variance lambda for every element.
    """
    full = full or w
    off = full - w  # elements to skip at the front
    arr = F.col(hist)

    def at(i: int) -> Column:  # i = 0 .. w-1 within the last-w window (0 = oldest)
        return F.element_at(arr, off + i + 1)

    newest = F.col(latest) if latest else at(w - 1)
    window_vals = F.slice(arr, off + 1, w) if off else arr
    base = [newest[c].alias(f"latest_{c}") for c in feature_cols]
    base += [at(w - k)[spec.target].alias(f"{spec.target}_lag_{k}") for k in range(w, 0, -1)]
    base += [F.transform(window_vals, _field(c)).alias(f"_v_{c}") for c in spec.numeric]
    x = h.select(*keys, *base)
    x = x.select("*", *[(F.aggregate(F.col(f"_v_{c}"), F.lit(0.0), lambda a, v: a + v) / F.lit(float(w)))
                        .alias(f"_m_{c}") for c in spec.numeric])
    var = {c: F.aggregate(F.col(f"_v_{c}"), F.lit(0.0), _sq_dev(F.col(f"_m_{c}"))) / F.lit(float(w)) for c in spec.numeric}
    out = [F.col(k) for k in x.columns[:len(keys)]]
    out += [F.col(f"latest_{c}") for c in feature_cols]
    out += [F.col(f"{spec.target}_lag_{k}") for k in range(w, 0, -1)]
    out += [F.col(f"_m_{c}").alias(f"{c}_mean_{w}") for c in spec.numeric]
    out += [F.sqrt(var[c]).alias(f"{c}_std_{w}") for c in spec.numeric]
    out += [F.array_min(f"_v_{c}").alias(f"{c}_min_{w}") for c in spec.numeric]
    out += [F.array_max(f"_v_{c}").alias(f"{c}_max_{w}") for c in spec.numeric]
    t = spec.target
    out += [(F.col(f"{t}_lag_1") - F.col(f"{t}_lag_{h + 1}")).alias(f"{t}_change_{h}h") for h in DELTA_HOURS if h < w]
    return x.select(*out)


def window_history(processed: DataFrame, spec: PanelSpec, feature_cols: list[str], window: int,
                   hist_cols: list[str] | None = None) -> DataFrame:
    """Valid targets with ``_hist`` (the ``window`` preceding rows of ``hist_cols``,
    oldest first) and ``_latest`` (all features at *t-1*).

    The sliding ``collect_list`` carries only the columns that need the whole window
    (the numeric inputs by default); the other features are needed at *t-1* only and
    come from one ``lag``.  The (non-pushable) filter to valid targets follows the
    window, and all statistics are array functions evaluated on target rows only.
    """
    w = window
    hcols = list(hist_cols or spec.numeric)
    cols = list(dict.fromkeys([*feature_cols, *hcols]))
    x = with_lookback_parts(processed.select(spec.station, spec.time, spec.observed_target, "split", *cols), spec, w)
    win = lookback_window(spec)
    hist = F.collect_list(F.struct(*[F.col(c) for c in hcols])).over(win.rowsBetween(-w, -1))
    latest = F.lag(F.struct(*[F.col(c) for c in feature_cols]), 1).over(win)
    x = x.select(spec.station, spec.time, spec.observed_target, "split", HALO,
                 hist.alias("_hist"), latest.alias("_latest"), _valid_target(spec, w).alias("_ok"))
    return x.filter("_ok").drop("_ok", HALO)


SIDE = ("n", "sum", "var", "min", "max")


def _block_side(c: str, win: WindowSpec) -> Column:
    """Running statistics of ``c`` from one end of a block."""
    fns = (F.count, F.sum, F.var_pop, F.min, F.max)
    return F.struct(*[fn(c).over(win).alias(s) for s, fn in zip(SIDE, fns, strict=True)]).alias(c)


def _window_sides(processed: DataFrame, spec: PanelSpec, feature_cols: list[str], windows: list[int]) -> DataFrame:
    """Valid targets of the largest window with what W8-W12 need of each size: ``_latest`` (all features at *t-1*),
    ``_lags`` (the target's values, oldest first) and the two sides ``_old_<w>``, ``_new_<w>`` of every window.

    Hours are cut into blocks of ``w`` hours since 1970.  The window *t-w ... t-1* touches at most two of them: it is
    the end of the block of *t-w* and the beginning of the block of *t-1*.  Running statistics from either end of a
    block are kept per row, so a row costs the same whatever ``w`` is, nothing is ever subtracted, and the numbers
    don't depend on the chunks.  Rows are shuffled once, by (series, chunk); both directions are sorts inside it.
    Chunks are joined until they are SIDE_CHUNK windows long, so a long window copies a quarter of the rows at most.
    """
    full = max(windows)
    cols = list(dict.fromkeys([*feature_cols, *spec.numeric]))
    if spec.chunk_hours and full <= spec.chunk_hours:
        spec = spec.with_(chunk_hours=spec.chunk_hours * -(-SIDE_CHUNK * full // spec.chunk_hours))
    rows = processed.select(spec.station, spec.time, spec.observed_target, "split", *cols)
    x = lookback_parts(rows, spec, full)
    tasks = lookback_tasks(rows, spec, full)
    x = dealt(x, tasks, spec.station, PART) if tasks else x.repartition(spec.station, PART)
    part, win = [spec.station, PART], lookback_window(spec)
    for w in sorted(set(windows)):
        x = x.withColumn("_block", F.floor(epoch_hours(spec.time) / F.lit(w)))
        ends = Window.partitionBy(*part, "_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        x = x.withColumn("_end", F.struct(*[_block_side(c, ends.orderBy(F.col(spec.time).desc())) for c in spec.numeric]))
        x = x.withColumn("_begin", F.struct(*[_block_side(c, ends.orderBy(spec.time)) for c in spec.numeric]))
        # the order of the second pass, so that it needs no sort of its own
        win = Window.partitionBy(*part).orderBy("_block", spec.time)
        x = x.withColumns({f"_old_{w}": F.lag("_end", w).over(win), f"_new_{w}": F.lag("_begin", 1).over(win)})
        x = x.drop("_end", "_begin")
    lags = F.collect_list(F.struct(spec.target)).over(win.rowsBetween(-full, -1))  # a struct keeps nulls in place
    latest = F.lag(F.struct(*feature_cols) if feature_cols else F.lit(None), 1).over(win)
    sides = [f"_{side}_{w}" for w in sorted(set(windows)) for side in ("old", "new")]
    x = with_gaps(x, spec, win).select(spec.station, spec.time, spec.observed_target, "split", *sides, lags.alias("_lags"),
                                       latest.alias("_latest"), _valid_target(spec, full, win).alias("_ok"))
    return x.filter("_ok").drop("_ok")


def _side_statistics(spec: PanelSpec, w: int) -> list[Column]:
    """Statistics of the window of ``w`` hours from its two sides; mean and deviation are null where a value is."""
    # a target at the beginning of a block has its whole window in the block before
    whole = F.pmod(epoch_hours(spec.time), F.lit(w)) == 0
    out = {stat: [] for stat in ROLLING_STATS}
    for c in spec.numeric:
        old, new = F.col(f"_old_{w}")[c], F.col(f"_new_{w}")[c]
        n, m = old["n"], F.when(whole, 0).otherwise(new["n"])
        mean = F.when(m == 0, old["sum"]).otherwise(old["sum"] + new["sum"]) / F.lit(float(w))
        apart = new["sum"] / m - old["sum"] / n
        squares = F.when(m == 0, n * old["var"]).otherwise(
            n * old["var"] + m * new["var"] + apart * apart * (n * m / F.lit(float(w))))
        known = n + m == F.lit(w)
        low, high = (pick(old[stat], F.when(~whole, new[stat])) for stat, pick in (("min", F.least), ("max", F.greatest)))
        # sums of equal values may differ in the last digit; their deviation is none
        deviation = F.when(low == high, 0.0).otherwise(F.sqrt(squares / F.lit(float(w))))
        for stat, value in (("mean", F.when(known, mean)), ("std", F.when(known, deviation)), ("min", low), ("max", high)):
            out[stat].append(value.alias(f"{c}_{stat}_{w}"))
    return [col for stat in ROLLING_STATS for col in out[stat]]


def _side_features(spec: PanelSpec, feature_cols: list[str], w: int, full: int) -> list[Column]:
    """The columns of ``tabular_feature_names`` for a window of ``w`` hours over ``_window_sides`` up to ``full`` hours."""

    def lag(k: int) -> Column:
        return F.element_at("_lags", full - k + 1)[spec.target]

    out = [F.col("_latest")[c].alias(f"latest_{c}") for c in feature_cols]
    out += [lag(k).alias(f"{spec.target}_lag_{k}") for k in range(w, 0, -1)]
    out += _side_statistics(spec, w)
    return out + [(lag(1) - lag(h + 1)).alias(f"{spec.target}_change_{h}h") for h in DELTA_HOURS if h < w]


def _target_keys(spec: PanelSpec) -> list[Column]:
    return [F.col(spec.station).alias("station"), F.col("split"), F.col(spec.time).alias("target_datetime"),
            F.col(spec.observed_target).cast("double").alias("target")]


def tabular_features(processed: DataFrame, spec: PanelSpec, feature_cols: list[str],
                     window: int | None = None) -> DataFrame:
    """Latest features, target lags, rolling mean/std/min/max, target changes."""
    w = window or spec.window
    return tabular_features_multi(processed, spec, feature_cols, [w])[w]


def tabular_features_multi(processed: DataFrame, spec: PanelSpec, feature_cols: list[str],
                           windows: list[int]) -> dict[int, DataFrame]:
    """Feature tables for several window sizes from one pass with the largest window.

    Targets are those valid for the largest window, so every size is evaluated on
    the same targets (as the ablation requires).  Windows beyond ``LONG_WINDOW`` hours take their statistics from
    block sides, at a cost per row that doesn't depend on the window; below it the array of the window is cheaper."""
    full = max(windows)
    if full > LONG_WINDOW:
        x = _window_sides(processed, spec, feature_cols, windows)
        return {w: x.select(*_target_keys(spec), *_side_features(spec, feature_cols, w, full)) for w in windows}
    h = window_history(processed, spec, feature_cols, full)
    return {w: history_features(h, _target_keys(spec), spec, feature_cols, w, full) for w in windows}


def tabular_features_union(processed: DataFrame, spec: PanelSpec, feature_cols: list[str], windows: list[int]) -> DataFrame:
    """One table with the features of several window sizes, from one pass with the largest window.

    Latest values, lags and changes of a smaller window are those of the largest one; each smaller window adds
    its statistics.  The targets are those valid for the largest window."""
    full = max(windows)
    smaller = sorted(set(windows) - {full}, reverse=True)
    if full > LONG_WINDOW:
        x = _window_sides(processed, spec, feature_cols, windows)
        return x.select(*_target_keys(spec), *_side_features(spec, feature_cols, full, full),
                        *[c for w in smaller for c in _side_statistics(spec, w)])
    x = window_history(processed, spec, feature_cols, full)
    x = history_features(x, [*_target_keys(spec), "_hist", "_latest"], spec, feature_cols, full)
    for w in smaller:
        own = x.columns
        stats = [f"{c}_{stat}_{w}" for stat in ROLLING_STATS for c in spec.numeric]
        held = [F.col(c).alias(c if c in ("_hist", "_latest") else f"_k_{c}") for c in own]
        y = history_features(x.select(*held), [c if c in ("_hist", "_latest") else f"_k_{c}" for c in own], spec, [], w, full)
        x = y.select(*[F.col(c) if c in ("_hist", "_latest") else F.col(f"_k_{c}").alias(c) for c in own], *stats)
    return x.drop("_hist", "_latest")


def lag_features(processed: DataFrame, spec: PanelSpec, window: int | None = None) -> DataFrame:
    """W8 on its own: target lags ``<target>_lag_w .. _lag_1`` (lag 1 newest)."""
    w = window or spec.window
    x = with_lookback_parts(processed.select(spec.station, spec.time, spec.observed_target, "split", spec.target), spec, w)
    win = lookback_window(spec)
    lags = [F.lag(spec.target, k).over(win).alias(f"{spec.target}_lag_{k}") for k in range(w, 0, -1)]
    x = x.select(spec.station, spec.time, spec.observed_target, "split", HALO, _valid_target(spec, w).alias("_ok"), *lags)
    return x.filter("_ok").select(
        F.col(spec.station).alias("station"), "split", F.col(spec.time).alias("target_datetime"),
        *[f"{spec.target}_lag_{k}" for k in range(w, 0, -1)])


def rolling_stats_plain(processed: DataFrame, spec: PanelSpec, window: int | None = None) -> DataFrame:
    """W9 as sliding window aggregates -- the test twin of the array path."""
    w = window or spec.window
    x = with_lookback_parts(processed.select(spec.station, spec.time, spec.observed_target, "split", *spec.numeric), spec, w)
    frame = lookback_window(spec).rowsBetween(-w, -1)
    stats = []
    for stat, fn in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max)):
        stats += [fn(c).over(frame).alias(f"{c}_{stat}_{w}") for c in spec.numeric]
    x = x.select(spec.station, spec.time, "split", HALO, _valid_target(spec, w).alias("_ok"), *stats)
    return x.filter("_ok").select(F.col(spec.station).alias("station"), "split",
                                  F.col(spec.time).alias("target_datetime"),
                                  *[c for c in x.columns if c.endswith(f"_{w}")])


# ---------------------------------------------------------------- W4, W5, W7, W17


def window_tensor(processed: DataFrame, spec: PanelSpec, feature_cols: list[str], window: int | None = None) -> DataFrame:
    """The ``w x F`` window of every target as ``array<array<double>>`` (time-major)."""
    w = window or spec.window
    h = window_history(processed, spec, feature_cols, w, hist_cols=feature_cols)
    rows = F.transform(F.col("_hist"), lambda r: F.array(*[r[c].cast("double") for c in feature_cols]))
    return h.select(F.col(spec.station).alias("station"), "split", F.col(spec.time).alias("target_datetime"),
                    F.col(spec.observed_target).cast("double").alias("target"), rows.alias("window"))


def target_history(processed: DataFrame, spec: PanelSpec, params, window: int | None = None) -> DataFrame:
    """The de-standardised target history (``w`` values, oldest first) per target."""
    from .preprocess import inverse_scale

    w = window or spec.window
    h = window_history(processed, spec, [spec.target], w, hist_cols=[spec.target])
    vals = F.transform(F.col("_hist"), lambda r: inverse_scale(r[spec.target], params, spec.target))
    return h.select(F.col(spec.station).alias("station"), "split", F.col(spec.time).alias("target_datetime"),
                    F.col(spec.observed_target).cast("double").alias("target"), vals.alias("history"))


def window_batches(index: DataFrame, batch_size: int, seed: int | None = None, epoch: int = 0) -> DataFrame:
    """Batch number per sequence; unshuffled by id, or in a seeded order, another one each epoch.

    The dense ids of ``sequence_index`` are shuffled by a keyed permutation, a projection without any exchange; it needs
    the number of rows, one aggregate over the id column.  Ids with gaps, repeats or nulls (an index filtered by
    split) are ranked by a hash instead, which sorts them.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    if seed is None:
        return index.withColumn("batch_id", F.floor(F.col("sequence_id") / F.lit(batch_size)).cast("long"))
    n = _dense_size(index)
    if n:
        place = permuted(F.col("sequence_id"), n, seed, epoch)
        return index.withColumn("batch_id", F.call_function("div", place, F.lit(batch_size).cast("long")))
    mixed = str(seed) if not epoch else f"{seed}/{epoch}"
    key = F.md5(F.concat_ws(":", F.lit(mixed), F.col("sequence_id").cast("string")))
    ranked = global_rank(index.withColumn("_k", key), ["_k", "sequence_id"], "_r")
    return ranked.withColumn("batch_id", F.floor(F.col("_r") / F.lit(batch_size)).cast("long")).drop("_k", "_r")


def _dense_size(index: DataFrame) -> int:
    """Number of rows if the ids are 0 .. n-1, each once (as the exclusive or of 64-bit hashes tells); else 0."""
    x = F.col("sequence_id").cast("long")
    n, known, low, high, own = index.agg(F.count(F.lit(1)), F.count(x), F.min(x), F.max(x), F.bit_xor(F.xxhash64(x))).first()
    if not n or known < n or low != 0 or high != n - 1:
        return 0
    every = index.sparkSession.range(n).agg(F.bit_xor(F.xxhash64("id"))).first()[0]
    return n if own == every else 0


def global_rank(df: DataFrame, order_cols: list[str], name: str) -> DataFrame:
    """0-based position in a total order, without a single-partition window.

    The frame is written once, range-partitioned and sorted by the key, with each row's partition and position;
    row counts per partition (at most ``spark.sql.shuffle.partitions`` rows, so broadcasting them is bounded)
    give the offsets.  The order key must be unique for the result to be deterministic.
    """
    x = stored_order(df, order_cols, "global_rank")
    offsets = _partition_offsets(x, F.count(F.lit(1)), "_off")
    return (x.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_mid")).cast("long")).drop("_pid", "_mid", "_off"))


def deterministic_sample(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Seeded sample of ``n`` rows without replacement (all rows if fewer).

    ``orderBy(md5(seed:key)).limit(n)`` plans as TakeOrderedAndProject: every task
    keeps its own top ``n`` and only those reach the final merge.
    """
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")
