"""Independent wide windows: one row per window with ``<col>_lag_<k>`` columns.

Each row already holds its whole window, so everything here is map-only -- no
shuffle at all: each column's lags become one array (oldest first), the fill
*inside* a window is one left fold over it, the per-hour features are one lambda
over the zipped arrays, and the tabular features reuse the array functions of the
panel path.  The long (one row per hour) form is an ``inline`` of that array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PanelSpec
from ..functions.exprs import hours, nan_to_null, time_feature_columns, wind_feature_columns
from .lookback import GAP, HALO, lookback_window, with_lookback_parts
from .preprocess import FittedParams, inverse_scale
from .windows import history_features

TIME_PARTS = ("year", "month", "day", "hour")


def wide_columns(spec: PanelSpec) -> list[str]:
    return list(TIME_PARTS) + list(spec.numeric) + ([spec.wind] if spec.wind else [])


def lag_name(c: str, k: int) -> str:
    return f"{c}_lag_{k}"


def build_wide_windows(raw_panel: DataFrame, spec: PanelSpec, anchor: Column | None = None,
                       window: int | None = None) -> DataFrame:
    """Wide windows from a panel: for every anchor hour *t*, the raw rows *t-w .. t-1*
    of the series as ``<col>_lag_<k>`` (k = w .. 1), plus ``id`` and ``station``.

    Default anchors: every hour with a whole window before it; ``anchor`` narrows them.  The lags come from
    one (series, chunk) window with a ``w``-hour halo.
    """
    from .preprocess import add_datetime

    w = window or spec.window
    cols = wide_columns(spec)
    x = add_datetime(raw_panel, spec)
    x = with_lookback_parts(x.select(spec.station, spec.time, *cols), spec, w)
    win = lookback_window(spec)
    anchor = anchor if anchor is not None else F.lit(True)
    start = F.lag(spec.time, w).over(win)
    lags = [F.lag(c, k).over(win).alias(lag_name(c, k)) for k in range(w, 0, -1) for c in cols]
    whole = F.sum(GAP).over(win.rowsBetween(1 - w, 0)) == 0
    ok = (~F.col(HALO)) & start.isNotNull() & (start == F.col(spec.time) - hours(w)) & whole & anchor
    x = x.select(spec.station, spec.time, ok.alias("_ok"), *lags).filter("_ok")
    wid = F.concat(F.lit("w_"), F.col(spec.station), F.lit("_"), F.date_format(spec.time, "yyyyMMddHH"))
    return x.select(wid.alias("id"), F.col(spec.station).alias("station"),
                    *[lag_name(c, k) for k in range(w, 0, -1) for c in cols])


def lag_datetime(k: int) -> Column:
    return F.make_timestamp_ntz(*[F.col(lag_name(p, k)) for p in TIME_PARTS], F.lit(0), F.lit(0))


def wide_to_long(wide: DataFrame, spec: PanelSpec, window: int | None = None) -> DataFrame:
    """24 rows per window, ``time_step`` 0 = lag w (oldest) ... w-1 = lag 1."""
    w = window or spec.window
    cols = wide_columns(spec)
    steps = [F.struct(F.lit(j).cast("long").alias("time_step"), lag_datetime(w - j).alias(spec.time),
                      *[F.col(lag_name(c, w - j)).alias(c) for c in cols]) for j in range(w)]
    return wide.select("id", "station", F.inline(F.array(*steps)))


def _ffill_array(raw: Column) -> Column:
    """Forward fill inside one array (oldest first): a single left fold."""
    init = F.struct(F.array().cast("array<double>").alias("o"), F.lit(None).cast("double").alias("l"))

    def step(acc, x):
        v = F.coalesce(x, acc["l"])
        return F.struct(F.array_append(acc["o"], v).alias("o"), v.alias("l"))

    return F.aggregate(raw, init, step, lambda acc: acc["o"])


def _scaler(med: Column, mean: Column, std: Column):
    return lambda v: (F.coalesce(v, med) - mean) / std


def wide_history(wide: DataFrame, spec: PanelSpec, params: FittedParams, window: int | None = None) -> DataFrame:
    """Per window: ``_hist`` = array of w feature structs, oldest first (map-only).

    Each column's lags become one array; the fill inside the window is one fold over
    it, medians and scaling are a ``transform``, and the per-hour feature struct is
    built by one lambda over the zipped arrays.  Compared with per-lag column
    expressions this keeps the plan small: planning time does not grow with w x F.
    """
    w = window or spec.window
    lags = range(w, 0, -1)  # oldest first
    arrays = [F.array(*[nan_to_null(F.col(lag_name(c, k)).cast("double")) for k in lags]).alias(f"r_{c}")
              for c in spec.numeric]
    arrays.append(F.array(*[lag_datetime(k) for k in lags]).alias("t_"))
    if spec.wind:
        arrays.append(F.array(*[F.col(lag_name(spec.wind, k)) for k in lags]).alias("w_"))
    x = wide.select("id", "station", *arrays)
    scaled = [F.transform(_ffill_array(F.col(f"r_{c}")),
                          _scaler(F.lit(params.medians[c]), F.lit(params.means[c]), F.lit(params.stds[c]))).alias(f"s_{c}")
              for c in spec.numeric]
    x = x.select("*", *scaled)
    zipped = F.arrays_zip(*[F.col(f"s_{c}") for c in spec.numeric], *[F.col(f"r_{c}") for c in spec.numeric],
                          F.col("t_"), *([F.col("w_")] if spec.wind else []))
    station = F.col("station")

    def features(r):
        out = [r[f"s_{c}"].alias(c) for c in spec.numeric]
        out += time_feature_columns(r["t_"])
        if spec.wind:
            out += wind_feature_columns(r["w_"])
        out += [r[f"r_{c}"].isNull().cast("double").alias(f"{c}_missing") for c in spec.numeric]
        if params.onehot:
            out += [(station == F.lit(s)).cast("double").alias(f"{spec.station}_{s}") for s in params.stations]
        return F.struct(*out)

    return x.select("id", "station", F.transform(zipped, features).alias("_hist"))


def wide_features(wide: DataFrame, spec: PanelSpec, params: FittedParams, window: int | None = None) -> DataFrame:
    """Long model frame (id, station, time_step, features) with the in-window fill
    and fit-time medians / scaler."""
    w = window or spec.window
    h = wide_history(wide, spec, params, w)
    steps = F.transform(F.col("_hist"), lambda r, i: F.struct(i.cast("long").alias("time_step"), r.alias("f")))
    return h.select("id", "station", F.inline(steps)).select("id", "station", "time_step", "f.*")


def wide_metadata(wide: DataFrame, spec: PanelSpec, window: int | None = None) -> DataFrame:
    """Window start, end and target time (end + 1 hour)."""
    w = window or spec.window
    end = lag_datetime(1)
    return wide.select("id", "station", lag_datetime(w).alias("window_start_datetime"),
                       end.alias("window_end_datetime"), (end + hours(1)).alias("target_datetime"))


def wide_tabular(wide: DataFrame, spec: PanelSpec, params: FittedParams, window: int | None = None) -> DataFrame:
    """The tabular features of the panel path, from independent windows."""
    from .preprocess import feature_names

    w = window or spec.window
    h = wide_history(wide, spec, params, w)
    return history_features(h, ["id", "station"], spec, feature_names(spec, params), w, latest=None)


def wide_baselines(wide: DataFrame, spec: PanelSpec, params: FittedParams, window: int | None = None) -> DataFrame:
    """Persistence and window mean of independent windows (imputed target, original units)."""
    w = window or spec.window
    h = wide_history(wide, spec, params, w)
    ys = F.transform(F.col("_hist"), lambda r: inverse_scale(r[spec.target], params, spec.target))
    return h.select("id", "station", F.element_at(ys, w).alias("persistence"),
                    (F.aggregate(ys, F.lit(0.0), lambda a, v: a + v) / F.lit(float(w))).alias("window_mean"))


def window_steps(wide: DataFrame, spec: PanelSpec, window: int | None = None) -> DataFrame:
    """Consecutive-lag time steps that are not exactly one hour (V5 for wide windows)."""
    w = window or spec.window
    bad = [F.when(lag_datetime(k - 1) - lag_datetime(k) != hours(1), F.lit(k)) for k in range(w, 1, -1)]
    return wide.select("id", F.filter(F.array(*bad), lambda x: x.isNotNull()).alias("_bad")) \
        .select("id", F.explode("_bad").alias("lag")).withColumn("lag", F.col("lag").cast("long"))

