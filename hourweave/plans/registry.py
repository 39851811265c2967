"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and reads the driver tables (through the
shared stages of ``context``); outputs are rounded at the boundary with
``functions.rounded`` so they compare equal to the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DELTA_HOURS, EVENTS_SPEC, SPLITS, TIME_FEATURES, WIND_FEATURES
from ..functions.exprs import rounded
from ..operators import ensemble as EN
from ..operators import evaluate as E
from ..operators import forecast as FC
from ..operators import preprocess as P
from ..operators import windows as W
from ..operators.lsqr import fit_ridge_lsqr
from . import oracle as O
from .context import context

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

S = EVENTS_SPEC
NUM = list(S.numeric)
KEYS_T = ["station", "datetime"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def ctx(spark, sf_dir, panel="A"):
    return context(spark, sf_dir, panel)


# ================================================================ preprocessing


@register("panel_raw", O.wrap("SELECT year, month, day, hour, station, y, vmax, vmin, vsum, n, users, k, wd FROM raw",
                              floats=NUM, ints=["year", "month", "day", "hour"]))
def q_panel_raw(spark, sf):
    return rounded(ctx(spark, sf).raw().select("year", "month", "day", "hour", "station", *NUM, "wd"))


@register("add_datetime", O.wrap("SELECT station, datetime, year, month, day, hour FROM raw",
                                 ints=["year", "month", "day", "hour"]))
def q_add_datetime(spark, sf):
    raw = ctx(spark, sf).raw().drop("datetime")  # rebuilt from year / month / day / hour
    return rounded(P.add_datetime(raw, S).select("station", "datetime", "year", "month", "day", "hour"))


@register("assign_split", O.wrap(
    "SELECT station, datetime, split, CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END AS split_order "
    "FROM prep", ints=["split_order"]))
def q_assign_split(spark, sf):
    x = P.prepare(ctx(spark, sf).raw(), S)
    return rounded(x.select("station", "datetime", "split", P.split_order("split").alias("split_order")))


@register("missing_flags", O.wrap(
    f"SELECT station, datetime, {O._list(f'CAST({c} IS NULL AS DOUBLE) AS {c}_missing' for c in NUM)} FROM prep",
    floats=[f"{c}_missing" for c in NUM]))
def q_missing_flags(spark, sf):
    x = P.prepare(ctx(spark, sf).raw(), S)
    return rounded(x.select("station", "datetime", *P.missing_flag_columns(S)))


@register("ffill", O.wrap(f"SELECT station, datetime, {O._list(NUM)} FROM ffilled", floats=NUM))
def q_ffill(spark, sf):
    x = P.prepare(ctx(spark, sf).raw(), S)
    return rounded(P.forward_fill(x, S).select("station", "datetime", *NUM))


def _unpivot_sql(cte: str, value: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS {value} FROM {cte}" for c in NUM)


@register("fit_medians", O.wrap(_unpivot_sql("med", "median"), floats=["median"]))
def q_fit_medians(spark, sf):
    train = P.prepare(ctx(spark, sf).raw(), S).filter(F.col("split") == "train")
    return rounded(P.median_table(train, S))


_SC_SQL = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c}_m AS mean, {c}_s AS std FROM sc" for c in NUM)


@register("fit_scaler", O.wrap(_SC_SQL, floats=["mean", "std"]))
def q_fit_scaler(spark, sf):
    train = ctx(spark, sf).imputed().filter(F.col("split") == "train")
    return rounded(P.scaler_table(train, S))


@register("fit_params", O.wrap(
    f"SELECT m.\"column\", m.median, s.mean, s.std FROM ({_unpivot_sql('med', 'median')}) m "
    f"JOIN ({_SC_SQL}) s ON m.\"column\" = s.\"column\"", floats=["median", "mean", "std"]))
def q_fit_params(spark, sf):
    c = ctx(spark, sf)
    train_raw = P.prepare(c.raw(), S).filter(F.col("split") == "train")
    train_imp = c.imputed().filter(F.col("split") == "train")
    return rounded(P.median_table(train_raw, S).join(P.scaler_table(train_imp, S), "column"))


@register("impute", O.wrap(f"SELECT station, datetime, target_y, {O._list(NUM)} FROM filled", floats=["target_y"] + NUM))
def q_impute(spark, sf):
    return rounded(ctx(spark, sf).imputed().select("station", "datetime", S.observed_target, *NUM))


@register("time_features", O.wrap(f"SELECT station, datetime, {O._list(O._time_feats('datetime'))} FROM prep",
                                  floats=list(TIME_FEATURES)))
def q_time_features(spark, sf):
    from ..functions.exprs import time_feature_columns

    x = P.prepare(ctx(spark, sf).raw(), S)
    return rounded(x.select("station", "datetime", *time_feature_columns("datetime")))


@register("wind_features", O.wrap(f"SELECT station, datetime, wd, {O._list(O._wind_feats('wd'))} FROM prep",
                                  floats=list(WIND_FEATURES)))
def q_wind_features(spark, sf):
    from ..functions.exprs import wind_feature_columns

    x = P.prepare(ctx(spark, sf).raw(), S)
    return rounded(x.select("station", "datetime", "wd", *wind_feature_columns("wd")))


_ONEHOT = [f"station_{s}" for s in O.STATIONS_A]


@register("station_onehot", O.wrap(f"SELECT station, datetime, {O._list(_ONEHOT)} FROM proc", floats=_ONEHOT))
def q_station_onehot(spark, sf):
    c = ctx(spark, sf)
    return rounded(c.processed().select("station", "datetime", *[f"station_{s}" for s in c.params().stations]))


@register("scale", O.wrap(f"SELECT station, datetime, {O._list(NUM)} FROM proc", floats=NUM))
def q_scale(spark, sf):
    return rounded(ctx(spark, sf).processed().select("station", "datetime", *NUM))


@register("inverse_scale", O.wrap("SELECT station, datetime, y AS y_original FROM filled", floats=["y_original"]))
def q_inverse_scale(spark, sf):
    c = ctx(spark, sf)
    return rounded(c.processed().select("station", "datetime",
                                        P.inverse_scale(F.col("y"), c.params(), "y").alias("y_original")))


@register("preprocess", O.wrap("SELECT * FROM proc", floats=["target_y"] + list(O.FEATURES)))
def q_preprocess(spark, sf):
    return rounded(ctx(spark, sf).processed())


_POLL = P.select_feature_set(list(O.FEATURES), S, "pollution_only")


@register("feature_set_select", O.wrap(f"SELECT datetime, station, {O._list(_POLL)} FROM proc", floats=_POLL))
def q_feature_set_select(spark, sf):
    c = ctx(spark, sf)
    cols = P.select_feature_set(c.feature_names(), S, "pollution_only")
    return rounded(c.processed().select("datetime", "station", *cols))


# ================================================================ windows

_SEQ_F = ["target"]
_SEQ_I = ["sequence_id"]


@register("sequence_index", O.wrap("SELECT * FROM seq", floats=_SEQ_F, ints=_SEQ_I))
def q_sequence_index(spark, sf):
    return rounded(W.sequence_index(ctx(spark, sf).processed(), S))


@register("split_filter", O.wrap("SELECT * FROM seq WHERE split = 'validation'", floats=_SEQ_F, ints=_SEQ_I))
def q_split_filter(spark, sf):
    return rounded(W.filter_split(W.sequence_index(ctx(spark, sf).processed(), S), "validation"))


@register("window_resize", O.wrap(
    "SELECT sequence_id, station, split, target_datetime - INTERVAL 6 HOUR AS window_start_datetime, "
    "window_end_datetime, target_datetime, target FROM seq", floats=_SEQ_F, ints=_SEQ_I))
def q_window_resize(spark, sf):
    return rounded(W.resize_windows(W.sequence_index(ctx(spark, sf).processed(), S), 6, S.window))


_TAB_SQL, _TAB_NAMES = O.tabular_select()
_LAGS = [f"y_lag_{k}" for k in range(S.window, 0, -1)]
_ROLL = [n for n in _TAB_NAMES if n.endswith(f"_{S.window}") and not n.startswith("y_lag")]
_DELTA = [f"y_change_{h}h" for h in DELTA_HOURS if h < S.window]
_LATEST = [f"latest_{c}" for c in O.FEATURES]


def _tab_sub(cols):
    return O.wrap(f"SELECT station, split, target_datetime, {O._list(cols)} FROM ({_TAB_SQL}) t", floats=cols)


def _tab(spark, sf):
    c = ctx(spark, sf)
    return W.tabular_features(c.processed(), S, c.feature_names())


@register("lag_features", _tab_sub(_LAGS))
def q_lag_features(spark, sf):
    return rounded(W.lag_features(ctx(spark, sf).processed(), S))


@register("rolling_stats", _tab_sub(_ROLL))
def q_rolling_stats(spark, sf):
    return rounded(_tab(spark, sf).select("station", "split", "target_datetime", *_ROLL))


@register("rolling_stats_plain", _tab_sub(_ROLL))
def q_rolling_stats_plain(spark, sf):
    return rounded(W.rolling_stats_plain(ctx(spark, sf).processed(), S))


@register("delta_features", _tab_sub(_DELTA))
def q_delta_features(spark, sf):
    return rounded(_tab(spark, sf).select("station", "split", "target_datetime", *_DELTA))


@register("latest_features", _tab_sub(_LATEST))
def q_latest_features(spark, sf):
    return rounded(_tab(spark, sf).select("station", "split", "target_datetime", *_LATEST))


@register("tabular_features", O.wrap(_TAB_SQL, floats=["target"] + _TAB_NAMES))
def q_tabular_features(spark, sf):
    return rounded(_tab(spark, sf))


@register("window_tensor")
def q_window_tensor(spark, sf):
    c = ctx(spark, sf)
    return W.window_tensor(c.processed(), S, c.feature_names())


@register("target_history")
def q_target_history(spark, sf):
    c = ctx(spark, sf)
    return W.target_history(c.processed(), S, c.params())


@register("window_tensor_steps", O.wrap(
    f"SELECT s.station, s.target_datetime, {S.window} - date_diff('hour', p.datetime, s.target_datetime) AS step, "
    f"{len(O.FEATURES)} AS features, {' + '.join('p.' + f for f in O.FEATURES)} AS total FROM seq s JOIN proc p "
    f"ON p.station = s.station AND p.datetime >= s.window_start_datetime AND p.datetime <= s.window_end_datetime",
    floats=["total"], ints=["step", "features"]))
def q_window_tensor_steps(spark, sf):
    """The tensor's time steps as rows: number of features and their sum."""
    c = ctx(spark, sf)
    x = W.window_tensor(c.processed(), S, c.feature_names())
    return rounded(x.select("station", "target_datetime", F.posexplode("window").alias("step", "row")).select(
        "station", "target_datetime", "step", F.size("row").alias("features"),
        F.aggregate("row", F.lit(0.0), lambda a, v: a + v).alias("total")))


@register("target_history_steps", O.wrap(
    f"SELECT s.station, s.split, s.target_datetime, s.target, {S.window} - date_diff('hour', f.datetime, s.target_datetime) AS step, "
    "f.y AS value FROM seq s JOIN filled f ON f.station = s.station AND f.datetime >= s.window_start_datetime "
    "AND f.datetime <= s.window_end_datetime", floats=["target", "value"], ints=["step"]))
def q_target_history_steps(spark, sf):
    c = ctx(spark, sf)
    x = W.target_history(c.processed(), S, c.params())
    return rounded(x.select("station", "split", "target_datetime", "target", F.posexplode("history").alias("step", "value")))


@register("window_batches", O.wrap("SELECT sequence_id, sequence_id // 512 AS batch_id FROM seq",
                                   ints=["sequence_id", "batch_id"]))
def q_window_batches(spark, sf):
    idx = W.sequence_index(ctx(spark, sf).processed(), S)
    return rounded(W.window_batches(idx, 512).select("sequence_id", "batch_id"))


def _permutation_ctes(seed: int, epoch: int = 0) -> str:
    """``walk``: every sequence id with where a seeded permutation sends it, walking on until that is an id again."""
    def key(j, name):
        return f"(CAST('0x' || substr(md5('{seed}/{epoch}/{j}/{name}'), 1, 7) AS BIGINT) + 1)"

    prime = 2147483647
    inner = "SELECT sequence_id, n, a, b, pos % a AS l0, pos // a AS h0 FROM {source}"
    for j in range(6):
        given, moved, size = ("l", "h", "b") if j % 2 else ("h", "l", "a")
        u = f"(({given}{j} * {key(j, 'factor')} + {key(j, 'offset')}) % {prime})"
        inner = (f"SELECT sequence_id, n, a, b, {given}{j} AS {given}{j + 1}, "
                 f"({moved}{j} + ((u * u) % {prime} * u + u) % {prime}) % {size} AS {moved}{j + 1} "
                 f"FROM (SELECT *, {u} AS u FROM ({inner}) AS r{j}) AS u{j}")
    once = f"SELECT sequence_id, n, a, b, l6 + a * h6 AS pos FROM ({inner}) AS r6"
    return (", size AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM seq), "
            "ids AS (SELECT s.sequence_id, z.n, z.a, (z.n + z.a - 1) // z.a AS b, s.sequence_id AS pos FROM seq s, size z), "
            f"walk AS ({once.format(source='ids')} UNION ALL {once.format(source='(SELECT * FROM walk WHERE pos >= n) AS w')})")


@register("window_batches_shuffled", O.wrap(
    "SELECT sequence_id, pos // 512 AS batch_id FROM walk WHERE pos < n", ints=["sequence_id", "batch_id"],
    ctes="RECURSIVE " + O.panel_ctes() + _permutation_ctes(42)))
def q_window_batches_shuffled(spark, sf):
    idx = W.sequence_index(ctx(spark, sf).processed(), S)
    return rounded(W.window_batches(idx, 512, seed=42).select("sequence_id", "batch_id"))


@register("deterministic_sample", O.wrap(
    "SELECT * FROM seq ORDER BY md5(concat_ws(':', '42', CAST(sequence_id AS VARCHAR))), sequence_id LIMIT 500",
    floats=_SEQ_F, ints=_SEQ_I))
def q_deterministic_sample(spark, sf):
    idx = W.sequence_index(ctx(spark, sf).processed(), S)
    return rounded(W.deterministic_sample(idx, 500, 42, "sequence_id"))


# ================================================================ forecasts


def _wide_fc(spark, sf):
    c = ctx(spark, sf)
    return FC.baseline_forecasts(c.processed(), S, c.params())


def _preds(spark, sf):
    return FC.to_long(_wide_fc(spark, sf), ["persistence", "window_mean"])


_PRED_F = ["y_true", "y_pred"]


@register("forecast_persistence", O.wrap(
    "SELECT station, split, target_datetime, y_true, y_pred FROM cpreds WHERE model = 'persistence'", floats=_PRED_F))
def q_forecast_persistence(spark, sf):
    wide = _wide_fc(spark, sf)
    return rounded(wide.select("station", "split", "target_datetime", "y_true",
                               FC.clip_predictions("persistence").alias("y_pred")))


@register("forecast_window_mean", O.wrap(
    "SELECT station, split, target_datetime, y_true, y_pred FROM cpreds WHERE model = 'window_mean'", floats=_PRED_F))
def q_forecast_window_mean(spark, sf):
    wide = _wide_fc(spark, sf)
    return rounded(wide.select("station", "split", "target_datetime", "y_true",
                               FC.clip_predictions("window_mean").alias("y_pred")))


@register("prediction_residuals", O.wrap("SELECT *, y_true - y_pred AS residual FROM cpreds",
                                         floats=_PRED_F + ["residual"]))
def q_prediction_residuals(spark, sf):
    p = E.prepare_predictions(_preds(spark, sf))
    return rounded(p.withColumn("residual", F.col("y_true") - F.col("y_pred")))


def _tab_written(spark, sf):
    """Tabular features written once per session (model fits make several passes)."""
    from ..session import materialize

    c = ctx(spark, sf)
    return c._memo("tabular", lambda: materialize(W.tabular_features(c.processed(), S, c.feature_names()), "tabular"))


@register("forecast_ridge")
def q_forecast_ridge(spark, sf):
    tab = _tab_written(spark, sf)
    names = [n for n in tab.columns if n not in ("station", "split", "target_datetime", "target")]
    model = FC.fit_ridge(tab.filter(F.col("split") == "train"), names)
    return FC.score(model, tab.filter(F.col("split") != "train"), "ridge")


@register("forecast_gbt")
def q_forecast_gbt(spark, sf):
    tab = _tab_written(spark, sf)
    names = [n for n in tab.columns if n not in ("station", "split", "target_datetime", "target")]
    model = FC.fit_gbt(tab.filter(F.col("split") == "train"), names)
    return FC.score(model, tab.filter(F.col("split") != "train"), "gbt")


# ================================================================ evaluation

_MF = ["rmse", "mae", "r2"]
_MI = ["samples"]


@register("metrics_overall", O.wrap("SELECT * FROM movr", floats=_MF, ints=_MI))
def q_metrics_overall(spark, sf):
    return rounded(E.metrics_overall(_preds(spark, sf)))


@register("metrics_by_station", O.wrap("SELECT * FROM mst", floats=_MF, ints=_MI))
def q_metrics_by_station(spark, sf):
    return rounded(E.metrics_by_station(_preds(spark, sf)))


def _ranges_values() -> str:
    from ..config import TARGET_RANGES

    rows = []
    for label, lo, hi, incl in TARGET_RANGES:
        rows.append(f"('{label}', {lo}, {'NULL' if hi is None else hi}, {'true' if incl else 'false'})")
    return "(VALUES " + ", ".join(rows) + ") AS r(label, lo, hi, lo_incl)"


@register("metrics_by_range", O.wrap(
    f"SELECT model, split, r.label AS pollution_range, {O.metric_cols()} FROM cpreds JOIN {_ranges_values()} "
    "ON (CASE WHEN r.lo_incl THEN y_true >= r.lo ELSE y_true > r.lo END) AND (r.hi IS NULL OR y_true <= r.hi) "
    "GROUP BY model, split, r.label", floats=_MF, ints=_MI))
def q_metrics_by_range(spark, sf):
    return rounded(E.metrics_by_range(_preds(spark, sf)))


@register("metrics_long", O.wrap(
    f"SELECT model, split, station, {O.metric_cols()} FROM cpreds "
    "GROUP BY GROUPING SETS ((model, split), (model, split, station))", floats=_MF, ints=_MI))
def q_metrics_long(spark, sf):
    return rounded(E.metrics_long(_preds(spark, sf)))


@register("metrics_pivot", O.wrap(
    "SELECT model, " + ", ".join(f"max(CASE WHEN split = '{s}' THEN rmse END) AS {s}" for s in SPLITS)
    + " FROM movr GROUP BY model", floats=list(SPLITS)))
def q_metrics_pivot(spark, sf):
    return rounded(E.metrics_pivot(E.metrics_overall(_preds(spark, sf))))


_RELABEL = {"persistence": "Persistence", "window_mean": "Window mean"}


@register("model_ranking", O.wrap(
    "SELECT CASE model WHEN 'persistence' THEN 'Persistence' WHEN 'window_mean' THEN 'Window mean' ELSE model END "
    "AS model, split, samples, rmse, mae, r2, rank() OVER (PARTITION BY split ORDER BY rmse) AS rank FROM movr",
    floats=_MF, ints=_MI + ["rank"]))
def q_model_ranking(spark, sf):
    return rounded(E.model_ranking(E.metrics_overall(_preds(spark, sf)), _RELABEL))


@register("model_ranking_union", O.wrap(
    "SELECT model, split, samples, rmse, mae, r2, rank() OVER (PARTITION BY split ORDER BY rmse) AS rank FROM movr",
    floats=_MF, ints=_MI + ["rank"]))
def q_model_ranking_union(spark, sf):
    """Metric tables that were made model by model, united and ranked."""
    p = _preds(spark, sf)
    tables = [E.metrics_overall(p.filter(F.col("model") == m)) for m in ("persistence", "window_mean")]
    return rounded(E.model_ranking(E.union_metrics(*tables)))


@register("range_extract", O.wrap(
    f"SELECT model, split, r.label AS pollution_range, {O.metric_cols()} FROM cpreds JOIN {_ranges_values()} "
    "ON (CASE WHEN r.lo_incl THEN y_true >= r.lo ELSE y_true > r.lo END) AND (r.hi IS NULL OR y_true <= r.hi) "
    "WHERE model = 'window_mean' AND split = 'validation' GROUP BY model, split, r.label", floats=_MF, ints=_MI))
def q_range_extract(spark, sf):
    return rounded(E.range_extract(E.metrics_by_range(_preds(spark, sf)), "window_mean", "validation"))


@register("best_model", O.wrap("SELECT * FROM movr WHERE split = 'validation' ORDER BY rmse, model LIMIT 1",
                               floats=_MF, ints=_MI))
def q_best_model(spark, sf):
    return rounded(E.best_model(E.metrics_overall(_preds(spark, sf))))


@register("station_ranking", O.wrap(
    "SELECT * FROM mst WHERE model = 'window_mean' AND split = 'validation'", floats=_MF, ints=_MI))
def q_station_ranking(spark, sf):
    return rounded(E.station_ranking(E.metrics_by_station(_preds(spark, sf)), "window_mean", "validation"))


@register("prediction_summary", O.wrap(
    "SELECT model, count(*) AS rows, min(y_pred) AS min, max(y_pred) AS max, avg(y_pred) AS mean, "
    "stddev_samp(y_pred) AS std, sum(CASE WHEN y_pred IS NULL OR isnan(y_pred) OR isinf(y_pred) THEN 1 ELSE 0 END) AS missing, "
    "sum(CASE WHEN y_pred < 0 THEN 1 ELSE 0 END) AS negative FROM cpreds GROUP BY model",
    floats=["min", "max", "mean", "std"], ints=["rows", "missing", "negative"]))
def q_prediction_summary(spark, sf):
    return rounded(E.prediction_summary(E.prepare_predictions(_preds(spark, sf))))


@register("metrics_recombine", O.wrap(
    "SELECT model, split, sum(samples) AS samples, sqrt(sum(samples * rmse * rmse) / sum(samples)) AS rmse, "
    "sum(samples * mae) / sum(samples) AS mae FROM mst GROUP BY model, split", floats=["rmse", "mae"], ints=_MI))
def q_metrics_recombine(spark, sf):
    return rounded(E.recombine_overall(E.metrics_by_station(_preds(spark, sf))))


# ================================================================ ensemble

_PAIR = "SELECT station, split, target_datetime, y_true, persistence AS pred_first, window_mean AS pred_second FROM fc"


def _pair(spark, sf):
    return EN.wide_pair(_wide_fc(spark, sf), "persistence", "window_mean")


@register("ensemble_blend", O.wrap(
    f"SELECT *, 0.25 * pred_first + 0.75 * pred_second AS y_pred FROM ({_PAIR}) p",
    floats=["y_true", "pred_first", "pred_second", "y_pred"]))
def q_ensemble_blend(spark, sf):
    return rounded(EN.blend(_pair(spark, sf), 0.25))


_PLANTED = f"SELECT station, target_datetime, split, y_true, pred_first, pred_second, hour(target_datetime) AS h FROM ({_PAIR}) p"


@register("align_predictions", O.wrap(
    f"SELECT unnest(['missing_in_first', 'missing_in_second', 'repeated_in_first', 'repeated_in_second', 'split_mismatch', "
    "'y_true_mismatch']) AS rule, unnest([count(*) FILTER (WHERE h = 2), count(*) FILTER (WHERE h = 3), "
    "count(*) FILTER (WHERE h IN (5, 6)), count(*) FILTER (WHERE h IN (6, 7)), count(*) FILTER (WHERE h = 8), "
    f"count(*) FILTER (WHERE h = 9)]) AS violations FROM ({_PLANTED}) x", ints=["violations"]))
def q_align_predictions(spark, sf):
    """Both models' tables with faults planted by the hour: missing and repeated rows, other splits and targets."""
    return rounded(EN.align_predictions(*_planted(spark, sf))[1])


@register("align_rows", O.wrap(
    f"SELECT station, target_datetime, split, y_true, pred_first, pred_second FROM ({_PLANTED}) x WHERE h NOT IN (2, 3, 5, 6, 7)",
    floats=["y_true", "pred_first", "pred_second"]))
def q_align_rows(spark, sf):
    return rounded(EN.align_predictions(*_planted(spark, sf))[0])


def _planted(spark, sf):
    hour = F.hour("target_datetime")
    first, second = (_preds(spark, sf).filter(F.col("model") == m).withColumn("h", hour) for m in ("persistence", "window_mean"))
    first = first.filter("h <> 2").unionByName(first.filter("h IN (5, 6)"))
    second = second.filter("h <> 3").unionByName(second.filter("h IN (6, 7)"))
    second = second.withColumn("split", F.when(F.col("h") == 8, F.lit("other")).otherwise(F.col("split"))).withColumn(
        "y_true", F.when(F.col("h") == 9, F.col("y_true") + 1).otherwise(F.col("y_true")))
    return first.drop("h"), second.drop("h")


def _search_sql(split_filter: str) -> str:
    e = "(y_true - (i / 100.0) * pred_first - (1 - i / 100.0) * pred_second)"
    return (f"SELECT round(i / 100.0, 10) AS first_weight, round(1 - i / 100.0, 10) AS second_weight, "
            f"sqrt(avg({e} * {e})) AS rmse, avg(abs({e})) AS mae, {O._r2('y_true', e)} AS r2 "
            f"FROM ({_PAIR}) p, range(0, 101) AS g(i) WHERE {split_filter} GROUP BY i")


@register("ensemble_weight_search", O.wrap(_search_sql("split = 'validation'"),
                                           floats=["first_weight", "second_weight", "rmse", "mae", "r2"]))
def q_ensemble_weight_search(spark, sf):
    return rounded(EN.weight_search(W.filter_split(_pair(spark, sf), "validation"), 0.01))


@register("ensemble_best_weight", O.wrap(
    f"SELECT * FROM ({_search_sql(chr(39).join(['split = ', 'validation', '']))}) s "
    "ORDER BY rmse, mae, first_weight LIMIT 1", floats=["first_weight", "second_weight", "rmse", "mae", "r2"]))
def q_ensemble_best_weight(spark, sf):
    return rounded(EN.best_weight(EN.weight_search(W.filter_split(_pair(spark, sf), "validation"), 0.01)))


@register("ensemble_metrics", O.wrap(
    f"WITH bw AS (SELECT first_weight AS w FROM ({_search_sql(chr(39).join(['split = ', 'validation', '']))}) s "
    "ORDER BY rmse, mae, first_weight LIMIT 1) "
    f"SELECT 'blend' AS model, split, {O.metric_cols('y_true', '(CASE WHEN bw.w * pred_first + (1 - bw.w) * pred_second < 0 THEN 0.0 ELSE bw.w * pred_first + (1 - bw.w) * pred_second END)')} "
    f"FROM ({_PAIR}) p, bw GROUP BY split", floats=_MF, ints=_MI))
def q_ensemble_metrics(spark, sf):
    pair = _pair(spark, sf)
    w = EN.chosen_weight(pair, 0.01)
    return rounded(EN.ensemble_metrics(pair, w))


# ================================================================ Panel B (many sparse series)

_B = dict(ctes=O.panel_b_ctes())
_TAB_B_SQL, _TAB_B_NAMES = O.tabular_select(features=O.FEATURES_B)


@register("panel_b_impute", O.wrap(f"SELECT station, datetime, target_y, {O._list(NUM)} FROM filled",
                                   floats=["target_y"] + NUM, **_B))
def q_panel_b_impute(spark, sf):
    """Forward fill across long gaps and chunk boundaries on 1 series per user."""
    return rounded(ctx(spark, sf, "B").imputed().select("station", "datetime", S.observed_target, *NUM))


@register("panel_b_sequence_index", O.wrap("SELECT * FROM seq", floats=_SEQ_F, ints=_SEQ_I, **_B))
def q_panel_b_sequence_index(spark, sf):
    return rounded(W.sequence_index(ctx(spark, sf, "B").processed(), S))


@register("panel_b_tabular_features", O.wrap(_TAB_B_SQL, floats=["target"] + _TAB_B_NAMES, **_B))
def q_panel_b_tabular_features(spark, sf):
    c = ctx(spark, sf, "B")
    return rounded(W.tabular_features(c.processed(), S, c.feature_names()))


_WEEK = 168
_WEEK_SQL, _WEEK_NAMES = O.tabular_select(features=(), window=_WEEK)
_WEEK_ROLL = [n for n in _WEEK_NAMES if n.endswith(f"_{_WEEK}") and not n.startswith("y_lag")]


@register("panel_b_weekly_statistics", O.wrap(
    f"SELECT station, split, target_datetime, {O._list(_WEEK_ROLL)} FROM ({_WEEK_SQL}) t", floats=_WEEK_ROLL, **_B))
def q_panel_b_weekly_statistics(spark, sf):
    """W9 over a week: statistics from block sides, whose cost doesn't grow with the window."""
    x = W.tabular_features(ctx(spark, sf, "B").processed(), S, [], _WEEK)
    return rounded(x.select("station", "split", "target_datetime", *_WEEK_ROLL))


@register("panel_b_station_vector", O.wrap(
    "SELECT station, row_number() OVER (ORDER BY station) - 1 AS hot, count(*) OVER () AS size, 1 AS ones "
    "FROM (SELECT DISTINCT station FROM prep WHERE split = 'train') t", ints=["hot", "size", "ones"], **_B))
def q_panel_b_station_vector(spark, sf):
    """The sparse one-hot vector of every train series: where its one is."""
    c = ctx(spark, sf, "B")
    x = P.station_vector(c.params().station_table(spark).select("station"), S, c.params())
    return rounded(x.select("station", *hot_positions("station_vector")))


_EFFECTS_SQL = """
SELECT t.station, coalesce(g.n, 0) AS rows, coalesce(g.n * (g.m - b.intercept) / (g.n + 10.0), 0.0) AS effect, b.intercept
FROM (SELECT DISTINCT station FROM prep WHERE split = 'train') t
LEFT JOIN (SELECT station, count(*) AS n, avg(y) AS m FROM prep WHERE split = 'train' AND y IS NOT NULL GROUP BY station) g
  ON g.station = t.station,
(SELECT sum(n * 10.0 / (n + 10.0) * m) / sum(n * 10.0 / (n + 10.0)) AS intercept FROM (
   SELECT station, count(*) AS n, avg(y) AS m FROM prep WHERE split = 'train' AND y IS NOT NULL GROUP BY station) x) b"""


@register("panel_b_series_effects", O.wrap(_EFFECTS_SQL, floats=["effect", "intercept"], ints=["rows"], **_B))
def q_panel_b_series_effects(spark, sf):
    """ridge of the observed target on the series indicator by LSQR; SQL has the closed form of that case."""
    c = ctx(spark, sf, "B")
    train = c.imputed().filter("split = 'train'").filter(F.col(S.observed_target).isNotNull())
    model = fit_ridge_lsqr(train, [], S.observed_target, 10.0, series=S.station, known=c.params().station_table(spark))
    seen = train.groupBy(F.col(S.station).alias("series")).agg(F.count(F.lit(1)).alias("rows"))
    out = model.effects.join(seen, "series", "left").select(
        F.col("series").alias("station"), F.coalesce("rows", F.lit(0)).alias("rows"), "effect", F.lit(model.intercept).alias("intercept"))
    return rounded(out)


def hot_positions(vector: str):
    """Where a sparse vector's first nonzero value is, its size and the number of nonzero values, never made dense."""
    v = F.unwrap_udt(F.col(vector))
    ones = F.filter(F.arrays_zip(v["indices"].alias("i"), v["values"].alias("v")), lambda e: e["v"] != 0)
    return F.get(ones, F.lit(0))["i"].cast("long").alias("hot"), v["size"].alias("size"), F.size(ones).alias("ones")


@register("panel_b_metrics", O.wrap("SELECT * FROM movr", floats=_MF, ints=_MI, **_B))
def q_panel_b_metrics(spark, sf):
    c = ctx(spark, sf, "B")
    return rounded(E.metrics_overall(FC.to_long(FC.baseline_forecasts(c.processed(), S, c.params()),
                                                ["persistence", "window_mean"])))


# topic modules register into QUERIES / ORACLES on import
from . import q_audit  # noqa: E402,F401
from . import q_wide  # noqa: E402,F401
from . import q_ablation  # noqa: E402,F401
from . import q_baseline_grid  # noqa: E402,F401
