"""Missing values, gaps, unknown series, saved parameters, models and grids."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from hourweave.config import EVENTS_SPEC
from hourweave.functions.exprs import regression_metric_columns
from hourweave.operators import ensemble as EN
from hourweave.operators import forecast as FC
from hourweave.operators import preprocess as P
from hourweave.operators import quality as Q
from hourweave.operators import wide as WD
from hourweave.operators import windows as W
from hourweave.session import checkpoint_root

S = EVENTS_SPEC
NUM = list(S.numeric)


def panel(spark, hours=60, series=("a", "b"), start="2024-01-20 00:00:00"):
    """A whole hourly panel over the split boundaries."""
    x = spark.createDataFrame([(s,) for s in series], "station string").join(spark.range(hours).withColumnRenamed("id", "h"))
    t = F.timestamp_add("HOUR", F.col("h"), F.lit(start).cast("timestamp_ntz"))
    return x.select("station", t.alias("datetime"), *[(F.col("h") * (i + 1) + F.length("station")).cast("double").alias(c)
                                                     for i, c in enumerate(NUM)], F.lit("N").alias("wd"))


def test_clip_keeps_missing_predictions_missing(spark):
    x = spark.createDataFrame([(None,), (float("nan"),), (-1.0,), (2.0,), (float("inf"),), (float("-inf"),)], "p double")
    got = [r[0] for r in x.select(FC.clip_predictions("p")).collect()]
    assert got[0] is None and math.isnan(got[1]) and got[2:5] == [0.0, 2.0, math.inf] and got[5] == 0.0
    bad = {r["rule"]: r["violations"] for r in Q.non_finite(x.select(FC.clip_predictions("p").alias("p")), ["p"]).collect()}
    assert bad["p"] == 3


def test_metrics_count_only_whole_pairs(spark):
    x = spark.createDataFrame([(1.0, 2.0), (3.0, None), (None, 1.0), (5.0, 5.0)], "y double, p double")
    r = x.agg(*regression_metric_columns("y", "p")).first()
    assert r["samples"] == 2 and r["mae"] == 0.5 and r["r2"] == pytest.approx(1 - 1 / 8)


def test_window_search_equals_one_blend_at_a_time(spark):
    x = spark.range(50).select((F.rand(1) * 9).alias("y_true"), (F.rand(2) * 9).alias("pred_first"), (F.rand(3) * 9).alias("pred_second"))
    for r in EN.weight_search(x, 0.25).collect():
        one = EN.blend(x, r["first_weight"]).agg(*regression_metric_columns("y_true", "y_pred")).first()
        assert [r[k] for k in ("rmse", "mae", "r2")] == pytest.approx([one[k] for k in ("rmse", "mae", "r2")], rel=1e-9)
    assert EN.weight_search(x.limit(0), 0.5).count() == 0


def test_windows_need_every_hour_once(spark):
    spec = S.with_(window=3, chunk_hours=6)
    rows = [(0, 1.0), (1, 1.0), (1, 1.0), (3, 1.0), (4, 1.0), (5, 1.0), (6, 1.0), (7, 1.0)]
    x = spark.createDataFrame([("a", h, v) for h, v in rows], "station string, h int, v double")
    t = F.timestamp_add("HOUR", F.col("h"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    x = x.select("station", t.alias(spec.time), F.col("v").alias(spec.observed_target), F.lit("train").alias("split"))
    got = sorted(r["target_datetime"].hour for r in W.sequence_index(x, spec, 3).collect())
    assert got == [6, 7]


def test_nan_inputs_of_wide_windows_are_missing(spark):
    raw = panel(spark, 40)
    params = P.fit_params(raw, S)
    whole = WD.build_wide_windows(raw.select(F.year("datetime").alias("year"), F.month("datetime").alias("month"),
                                             F.dayofmonth("datetime").alias("day"), F.hour("datetime").alias("hour"), "*"), S)
    assert whole.count() == 2 * (40 - S.window)
    null = whole.withColumn("y_lag_1", F.lit(None).cast("double"))
    nan = whole.withColumn("y_lag_1", F.lit(float("nan")))
    for f in (WD.wide_baselines, WD.wide_tabular, WD.wide_features):
        a, b = (sorted(map(str, f(x, S, params).collect())) for x in (null, nan))
        assert a == b and "nan" not in "".join(a)


def test_panels_that_break_the_contract_are_refused(spark):
    good = P.prepare(panel(spark), S)
    assert Q.assert_panel(good, S) is good
    faults = {
        "null_station": good.withColumn("station", F.when(F.hour("datetime") == 3, None).otherwise(F.col("station"))),
        "duplicate_key": good.unionByName(good.filter(F.hour("datetime") == 5)),
        "non_hourly": good.filter(F.hour("datetime") != 5),
    }
    for rule, bad in faults.items():
        with pytest.raises(ValueError, match=rule):
            Q.assert_panel(bad, S)
    with pytest.raises(ValueError, match="must not be used"):
        Q.assert_features(good, [S.observed_target], S)
    with pytest.raises(ValueError, match="y="):
        Q.assert_features(good.withColumn("y", F.lit(None).cast("double")), ["y"], S)


def test_wide_windows_that_break_the_contract_are_refused(spark):
    raw = panel(spark, 40).withColumns({k: getattr(F, f)("datetime") for k, f in (
        ("year", "year"), ("month", "month"), ("day", "dayofmonth"), ("hour", "hour"))})
    wide = WD.build_wide_windows(raw, S)
    known = spark.createDataFrame([("a",), ("b",)], "station string")
    assert Q.assert_wide(wide, S, known) is wide
    with pytest.raises(ValueError, match="unknown_station=1"):
        Q.assert_wide(wide, S, known.limit(1))
    with pytest.raises(ValueError, match="non_hourly"):
        Q.assert_wide(wide.withColumn("hour_lag_4", F.lit(2)), S, known)
    with pytest.raises(ValueError, match="duplicate_id"):
        Q.assert_wide(wide.unionByName(wide.limit(1)), S, known)
    with pytest.raises(ValueError, match="missing columns"):
        Q.assert_wide(wide.drop("y_lag_3"), S, known)


def test_an_observed_target_that_is_there_is_kept(spark):
    x = panel(spark).withColumn(S.observed_target, F.lit(5.0))
    assert {r[0] for r in P.transform(x, S, P.fit_params(x, S)).select(S.observed_target).distinct().collect()} == {5.0}


@pytest.mark.parametrize("count", [65, 10_000])
def test_any_number_of_series_has_categories(spark, count):
    names = [f"s{i:05d}" for i in range(count)]
    x = panel(spark, 1, names)
    params = P.fit_params(x, S, onehot=count < 100)
    table = {r["station"]: r["position"] for r in params.station_table(spark).collect()}
    assert table == {s: i for i, s in enumerate(names)}
    assert Q.unknown_stations(x.select("station"), params.station_table(spark)).count() == 0
    assert sum(n.startswith("station_") for n in P.feature_names(S, params)) == (65 if count == 65 else 0)
    some = spark.createDataFrame([("s00000",), (names[-1],), ("new",)], "station string")
    hot = {r["station"]: r["station_vector"] for r in P.station_vector(some, S, params).collect()}
    assert {s: (v.size, list(v.indices)) for s, v in hot.items()} == {
        "s00000": (count, [0]), names[-1]: (count, [count - 1]), "new": (count, [])}


def test_parameters_survive_a_round_trip(spark):
    x = panel(spark)
    params = P.fit_params(x, S)
    path = f"{checkpoint_root(spark)}/params-{uuid.uuid4().hex}"
    params.save(spark, path)
    again = P.FittedParams.load(spark, path)
    for name in ("columns", "medians", "means", "stds", "stations", "onehot"):
        assert getattr(again, name) == getattr(params, name)
    a, b = (sorted(map(str, P.transform(x, S, p).collect())) for p in (params, again))
    assert a == b


def train(spark):
    return spark.range(200).select(F.rand(1).alias("a"), F.rand(2).alias("b"), (F.rand(1) * 3 + F.rand(2)).alias("target"))


def test_ridge_equals_the_normal_equations_and_survives_saving(spark):
    import numpy as np

    x = train(spark)
    model = FC.fit_ridge(x, ["a", "b"], alpha=10.0)
    rows = x.toPandas()
    a, y = rows[["a", "b"]].to_numpy(), rows["target"].to_numpy()
    c = a - a.mean(0)
    w = np.linalg.solve(c.T @ c + 10 * np.eye(2), c.T @ (y - y.mean()))
    assert model.stages[-1].coefficients.toArray() == pytest.approx(w, rel=1e-6)
    path = FC.save_model(model, f"{checkpoint_root(spark)}/model-{uuid.uuid4().hex}")
    a, b = ([r["y_pred"] for r in FC.score(m, x, "ridge", keys=["a"]).orderBy("a").collect()] for m in (model, FC.load_model(path)))
    assert a == b


def test_a_stopped_grid_goes_on_where_it_was(spark, monkeypatch):
    x = panel(spark, 240, ("a", "b", "c"), "2024-01-18 00:00:00")
    processed, params = P.preprocess(x, S)
    names = P.feature_names(S, params)
    path = f"{checkpoint_root(spark)}/grid-{uuid.uuid4().hex}"
    fitted, real = [], FC.fit_ridge

    def stops(*args, **kw):
        if len(fitted) == 3:
            raise KeyboardInterrupt
        fitted.append(1)
        return real(*args, **kw)

    monkeypatch.setattr(FC, "fit_ridge", stops)
    with pytest.raises(KeyboardInterrupt):
        FC.ablation_grid(processed, S, names, windows=(6, 12), results_path=path)
    assert spark.read.parquet(f"{path}/runs").count() == 3
    fitted.clear()
    results, _ = FC.ablation_grid(processed, S, names, windows=(6, 12), results_path=path)
    assert len(fitted) == 1 and results.count() == 4 == spark.read.parquet(f"{path}/runs").count()
    keys = [(r["window_size"], r["feature_set"]) for r in results.collect()]
    assert keys == sorted(keys)
