"""Metrics, ranges, blending, weight search (FX7) and the published ablation tables (FX12)."""
import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourweave.functions.exprs import range_labels
from hourweave.operators import ensemble as EN
from hourweave.operators import evaluate as E


def preds(spark, ys, ps, model="m", split="validation", stations=None):
    stations = stations or ["A"] * len(ys)
    rows = [(model, split, s, dt.datetime(2015, 1, 1) + dt.timedelta(hours=i), float(y), float(p))
            for i, (s, y, p) in enumerate(zip(stations, ys, ps))]
    return spark.createDataFrame(rows, "model string, split string, station string, target_datetime timestamp_ntz, "
                                 "y_true double, y_pred double")


def test_metrics_and_clip(spark):
    r = E.metrics_overall(preds(spark, [10, 20, 30], [11, 19, -5])).first()
    e = np.array([10, 20, 30]) - np.array([11, 19, 0])  # clipped
    assert r["rmse"] == pytest.approx(math.sqrt((e ** 2).mean()))
    assert r["mae"] == pytest.approx(np.abs(e).mean())
    assert r["r2"] == pytest.approx(1 - (e ** 2).sum() / ((np.array([10, 20, 30]) - 20) ** 2).sum())
    const = E.metrics_overall(preds(spark, [5, 5], [5, 5])).first()
    assert const["r2"] == 1.0
    assert E.metrics_overall(preds(spark, [5], [4])).first()["r2"] is None


def test_station_recombination(spark):
    p = preds(spark, [1, 2, 3, 4, 5, 6], [1.5, 2, 2, 5, 5, 7], stations=list("AABBBC"))
    overall = E.metrics_overall(p).first()
    rec = E.recombine_overall(E.metrics_by_station(p)).first()
    assert rec["rmse"] == pytest.approx(overall["rmse"]) and rec["mae"] == pytest.approx(overall["mae"])


def test_range_overlap_at_250(spark):
    df = spark.createDataFrame([(0.0,), (35.0,), (35.5,), (250.0,), (-1.0,), (999.0,)], "y double")
    got = [r[0] for r in df.select(range_labels("y")).collect()]
    assert got == [["0-35"], ["0-35"], ["35-75"], ["150-250", "250+"], [], ["250+"]]
    got = [r[0] for r in df.select(range_labels("y", disjoint=True)).collect()]
    assert got[3] == ["150-250"]


def test_blend_and_bounds(spark):
    a = spark.createDataFrame([("A", 10.0, 20.0), ("A", 20.0, 40.0)], "station string, pred_first double, pred_second double")
    got = [r["y_pred"] for r in EN.blend(a, 0.75).collect()]
    assert got == [12.5, 25.0]
    with pytest.raises(ValueError):
        EN.blend(a, 1.5)


def test_weight_search_picks_exact_model(spark):
    rows = [("A", "validation", dt.datetime(2015, 1, 1, i), y, y, 20.0 - y) for i, y in enumerate([0.0, 10.0, 20.0])]
    al = spark.createDataFrame(rows, "station string, split string, target_datetime timestamp_ntz, y_true double, "
                               "pred_first double, pred_second double")
    s = EN.weight_search(al, 0.1)
    assert s.count() == 11
    best = EN.best_weight(s).first()
    assert best["first_weight"] == 1.0 and best["rmse"] == 0.0


def test_alignment_reports_unmatched(spark):
    a = preds(spark, [1, 2, 3], [1, 2, 3])
    b = preds(spark, [1, 2], [2, 2])
    aligned, v = EN.align_predictions(a, b)
    counts = {r["rule"]: r["violations"] for r in v.collect()}
    assert counts["missing_in_second"] == 1 and counts["missing_in_first"] == 0 and aligned.count() == 2


def test_alignment_reports_repeated_keys_and_differences(spark):
    a, b = preds(spark, [1, 2, 3, 4], [1, 2, 3, 4]), preds(spark, [1, 2, 3, 4], [2, 2, 2, 2])
    first = a.orderBy("target_datetime").limit(1)
    aligned, v = EN.align_predictions(a.unionByName(first), b.unionByName(first).withColumn("y_true", F.col("y_true") + 1))
    counts = {r["rule"]: r["violations"] for r in v.collect()}
    assert counts == {"missing_in_first": 0, "missing_in_second": 0, "repeated_in_first": 1, "repeated_in_second": 1,
                      "split_mismatch": 0, "y_true_mismatch": 3}
    assert aligned.count() == 3


@pytest.mark.parametrize("rows", [
    [(1.0, 1.0, 1.0)], [(0.0, 1.0, -1.0), (2.0, 2.0, 5.0), (3.0, 3.0, 3.0), (1.0, 0.5, 1.5), (4.0, 5.0, 4.0)],
    [(float(i % 7), float(i % 5) + 0.25, float(i % 11) - 0.125) for i in range(300)]])
@pytest.mark.parametrize("step", [0.01, 0.25, 1.0])
def test_weight_search_equals_every_weight_by_itself(spark, rows, step):
    import numpy as np

    df = spark.createDataFrame(rows, "y_true double, pred_first double, pred_second double")
    y, p, q = map(np.array, zip(*rows))
    for r in EN.weight_search(df, step).collect():
        e = y - r["first_weight"] * p - (1 - r["first_weight"]) * q
        assert r["mae"] == pytest.approx(np.abs(e).mean(), abs=1e-9)
        assert r["rmse"] == pytest.approx(np.sqrt((e * e).mean()), abs=1e-7)


# Published ablation results (GRU runs): run_id, window, feature_set, seed, validation rmse/mae, local-test rmse.
ABLATION = [
    ("gru_w6_all_features_s42", 6, "all_features", 42, 16.354541021074287, 8.600785216398087, None, 121.89552878399992),
    ("gru_w6_pollution_only_s42", 6, "pollution_only", 42, 17.279345476885766, 8.87062033167319, None, 79.86755619699989),
    ("gru_w12_all_features_s42", 12, "all_features", 42, 16.291361460527312, 8.639117846560877, None, 92.46081831100037),
    ("gru_w12_pollution_only_s42", 12, "pollution_only", 42, 17.206413805658094, 8.722059056945996, None, 86.96772940300025),
    ("gru_w24_all_features_s42", 24, "all_features", 42, 16.178228414125662, 8.501350203419399, 27.2517395363264, 140.7417160490004),
    ("gru_w24_all_features_s123", 24, "all_features", 123, 15.958252903709358, 8.434037598401193, 26.743576700148683, 140.7833068889995),
    ("gru_w24_all_features_s2026", 24, "all_features", 2026, 16.276831891777416, 8.450450914748401, 27.358760539914876, 102.53167684300024),
    ("gru_w24_pollution_only_s42", 24, "pollution_only", 42, 17.059313991371557, 8.715251770254785, None, 96.63761546100068),
]


def ablation(spark):
    rows = [(r[0], "gru", r[1], r[2], r[3], r[4], r[5], r[6], r[7]) for r in ABLATION]
    return spark.createDataFrame(rows, "run_id string, model string, window_size long, feature_set string, seed long, "
                                 "validation_rmse double, validation_mae double, local_test_rmse double, "
                                 "training_seconds double")


def test_ablation_summary_matches_published(spark):
    got = {(r["window_size"], r["feature_set"]): r for r in E.ablation_summary(ablation(spark)).collect()}
    top = got[(24, "all_features")]
    assert top["runs"] == 3
    assert top["validation_rmse_mean"] == pytest.approx(16.137771069870812)
    assert top["validation_rmse_std"] == pytest.approx(0.16309733424471895)
    assert top["validation_rmse_min"] == pytest.approx(15.958252903709358)
    assert top["validation_mae_mean"] == pytest.approx(8.461946238856331)
    assert top["local_test_rmse_mean"] == pytest.approx(27.118025592129985)
    assert top["local_test_rmse_std"] == pytest.approx(0.3286675422547695)
    assert top["training_seconds_mean"] == pytest.approx(128.01889992700004)
    assert got[(12, "all_features")]["validation_rmse_std"] is None


def test_ablation_improvement_selection_seeds(spark):
    imp = {r["window_size"]: r for r in E.ablation_improvement(ablation(spark)).collect()}
    assert imp[24]["absolute_rmse_reduction"] == pytest.approx(17.059313991371557 - 16.178228414125662)
    sel = E.selected_configuration(ablation(spark)).first()
    assert sel["run_id"] == "gru_w24_all_features_s42"   # seed-42 grid
    rob = {r["metric"]: r for r in E.seed_robustness(ablation(spark), 24, "all_features").collect()}
    assert rob["validation_rmse"]["sample_sd"] == pytest.approx(0.16309733424471895)
    rank = E.ablation_ranking(ablation(spark)).first()
    assert rank["label"] == "GRU / 24h / all_features"


def test_best_epoch(spark):
    hist = spark.createDataFrame([("r", 1, 3.0), ("r", 2, 2.0), ("r", 3, 2.0), ("r", 4, 2.5)],
                                 "run_id string, epoch long, val_rmse double")
    assert E.best_epoch(hist).first()["best_epoch"] == 2


def test_weight_search_published_pick(spark):
    rows = [(0.46, 15.3378154505277, 8.282395613035241), (0.47, 15.337128191997024, 8.285392754918343),
            (0.48, 15.336703680496356, 8.28855122863586), (0.49, 15.336542283661183, 8.291916934362575),
            (0.50, 15.336643722565524, 8.295471973473132), (0.51, 15.337008143295037, 8.299214576699015)]
    s = spark.createDataFrame(rows, "first_weight double, rmse double, mae double")
    assert EN.best_weight(s).first()["first_weight"] == 0.49
