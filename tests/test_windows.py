"""Sequence index and window features: FX3 (two stations, 30 hours), FX6 lags, chunk laws."""
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from hourweave.config import PanelSpec
from hourweave.operators import windows as W

SPEC = PanelSpec(target="a", primary=("a",), context=("b",), wind=None, window=24,
                 validation_start="2015-09-01 00:00:00", test_start="2015-12-01 00:00:00", chunk_hours=26)


def fx3(spark, drop_hour=None, null_target_at=None):
    rows = []
    for s, off in (("StationA", 0), ("StationB", 100)):
        for h in range(30):
            if drop_hour is not None and s == "StationA" and h == drop_hour:
                continue
            t = dt.datetime(2015, 8, 31) + dt.timedelta(hours=h)
            tgt = None if (null_target_at == h and s == "StationA") else float(h + off)
            split = "train" if t < dt.datetime(2015, 9, 1) else "validation"
            rows.append((t, s, tgt, float(h + off), float(2 * h + off), split))
    return spark.createDataFrame(rows, "datetime timestamp_ntz, station string, target_a double, a double, b double, split string")


def test_index_exact_windows_and_split_by_target(spark):
    idx = W.sequence_index(fx3(spark), SPEC).orderBy("sequence_id").collect()
    assert len(idx) == 12 and [r["sequence_id"] for r in idx] == list(range(12))
    first = idx[0]
    assert first["station"] == "StationA" and first["target"] == 24.0
    assert first["window_start_datetime"] == dt.datetime(2015, 8, 31, 0) and first["split"] == "validation"
    assert {r["station"] for r in idx[6:]} == {"StationB"} and idx[6]["target"] == 124.0


def test_null_target_skipped_and_gap_excluded(spark):
    assert W.sequence_index(fx3(spark, null_target_at=26), SPEC).count() == 11
    # a deleted hour breaks every window that spans it
    assert W.sequence_index(fx3(spark, drop_hour=10), SPEC).filter("station = 'StationA'").count() == 0


def test_lags_and_tabular_match_plain_windows(spark):
    df = fx3(spark)
    tab = W.tabular_features(df, SPEC, ["a", "b"]).orderBy("station", "target_datetime").collect()
    r = tab[0]
    assert r["a_lag_24"] == 0.0 and r["a_lag_1"] == 23.0 and r["latest_b"] == 46.0
    assert r["a_mean_24"] == pytest.approx(11.5) and r["b_max_24"] == 46.0 and r["a_change_12h"] == 12.0
    plain = W.rolling_stats_plain(df, SPEC).orderBy("station", "target_datetime").collect()
    for x, y in zip(tab, plain):
        for c in ("a_mean_24", "a_std_24", "b_min_24", "b_max_24"):
            assert x[c] == pytest.approx(y[c])


def test_chunked_equals_unchunked_and_partition_invariant(spark):
    df = fx3(spark)
    ref = W.tabular_features(df, SPEC.with_(chunk_hours=None), ["a", "b"]).orderBy("station", "target_datetime").collect()
    for ch in (24, 25, 40):
        got = W.tabular_features(df, SPEC.with_(chunk_hours=ch), ["a", "b"]).orderBy("station", "target_datetime").collect()
        assert got == ref
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        one = W.sequence_index(df, SPEC).orderBy("sequence_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert one == W.sequence_index(df, SPEC).orderBy("sequence_id").collect()


def noisy(spark, hours=420, series=2, null_at=None, drop=()):
    """Hourly rows with values that no float sum holds exactly."""
    rows = []
    for s in range(series):
        for h in range(hours):
            if (s, h) in drop:
                continue
            t = dt.datetime(2015, 8, 31, 5) + dt.timedelta(hours=h)
            a, b = (h * 7919 + s * 31) % 1009 / 7.0, -((h * 104729 + s) % 911) / 3.0
            rows.append((t, f"S{s}", a, None if (s, h) == null_at else a, b, "train"))
    return spark.createDataFrame(rows, "datetime timestamp_ntz, station string, target_a double, a double, b double, split string")


@pytest.mark.parametrize("w", [97, 168])
def test_long_windows_from_block_sides_equal_plain_windows(spark, w):
    spec, df = SPEC.with_(chunk_hours=200), noisy(spark, drop={(0, 30)})
    tab = W.tabular_features(df, spec, ["a", "b"], w).orderBy("station", "target_datetime").collect()
    assert len(tab) == (420 - 31 - w) + (420 - w)
    values = {(r["station"], r["datetime"]): (r["a"], r["b"]) for r in df.collect()}
    for r in tab:
        seen = [values[r["station"], r["target_datetime"] - dt.timedelta(hours=k)] for k in range(w, 0, -1)]
        for i, c in enumerate("ab"):
            v = [x[i] for x in seen]
            mean = math.fsum(v) / w
            assert r[f"{c}_mean_{w}"] == pytest.approx(mean, rel=1e-12)
            assert r[f"{c}_std_{w}"] == pytest.approx(math.sqrt(math.fsum((x - mean) ** 2 for x in v) / w), rel=1e-12)
            assert (r[f"{c}_min_{w}"], r[f"{c}_max_{w}"]) == (min(v), max(v))
            assert r[f"latest_{c}"] == v[-1]
        assert [r[f"a_lag_{k}"] for k in range(w, 0, -1)] == [x[0] for x in seen]
        assert r["a_change_12h"] == seen[-1][0] - seen[-13][0]


def test_block_sides_chunks_sizes_nulls(spark, monkeypatch):
    df, order = noisy(spark, 120, null_at=(1, 60)), ("station", "target_datetime")
    arrays = W.tabular_features_union(df, SPEC, ["a", "b"], [6, 12, 24]).orderBy(*order).collect()
    monkeypatch.setattr(W, "LONG_WINDOW", 0)
    sides = W.tabular_features_union(df, SPEC, ["a", "b"], [6, 12, 24]).orderBy(*order).collect()
    assert len(sides) == len(arrays) == 2 * (120 - 24) and sides[0].asDict().keys() == arrays[0].asDict().keys()
    for x, y in zip(arrays, sides, strict=True):
        for c in x.asDict():
            # a null value: no mean and no deviation, the extremes of the others; lags keep their places
            assert y[c] == (pytest.approx(x[c], rel=1e-12, abs=1e-12) if isinstance(x[c], float) else x[c]), c
    multi = W.tabular_features_multi(df, SPEC, ["a", "b"], [6, 24])
    assert multi[6].columns == ["station", "split", "target_datetime", "target", *W.tabular_feature_names(SPEC, ["a", "b"], 6)]
    assert multi[6].count() == multi[24].count() == len(sides)
    for chunk in (None, 24, 40):
        got = W.tabular_features_union(df, SPEC.with_(chunk_hours=chunk), ["a", "b"], [6, 12, 24]).orderBy(*order).collect()
        assert got == sides
    assert W.tabular_features(df.limit(0), SPEC, ["a", "b"]).count() == 0
    constant = df.withColumn("b", F.lit(0.1))
    assert {r["b_std_24"] for r in W.tabular_features(constant, SPEC, ["a", "b"]).collect()} == {0.0}


def test_long_windows_shuffle_once(spark):
    df, spec = noisy(spark, 200), SPEC.with_(chunk_hours=200)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = W.tabular_features(df, spec, ["a", "b"], 168)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 2


def test_resize_and_batches(spark):
    idx = W.sequence_index(fx3(spark), SPEC)
    r = W.resize_windows(idx, 6, 24).orderBy("sequence_id").first()
    assert r["window_start_datetime"] == dt.datetime(2015, 8, 31, 18) and r["target"] == 24.0
    with pytest.raises(ValueError):
        W.resize_windows(idx, 48, 24)
    b = W.window_batches(idx, 5).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [x["count"] for x in b] == [5, 5, 2]
    s = W.window_batches(idx, 5, seed=42).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [x["count"] for x in s] == [5, 5, 2]
    assert W.deterministic_sample(idx, 4, 42, "sequence_id").count() == 4
    assert W.deterministic_sample(idx, 100, 42, "sequence_id").count() == 12


def test_global_rank_dense(spark):
    df = spark.range(0, 1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    got = [r["pos"] for r in W.global_rank(df, ["k"], "pos").orderBy("k").collect()]
    assert got == list(range(1000))
