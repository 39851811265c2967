"""Independent wide windows: FX8/FX9 shapes, in-window fill, order, gaps; wide == panel law."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourweave.config import PanelSpec
from hourweave.operators import preprocess as P
from hourweave.operators import wide as WD
from hourweave.operators import windows as W

SPEC = PanelSpec(target="a", primary=("a",), context=("b",), wind="wd", window=24,
                 validation_start="2016-01-01 12:00:00", test_start="2016-01-02 00:00:00", chunk_hours=30)


def panel(spark, hours=48):
    rows = []
    for s, off in (("StationA", 0), ("StationB", 20)):
        for h in range(hours):
            t = dt.datetime(2016, 1, 1) + dt.timedelta(hours=h)
            a = None if (s == "StationA" and h in (3, 30)) else float(10 + off + h)
            rows.append((t.year, t.month, t.day, t.hour, s, a, float(5 + h % 7), "N" if h % 2 else "E"))
    return spark.createDataFrame(rows, "year int, month int, day int, hour int, station string, a double, b double, wd string")


def test_wide_long_order_and_fill(spark):
    raw = panel(spark)
    params = P.fit_params(raw, SPEC)
    wide = WD.build_wide_windows(raw, SPEC, anchor=F.col("datetime") == F.lit("2016-01-02 00:00:00").cast("timestamp_ntz"))
    assert wide.count() == 2 and len(wide.columns) == 2 + 24 * 7
    long = WD.wide_to_long(wide, SPEC).filter("station = 'StationA'").orderBy("time_step").collect()
    assert [r["time_step"] for r in long] == list(range(24))
    assert long[0]["datetime"] == dt.datetime(2016, 1, 1, 0) and long[-1]["datetime"] == dt.datetime(2016, 1, 1, 23)
    feats = WD.wide_features(wide, SPEC, params).filter("station = 'StationA'").orderBy("time_step").collect()
    inv = lambda v: v * params.stds["a"] + params.means["a"]
    assert inv(feats[3]["a"]) == pytest.approx(12.0)   # hour 3 missing -> hour 2 value
    assert feats[3]["a_missing"] == 1.0
    meta = WD.wide_metadata(wide, SPEC).filter("station = 'StationA'").first()
    assert meta["target_datetime"] == dt.datetime(2016, 1, 2, 0)


def test_leading_gap_takes_train_median(spark):
    raw = panel(spark)
    params = P.fit_params(raw, SPEC)
    wide = WD.build_wide_windows(raw, SPEC, anchor=F.col("datetime") == F.lit("2016-01-02 07:00:00").cast("timestamp_ntz"))
    wide = wide.withColumn("a_lag_24", F.lit(None).cast("double"))
    first = WD.wide_features(wide, SPEC, params).filter("station = 'StationA' AND time_step = 0").first()
    assert first["a"] * params.stds["a"] + params.means["a"] == pytest.approx(params.medians["a"])


def test_non_hourly_window_detected(spark):
    raw = panel(spark)
    wide = WD.build_wide_windows(raw, SPEC, anchor=F.col("datetime") == F.lit("2016-01-02 00:00:00").cast("timestamp_ntz"))
    bad = wide.withColumn("hour_lag_10", F.lit(0).cast("int"))
    assert WD.window_steps(wide, SPEC).count() == 0
    assert WD.window_steps(bad, SPEC).count() >= 1


def test_wide_tabular_equals_panel_tabular(spark):
    raw = panel(spark)
    params = P.fit_params(raw, SPEC)
    proc = P.transform(raw, SPEC, params)
    names = P.feature_names(SPEC, params)
    # windows without gaps only: StationB (StationA has no missing-free overlap issue either: fill is causal)
    anchor = F.col("datetime") >= F.lit("2016-01-02 00:00:00").cast("timestamp_ntz")
    wide = WD.build_wide_windows(raw, SPEC, anchor=anchor)
    wt = WD.wide_tabular(wide, SPEC, params).filter("station = 'StationB'").orderBy("id").collect()
    pt = W.tabular_features(proc, SPEC, names).filter("station = 'StationB' AND target_datetime >= '2016-01-02'") \
        .orderBy("target_datetime").collect()
    assert len(wt) == len(pt) > 0
    for x, y in zip(wt, pt):
        for c in ("a_lag_1", "a_mean_24", "b_std_24", "latest_wd_sin", "a_change_6h"):
            assert x[c] == pytest.approx(y[c])
