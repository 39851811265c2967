"""Preprocessing: FX1 (one station, 8 hours), FX2 (split edges), causal-fill laws."""
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from hourweave.config import AIR_SPEC
from hourweave.operators import preprocess as P

SPEC = AIR_SPEC.with_(chunk_hours=3)  # tiny chunks: the carry path is exercised
NUM = list(AIR_SPEC.numeric)
WINDS = ["N", "NE", None, "E", "SE", "S", "SW", "W"]


def fx1(spark, station="TestStation"):
    rows = []
    for r in range(8):
        vals = [float(r + 1 + i) for i in range(len(NUM))]
        if r == 1:
            vals[0] = None  # PM2.5 missing at r = 1
        if r == 0:
            vals[4] = None  # CO missing at r = 0
        rows.append((2015, 1, 1, r, station, *vals, WINDS[r]))
    schema = "year int, month int, day int, hour int, station string, " + \
        ", ".join(f"{c} double" for c in NUM) + ", wd string"
    return spark.createDataFrame(rows, schema)


def test_fill_flags_wind_onehot(spark):
    df = fx1(spark)
    params = P.fit_params(df, SPEC)
    out = {r["datetime"].hour: r for r in P.transform(df, SPEC, params).collect()}
    assert out[1][SPEC.observed_target] is None                   # target stays missing
    unscaled = lambda r, c: r[c] * params.stds[c] + params.means[c]
    assert unscaled(out[1], "PM2_5") == pytest.approx(1.0)        # filled from r = 0
    assert unscaled(out[0], "CO") == pytest.approx(params.medians["CO"])
    assert params.medians["CO"] == pytest.approx(float(__import__("statistics").median([r + 5.0 for r in range(1, 8)])))
    assert out[1]["PM2_5_missing"] == 1.0 and out[0]["CO_missing"] == 1.0 and out[3]["PM2_5_missing"] == 0.0
    assert out[2]["wd_missing"] == 1.0 and out[2]["wd_cos"] == pytest.approx(1.0)
    assert out[3]["wd_sin"] == pytest.approx(1.0)                 # east = 90 degrees
    assert all(r["station_TestStation"] == 1.0 for r in out.values())
    assert P.feature_names(SPEC, params)[:len(NUM)] == NUM


def test_unknown_wind_and_case(spark):
    from hourweave.functions.exprs import wind_feature_columns

    df = spark.createDataFrame([("ne",), (" NE",), ("CALM",), (None,)], "wd string")
    r = df.select(*wind_feature_columns("wd")).collect()
    assert r[0]["wd_missing"] == 0.0 and r[0]["wd_sin"] == pytest.approx(math.sin(math.radians(45)))
    assert [x["wd_missing"] for x in r[1:]] == [1.0, 1.0, 1.0]   # upper-cased, not trimmed


def test_split_edges(spark):
    times = ["2015-08-31 23:00:00", "2015-09-01 00:00:00", "2015-11-30 23:00:00", "2015-12-01 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("datetime"))
    got = [r[0] for r in df.select(P.split_column(AIR_SPEC)).collect()]
    assert got == ["train", "validation", "validation", "local_test"]


def test_fill_never_uses_the_future(spark):
    base = fx1(spark)
    changed = base.withColumn("PM2_5", F.when(F.col("hour") >= 5, F.lit(999.0)).otherwise(F.col("PM2_5")))
    f1 = P.forward_fill(P.prepare(base, SPEC), SPEC).filter("hour(datetime) < 5").orderBy("datetime").collect()
    f2 = P.forward_fill(P.prepare(changed, SPEC), SPEC).filter("hour(datetime) < 5").orderBy("datetime").collect()
    assert [r["PM2_5"] for r in f1] == [r["PM2_5"] for r in f2]


def test_chunked_fill_equals_plain(spark):
    # two stations, long leading gap crossing several chunks
    rows = []
    for s in ("A", "B"):
        for h in range(40):
            v = None if (h < 7 or 12 <= h < 30) else float(h + (100 if s == "B" else 0))
            rows.append((s, dt.datetime(2015, 1, 1) + dt.timedelta(hours=h), v))
    df = spark.createDataFrame(rows, "station string, datetime timestamp_ntz, PM2_5 double")
    plain = P.forward_fill(df, SPEC.with_(chunk_hours=None), ["PM2_5"]).orderBy("station", "datetime").collect()
    for ch in (3, 5, 16):
        chunked = P.forward_fill(df, SPEC.with_(chunk_hours=ch), ["PM2_5"]).orderBy("station", "datetime").collect()
        assert [r["PM2_5"] for r in chunked] == [r["PM2_5"] for r in plain]
    assert plain[10]["PM2_5"] == 10.0 and plain[29]["PM2_5"] == 11.0 and plain[0]["PM2_5"] is None


def test_scaler_zero_std_and_inverse(spark):
    df = fx1(spark).withColumn("RAIN", F.lit(0.0))
    params = P.fit_params(df, SPEC)
    assert params.stds["RAIN"] == 1.0
    out = P.transform(df, SPEC, params).select(P.inverse_scale(F.col("TEMP"), params, "TEMP").alias("t")).collect()
    assert sorted(r["t"] for r in out) == pytest.approx([float(r + 1 + 6) for r in range(8)])


def test_pollution_only_feature_set():
    names = ["PM2_5", "TEMP", "hour_sin", "wd_sin", "wd_cos", "wd_missing", "PM2_5_missing", "TEMP_missing", "station_A"]
    assert P.select_feature_set(names, AIR_SPEC, "pollution_only") == ["PM2_5", "hour_sin", "PM2_5_missing", "station_A"]
    with pytest.raises(ValueError):
        P.select_feature_set(names, AIR_SPEC, "weather_only")
