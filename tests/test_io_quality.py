"""Sources/sinks (FX14), quality rules, answer tables (FX10) and the streaming scorer."""
import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from hourweave.config import AIR_RAW_CSV_COLUMNS, PanelSpec
from hourweave.operators import preprocess as P
from hourweave.operators import quality as Q
from hourweave.operators import submission as SB
from hourweave.operators import wide as WD
from hourweave.sources import files as IO


def test_panel_csv_na_and_empty(spark):
    d = tempfile.mkdtemp(prefix="hw-csv-")
    lines = [",".join(AIR_RAW_CSV_COLUMNS)]
    lines.append("1,2015,1,1,0,NA,20,3,4,5,6,7,1000,-5,0,N,1.5,S1")
    lines.append("2,2015,1,1,1,,21,3,4,5,6,7,1001,-5,0,,1.6,S1")
    lines.append("3,2015,1,1,2,12.5,22,3,4,5,6,7,1002,-5,0,NE,1.7,S1")
    with open(os.path.join(d, "train.csv"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    df = IO.read_panel_csv(spark, d)
    assert "PM2_5" in df.columns and "PM2.5" not in df.columns
    rows = df.orderBy("No").collect()
    assert rows[0]["PM2_5"] is None and rows[1]["PM2_5"] is None and rows[2]["PM2_5"] == 12.5
    assert rows[1]["wd"] is None and rows[0]["station"] == "S1"


def test_upsert_replaces_rerun_keys(spark):
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "model string, rmse double")
    new = spark.createDataFrame([("b", 3.0), ("c", 4.0)], "model string, rmse double")
    got = {r["model"]: r["rmse"] for r in IO.upsert(old, new, ["model"]).collect()}
    assert got == {"a": 1.0, "b": 3.0, "c": 4.0}


SPEC = PanelSpec(target="a", primary=("a",), context=(), wind=None, chunk_hours=5)


def panel(spark):
    t0 = dt.datetime(2020, 1, 1)
    hours = [0, 1, 2, 3, 7, 8, 8, 20]  # gap 3 -> 7, duplicate 8, gap 8 -> 20
    rows = [("s", t0 + dt.timedelta(hours=h), float(h)) for h in hours] + [("t", t0, 1.0), ("t", t0 + dt.timedelta(hours=1), 2.0)]
    return spark.createDataFrame(rows, "station string, datetime timestamp_ntz, a double")


def test_continuity_gaps_and_duplicates(spark):
    df = panel(spark)
    cont = {r["station"]: r for r in Q.continuity(df, SPEC).collect()}
    assert cont["s"]["actual_rows"] == 8 and cont["s"]["expected_rows"] == 21
    assert cont["s"]["missing_timestamps"] == 21 - 7 and cont["t"]["missing_timestamps"] == 0
    gaps = sorted((r["datetime"].hour, r["gap_hours"]) for r in Q.non_hourly(df, SPEC).collect())
    assert (7, 4.0) in gaps and (20, 12.0) in gaps
    dup = Q.duplicate_keys(df, SPEC).collect()
    assert len(dup) == 1 and dup[0]["count"] == 2
    assert Q.duplicate_rows(df, SPEC).count() == 2


def test_rule_tables_and_assert(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (float("inf"),)], "x double")
    rules = {r["rule"]: r["violations"] for r in Q.non_finite(df, ["x"]).collect()}
    assert rules == {"x": 3, "empty_input": 0}
    with pytest.raises(ValueError):
        Q.assert_clean(Q.non_finite(df, ["x"]))
    with pytest.raises(ValueError):
        Q.leakage_guard(["a", "target_a"], SPEC)


def test_submission_clip_order_checks(spark):
    template = spark.createDataFrame([("test_00001", 0), ("test_00002", 1)], "id string, position long")
    preds = spark.createDataFrame([("test_00002", 12.5), ("test_00001", -3.0)], "id string, blend double")
    sub = SB.build_submission(template, preds)
    got = {r["id"]: (r["position"], r["prediction"]) for r in sub.collect()}
    assert got == {"test_00001": (0, 0.0), "test_00002": (1, 12.5)}
    checks = {r["rule"]: r["violations"] for r in Q.submission_checks(sub, template).collect()}
    assert all(v == 0 for v in checks.values())
    summ = Q.submission_summary(sub).first()
    assert summ["rows"] == 2 and summ["std"] == pytest.approx(6.25)
    assert {r["rule"]: r["violations"] for r in Q.id_alignment(template, sub).collect()}["id_mismatch"] == 0
    fp1 = Q.table_fingerprint(sub, ["id", "position", "prediction"]).first()
    fp2 = Q.table_fingerprint(sub.orderBy(F.desc("id")), ["id", "position", "prediction"]).first()
    assert fp1 == fp2


def test_streaming_scorer_matches_batch(spark):
    from hourweave.streaming.scoring import score_window_files

    spec = PanelSpec(target="a", primary=("a",), context=("b",), wind="wd", window=24,
                     validation_start="2016-01-01 12:00:00", test_start="2016-01-02 00:00:00", chunk_hours=30)
    rows = []
    for s, off in (("A", 0), ("B", 20)):
        for h in range(48):
            t = dt.datetime(2016, 1, 1) + dt.timedelta(hours=h)
            rows.append((t.year, t.month, t.day, t.hour, s, float(10 + off + h), float(h % 5), "N"))
    raw = spark.createDataFrame(rows, "year int, month int, day int, hour int, station string, a double, b double, wd string")
    params = P.fit_params(raw, spec)
    wide = WD.build_wide_windows(raw, spec, anchor=F.col("datetime") >= F.lit("2016-01-02 00:00:00").cast("timestamp_ntz"))
    root = tempfile.mkdtemp(prefix="hw-stream-")
    src, sink, ckpt = (os.path.join(root, n) for n in ("in", "out", "ckpt"))
    wide.write.parquet(src)
    score_window_files(spark, src, wide.schema, spec, params, 0.5, sink, ckpt)
    streamed = {r["id"]: r["prediction"] for r in spark.read.parquet(sink).collect()}
    batch = {r["id"]: max(r["blend"], 0.0) for r in SB.blended_window_predictions(wide, spec, params, 0.5).collect()}
    assert len(streamed) == 48 and streamed.keys() == batch.keys()
    assert all(streamed[k] == pytest.approx(batch[k]) for k in batch)


def test_template_positions_across_part_files(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="hw-tmpl-"), "t")
    ids = [f"test_{i:05d}" for i in range(500)]
    spark.createDataFrame([(i, 0.0) for i in ids], "id string, y double").repartitionByRange(4, "id") \
        .sortWithinPartitions("id").write.option("header", True).csv(d)
    assert len([f for f in os.listdir(d) if f.startswith("part-")]) == 4
    got = IO.read_template_csv(spark, d, value_col="y").orderBy("position").collect()
    assert [r["id"] for r in got] == ids and [r["position"] for r in got] == list(range(500))
