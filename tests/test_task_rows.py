"""Tasks hold a bounded number of panel rows, however well these compress."""
import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from hourweave import session
from hourweave.config import PanelSpec
from hourweave.operators import forecast as FC
from hourweave.operators import preprocess as P
from hourweave.operators import quality as Q
from hourweave.operators import windows as W
from hourweave.operators.lookback import HALO
from hourweave.sources.events_panel import densify_panel, hourly_aggregate

SPEC = PanelSpec(target="a", primary=("a",), context=(), wind=None, window=24, chunk_hours=48)
START = dt.datetime(2024, 1, 1)
HOURS, SERIES = 480, 20


@pytest.fixture
def few_rows(monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 500)


def panel(spark):
    """Hourly rows with a value every tenth hour."""
    h = F.col("id") % HOURS
    return spark.range(HOURS * SERIES).select(
        F.concat(F.lit("s"), F.floor(F.col("id") / HOURS)).alias("station"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(hours=h.cast("int"))).alias("datetime"),
        F.when(h % 10 == 0, (F.col("id") % 97).cast("double")).alias("a"),
        F.when(h % 10 == 0, 1.0).alias("target_a"), F.lit("train").alias("split"))


def largest_task(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def same_rows(x, y):
    key = lambda r: (r["station"], r[1], r[2])
    assert sorted(x, key=key) == sorted(y, key=key)


def test_panel_rules_count_hours_in_blocks(spark):
    """the rules shuffled a row per panel row."""
    rows = [(s, START + dt.timedelta(hours=h)) for s in ("s", "t") for h in range(640) if (s, h) not in {("s", 70), ("s", 71)}]
    rows += [("s", START)] * 3 + [("t", START + dt.timedelta(hours=100))]             # repeated: 4
    rows += [(None, START), (None, START), (None, None), ("t", None)]                 # no station: 3, no time: 2
    df = spark.createDataFrame(rows, "station string, datetime timestamp_ntz")
    assert {r["rule"]: r["violations"] for r in Q.panel_rules(df, SPEC).collect()} == {
        "null_station": 3, "null_time": 2, "duplicate_key": 4, "non_hourly": 2}
    assert Q._hour_blocks(df, SPEC).count() <= 2 * 11 + 3
    # times off the hour are different times of their hour; hours before 1970 have blocks too
    odd = [("u", START), ("u", START + dt.timedelta(minutes=5)), ("u", START + dt.timedelta(minutes=5, microseconds=1)),
           ("v", dt.datetime(1969, 12, 31, 22)), ("v", dt.datetime(1970, 1, 1, 1)), ("w", START), ("w", START)]
    df = spark.createDataFrame(odd, "station string, datetime timestamp_ntz")
    assert {r["rule"]: r["violations"] for r in Q.panel_rules(df, SPEC).collect()} == {
        "null_station": 0, "null_time": 0, "duplicate_key": 1, "non_hourly": (1 - 3) + 2 + 0}


def test_events_are_dealt_before_they_are_counted(spark, few_rows, monkeypatch):
    """one task counted the cells of all events that it read."""
    d = tempfile.mkdtemp(prefix="hw-events-")
    spark.range(4000).select((F.col("id") % 200).alias("user_id"), F.lit("click").alias("event_type"),
                             F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60).alias("ts"),
                             (F.col("id") % 50).cast("double").alias("value"), F.lit('{"k": 3}').alias("props")) \
        .coalesce(1).write.parquet(os.path.join(d, "events.parquet"))
    agg = hourly_aggregate(spark, d, "B")
    assert "REPARTITION_BY_NUM" in agg._jdf.queryExecution().executedPlan().toString()
    got = agg.collect()
    monkeypatch.setattr(session, "TASK_ROWS", 1 << 18)
    same_rows(got, hourly_aggregate(spark, d, "B").collect())


def test_medians_count_values_in_many_tasks(spark, few_rows, monkeypatch):
    """as above, for the distinct values of the train rows."""
    train = panel(spark).unionByName(panel(spark).withColumn("station", F.concat("station", F.lit("b"))))
    sent = []
    monkeypatch.setattr(P, "dealt", lambda df, tasks, *keys: sent.append((df, tasks)) or session.dealt(df, tasks, *keys))
    median = P.median_table(train, SPEC).first()["median"]
    values = sorted(r["a"] for r in train.collect() if r["a"] is not None)
    n = len(values)
    assert median == (values[(n - 1) // 2] + values[n // 2]) / 2
    (rows, tasks), = sent
    assert rows.count() == n and tasks == max(-(-n // 500), spark.sparkContext.defaultParallelism)


def test_block_sides_copy_few_rows_and_are_dealt(spark, few_rows, monkeypatch):
    """a week's halo copied every row, and sorts took what 64 MB of compressed rows hold."""
    spec, df = SPEC.with_(chunk_hours=168), panel(spark)
    copies = []
    parts = W.lookback_parts

    def counted(*args):
        x = parts(*args)
        copies.append(x.filter(HALO).count())
        return x

    monkeypatch.setattr(W, "lookback_parts", counted)
    x = W.tabular_features(df, spec, ["a"], 168)
    assert copies[0] <= HOURS * SERIES / 2
    assert largest_task(x) < 500 and x.count() == SERIES * (HOURS // 10 - 17)
    monkeypatch.setattr(session, "TASK_ROWS", 1 << 18)
    same_rows(x.collect(), W.tabular_features(df, spec, ["a"], 168).collect())


def test_look_back_windows_are_dealt(spark, few_rows, monkeypatch):
    """one task sorted and windowed what 64 MB of compressed rows hold."""
    df = P.impute(panel(spark), SPEC, {"a": 0.0})
    x = W.tabular_features(df, SPEC, ["a"])
    assert x.select(F.spark_partition_id().alias("p")).distinct().count() >= 15
    monkeypatch.setattr(session, "TASK_ROWS", 1 << 18)
    same_rows(x.collect(), W.tabular_features(df, SPEC, ["a"]).collect())


def test_forward_fill_is_dealt(spark, few_rows, monkeypatch):
    """one task filled what 64 MB of compressed rows hold."""
    df = panel(spark)
    x = P.forward_fill(df, SPEC, ["a"])
    assert largest_task(x) < 2000
    monkeypatch.setattr(session, "TASK_ROWS", 1 << 18)
    same_rows(x.collect(), P.forward_fill(df, SPEC.with_(chunk_hours=None), ["a"]).collect())


def test_written_files_hold_few_rows(spark):
    """a task that reads the panel takes some 30 small files."""
    x = session.materialize(panel(spark).coalesce(1), "files", file_rows=1000)
    assert len(x.inputFiles()) == 10 and x.count() == HOURS * SERIES


def test_baselines_are_dealt(spark, few_rows, monkeypatch):
    """as F3, for the baselines under the metrics."""
    df = P.impute(panel(spark), SPEC, {"a": 0.0})
    params = P.FittedParams(["a"], {"a": 0.0}, {"a": 0.0}, {"a": 1.0}, [], False)
    x = FC.baseline_forecasts(df, SPEC, params)
    assert x.select(F.spark_partition_id().alias("p")).distinct().count() >= 15
    monkeypatch.setattr(session, "TASK_ROWS", 1 << 18)
    same_rows(x.collect(), FC.baseline_forecasts(df, SPEC, params).collect())


def test_cells_and_chunks_are_dealt(spark, few_rows, monkeypatch):
    """the tasks that counted events per cell and wrote the panel's hours were left to Spark, which goes by bytes."""
    d = tempfile.mkdtemp(prefix="hw-events-")
    spark.range(6000).select(F.when(F.col("id") % 50 != 0, F.col("id") % 211).alias("user_id"),
                             F.when(F.col("id") % 7 != 0, F.concat(F.lit("t"), F.col("id") % 3)).alias("event_type"),
                             F.timestamp_seconds(F.lit(1_704_067_200) + F.floor(F.col("id") / 2) * 300).alias("ts"),
                             F.when(F.col("id") % 11 != 0, (F.col("id") % 50).cast("double") / 4).alias("value"),
                             F.when(F.col("id") % 13 != 0, F.concat(F.lit('{"k": '), F.col("id") % 9, F.lit("}"))).alias("props")) \
        .write.parquet(os.path.join(d, "events.parquet"))
    agg = hourly_aggregate(spark, d, "B")
    sparse = session.materialize(agg, "sparse_test")
    n = sparse.count()
    assert largest_task(agg) < n / 3
    panel_b = densify_panel(sparse.filter("station IS NOT NULL"), SPEC)
    assert panel_b.select(F.spark_partition_id().alias("p")).distinct().count() >= 8
    monkeypatch.setattr(session, "TASK_ROWS", 1 << 18)
    rows = lambda df: sorted(df.collect(), key=lambda r: (r["station"] or "", r["datetime"]))
    assert rows(agg) == rows(hourly_aggregate(spark, d, "B")) and len(rows(agg)) == n
    assert rows(panel_b) == rows(densify_panel(sparse.filter("station IS NOT NULL"), SPEC))
    # by hand from the events
    events, cells = spark.read.parquet(os.path.join(d, "events.parquet")).collect(), {}
    for e in events:
        cells.setdefault((e["user_id"] and str(e["user_id"]) if e["user_id"] != 0 else "0", e["ts"].replace(minute=0, second=0)), []).append(e)
    assert n == len(cells)
    for r in agg.collect():
        own = cells[r["station"], r["datetime"]]
        v = [e["value"] for e in own if e["value"] is not None]
        k = [int(e["props"][6:-1]) for e in own if e["props"]]
        assert (r["_n"], r["_u"]) == (len(v), len({e["event_type"] for e in own} - {None}))
        assert (r["vmax"], r["vmin"], r["_ksum"]) == (max(v, default=None), min(v, default=None), sum(k) if k else None)
        assert r["k"] == (sum(k) / len(k) if k else None) and (r["y"] is None) == (not v)
