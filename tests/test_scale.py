"""Scale laws: exact quantiles without whole-group tasks; a hot series spread over tasks."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourweave.config import PanelSpec
from hourweave.functions.quantiles import exact_quantiles
from hourweave.operators import windows as W
from hourweave.operators.lookback import PART, lookback_window, with_lookback_parts


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_exact_quantiles_match_numpy(spark, parts):
    rng = np.random.default_rng(7)
    hot = np.round(rng.normal(50, 20, 3000), 1)          # one group holds most rows, many ties
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in (1.0, 2.0, 2.0, 10.0)]
    rows += [("cold", None), ("one", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = {r["g"]: r for r in exact_quantiles(df, "v", probs, ["g"], partitions=parts).collect()}
    for g, vals in (("hot", hot), ("cold", np.array([1.0, 2.0, 2.0, 10.0])), ("one", np.array([5.0]))):
        for i, p in enumerate(probs):
            assert got[g][f"q_{i}"] == pytest.approx(float(np.quantile(vals, p)), abs=1e-9)
    whole = exact_quantiles(df, "v", [0.5], partitions=parts).first()[0]
    assert whole == pytest.approx(float(np.median(np.concatenate([hot, [1.0, 2.0, 2.0, 10.0, 5.0]]))))


def test_hot_series_spans_many_window_partitions(spark):
    spec = PanelSpec(target="a", primary=("a",), context=(), wind=None, window=24, chunk_hours=48)
    start = dt.datetime(2020, 1, 1)
    df = spark.range(0, 24 * 40).select(
        F.lit("hot").alias("station"),
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("datetime"),
        F.col("id").cast("double").alias("a"), F.col("id").cast("double").alias("target_a"), F.lit("train").alias("split"))
    x = with_lookback_parts(df, spec, 24).withColumn("_lag", F.lag("a", 1).over(lookback_window(spec)))
    tasks = x.select(F.spark_partition_id().alias("p")).distinct().count()
    assert x.select(PART).distinct().count() >= 20 and tasks > 1
    # and the result equals the unchunked computation
    a = W.lag_features(df, spec).orderBy("target_datetime").collect()
    b = W.lag_features(df, spec.with_(chunk_hours=None)).orderBy("target_datetime").collect()
    assert a == b and len(a) == 24 * 40 - 24


def test_prefix_sum_and_dense_ids_match_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(f"s{i:03d}", int(rng.integers(0, 50))) for i in range(300)]
    df = spark.createDataFrame(rows, "station string, c long")
    got = {r["station"]: r["off"] for r in W.prefix_sum(df, ["station"], "c", "off").collect()}
    run = 0
    for s, c in sorted(rows):
        assert got[s] == run
        run += c
    # dense ids over many series and chunks equal a sorted enumeration
    spec = PanelSpec(target="a", primary=("a",), context=(), wind=None, chunk_hours=7)
    t0 = dt.datetime(2020, 1, 1)
    pts = [(f"s{i % 40:02d}", t0 + dt.timedelta(hours=int(h))) for i, h in enumerate(rng.integers(0, 200, 2000))]
    pts = sorted(set(pts))
    idx = spark.createDataFrame(pts, "station string, target_datetime timestamp_ntz")
    ids = W.dense_sequence_id(idx, spec.with_(time="target_datetime"), "target_datetime") \
        .orderBy("sequence_id").collect()
    assert [r["sequence_id"] for r in ids] == list(range(len(pts)))
    assert [(r["station"], r["target_datetime"]) for r in ids] == pts
