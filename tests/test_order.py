"""Ranks, prefix sums, batches and quantiles at a size where range bounds are sampled."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourweave.functions.quantiles import exact_quantiles
from hourweave.operators import windows as W

N = 1_000_000


@pytest.fixture(params=["true", "false"])
def reuse(spark, request):
    spark.conf.set("spark.sql.exchange.reuse", request.param)
    yield request.param
    spark.conf.unset("spark.sql.exchange.reuse")


def payload(spark):
    return spark.range(N).select("id", F.xxhash64("id").alias("key"), F.repeat(F.lit("x"), 20).alias("a"), F.rand(3).alias("b"))


def test_global_rank_has_every_position_once(spark, reuse):
    got = W.global_rank(payload(spark), ["key", "id"], "r")
    row = got.agg(F.count_distinct("r"), F.min("r"), F.max("r")).first()
    assert tuple(row) == (N, 0, N - 1)
    out_of_order = got.select("r", "key").orderBy("r").toPandas()["key"].to_numpy()
    assert (np.diff(out_of_order) >= 0).all()


def test_prefix_sum_is_the_running_sum(spark, reuse):
    got = W.prefix_sum(payload(spark).withColumn("n", F.lit(2)), ["key", "id"], "n", "before")
    assert tuple(got.agg(F.count_distinct("before"), F.min("before"), F.max("before")).first()) == (N, 0, 2 * (N - 1))


def test_shuffled_batches_are_full(spark, reuse):
    index = payload(spark).withColumnRenamed("id", "sequence_id")
    one = W.window_batches(index, 512, seed=42)
    sizes = [r["count"] for r in one.groupBy("batch_id").count().orderBy("batch_id").collect()]
    assert sizes[:-1] == [512] * (N // 512) and sizes[-1] == N % 512
    other = W.window_batches(index, 512, seed=42, epoch=1)
    same = one.select("sequence_id", "batch_id").join(other.select("sequence_id", F.col("batch_id").alias("o")), "sequence_id")
    assert same.filter("batch_id = o").count() < N // 100


def test_quantiles_with_a_value_that_most_rows_share(spark, reuse):
    x = spark.range(N).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 20 > 0, 7.0).otherwise(F.rand(5) * 20).alias("v"))
    probs = [0.0, 0.01, 0.5, 0.99, 1.0]
    x = x.withColumn("v", F.when(F.col("id") % 1000 == 1, None).otherwise(F.col("v"))) if "id" in x.columns else x
    want = {r["g"]: r["q"] for r in x.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, probs))).alias("q")).collect()}
    for few in (True, False):
        for r in exact_quantiles(x, "v", probs, ["g"], few_groups=few).collect():
            assert [r[f"q_{i}"] for i in range(5)] == pytest.approx(want[r["g"]], abs=1e-12)
    (whole,) = exact_quantiles(x, "v", [0.25]).collect()
    assert whole["q_0"] == pytest.approx(x.agg(F.percentile("v", 0.25)).first()[0], abs=1e-12)
