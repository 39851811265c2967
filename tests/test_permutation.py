"""The seeded permutation behind the epoch shuffle."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourweave.functions import permutation as P
from hourweave.operators import windows as W


def plain(x, n, seed, epoch=0):
    """One number at a time, walking on until it is below n."""
    a, b = P._halves(n)
    while True:
        low, high = x % a, x // a
        for j, (factor, offset) in enumerate(P.round_keys(seed, epoch)):
            u = ((low if j % 2 else high) * factor + offset) % P.PRIME
            add = (u * u % P.PRIME * u + u) % P.PRIME
            low, high = (low, (high + add) % b) if j % 2 else ((low + add) % a, high)
        x = low + a * high
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 97, 1000, 4097])
@pytest.mark.parametrize("seed", [0, 42])
def test_it_is_the_plain_walk_and_a_bijection(spark, n, seed):
    got = spark.range(n).withColumn("p", P.permuted(F.col("id"), n, seed)).orderBy("id").toPandas()["p"].tolist()
    assert got == [plain(x, n, seed) for x in range(n)]
    assert sorted(got) == list(range(n))


def test_walks_of_several_passes_end():
    n, longest = 0, 0
    for n in range(2, 1000):
        longest = max(longest, P.longest_walk(n, P.round_keys(7)))
    assert longest > 2


def test_large_ids_keep_all_their_bits(spark):
    n = 4 * 10**18 + 7
    ids = [0, 1, n - 1, 2**53 + 1, 3 * 10**18 + 1]
    # the walk is given: the pairs beyond n are too many to list here
    keep, P.longest_walk = P.longest_walk, lambda n, keys: 3
    try:
        frame = spark.createDataFrame([(i,) for i in ids], "id long")
        got = [r["p"] for r in frame.withColumn("p", P.permuted(F.col("id"), n, 42)).collect()]
    finally:
        P.longest_walk = keep
    assert got == [plain(i, n, 42) for i in ids]


def test_nulls_stay_and_bad_sizes_are_refused(spark):
    frame = spark.createDataFrame([(None,), (1,)], "id long")
    assert [r["p"] is None for r in frame.withColumn("p", P.permuted(F.col("id"), 2, 1)).collect()] == [True, False]
    with pytest.raises(ValueError):
        frame.withColumn("p", P.permuted(F.col("id"), 0, 1))


def test_neighbours_and_epochs_are_spread(spark):
    n = 100_000
    x = spark.range(n)
    for e in range(3):
        x = x.withColumn(f"e{e}", P.permuted(F.col("id"), n, 42, e))
    x = x.orderBy("id").drop("id").toPandas().to_numpy()
    for e in range(3):
        assert abs(np.corrcoef(np.arange(n), x[:, e])[0, 1]) < 0.02
        assert (np.abs(np.diff(x[:, e])) < n // 100).mean() < 0.03
    assert abs(np.corrcoef(x[:, 0], x[:, 1])[0, 1]) < 0.02
    batches = [len(set(x[k:k + 500, 0] // 500)) for k in range(0, n, 500)]
    assert min(batches) > 150  # 500 neighbours go to 184 of 200 batches in the mean


def test_batches_of_dense_ids_need_no_exchange_of_rows(spark):
    index = spark.range(10_000).select(F.col("id").alias("sequence_id"))
    one = W.window_batches(index, 64, seed=42)
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
    assert one.groupBy("batch_id").count().filter("count <> 64").count() == 1  # the last one, 16 rows


@pytest.mark.parametrize("ids", [[0, 1, 1, 3, 4], [2, 5, 9], [0, 1, None], [1, 2, 3]])
def test_other_ids_are_ranked(spark, ids):
    index = spark.createDataFrame([(i,) for i in ids], "sequence_id long")
    assert W._dense_size(index) == 0
    got = W.window_batches(index, 2, seed=42).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in got) == sorted([2] * (len(ids) // 2) + [1] * (len(ids) % 2))
