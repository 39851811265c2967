"""Boosted trees against a plain trainer, on any partitions, in one task and in lockstep."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourweave.operators import boosting as B


def table(spark, n=700, partitions=3, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(2)
    y = np.where(x[:, 0] > 0.3, 5.0, 0.0) + x[:, 1] * x[:, 2] + rng.normal(size=n) * 0.1
    rows = [(int(i), *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, target double").repartition(partitions, "id")


def plain_fit(x, y, edges, growth):
    """(base, trees as nested tuples): the same growth rule, row by row, without histograms."""
    n, f = x.shape
    bins = [[sum(float(e) < x[i, j] for e in edges[j]) for j in range(f)] for i in range(n)]
    scale = 2.0 ** (40 - math.frexp(max(abs(float(y.min())), abs(float(y.max()))))[1])
    base = sum(round(v * scale) for v in y.tolist()) / scale / n
    pred, trees = [base] * n, []
    bound = max(abs(float(y.min()) - base), abs(float(y.max()) - base))

    def best(rows, step, unit):
        total, out = sum(step[i] for i in rows), None
        for j in range(f):
            for cut in sorted({bins[i][j] for i in rows}):
                left = [i for i in rows if bins[i][j] <= cut]
                nl, nr = len(left), len(rows) - len(left)
                if min(nl, nr) < growth.least:
                    continue
                sl = sum(step[i] for i in left) / unit
                sr = total / unit - sl
                gain = sl * sl / (nl + growth.l2) + sr * sr / (nr + growth.l2) - (total / unit)**2 / (len(rows) + growth.l2)
                if gain > 0 and (out is None or gain > out[0]):
                    out = gain, j, cut
        return out

    for _ in range(growth.iterations):
        residual = [a - p for a, p in zip(y.tolist(), pred, strict=True)]
        unit = 2.0 ** math.floor(math.log2((1 << 19) / bound))
        step = [round(r * unit) for r in residual]
        leaves = [(list(range(n)), best(list(range(n)), step, unit))]
        while len(leaves) < growth.leaves and any(s for _, s in leaves):
            k = max((i for i in range(len(leaves)) if leaves[i][1]), key=lambda i: leaves[i][1][0])
            rows, (_, j, cut) = leaves.pop(k)
            for part in ([i for i in rows if bins[i][j] <= cut], [i for i in rows if bins[i][j] > cut]):
                leaves.append((part, best(part, step, unit)))
        trees.append(len(leaves))
        bound = max(map(abs, residual)) * (1 + growth.rate)
        for rows, _ in leaves:
            value = growth.rate * sum(step[i] for i in rows) / unit / (len(rows) + growth.l2)
            for i in rows:
                pred[i] += value
    return base, trees, np.array(pred)


def test_equals_a_plain_trainer(spark):
    df = table(spark, 160)
    growth = B.Growth(iterations=4, leaves=6, least=8, rate=0.3)
    names = ("a", "b", "c", "d")
    for limit in (1 << 30, 0):  # in one task, and in passes over the blocks
        model = B.fit_many(df, [B.Run(names)], key=["id"], growth=growth, local_bytes=limit)[0]
        frame = df.orderBy("id").toPandas()
        base, leaves, pred = plain_fit(frame[list(names)].to_numpy(), frame["target"].to_numpy(),
                                       [np.array(e) for e in model.edges], growth)
        assert model.base == base
        assert [sum(f < 0 for f in t.feature) for t in model.trees] == leaves
        assert np.abs(model.predict(frame) - pred).max() < 1e-12


def fitted(df, limit, runs, growth):
    return [(m.base, m.edges, m.trees) for m in B.fit_many(df, runs, key=["id"], growth=growth, local_bytes=limit)]


def test_the_same_trees_on_any_partitions_and_either_way(spark, monkeypatch):
    growth = B.Growth(iterations=3, leaves=12, least=5)
    names = ("a", "b", "c", "d")
    runs = [B.Run(names), B.Run(names, 7, 0.7, 0.6), B.Run(("b", "d"), 123, 0.7)]
    want = fitted(table(spark, partitions=1), 1 << 30, runs, growth)
    assert fitted(table(spark, partitions=8), 1 << 30, runs, growth) == want
    assert fitted(table(spark, partitions=3), 0, runs, growth) == want
    monkeypatch.setattr(B, "CHECKPOINT", 2)
    assert fitted(table(spark, partitions=8), 0, runs, growth) == want


def test_small_blocks_give_the_same_trees(spark, monkeypatch):
    growth = B.Growth(iterations=3, leaves=8, least=5)
    runs = [B.Run(("a", "b", "c", "d"), 5, 0.8, 0.8)]
    want = fitted(table(spark), 1 << 30, runs, growth)
    monkeypatch.setattr(B, "BLOCK_ROWS", 64)
    assert fitted(table(spark), 1 << 30, runs, growth) == want


def test_seeds_differ_and_repeat(spark):
    df, growth, names = table(spark), B.Growth(iterations=5, leaves=8), ("a", "b", "c", "d")
    models = B.fit_many(df, [B.Run(names, s, 0.8, 0.8) for s in (42, 123, 2026, 42)], key=["id"], growth=growth)
    x = df.toPandas()
    rmse = [float(np.sqrt(((m.predict(x) - x["target"])**2).mean())) for m in models]
    assert len(set(rmse)) == 3 and rmse[0] == rmse[3]
    assert np.std(rmse[:3], ddof=1) > 0


def test_scores_histories_and_saved_models(spark, tmp_path):
    df, growth = table(spark), B.Growth(iterations=20, leaves=8, rate=0.2)
    model = B.fit_many(df, [B.Run(("a", "b", "c"))], key=["id"], growth=growth)[0]
    scored = model.transform(df).toPandas()
    assert np.array_equal(scored["y_pred"].to_numpy(), model.predict(scored))
    curve = [r["val_rmse"] for r in B.histories({"x": model}, df).orderBy("epoch").collect()]
    assert len(curve) == 20 and curve[-1] < curve[0] / 2
    assert abs(curve[-1] - float(np.sqrt(((scored["y_pred"] - scored["target"])**2).mean()))) < 1e-12
    model.save(spark, str(tmp_path / "m"))
    assert B.BoostedModel.load(spark, str(tmp_path / "m")) == model


def test_missing_values_ties_and_empty_tables(spark):
    rows = [(i, None if i % 3 else float(i % 5), 1.0, float(i % 3 > 0)) for i in range(120)] + [(500, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double, target double")
    model = B.fit_many(df, [B.Run(("a", "b"))], key=["id"], growth=B.Growth(iterations=60, least=5, rate=0.3))[0]
    x = df.filter(F.col("target").isNotNull()).toPandas()
    assert np.abs(model.predict(x) - x["target"]).max() < 0.05  # missing values are a side of their own
    with pytest.raises(ValueError):
        B.fit_many(df.limit(0), [B.Run(("a",))], key=["id"])
    flat = B.fit_many(df.withColumn("target", F.lit(2.5)), [B.Run(("a",))], key=["id"], growth=B.Growth(iterations=2))[0]
    assert set(flat.predict(x)) == {2.5}
