"""Ridge by LSQR against the normal equations."""

import numpy as np
import pandas as pd
import pytest

from hourweave.operators.lsqr import fit_ridge_lsqr


def made(rows, series, seed=1):
    g = np.random.default_rng(seed)
    a = g.normal(size=rows)
    frame = pd.DataFrame({"a": a, "b": a * 0.95 + 0.1 * g.normal(size=rows) + 50, "s": [f"s{i:06d}" for i in g.integers(0, series + 1, rows)]})
    frame["target"] = 3 * frame["a"] - frame["b"] + frame["s"].str[1:].astype(int) % 7 + g.normal(size=rows) + 1000
    return frame


def known(spark, series):
    return spark.createDataFrame(pd.DataFrame({"station": [f"s{i:06d}" for i in range(series)], "position": range(series)}))


def solved(frame, series, alpha):
    x = frame[["a", "b"]].to_numpy()
    if series:
        at = frame["s"].str[1:].astype(int).to_numpy()
        x = np.c_[x, (at[:, None] == np.arange(series)).astype(float)]  # the value series itself is unknown: all zeros
    y = frame["target"].to_numpy()
    c = x - x.mean(0)
    w = np.linalg.solve(c.T @ c + alpha * np.eye(x.shape[1]), c.T @ (y - y.mean()))
    return w, y.mean() - x.mean(0) @ w, x


@pytest.mark.parametrize("alpha", [0.5, 10.0])
@pytest.mark.parametrize("series", [0, 40])
def test_it_solves_the_normal_equations(spark, alpha, series):
    frame = made(9000, series or 5)
    w, b, x = solved(frame, series, alpha)
    rows = spark.createDataFrame(frame).repartition(3)
    model = fit_ridge_lsqr(rows, ["a", "b"], alpha=alpha, **({"series": "s", "known": known(spark, series)} if series else {}))
    assert model.weights == pytest.approx(w[:2], rel=1e-6) and model.intercept == pytest.approx(b, rel=1e-6)
    assert model.gradient < 1e-7
    got = model.transform(spark.createDataFrame(frame)).select("a", "y_pred").toPandas().sort_values("a")["y_pred"].to_numpy()
    assert got == pytest.approx((b + x @ w)[np.argsort(frame["a"].to_numpy())], rel=1e-6)
    if series:
        effects = model.effects.orderBy("series").toPandas()["effect"].to_numpy()
        assert effects == pytest.approx(w[2:], rel=1e-6, abs=1e-6)


def test_many_series(spark):
    """100,000 indicators, solved in closed form: effect = n / (n + alpha) * (mean - intercept)."""
    frame = made(150_000, 100_000, seed=2)
    model = fit_ridge_lsqr(spark.createDataFrame(frame), [], alpha=2.0, series="s", known=known(spark, 100_000))
    own = frame[frame["s"] != "s100000"].groupby("s")["target"].agg(["count", "mean"])
    weight = own["count"] * 2.0 / (own["count"] + 2.0)
    other = frame[frame["s"] == "s100000"]["target"]
    b = ((weight * own["mean"]).sum() + other.sum()) / (weight.sum() + len(other))
    assert model.intercept == pytest.approx(b, rel=1e-9)
    got = model.effects.toPandas().set_index("series")["effect"]
    assert len(got) == 100_000
    expected = own["count"] / (own["count"] + 2.0) * (own["mean"] - b)
    assert got.loc[expected.index].to_numpy() == pytest.approx(expected.to_numpy(), abs=1e-6)
    assert (got.drop(expected.index).abs() < 1e-9).all()


def test_edges(spark):
    schema = "a double, target double"
    flat = fit_ridge_lsqr(spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], schema), ["a"])
    assert flat.weights == [0.0] and flat.intercept == 5.0
    with pytest.raises(ValueError):
        fit_ridge_lsqr(spark.createDataFrame([], schema), ["a"])
    with pytest.raises(Exception, match="finite"):
        fit_ridge_lsqr(spark.createDataFrame([(None, 5.0)], schema), ["a"])
