"""Ridge regression by LSQR over rows that stay where they are, with one indicator per series.

Golub-Kahan bidiagonalisation needs vectors ``u`` as long as the table and ``v`` as long as the coefficients.  Every
``u`` is a combination c * y + A * w of the label and the columns, so only ``c`` and ``w`` are kept: one pass over the
written blocks makes the next ``u`` row by row and sums its square and its product with the columns.  A pass shuffles
partial sums, at most one per column and task; nothing of the table's length is stored, moved or collected.

The series indicator is a position per row, never a column per series.  Its coefficients are part of the model and
are held by the driver as numbers: SERIES at most, beyond that the fit is refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: rows of a written block
BLOCK_ROWS = 4096
#: series with a coefficient of their own (8 bytes each)
SERIES = 20_000_000


@dataclass
class RidgeModel:
    """y_pred = intercept + features . weights + effect of the series (0 for unknown ones)."""

    features: list[str]
    weights: np.ndarray
    intercept: float
    series: str | None
    effects: DataFrame | None
    passes: int
    #: norm of the objective's gradient at the solution, relative to that at zero
    gradient: float

    def transform(self, df: DataFrame) -> DataFrame:
        y = F.lit(float(self.intercept))
        for name, weight in zip(self.features, self.weights.tolist(), strict=True):
            y = y + F.col(name).cast("double") * F.lit(weight)
        if self.effects is None:
            return df.withColumn("y_pred", y)
        known = self.effects.select(F.col("series").alias("_series"), F.col("effect").alias("_effect"))
        joined = df.join(known, df[self.series] == F.col("_series"), "left")
        return joined.withColumn("y_pred", y + F.coalesce("_effect", F.lit(0.0))).drop("_series", "_effect")


def _blocks(train: DataFrame, features: list[str], label: str) -> DataFrame:
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), BLOCK_ROWS):
                part = frame.iloc[k:k + BLOCK_ROWS]
                x = np.stack(part["x"].to_numpy()).astype(np.float64) if features else np.empty((len(part), 0))
                y = part["y"].to_numpy(np.float64)
                if not (np.isfinite(x).all() and np.isfinite(y).all()):
                    raise ValueError("features and label of a fit must be finite numbers")
                yield pd.DataFrame({"n": [len(part)], "x": [x.tobytes()], "y": [y.tobytes()],
                                    "at": [part["at"].to_numpy(np.int32).tobytes()]})

    x = F.array(*[F.col(c).cast("double") for c in features]) if features else F.array().cast("array<double>")
    rows = train.select(x.alias("x"), F.col(label).cast("double").alias("y"), "at")
    return materialize(rows.mapInPandas(pack, "n int, x binary, y binary, at binary"), "lsqr_blocks")


class _Columns:
    """Products with the columns, the label being one more column: sums over the blocks."""

    def __init__(self, blocks: DataFrame, dense: int, series: int):
        self.blocks, self.dense, self.series, self.passes = blocks, dense, series, 0

    def sums(self, weights: np.ndarray, c: float, shift: float) -> tuple[np.ndarray, np.ndarray, float, float]:
        """With t = rows . weights + c * y - shift: (columns' sums of t, (rows, sum of y), sum of t, sum of squares)."""
        dense, series = self.dense, self.series
        sent = self.blocks.sparkSession.sparkContext.broadcast(weights)

        def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            w = sent.value
            own, effects, rest = np.zeros(dense), np.zeros(series), np.zeros(4)
            for frame in frames:
                for n, x, y, at in zip(frame["n"], frame["x"], frame["y"], frame["at"], strict=True):
                    x, y = np.frombuffer(x).reshape(n, dense), np.frombuffer(y)
                    at = np.frombuffer(at, np.int32)
                    known = at >= 0
                    t = x @ w[:dense] + c * y - shift
                    t[known] += w[dense + at[known]]
                    own += x.T @ t
                    if series:
                        np.add.at(effects, at[known], t[known])
                    rest += (t.sum(), t @ t, n, y.sum())
            there = np.flatnonzero(effects)
            j = np.r_[np.arange(dense), dense + there, np.arange(4) - 4]
            yield pd.DataFrame({"j": j, "s": np.r_[own, effects[there], rest]})

        found = self.blocks.mapInPandas(add, "j long, s double").groupBy("j").agg(F.sum("s").alias("s")).toPandas()
        sent.unpersist()
        self.passes += 1
        out = np.zeros(dense + series + 4)
        out[found["j"].to_numpy() % len(out)] = found["s"].to_numpy()  # -4 .. -1 are the last four
        total, squares, n, y = out[-4:]
        return out[:-4], np.array([n, y]), float(total), float(squares)


def fit_ridge_lsqr(train: DataFrame, features: list[str], label: str = "target", alpha: float = 10.0, series: str | None = None,
                   known: DataFrame | None = None, tolerance: float = 1e-11, most_passes: int = 1000) -> RidgeModel:
    """ridge by LSQR; ``series`` names the column whose values, those in ``known``, get a coefficient each.

    ``known`` (series, position) numbers the values densely from 0, as ``FittedParams.station_table`` does; other
    values have no coefficient.  The intercept is not penalised.  Rows need finite features and a finite label.
    """
    spark = train.sparkSession
    if alpha < 0:
        raise ValueError("alpha must not be negative")
    size = known.count() if series else 0
    if size > SERIES:
        raise ValueError(f"{size} series: more coefficients than the driver is to hold")
    rows = train.withColumn("at", F.lit(-1))
    if series:
        places = known.select(F.col(known.columns[0]).alias("_series"), F.col("position").cast("int").alias("_at"))
        rows = train.join(places, train[series] == F.col("_series"), "left").withColumn("at", F.coalesce("_at", F.lit(-1)))
    columns = _Columns(_blocks(rows, features, label), len(features), size)
    dense, zero = len(features), np.zeros(len(features) + size)

    # column means (t = 1) and the label's
    ones, (n, total_y), _, _ = columns.sums(zero, 0.0, -1.0)
    if not n:
        raise ValueError("cannot fit on an empty training set")
    mean, mean_y = ones / n, total_y / n

    def centred(w: np.ndarray, c: float) -> tuple[np.ndarray, float]:
        """(product of the centred columns with t, norm of t) for t = centred columns . w + c * centred label."""
        product, _, total, squares = columns.sums(w, c, float(mean @ w + c * mean_y))
        return product - mean * total, float(np.sqrt(max(squares, 0.0)))

    damp, solution = float(np.sqrt(alpha)), zero.copy()
    product, beta = centred(zero, 1.0)
    first = float(np.linalg.norm(product))
    # label or columns that don't vary leave nothing to fit
    if beta > 0 and first > 0:
        c, w = 1.0 / beta, zero.copy()  # u = c * label + columns . w
        v = product / beta
        a = float(np.linalg.norm(v))
        v = v / a
        step, rest, low = v.copy(), beta, a
        while columns.passes < most_passes:
            c, w = -a * c, v - a * w
            product, beta = centred(w, c)
            if beta > 0:
                c, w = c / beta, w / beta
                product = product / beta - beta * v
                a = float(np.linalg.norm(product))
                v = product / a if a > 0 else product
            else:
                a = 0.0
            # rotations: the damping first, then the bidiagonal
            damped = float(np.hypot(low, damp))
            rest = rest * low / damped
            high = float(np.hypot(damped, beta))
            cosine, sine = damped / high, beta / high
            solution = solution + cosine * rest / high * step
            step = v - sine * a / high * step
            low, rest = -cosine * a, sine * rest
            if abs(rest * a * cosine) <= tolerance * first or a == 0:
                break
    # the gradient at the solution, from the rows themselves
    product, _ = centred(-solution, 1.0)
    left = float(np.linalg.norm(product - alpha * solution)) / first if first > 0 else 0.0
    effects = None
    if series:
        numbers = spark.createDataFrame(pd.DataFrame({"_at": np.arange(size, dtype=np.int32), "effect": solution[dense:]}),
                                        "_at int, effect double")
        effects = materialize(places.join(numbers, "_at").select(F.col("_series").alias("series"), "effect"), "lsqr_effects")
    return RidgeModel(list(features), solution[:dense], float(mean_y - mean @ solution), series, effects, columns.passes, left)
