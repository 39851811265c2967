"""Two-model blending: alignment, convex blend, weight search, frozen-weight evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import regression_metric_columns
from .evaluate import metrics_overall

KEY = ("station", "target_datetime")


def align_predictions(first: DataFrame, second: DataFrame, key=KEY, rtol: float = 1e-5, atol: float = 1e-8) -> tuple[DataFrame, DataFrame]:
    """One-to-one alignment of two prediction tables on ``key``.

    Returns (aligned, violations).  ``aligned``: key, split, y_true, pred_first, pred_second of the keys that
    stand once on either side.  ``violations``: one row per rule with a count -- keys repeated in a table, keys
    present in only one table, and keys once on either side whose split or y_true disagree (``allclose`` rule).
    A repeated key is neither aligned nor compared: which of its rows belong together is not known.
    """
    key = list(key)

    def once(df: DataFrame, tag: str) -> DataFrame:
        values = F.struct(F.col("split").alias("s"), F.col("y_true").alias("y"), F.col("y_pred").alias("p"))
        return df.groupBy(*key).agg(F.count(F.lit(1)).alias(f"n{tag}"), F.max(values).alias(tag))

    # NULL keys are keys of their own, as in the grouping
    a, b = once(first, "a").alias("a"), once(second, "b").alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key]
    j = a.join(b, on, "full_outer").select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in key], "na", "nb",
                                           F.col("a.a").alias("a"), F.col("b.b").alias("b"))
    pair = (F.col("na") == 1) & (F.col("nb") == 1)
    close = F.abs(F.col("a.y") - F.col("b.y")) <= F.lit(atol) + F.lit(rtol) * F.abs(F.col("b.y"))
    flags = {"missing_in_first": F.col("na").isNull(), "missing_in_second": F.col("nb").isNull(),
             "repeated_in_first": F.col("na") > 1, "repeated_in_second": F.col("nb") > 1,
             "split_mismatch": pair & (F.col("a.s") != F.col("b.s")), "y_true_mismatch": pair & ~close}
    counts = j.agg(*[F.count(F.when(f, 1)).alias(r) for r, f in flags.items()])
    violations = counts.select(F.inline(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.col(r).alias("violations")) for r in flags])))
    aligned = j.filter(pair).filter("a.p IS NOT NULL AND b.p IS NOT NULL").select(
        *key, F.col("a.s").alias("split"), F.col("a.y").alias("y_true"), F.col("a.p").alias("pred_first"),
        F.col("b.p").alias("pred_second"))
    return aligned, violations


def wide_pair(wide: DataFrame, first: str, second: str) -> DataFrame:
    """Aligned pair straight from a wide prediction table (already one row per target)."""
    return wide.select(*[c for c in ("station", "split", "target_datetime", "y_true") if c in wide.columns],
                       F.col(first).alias("pred_first"), F.col(second).alias("pred_second"))


def blend(aligned: DataFrame, first_weight: float) -> DataFrame:
    """F8: ``w * first + (1 - w) * second``; ``w`` must lie in [0, 1]."""
    w = float(first_weight)
    if not 0.0 <= w <= 1.0:
        raise ValueError(f"first_weight must be within [0, 1], got {w}")
    return aligned.withColumn("y_pred", F.lit(w) * F.col("pred_first") + F.lit(1.0 - w) * F.col("pred_second"))


def weight_grid_size(step: float) -> int:
    n = round(1.0 / step)
    if n <= 0 or abs(n * step - 1.0) > 1e-9:
        raise ValueError(f"step must divide 1 evenly, got {step}")
    return n


def weight_search(aligned: DataFrame, step: float = 0.01) -> DataFrame:
    """RMSE / MAE / R^2 of every weight on the ``round(1/step)+1`` grid (unclipped).

    One pass with a handful of sums.  Squared errors of all weights follow from the sums of e1^2, e1*e2 and e2^2.
    |e2 + w (e1 - e2)| is linear in w on both sides of its kink, so a row adds intercept and slope to the bin of
    the first weight beyond its kink; the sums below and above a weight give its absolute error.
    """
    n = weight_grid_size(step)
    y, e1, e2 = F.col("y_true"), F.col("y_true") - F.col("pred_first"), F.col("y_true") - F.col("pred_second")
    rows = aligned.select(y.alias("y"), e1.alias("e1"), e2.alias("e2")).filter("e1 IS NOT NULL AND e2 IS NOT NULL")
    d, e2 = F.col("e1") - F.col("e2"), F.col("e2")
    kink = F.when((d != 0) & (e2 != 0), -e2 / d)
    turns = F.coalesce(F.when((kink >= 0) & (kink < 1), F.floor(kink * n).cast("int") + 1), F.lit(n + 1))
    sign = F.signum(F.when(e2 != 0, e2).otherwise(d))
    bins = rows.groupBy(turns.alias("turns")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(sign * e2).alias("a"), F.sum(sign * d).alias("b"),
        F.sum(F.col("e1") * F.col("e1")).alias("s11"), F.sum(F.col("e1") * e2).alias("s12"), F.sum(e2 * e2).alias("s22"),
        F.avg("y").alias("y"), F.var_pop("y").alias("v"))
    # n + 2 rows at most
    mean = F.sum(F.col("n") * F.col("y")) / F.sum("n")
    one = bins.agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in ("s11", "s12", "s22")], mean.alias("mean"),
                   F.collect_list(F.struct("turns", "a", "b", "n", "y", "v")).alias("bins")).filter("n > 0")
    one = one.withColumn("sst", F.aggregate("bins", F.lit(0.0), lambda s, r: s + r["n"] * (
        r["v"] + (r["y"] - F.col("mean")) * (r["y"] - F.col("mean")))))
    grid = one.select("n", "s11", "s12", "s22", "sst", "bins", F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(round(i / n, 10)).alias("first_weight")) for i in range(n + 1)])))
    w = F.col("first_weight")
    absolute = F.aggregate("bins", F.lit(0.0), lambda s, r: s + F.when(r["turns"] > F.col("i"), 1.0).otherwise(-1.0) * (
        r["a"] + w * r["b"]))
    sse = F.greatest(F.lit(0.0), w * w * F.col("s11") + 2 * w * (1 - w) * F.col("s12") + (1 - w) * (1 - w) * F.col("s22"))
    sst = F.col("sst")
    r2 = (F.when(F.col("n") < 2, F.lit(None).cast("double"))
          .when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(1 - sse / sst))
    return grid.select("first_weight", F.round(F.lit(1.0) - w, 10).alias("second_weight"),
                       F.sqrt(sse / F.col("n")).alias("rmse"),
                       (F.greatest(F.lit(0.0), absolute) / F.col("n")).alias("mae"), r2.alias("r2"))


def best_weight(search: DataFrame) -> DataFrame:
    """lowest RMSE, then MAE, then the smaller weight (one row)."""
    return search.orderBy("rmse", "mae", "first_weight").limit(1)


def ensemble_metrics(aligned: DataFrame, weight: float, name: str = "blend") -> DataFrame:
    """the frozen weight (chosen on validation) evaluated on every split, clipped."""
    b = blend(aligned, weight).withColumn("model", F.lit(name))
    return metrics_overall(b.select("model", "split", "y_true", "y_pred"))


def chosen_weight(aligned: DataFrame, step: float = 0.01, split: str = "validation") -> float:
    """Weight chosen on ``split`` (one scalar to the driver); no rows on ``split`` is an error."""
    row = best_weight(weight_search(aligned.filter(F.col("split") == split), step)).first()
    if row is None:
        raise ValueError(f"no aligned predictions on split {split!r} to choose a weight from")
    return float(row["first_weight"])
