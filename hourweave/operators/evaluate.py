"""Evaluation operators (E1-E16) on a long prediction table.

Every metric is one aggregation with a map-side partial: the shuffle carries one
row per group and task, whatever the number of predictions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SPLITS, TARGET_RANGES
from ..functions.exprs import is_finite, range_labels, regression_metric_columns
from .forecast import clip_predictions

KEYS = ("model", "split")


def _keys(df: DataFrame, keys) -> list[str]:
    return [k for k in keys if k in df.columns]


def prepare_predictions(pred: DataFrame, clip: bool = True) -> DataFrame:
    """E4 step 1: clip (evaluation clips, the weight search does not)."""
    return pred.withColumn("y_pred", clip_predictions("y_pred")) if clip else pred


def metrics_overall(pred: DataFrame, keys=KEYS, clip: bool = True) -> DataFrame:
    """E1 per (model, split)."""
    k = _keys(pred, keys)
    return prepare_predictions(pred, clip).groupBy(*k).agg(*regression_metric_columns("y_true", "y_pred"))


def metrics_by_station(pred: DataFrame, keys=KEYS, clip: bool = True) -> DataFrame:
    """E2; rows without a station are left out (as a pandas groupby does)."""
    k = _keys(pred, keys)
    x = prepare_predictions(pred, clip).filter(F.col("station").isNotNull())
    return x.groupBy(*k, "station").agg(*regression_metric_columns("y_true", "y_pred"))


def metrics_by_range(pred: DataFrame, keys=KEYS, clip: bool = True, disjoint: bool = False) -> DataFrame:
    """Per target range; a target of exactly 250 counts in two ranges by default.

    Each row is exploded into the 0-2 ranges containing it (map side), so no
    non-equi join is needed; empty ranges produce no row.
    """
    k = _keys(pred, keys)
    x = prepare_predictions(pred, clip).select("*", F.explode(range_labels("y_true", disjoint)).alias("pollution_range"))
    return x.groupBy(*k, "pollution_range").agg(*regression_metric_columns("y_true", "y_pred"))


def metrics_long(pred: DataFrame, clip: bool = True) -> DataFrame:
    """Overall and per-station metrics of every (model, split) in one aggregation
    (GROUPING SETS); ``station`` is NULL on the overall rows."""
    x = prepare_predictions(pred, clip)
    return x.groupingSets([["model", "split"], ["model", "split", "station"]], "model", "split", "station").agg(
        *regression_metric_columns("y_true", "y_pred"))


def metrics_pivot(metrics: DataFrame, value: str = "rmse") -> DataFrame:
    """E5: model x split table of one metric."""
    return metrics.groupBy("model").pivot("split", list(SPLITS)).agg(F.first(value))


def union_metrics(*tables: DataFrame) -> DataFrame:
    """Metric tables of several sources as one, by column name (columns that a table lacks are NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def model_ranking(metrics: DataFrame, relabel: dict[str, str] | None = None) -> DataFrame:
    """Rank per split by RMSE (ties share a rank)."""
    m = metrics
    if relabel:
        m = m.replace(relabel, subset=["model"])
    return m.withColumn("rank", F.rank().over(Window.partitionBy("split").orderBy("rmse")).cast("long"))


def best_model(metrics: DataFrame, split: str = "validation") -> DataFrame:
    """The model with the lowest RMSE on ``split`` (model name breaks ties)."""
    return metrics.filter(F.col("split") == split).orderBy("rmse", "model").limit(1)


def station_ranking(station_metrics: DataFrame, model: str, split: str) -> DataFrame:
    """E14."""
    return station_metrics.filter((F.col("model") == model) & (F.col("split") == split)).orderBy("rmse", "station")


def range_extract(range_metrics: DataFrame, model: str, split: str) -> DataFrame:
    """One model's target ranges on one split, lowest range first."""
    order = F.array(*[F.lit(r[0]) for r in TARGET_RANGES])
    return range_metrics.filter((F.col("model") == model) & (F.col("split") == split)).orderBy(
        F.array_position(order, F.col("pollution_range")))


def prediction_summary(pred: DataFrame, keys=("model",), population_std: bool = False, col: str = "y_pred") -> DataFrame:
    """Rows, min, max, mean, std, missing, negative."""
    k = _keys(pred, keys)
    v = F.col(col)
    std = F.stddev_pop(v) if population_std else F.stddev_samp(v)
    return pred.groupBy(*k).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), std.alias("std"),
        F.sum((~is_finite(v)).cast("long")).alias("missing"),
        F.sum((v < 0).cast("long")).alias("negative"),
    )


# ---------------------------------------------------------------- ablation analysis


def ablation_summary(results: DataFrame) -> DataFrame:
    """Per (model, window, feature set); sample std (NULL for one run)."""
    return results.groupBy("model", "window_size", "feature_set").agg(
        F.count("run_id").alias("runs"),
        F.avg("validation_rmse").alias("validation_rmse_mean"),
        F.stddev_samp("validation_rmse").alias("validation_rmse_std"),
        F.min("validation_rmse").alias("validation_rmse_min"),
        F.avg("validation_mae").alias("validation_mae_mean"),
        F.avg("local_test_rmse").alias("local_test_rmse_mean"),
        F.stddev_samp("local_test_rmse").alias("local_test_rmse_std"),
        F.avg("training_seconds").alias("training_seconds_mean"),
    )


def ablation_improvement(results: DataFrame, seed: int | None = 42) -> DataFrame:
    """Per window, RMSE without vs with the context features and the reduction."""
    r = results if seed is None else results.filter(F.col("seed") == seed)
    p = r.groupBy("window_size").pivot("feature_set", ["pollution_only", "all_features"]).agg(F.avg("validation_rmse"))
    p = p.select("window_size", F.col("pollution_only").alias("pollution_only_rmse"),
                 F.col("all_features").alias("all_features_rmse"))
    red = F.col("pollution_only_rmse") - F.col("all_features_rmse")
    return p.select("*", red.alias("absolute_rmse_reduction"),
                    (red / F.col("pollution_only_rmse") * 100).alias("relative_improvement_percent"))


def ablation_tradeoff(results: DataFrame, feature_set: str = "all_features", seed: int | None = 42) -> DataFrame:
    """cost/accuracy rows of one feature set."""
    r = results if seed is None else results.filter(F.col("seed") == seed)
    cols = [c for c in ("window_size", "training_seconds", "validation_rmse", "validation_mae", "best_epoch") if c in r.columns]
    return r.filter(F.col("feature_set") == feature_set).select(*cols).orderBy("window_size")


def selected_configuration(results: DataFrame, seed: int | None = 42) -> DataFrame:
    """The run with the lowest validation RMSE (one row)."""
    r = results if seed is None else results.filter(F.col("seed") == seed)
    best = F.min_by(F.struct("run_id", "model", "window_size", "feature_set", "validation_rmse"),
                    F.struct("validation_rmse", "run_id"))
    return r.agg(best.alias("b")).select("b.*")


def seed_robustness(results: DataFrame, window: int, feature_set: str, model: str | None = None) -> DataFrame:
    """Mean and sample std over seeds of one configuration, one row per metric."""
    r = results.filter((F.col("window_size") == window) & (F.col("feature_set") == feature_set))
    if model:
        r = r.filter(F.col("model") == model)
    a = r.agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg("validation_rmse").alias("v_mean"), F.stddev_samp("validation_rmse").alias("v_sd"),
        F.avg("local_test_rmse").alias("t_mean"), F.stddev_samp("local_test_rmse").alias("t_sd"),
    )
    return a.select("runs", F.inline(F.array(
        F.struct(F.lit("validation_rmse").alias("metric"), F.col("v_mean").alias("mean"), F.col("v_sd").alias("sample_sd")),
        F.struct(F.lit("local_test_rmse").alias("metric"), F.col("t_mean").alias("mean"), F.col("t_sd").alias("sample_sd")),
    )))


def best_epoch(history: DataFrame, run_col: str = "run_id", epoch_col: str = "epoch", metric: str = "val_rmse") -> DataFrame:
    """Epoch (iteration) of the minimum validation metric per run; the earliest on ties."""
    return history.groupBy(run_col).agg(
        F.min_by(F.col(epoch_col), F.struct(F.col(metric), F.col(epoch_col))).alias("best_epoch"),
        F.min(metric).alias(f"best_{metric}"),
    )


def ablation_ranking(results: DataFrame, seed: int = 42) -> DataFrame:
    """Runs of one seed with a label ``MODEL / <w>h / feature_set``, best first."""
    label = F.concat_ws(" / ", F.upper("model"), F.concat(F.col("window_size").cast("string"), F.lit("h")), "feature_set")
    return results.filter(F.col("seed") == seed).select("run_id", label.alias("label"), "validation_rmse") \
        .orderBy("validation_rmse", "run_id")


def recombine_overall(station_metrics: DataFrame) -> DataFrame:
    """Law check: per-station RMSE/MAE recombine to the overall figures."""
    return station_metrics.groupBy("model", "split").agg(
        F.sum("samples").alias("samples"),
        F.sqrt(F.sum(F.col("samples") * F.col("rmse") * F.col("rmse")) / F.sum("samples")).alias("rmse"),
        (F.sum(F.col("samples") * F.col("mae")) / F.sum("samples")).alias("mae"),
    )
