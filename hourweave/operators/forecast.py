"""Forecast operators: persistence, window mean, ridge, histogram gradient boosting.

Predictions are one long table ``model, station, split, target_datetime, y_true,
y_pred`` (plus ``sequence_id`` where an index is attached).
"""

from __future__ import annotations

import time

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FEATURE_SETS, PanelSpec
from ..functions.exprs import regression_metric_columns
from ..sources.files import read_partitions, upsert, upsert_partitions
from .boosting import BoostedModel, Growth, Run, fit_many, histories
from .lookback import HALO, lookback_window, with_lookback_parts
from .preprocess import FittedParams, inverse_scale, select_feature_set
from .windows import _valid_target, tabular_features_multi, tabular_features_union

PRED_COLUMNS = ("model", "station", "split", "target_datetime", "y_true", "y_pred")


def clip_predictions(p: str | Column) -> Column:
    """negative predictions are impossible for the target -> 0; NULL and NaN stay as they are."""
    p = (F.col(p) if isinstance(p, str) else p).cast("double")
    return F.when(p < 0, F.lit(0.0)).otherwise(p)


def baseline_forecasts(processed: DataFrame, spec: PanelSpec, params: FittedParams,
                       window: int | None = None) -> DataFrame:
    """F1 persistence and F2 window mean, wide (one column per model).

    Both read the imputed target in original units (the standardised feature
    scaled back), over the same (series, chunk) window as the sequence index.
    """
    w = window or spec.window
    x = with_lookback_parts(processed.select(spec.station, spec.time, spec.observed_target, "split", spec.target), spec, w)
    x = x.withColumn("_y", inverse_scale(F.col(spec.target), params, spec.target))
    win = lookback_window(spec)
    x = x.select(
        spec.station, spec.time, spec.observed_target, "split", HALO,
        F.lag("_y", 1).over(win).alias("persistence"),
        F.avg("_y").over(win.rowsBetween(-w, -1)).alias("window_mean"),
        _valid_target(spec, w).alias("_ok"),
    )
    return x.filter("_ok").select(
        F.col(spec.station).alias("station"), "split", F.col(spec.time).alias("target_datetime"),
        F.col(spec.observed_target).cast("double").alias("y_true"), "persistence", "window_mean",
    )


def to_long(wide: DataFrame, models: list[str], keys: list[str] | None = None) -> DataFrame:
    """Wide prediction columns -> long ``model, ..., y_pred`` (map-only unpivot)."""
    keys = keys or [c for c in ("station", "split", "target_datetime", "y_true", "sequence_id") if c in wide.columns]
    long = wide.unpivot(keys, models, "model", "y_pred")
    return long.select("model", *keys, F.col("y_pred").cast("double").alias("y_pred"))


# ---------------------------------------------------------------- F3, F4, F6


def ridge_reg_param(train: DataFrame, label: str, alpha: float) -> float:
    """``regParam`` that makes Spark's normal-equation solver equal to ridge with penalty ``alpha``.

    Spark minimises 1/(2n) ||r||^2 + regParam/2 ||b||^2 on a label divided by its
    population std, so ridge's ||r||^2 + alpha ||b||^2 needs alpha * std(y) / n.
    """
    n, sd = train.agg(F.count(F.lit(1)), F.stddev_pop(label)).first()
    if not n:
        raise ValueError("cannot fit on an empty training set")
    return float(alpha) * float(sd or 1.0) / float(n)


def fit_ridge(train: DataFrame, feature_cols: list[str], label: str = "target", alpha: float = 10.0) -> PipelineModel:
    """exact ridge (normal equations, one tree-aggregate pass over the rows)."""
    reg = ridge_reg_param(train, label, alpha)
    lr = LinearRegression(featuresCol="_features", labelCol=label, predictionCol="y_pred", regParam=reg,
                          elasticNetParam=0.0, standardization=False, solver="normal", fitIntercept=True)
    return Pipeline(stages=[VectorAssembler(inputCols=feature_cols, outputCol="_features"), lr]).fit(train)


def fit_gbt(train: DataFrame, feature_cols: list[str], label: str = "target", max_iter: int = 150,
            step_size: float = 0.05, max_leaves: int = 31, min_instances: int = 30, l2: float = 1.0, seed: int = 42,
            row_rate: float = 1.0, column_rate: float = 1.0) -> BoostedModel:
    """histogram gradient boosting with best-first leaves (``boosting``), over every row."""
    growth = Growth(max_iter, step_size, max_leaves, min_instances, l2)
    return fit_many(train, [Run(tuple(feature_cols), seed, row_rate, column_rate)], label, _row_key(train), growth)[0]


def _row_key(train: DataFrame) -> list[str] | None:
    return [c for c in ("station", "target_datetime") if c in train.columns] or None


def score(model: PipelineModel | BoostedModel, df: DataFrame, name: str, keys: list[str] | None = None) -> DataFrame:
    """batch scoring with a fitted (or loaded) model, clipped, long format."""
    keys = keys or [c for c in ("station", "split", "target_datetime", "target", "sequence_id", "id") if c in df.columns]
    out = model.transform(df)
    cols = [F.lit(name).alias("model")] + [F.col(c) for c in keys if c != "target"]
    if "target" in keys:
        cols.append(F.col("target").alias("y_true"))
    return out.select(*cols, clip_predictions("y_pred").alias("y_pred"))


def save_model(model: PipelineModel | BoostedModel, path: str) -> str:
    """write a fitted model to any storage Spark reaches (a new folder)."""
    if isinstance(model, BoostedModel):
        model.save(SparkSession.getActiveSession(), f"{path}/boosted")
    else:
        model.write().save(path)
    return path


def load_model(path: str) -> PipelineModel | BoostedModel:
    try:
        return BoostedModel.load(SparkSession.getActiveSession(), f"{path}/boosted")
    except AnalysisException:  # no such folder: another kind of model
        return PipelineModel.load(path)


def select_answer(predictions: DataFrame, mode: str) -> DataFrame:
    """one component model's answers (the blend is ensemble.blend)."""
    return predictions.filter(F.col("model") == mode)


# ---------------------------------------------------------------- F13


def tabular_feature_subset(names: list[str], spec: PanelSpec, feature_cols_all: list[str], feature_set: str) -> list[str]:
    """Tabular columns that derive only from the model features of ``feature_set``."""
    keep = set(select_feature_set(feature_cols_all, spec, feature_set))
    dropped = [c for c in feature_cols_all if c not in keep]
    out = []
    for n in names:
        if n.startswith("latest_") and n[len("latest_"):] in dropped:
            continue
        if any(n.startswith(f"{c}_") and n[len(c) + 1:].split("_")[0] in ("mean", "std", "min", "max")
               for c in dropped):
            continue
        out.append(n)
    return out


def gbt_history(model: BoostedModel, valid: DataFrame, label: str = "target") -> list[float]:
    """Validation RMSE after each boosting iteration (the trainer's 'epochs')."""
    return [r["val_rmse"] for r in histories({"": model}, valid, label).orderBy("epoch").collect()]


RESULT_SCHEMA = ("run_id string, model string, window_size long, feature_set string, feature_count long, seed long, "
                 "best_epoch long, training_seconds double, validation_rmse double, validation_mae double, "
                 "validation_r2 double, local_test_rmse double, local_test_mae double, local_test_r2 double")
HISTORY_SCHEMA = "run_id string, epoch long, val_rmse double"


def ablation_grid(processed: DataFrame, spec: PanelSpec, feature_cols: list[str], windows=(6, 12, 24),
                  feature_sets=FEATURE_SETS, seeds=(42,), model: str = "ridge", existing: DataFrame | None = None,
                  gbt_iter: int = 150, gbt_rows: float = 0.8, gbt_columns: float = 0.8,
                  results_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """one fit per (window, feature set, seed); finished run ids are skipped.

    With ``results_path`` runs are written there as they finish (``runs`` and ``history``), and runs found
    there count as finished, so a stopped grid goes on where it was.  Results are sorted by model, window,
    feature set and seed.

    All window sizes come from one windowed pass (the largest window), so every run is evaluated on the same
    targets.  Boosted runs grow in lockstep over one table of all windows' features; each iteration sees the
    ``gbt_rows`` share of the rows and the ``gbt_columns`` share of the features that its seed draws.  Returns
    (results, history): one row per run, and for boosted runs the validation RMSE of every iteration.  Only
    metrics (a few numbers per run) reach the driver.
    """
    spark = processed.sparkSession
    done = set()
    saved, saved_history = _saved_runs(spark, results_path) if results_path else (None, None)
    if saved is not None:
        existing = saved if existing is None else existing.unionByName(saved)
    if existing is not None:
        done = {r[0] for r in existing.select("run_id").distinct().collect()}
    runs = [(f"{model}_w{w}_{fs}_s{seed}", w, fs, seed) for w in windows for fs in feature_sets for seed in seeds]
    runs = [r for r in runs if r[0] not in done]
    rows, hist = [], []

    def keep(new_rows, new_hist):
        rows.extend(new_rows)
        hist.extend(new_hist)
        if results_path:
            # a run that was stopped between the two writes replaces its history when it is repeated
            upsert_partitions(spark.createDataFrame(new_hist, HISTORY_SCHEMA), f"{results_path}/history", ["run_id"])
            upsert_partitions(spark.createDataFrame(new_rows, RESULT_SCHEMA), f"{results_path}/runs", ["run_id"])

    if model == "ridge":
        _ridge_runs(processed, spec, feature_cols, runs, list(windows), keep)
    elif runs:
        _boosted_runs(processed, spec, feature_cols, runs, list(windows), model, Growth(iterations=gbt_iter),
                      gbt_rows, gbt_columns, keep)
    new = spark.createDataFrame(rows, RESULT_SCHEMA)
    history = spark.createDataFrame(hist, HISTORY_SCHEMA)
    if saved_history is not None:
        history = saved_history.unionByName(history)
    if existing is not None:
        new = upsert(existing, new, ["run_id"])
    return new.orderBy("model", "window_size", "feature_set", "seed"), history


def _record(run, model: str, features: int, best: int | None, secs: float, metrics: dict) -> tuple:
    rec = (run[0], model, run[1], run[2], features, run[3], best, float(secs))
    for s in ("validation", "local_test"):
        m = metrics.get(s)
        rec += (m["rmse"], m["mae"], m["r2"]) if m else (None, None, None)
    return rec


def _ridge_runs(processed, spec, feature_cols, runs, windows, keep) -> None:
    from ..session import materialize

    # every fit makes several passes over its table: write each table once
    wanted = {r[1] for r in runs}
    tables = {w: materialize(t, f"tabular_w{w}")
              for w, t in tabular_features_multi(processed, spec, feature_cols, windows).items() if w in wanted}
    for run in runs:
        tab = tables[run[1]]
        names = [c for c in tab.columns if c not in ("station", "split", "target_datetime", "target")]
        cols = tabular_feature_subset(names, spec, feature_cols, run[2])
        t0 = time.time()
        fitted = fit_ridge(tab.filter(F.col("split") == "train"), cols)
        secs = time.time() - t0
        pred = score(fitted, tab.filter(F.col("split") != "train"), "ridge")
        m = {r["split"]: r for r in pred.groupBy("split").agg(*regression_metric_columns("y_true", "y_pred")).collect()}
        keep([_record(run, "ridge", len(cols), None, secs, m)], [])


def _boosted_runs(processed, spec, feature_cols, runs, windows, model, growth, row_rate, column_rate, keep) -> None:
    """All boosted runs at once: one table, one fit in lockstep, one scoring pass, one pass for the histories."""
    from ..session import materialize
    from .windows import tabular_feature_names

    tab = materialize(tabular_features_union(processed, spec, feature_cols, windows), "tabular_union")
    columns = {r[0]: tuple(tabular_feature_subset(tabular_feature_names(spec, feature_cols, r[1]), spec, feature_cols, r[2]))
               for r in runs}
    t0 = time.time()
    fitted = fit_many(tab.filter(F.col("split") == "train"), [Run(columns[r[0]], r[3], row_rate, column_rate) for r in runs],
                      key=["station", "target_datetime"], growth=growth)
    secs = (time.time() - t0) / len(runs)
    models = dict(zip([r[0] for r in runs], fitted, strict=True))
    scored = tab.filter(F.col("split") != "train")
    for name, m in models.items():
        scored = m.transform(scored, name)
    long = scored.select("split", F.col("target").alias("y_true"), *[clip_predictions(n).alias(n) for n in models]).unpivot(
        ["split", "y_true"], list(models), "run_id", "y_pred")
    found = {(r["run_id"], r["split"]): r
             for r in long.groupBy("run_id", "split").agg(*regression_metric_columns("y_true", "y_pred")).collect()}
    curves = histories(models, tab.filter(F.col("split") == "validation")).collect()
    best = {}
    for r in curves:
        best[r["run_id"]] = min(best.get(r["run_id"], (float("inf"), 0)), (r["val_rmse"], r["epoch"]))
    keep([_record(r, model, len(columns[r[0]]), best[r[0]][1] if r[0] in best else None, secs,
                  {s: found.get((r[0], s)) for s in ("validation", "local_test")}) for r in runs],
         [(r["run_id"], r["epoch"], r["val_rmse"]) for r in curves])


def _saved_runs(spark, path: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Runs and history already written under ``path``: lists of a few rows, read now so that later writes don't matter."""
    try:
        runs, history = (read_partitions(spark, f"{path}/{k}", schema).collect()
                         for k, schema in (("runs", RESULT_SCHEMA), ("history", HISTORY_SCHEMA)))
    except AnalysisException:  # nothing written yet
        return None, None
    finished = {r["run_id"] for r in runs}
    return (spark.createDataFrame(runs, RESULT_SCHEMA),
            spark.createDataFrame([h for h in history if h["run_id"] in finished], HISTORY_SCHEMA))
