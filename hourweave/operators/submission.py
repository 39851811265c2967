"""Answer tables for independent windows (F7, F12) and their validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PanelSpec
from .forecast import clip_predictions
from .preprocess import FittedParams
from .wide import wide_baselines
from .windows import global_rank


def template_from_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """An answer template (``id, position``) in id order, without a single-partition sort window."""
    return global_rank(df.select(F.col(id_col).alias("id")), ["id"], "position")


def blended_window_predictions(wide: DataFrame, spec: PanelSpec, params: FittedParams, first_weight: float,
                               first: str = "persistence", second: str = "window_mean") -> DataFrame:
    """Per window: both component forecasts and their convex blend (``first_weight``)."""
    if not 0.0 <= first_weight <= 1.0:
        raise ValueError("first_weight must be within [0, 1]")
    b = wide_baselines(wide, spec, params)
    blend = F.lit(first_weight) * F.col(first) + F.lit(1.0 - first_weight) * F.col(second)
    return b.select("id", "station", first, second, blend.alias("blend"))


def build_submission(template: DataFrame, predictions: DataFrame, value: str = "blend") -> DataFrame:
    """predictions attached to the template ids (template order kept in ``position``), clipped at 0."""
    p = predictions.select("id", clip_predictions(value).alias("prediction"))
    return template.select("id", "position").join(p, "id", "left")


def component_submissions(template: DataFrame, predictions: DataFrame, models=("persistence", "window_mean", "blend")) -> DataFrame:
    """One answer table per component model next to the blend (long, ``model`` column)."""
    long = predictions.unpivot(["id"], list(models), "model", "value")
    return template.select("id", "position").join(long, "id").select(
        "model", "id", "position", clip_predictions("value").alias("prediction"))
