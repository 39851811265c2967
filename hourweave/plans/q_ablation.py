"""Registered ablation queries (F13, E8-E12, E16).  Model fits have no SQL oracle; these
are checked by row counts here and against the published result tables in the tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..config import EVENTS_SPEC
from ..functions.exprs import rounded
from ..operators import evaluate as E
from ..operators import forecast as FC
from ..session import materialize
from .context import context
from .registry import register

S = EVENTS_SPEC
GRID_ITERATIONS = 150
MODELS = ("gbt", "ridge")


def grid(spark, sf):
    """Ridge and boosted trees over windows 6/12/24 x both feature sets, the trees (w=24, all features)
    also with a second seed; the trees of a call grow in lockstep.  Written once per session."""
    c = context(spark, sf)

    def build():
        ridge, _ = FC.ablation_grid(c.processed(), S, c.feature_names(), windows=(6, 12, 24), seeds=(42,), model="ridge")
        gbt, hist = FC.ablation_grid(c.processed(), S, c.feature_names(), windows=(6, 12, 24), seeds=(42,), model="gbt",
                                     gbt_iter=GRID_ITERATIONS)
        more, more_hist = FC.ablation_grid(c.processed(), S, c.feature_names(), windows=(24,), feature_sets=("all_features",),
                                           seeds=(123,), model="gbt", gbt_iter=GRID_ITERATIONS)
        return (materialize(ridge.unionByName(gbt).unionByName(more), "ablation"),
                materialize(hist.unionByName(more_hist), "ablation_hist"))
    return c._memo("ablation", build)


def _per_model(results, analysis):
    return reduce(lambda a, b: a.unionByName(b), [
        analysis(results.filter(F.col("model") == m)).withColumn("model", F.lit(m)) for m in MODELS])


@register("ablation_grid")
def q_ablation_grid(spark, sf):
    return grid(spark, sf)[0].drop("training_seconds")


@register("ablation_summary")
def q_ablation_summary(spark, sf):
    return rounded(E.ablation_summary(grid(spark, sf)[0]).drop("training_seconds_mean"))


@register("ablation_improvement")
def q_ablation_improvement(spark, sf):
    return rounded(_per_model(grid(spark, sf)[0], E.ablation_improvement))


@register("ablation_tradeoff")
def q_ablation_tradeoff(spark, sf):
    return rounded(_per_model(grid(spark, sf)[0], E.ablation_tradeoff).drop("training_seconds"))


@register("ablation_selected")
def q_ablation_selected(spark, sf):
    return rounded(E.selected_configuration(grid(spark, sf)[0]))


@register("seed_robustness")
def q_seed_robustness(spark, sf):
    return rounded(E.seed_robustness(grid(spark, sf)[0], 24, "all_features", model="gbt"))


@register("best_epoch")
def q_best_epoch(spark, sf):
    return rounded(E.best_epoch(grid(spark, sf)[1]))


@register("ablation_ranking")
def q_ablation_ranking(spark, sf):
    return rounded(E.ablation_ranking(grid(spark, sf)[0], seed=42))
