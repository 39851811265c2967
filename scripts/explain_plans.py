"""Summarise the physical plans of the headline queries (AQE off, so the static plan is shown).

usage: python scripts/explain_plans.py [sf_dir]
Prints, per query: shuffle Exchanges, broadcast exchanges, Window nodes, and pushed scan filters.
"""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from hourweave.config import EVENTS_SPEC as S
    from hourweave.operators import ensemble as EN
    from hourweave.operators import evaluate as E
    from hourweave.operators import forecast as FC
    from hourweave.operators import windows as W
    from hourweave.operators import wide as WD
    from hourweave.plans.context import context
    from hourweave.plans.registry import QUERIES
    from hourweave.session import build_session

    spark = build_session("local[8]")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    a, b = context(spark, sf, "A"), context(spark, sf, "B")
    fc = FC.baseline_forecasts(b.processed(), S, b.params())
    plans = {
        "panel_build (events -> dense panel)": __import__("hourweave.sources.events_panel", fromlist=["x"])
        .events_panel(spark, sf, "B", S, with_datetime=True),
        "impute (chunked ffill + carry)": __import__("hourweave.operators.preprocess", fromlist=["x"])
        .impute_with_flags(b.raw(), S, b.medians()),
        "sequence_index": W.sequence_index(b.processed(), S),
        "tabular_features": W.tabular_features(b.processed(), S, b.feature_names()),
        "forecasts + metrics_long": E.metrics_long(FC.to_long(fc, ["persistence", "window_mean"])),
        "weight_search": EN.weight_search(EN.wide_pair(fc, "persistence", "window_mean"), 0.01),
        "wide_tabular (map-only)": WD.wide_tabular(a.raw().sparkSession.read.parquet(
            a._memo("wide_path", lambda: _wide_path(spark, sf))), S, a.params()),
        "series_slice": QUERIES["series_slice"](spark, sf),
    }
    print(f"{'query':40s} {'exchanges':>9s} {'broadcast':>9s} {'windows':>7s}  pushed filters")
    for name, df in plans.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"(?<!Broadcast)Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        bcast = plan.count("BroadcastExchange")
        windows = len(re.findall(r"Window \[", plan))
        pushed = re.findall(r"PushedFilters: \[(.*?)(?:\], |, ReadSchema)", plan)
        pushed = "; ".join(p for p in pushed if p) or "-"
        print(f"{name:40s} {shuffles:9d} {bcast:9d} {windows:7d}  {pushed[:90]}")


def _wide_path(spark, sf):
    from hourweave.plans.q_wide import wide

    df = wide(spark, sf)
    return df.inputFiles()[0].rsplit("/", 1)[0]


if __name__ == "__main__":
    main()
