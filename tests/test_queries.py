"""Driver contract and a few registered queries end to end on the smallest data."""
import pytest

SF_SMALL = "/root/testdata/sf0.001"


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    rows = df.collect()
    assert {r["model"] for r in rows} == {"persistence", "window_mean"}
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100


@pytest.mark.parametrize("key", ["preprocess", "tabular_features", "metrics_by_range", "submission_build",
                                 "audit_continuity", "ensemble_weight_search"])
def test_query_against_oracle(spark, key):
    import os

    import duckdb

    import __spark_entry__ as entry
    from scripts.check_oracle import norm

    sp = entry.queries()[key](spark, SF_SMALL).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, 'events.parquet')}')")
    dp = con.execute(entry.oracle_sql()[key]).df()
    assert sorted(sp.columns) == sorted(dp.columns)
    assert norm(sp) == norm(dp)


def test_hot_positions_never_dense(spark):
    from pyspark.ml.linalg import Vectors

    from hourweave.plans.registry import hot_positions

    size = 2_000_000_000
    df = spark.createDataFrame([(1, Vectors.sparse(size, [7], [1.0])), (2, Vectors.sparse(size, [], []))], ["id", "v"])
    got = {r["id"]: (r["hot"], r["size"], r["ones"]) for r in df.select("id", *hot_positions("v")).collect()}
    assert got == {1: (7, size, 1), 2: (None, size, 0)}


def test_the_grid_fits_both_models_on_every_configuration(spark, monkeypatch):
    from hourweave.operators import forecast as FC
    from hourweave.plans import q_ablation as A

    fits = []

    def planned(processed, spec, names, windows, feature_sets=FC.FEATURE_SETS, seeds=(42,), model="ridge", gbt_iter=150):
        rows = [(f"{model}_w{w}_{f}_s{s}", model, w, f, 1, s, 1, 1.0, *[1.0] * 6) for w in windows for f in feature_sets for s in seeds]
        fits.extend(rows)
        return spark.createDataFrame(rows, FC.RESULT_SCHEMA), spark.createDataFrame([], FC.HISTORY_SCHEMA)

    class Shared:
        def processed(self):
            return None

        feature_names = processed

        def _memo(self, key, build):
            return build()

    monkeypatch.setattr(A, "context", lambda *_: Shared())
    monkeypatch.setattr(A.FC, "ablation_grid", planned)
    runs = {(r["model"], r["window_size"], r["feature_set"]) for r in A.grid(spark, SF_SMALL)[0].filter("seed = 42").collect()}
    assert runs == {(m, w, f) for m in ("ridge", "gbt") for w in (6, 12, 24) for f in FC.FEATURE_SETS}
    assert len({f[0] for f in fits}) == len(fits) == 13
    for query in (A.q_ablation_improvement, A.q_ablation_tradeoff):
        got = sorted((r["model"], r["window_size"]) for r in query(spark, SF_SMALL).collect())
        assert got == [(m, w) for m in ("gbt", "ridge") for w in (6, 12, 24)]
