"""Every stage of the pipeline against plain Python on what its predecessor kept."""

from collections import Counter

import duckdb
import plain
import pytest
from helpers import awkward, nothing
from test_packing import check, expected_pieces
from test_simhash import plain_components

import corpus_pipeline
from hourweave.llm.common import store
from hourweave.llm.quality_classifier import op3_quality_classifier

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents table and each stage's result, written and read again."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(store(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def rows(frame):
    return [(r["doc_id"], r["text"]) for r in frame.orderBy("doc_id").collect()]


def test_stages_are_named_in_order_and_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_near_dedup", "decontamination", "packing"]
    assert all(x.columns == stages[0].columns and x.dtypes == stages[0].dtypes for x in stages[1:-1])


def test_classifier_drops_what_it_rejects(spark, stages):
    kept = {r["doc_id"] for r in op3_quality_classifier(spark, SF).filter("predicted = 1").collect()}
    assert rows(stages[1]) == [r for r in rows(stages[0]) if r[0] in kept]
    assert 0.7 < len(kept) / stages[0].count() < 1


def test_line_dedup_changes_the_texts(stages):
    before = rows(stages[1])
    assert Counter(rows(stages[2])) == Counter((i, t) for i, t, _, _ in plain.line_dedup(before))
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())


def test_one_of_each_near_duplicate_group_stays(stages):
    before = rows(stages[2])
    keep = {first for _, _, first in plain_components(before)}
    assert rows(stages[3]) == [r for r in before if r[0] in keep]
    assert len(keep) < len(before)


def test_leaks_go(stages):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    before = rows(stages[3])
    bad = {i for (i, _, hit, _), _ in plain.contamination(before, items).items() if hit}
    assert rows(stages[4]) == [r for r in before if r[0] not in bad]
    assert bad


def test_the_rest_is_packed(stages):
    packed, want = stages[5].collect(), expected_pieces(rows(stages[4]))
    total = sum(n * k for (_, _, _, n, _), k in want.items())
    assert check(packed, want) <= -(-total // 4096) + 1


def test_run_applies_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, stages[5].select(*got.columns).collect()))


def test_stages_take_awkward_and_empty_documents(spark):
    for docs in (awkward(spark), nothing(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = store(stage(spark, docs, SF), "test-awkward")
            assert out.columns == docs.columns
            docs = out
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()
