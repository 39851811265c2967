import hashlib
from collections import Counter

import plain
from helpers import SF, awkward, documents, nothing

from hourweave.llm.line_dedup import dedup_lines, line_hashes, line_index, op2_line_dedup, probe, stage


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_query_equals_brute_force(spark):
    got = Counter(tuple(r) for r in op2_line_dedup(spark, SF).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect())
    assert got == Counter((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in plain.line_dedup(documents()))


def test_awkward_documents_keep_their_columns(spark):
    docs = awkward(spark).withColumnRenamed("start", "n_lines")
    out = dedup_lines(docs)
    assert Counter((r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in out.collect()) == Counter(
        plain.line_dedup(rows_of(docs)))
    assert set(out.columns) == set(docs.columns) | {"kept_text", "n_dropped"}
    assert dedup_lines(nothing(spark)).count() == 0


def test_probes_of_a_hot_line_are_dealt_out_without_changing_the_answer(spark):
    shared = "this line is in every one of the documents here"
    rows = [(i, f"{shared}\nown line of the document number {i}\n{shared.upper()}  ") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = line_hashes(docs)
    index, probes, shards = line_index(hashes, shard_lines=50)
    assert shards == 7
    for per_task in (1 << 18, 40):
        lost = probe(hashes, index, probes, shards, 3, per_task)
        assert sorted(r["doc_id"] for r in lost.collect()) == list(range(299))
    assert sorted(r["n_dropped"] for r in dedup_lines(docs).collect()) == [0] + [2] * 299


def test_stage_returns_documents(spark):
    docs = awkward(spark)
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter((i, t) for i, t, _, _ in plain.line_dedup(rows_of(docs)))
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
