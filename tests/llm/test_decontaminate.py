from collections import Counter

import duckdb
import plain
from helpers import LONG, SF, awkward, documents, nothing

from hourweave.llm.decontaminate import contaminated, op9_decontaminate, stage
from hourweave.llm.words import Words


def result(frame):
    return Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in frame.collect())


def test_query_equals_brute_force(spark):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    want = plain.contamination(documents(), items)
    got = op9_decontaminate(spark, SF).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in got) == Counter(
        (i, n, h, len(ids), h > 0) for (i, n, h, ids), k in want.items() for _ in range(k))
    assert any(r["contaminated"] for r in got)


def test_awkward_documents_and_items(spark):
    docs = awkward(spark)
    words = LONG.split()
    items = [(1, " ".join(words[2:14])), (2, "A, b!"), (3, None), (4, ""), (5, "..."), (None, " ".join(words[:10])), (6, "number 7"),
             (7, " ".join(words[2:14]).upper()), (7, "a"), (8, "the the the the the the the the the the"),
             (9, "line 3 of a long enough text number 3\nline 4 of a"), (10, "É 你好 é x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(contaminated(docs, bench)) == plain.contamination(rows, items)
    assert result(contaminated(docs, bench, 4, 2)) == plain.contamination(rows, items, 4)
    assert result(contaminated(docs, bench.limit(0))) == plain.contamination(rows, [])
    assert contaminated(nothing(spark), bench).count() == 0


def test_stage_drops_hit_documents_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bad = {r["doc_id"] for r in op9_decontaminate(spark, SF).filter("contaminated").collect()}
    kept = stage(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in documents() if i not in bad)


def test_words_of_a_batch():
    texts = ["", "A b", "--", "é1 你x\n", " \x00q"]
    w = Words(texts)
    assert [[w.word(j) for j in range(a, a + n)] for a, n in zip(w.first, w.count, strict=True)] == [
        plain.words(t) for t in texts]
