import zlib

import duckdb
import numpy as np
import pytest
from helpers import awkward, nothing

from hourweave.llm import quality_classifier as Q
from hourweave.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def labels(column):
    return dict(duckdb.sql(f"SELECT doc_id, {column} FROM '{SF}/labels.parquet'").fetchall())


def auc(rows):
    good, bad = ([s for s, y in rows if y == k] for k in (1, 0))
    return np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])


@pytest.mark.parametrize("query, column, accept, least", [
    (Q.op3_quality_classifier, "quality", 0.3, 0.97), (T.op7_toxicity, "toxic", 0.5, 0.8)])
def test_held_out_documents(spark, query, column, accept, least):
    got = query(spark, SF).collect()
    known = labels(column)
    assert len(got) == len({r["doc_id"] for r in got}) == 1000
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= accept)
    held = [r for r in got if r["held_out"] and r["doc_id"] in known]
    assert auc([(r["score"], known[r["doc_id"]]) for r in held]) >= least
    assert np.mean([r["predicted"] == known[r["doc_id"]] for r in held]) >= 0.95


def test_held_out_labels_are_not_learnt_from(spark):
    docs, own = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = own.selectExpr("doc_id", *(f"IF(crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0, 1 - {c}, {c}) AS {c}"
                                        for c in ("quality", "toxic")))
    assert np.array_equal(Q.fit(docs, own).weights, Q.fit(docs, turned).weights)
    a, b = T.fit(docs, own), T.fit(docs, turned)
    assert a.entries == b.entries and np.array_equal(a.weights, b.weights)


def test_awkward_documents_and_labels(spark):
    docs = awkward(spark)
    some = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (4, 0, 1), (7, 0, 1), (None, 1, 1), (8, None, None), (9, 7, 7), (99, 1, 1)],
                                 "doc_id long, quality int, toxic int")
    for classify in (Q.classify, T.classify):
        for own in (some, some.limit(0), some.filter("quality = 1 AND toxic = 0")):
            rows = classify(docs, own).collect()
            assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert classify(nothing(spark), some).count() == 0


def test_pairwise_ranker_orders_and_cuts():
    r = np.random.default_rng(1)
    label = (r.random(600) < 0.8).astype(int)
    rows = r.normal(size=(600, len(Q.FEATURES)))
    rows[:, 3] -= 3 * label
    ranker = Q.bradley_terry(rows, label)
    assert auc(list(zip(ranker.score(rows), label, strict=True))) > 0.97
    assert np.mean((ranker.score(rows) >= Q.ACCEPT) == label) > 0.93
    assert ranker.weights[3] < -0.5


def test_automaton_equals_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    entries = [T.Entry("abcab", False, 1, 1.0), T.Entry("abba", False, 0, 1.0), T.Entry("bacabb", False, 2, 1.0),
               T.Entry("cab", True, 0, 1.0)]
    automaton = T.Automaton(entries)
    r = np.random.default_rng(2)
    for _ in range(3000):
        word = "".join(r.choice(list("abc"), r.integers(1, 9)))
        best = min(((d, i) for i, e in enumerate(entries) if not e.stem and (d := distance(word, e.term)) <= e.edits), default=None)
        if word.startswith("cab") and len(word) > 3 and (best is None or best[0]):
            best = (0, 3)
        assert automaton.match(word) == best


def test_quotation_weighs_less_than_abuse():
    model = T.Model([T.Entry("idiot", False, 1, 4.0)], T.PRIOR)
    abuse = model.terms("You are such an idiot!")[0]
    quoted = model.terms('The report said that the word "idiot" was used by the witness in court.')[0]
    wrong = model.terms("what an idiott")[0]
    assert abuse["abuse"] == 1 and quoted["abuse"] <= 0.3 and wrong["edits"] == 1
    assert (quoted["start"], quoted["end"]) == (31, 36)
    assert model.scores(np.array([model.features("You idiot")]))[0] > model.scores(np.array([model.features('He said "idiot" twice')]))[0]


def test_terms_are_found_with_their_places(spark):
    model = T.Model([T.Entry("idiot", False, 1, 4.0)], T.PRIOR)
    docs = spark.createDataFrame([(1, "an idiot, an IDIOT"), (2, None), (None, "idi0t")], "doc_id long, text string")
    got = {(r["doc_id"], r["surface"], r["start"], r["edits"]) for r in T.find_terms(docs, model).collect()}
    assert got == {(1, "idiot", 3, 0), (1, "idiot", 13, 0), (None, "idi0t", 0, 1)}


def test_only_copies_leave_the_sample(spark):
    common = "the of and to in is it was for on are as with his they at be this from have or by one had not but what all".split()
    r = np.random.default_rng(3)
    texts = [" ".join(r.permutation(common + [f"own{i}x{j}" for j in range(20)])) for i in range(40)]  # Jaccard 0.4 between any two
    near = [t + " more" for t in texts[:5]]
    own = [(i, 1, t) for i, t in enumerate([*texts, *near, *(t.upper() for t in texts[5:9])])]
    words = [T.words_of(t) for _, _, t in own]
    hashes = [T._hashes(set(w)) for w in words]
    rows = spark.createDataFrame(
        [(*row[:2], T._copy(w), h.view(np.int64).tolist(), T._bands(h)) for row, w, h in zip(own, words, hashes, strict=True)],
        "doc_id long, label int, copy long, words array<long>, bands array<long>")
    assert sorted(r["doc_id"] for r in T.without_copies(rows).collect()) == list(range(40))


def test_terms_count_over_documents_that_share_common_words(spark):
    common = "the of and to in is it was for on are as with his they at be this from have or by one had not but what all".split()
    r = np.random.default_rng(4)
    rows = [(i, int(i < 30), " ".join(r.permutation(common + [f"own{i}x{j}" for j in range(5)] + ["grobling"] * (i < 30))))
            for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    rows = spark.createDataFrame(rows, "doc_id long, toxic int, text string")
    model = T.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    assert model.match("grobling") is not None


def test_a_stem_and_its_exact_word():
    counts = [("idiot", 40, 0), ("idiot$", 30, 0), ("idioti", 20, 0), ("idiotic$", 20, 0)]
    entries = T.choose_entries(counts, 100, 1000)
    assert [(e.term, e.stem) for e in entries][:2] == [("idiot", True), ("idiot", False)]
    model = T.Model(entries, T.PRIOR)
    assert model.match("idiot") == (0, 1) and model.match("idiots") == (0, 0) and model.match("idiom") != (0, 0)
    assert model.scores(np.array([model.features("you idiot")]))[0] > model.scores(np.array([model.features("you there")]))[0]


def test_stems_and_short_words_take_edits():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    entries = [T.Entry("abcab", False, 1, 1.0), T.Entry("bacab", True, 2, 1.0), T.Entry("cab", True, 1, 1.0), T.Entry("cab", False, 1, 1.0)]
    automaton = T.Automaton(entries)
    r = np.random.default_rng(5)
    for _ in range(3000):
        word = "".join(r.choice(list("abc"), r.integers(1, 9)))
        best = min(((d, i) for i, e in enumerate(entries)
                    if (d := min((distance(word[:n], e.term) for n in range(len(word))), default=9) if e.stem
                        else distance(word, e.term)) <= e.edits), default=None)
        got = automaton.match(word)
        assert (got and got[0]) == (best and best[0])


def test_misspellings_in_stems_and_of_short_and_long_terms():
    counts = [("scum$", 60, 0), ("dummkop", 50, 0), ("worthless$", 45, 0), ("stupid$", 40, 0)]
    entries = T.choose_entries(counts, 100, 1000)
    near = [(0, 1, "scam", 0, 9), (0, 1, "sum", 0, 1), (0, 1, "scvm", 3, 0)]
    entries, ordinary = T.weigh_slips(entries, {0: 60, 1: 50, 2: 45, 3: 40}, near, 100, 1000)
    model = T.Model(entries, T.PRIOR, ordinary)
    for word in ("scvm", "dunmkopf", "dumkopfe", "wortlhess", "worfless", "stupdi"):
        assert model.match(word) and model.match(word)[0], word
    assert model.match("scam") is None and model.match("sum") is None and model.match("scum") == (0, 0)
    often = [(0, 1, f"s{i}um", 0, 1) for i in range(40)]
    assert T.weigh_slips(entries, {0: 60}, often, 100, 1000)[0][0].edits == 0


def test_a_misspelt_text_scores_as_toxic(spark):
    r = np.random.default_rng(6)
    plain = [f"{a}{b}{c}" for a in ("ta", "ne", "ro", "li") for b in ("mu", "si", "po") for c in ("ga", "re", "to")]
    rows = [(i, int(i % 4 == 0), " ".join([*r.choice(plain, 20), *(["scum"] * 3 if i % 4 == 0 else [])])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, toxic int, text string")
    model = T.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    score = [model.scores(np.array([model.features(t)]))[0] for t in ("scvm you scvm and scvm", "you and")]
    assert score[0] >= T.TOXIC > score[1]


def test_repeated_ids_leave_the_sample_bounded(spark, monkeypatch):
    """100,000 rows of one labelled id are one row of either sample."""
    from pyspark.sql import functions as F

    from hourweave.llm.common import held_out

    many = spark.range(100_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text no "), "id").alias("text"))
    rest = spark.range(2, 40).select(F.col("id").alias("doc_id"), F.concat(F.lit("words of document "), "id").alias("text"))
    docs = many.union(rest)
    labels = spark.range(1, 40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"),
                                       (F.col("id") % 2).cast("int").alias("toxic"))
    seen, real = [], Q.bradley_terry
    monkeypatch.setattr(Q, "bradley_terry", lambda x, y: seen.append(len(x)) or real(x, y))
    Q.fit(docs, labels)
    learnt = labels.filter(~held_out(F.col("doc_id"))).count()
    assert seen == [learnt]
    rows, fit_weights = [], T.logistic
    monkeypatch.setattr(T, "logistic", lambda x, y, p: rows.append(len(y)) or fit_weights(x, y, p))
    T.fit(docs, labels)
    assert all(n <= 2 * learnt for n in rows)
    assert learnt > 20
