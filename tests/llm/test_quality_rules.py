from collections import Counter

import plain
from helpers import SF, awkward, documents, nothing

from hourweave.llm.quality_rules import beta_priors, judge, measure, op10_quality_rules

NAMES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def test_measures_equal_brute_force(spark):
    got = measure(spark.read.parquet(f"{SF}/documents.parquet"))
    assert {r["doc_id"]: tuple(r[n] for n in NAMES) for r in got.collect()} == {i: plain.rules(t) for i, t in documents()}


def test_awkward_documents(spark):
    docs = awkward(spark)
    got = judge(docs)
    assert Counter((r["doc_id"], *(r[n] for n in NAMES)) for r in got.collect()) == Counter(
        (r["doc_id"], *plain.rules(r["text"])) for r in docs.collect())
    for r in got.collect():
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert judge(nothing(spark)).count() == 0


def text(k, junk):
    words = " ".join(f"w{k}x{j}" for j in range(30))
    return words.replace(" ", " ### ") if junk else words


def verdicts(spark, rows):
    docs = spark.createDataFrame([(i, text(i, junk), host) for i, (host, junk) in enumerate(rows)],
                                 "doc_id long, text string, source string")
    kept = {host: [] for host, _ in rows}
    for r in judge(docs).collect():
        kept[rows[r["doc_id"]][0]].append(r["kept"])
    return kept


def test_a_bad_host_is_refused(spark):
    rows = [(f"good{h}", False) for h in range(20) for k in range(40)] + [("bad", k % 10 > 0) for k in range(60)] + [(None, False)]
    kept = verdicts(spark, rows)
    assert not any(kept.pop("bad")) and all(all(x) for x in kept.values())


def test_a_small_host_is_judged_by_what_hosts_are_like(spark):
    rows = [(f"host{h}", k < 4) for h in range(20) for k in range(40)] + [("tiny", True)]
    assert all(all(x) for x in verdicts(spark, rows).values())


def test_priors_of_equal_hosts_are_strong_and_of_unequal_ones_weak(spark):
    def prior(rates):
        hosts = spark.createDataFrame([(f"h{i}", 100, k, 0, 0, 0) for i, k in enumerate(rates)],
                                      "host string, n long, short long, repeated long, symbols long, dup_lines long")
        return beta_priors(hosts)["short"]

    assert prior([10] * 20)[1] > 1000 > 50 > prior([0, 0, 0, 90, 95])[1]
    assert prior([7])[0] == 0.07


def test_query_columns(spark):
    got = op10_quality_rules(spark, SF)
    assert got.count() == len(documents()) and got.filter("kept").count() > 0.7 * got.count()
