import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import SF, awkward, nothing
from plain import low
from pyspark.sql import functions as F

from hourweave.llm import phrases


def plain(rows, least, longest, top, percent):
    """Collocations of (lang, text) rows by counting all phrases."""
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", low(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        own = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        inside = defaultdict(int)
        for p, a in own.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        for p, a in own.items():
            if 100 * inside[p] >= percent * a:
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def made(seed=1, docs=120, words=14):
    """Texts of few words, so that many phrases are frequent, with hot runs, gaps and null langs."""
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(words)] + ["É", "N\x00L", "<", "\x1c"]
    out = []
    for i in range(docs):
        w = [rng.choice(names[:4]) if rng.random() < 0.6 else rng.choice(names) for _ in range(rng.randint(0, 120))]
        sep = rng.choice([" ", "\t", "  ", ". ", ",", " "])
        text = "".join(x + (sep if rng.random() < 0.2 else " ") for x in w)
        out.append((rng.choice(["en", "de", None, "und"]), text if i % 17 else None))
    return out + [("en", "Alpha BETA gamma delta epsilon zeta " * 60)] * 3


@pytest.mark.parametrize("least,longest,top,percent,block", [
    (3, 5, 2000, 100, 1 << 19), (3, 5, 2000, 100, 7), (2, 3, 5, 60, 64), (5, 2, 2000, 100, 1000), (3, 5, 40, 1, 50), (1, 5, 3000, 100, 333)])
def test_equals_counting_all_phrases(spark, least, longest, top, percent, block):
    rows = made()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = phrases.collocations(docs, least, longest, top, percent, block).collect()
    assert sorted(map(tuple, got)) == plain(rows, least, longest, top, percent)


def test_query_equals_counting(spark):
    import duckdb

    rows = duckdb.sql(f"SELECT lang, text FROM '{SF}/documents.parquet'").fetchall()
    got = sorted(map(tuple, phrases.op11_phrases(spark, SF).collect()))
    assert got == plain(rows, 100, 5, 2000, 100) and got


def test_awkward_documents(spark):
    docs = awkward(spark)
    got = sorted(map(tuple, phrases.collocations(docs, 2, block=100).collect()))
    assert got == plain([(r["lang"], r["text"]) for r in docs.collect()], 2, 5, 2000, 100) and got
    assert phrases.collocations(nothing(spark)).count() == 0
    assert phrases.collocations(docs, 10**6).count() == 0
    with pytest.raises(ValueError):
        phrases.collocations(docs, percent=0)


def test_a_text_is_cut_into_words_the_same_by_any_slices():
    t = "one two.three,four  five\tsix !\n seven " * 50 + "x" * 300
    whole = [w for part in phrases.word_slices(t) for w in part if w]
    for size in (1, 5, 64):
        assert [w for part in phrases.word_slices(t, size) for w in part if w] == whole


def test_scores_beyond_64_bits_are_exact(spark):
    a, n = 9_876_543_210_123, 98_765_432_109_876_543
    rows = [(a, n, [a, 3 * a + 1], [a + 7, a]), (a, n, [a + 1], [a + 2])]
    df = spark.createDataFrame(rows, "a long, n long, pre array<long>, suf array<long>")
    got = [tuple(r) for r in df.select(phrases._lowest_cut("pre", "suf").alias("c")).select("c.*").collect()]
    want = [min((1000 * a * n // (pre[k - 1] * suf[len(suf) - k]), k, pre[k - 1], suf[len(suf) - k]) for k in range(1, len(pre) + 1))
            for _, _, pre, suf in rows]
    assert got == want


def test_ties_go_by_the_bytes_of_the_phrase(spark):
    docs = spark.createDataFrame([("en", "b c. a d. É f. ｚ q. \U0001f600 r. Z é"), ("en", "b c. a d. É f. ｚ q. \U0001f600 r. Z é")], "lang string, text string")
    got = [r["phrase"] for r in phrases.collocations(docs, 2).orderBy(F.col("rank")).collect()]
    assert got == sorted(got, key=str.encode) and len(got) == 6
