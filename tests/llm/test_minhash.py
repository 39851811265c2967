import random

import numpy as np
import pytest
from helpers import SF, awkward, documents, nothing
from plain import low

from hourweave.llm import minhash

SPACES = " \t\n\x0b\x0c\r"


def shingles(text, size=4):
    for c in SPACES[1:]:
        text = text.replace(c, " ")
    w = [x for x in low(text).split(" ") if x]
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def plain(rows, size=4, percent=80):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows by comparing all pairs of different sets."""
    sets = [frozenset(shingles(t or "", size)) for _, t in rows]
    kinds = list({s for s in sets if s})
    root = {s: s for s in kinds}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    root[find(a)] = find(b)
    least = {}
    for (i, _), s in zip(rows, sets, strict=True):
        if s and i is not None:
            least[find(s)] = min(i, least.get(find(s), i))
    return sorted(((i, len(s), least.get(find(s)) if s else i) for (i, _), s in zip(rows, sets, strict=True)), key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


def test_query_equals_comparing_all_pairs(spark):
    got = minhash.op12_minhash(spark, SF).collect()
    want = plain(documents())
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_awkward_documents(spark):
    docs = awkward(spark)
    assert result(minhash.near_duplicates(docs)) == plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert minhash.near_duplicates(nothing(spark)).count() == 0
    blank = spark.createDataFrame([(1, ""), (2, None), (None, " ")], "doc_id long, text string")
    assert result(minhash.near_duplicates(blank)) == plain([(1, ""), (2, None), (None, " ")])


def near_copies(seed=3, groups=6, copies=60):
    """Groups of copies with some words changed: around the threshold, in chains, and one far larger than a cell."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        words = [f"g{g}w{rng.randint(0, 400)}" for _ in range(rng.choice([5, 8, 40, 90, 150]))]
        for _ in range(copies):
            own = list(words)
            for _ in range(rng.randint(0, max(1, len(own) // 20))):
                own[rng.randrange(len(own))] = f"x{rng.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(own)))
            if rng.random() < 0.3:
                words = own
    shared = [f"common{i}" for i in range(60)]  # alike in three fifths only
    rows += [(len(rows) + i, " ".join(shared + [f"own{i}_{k}" for k in range(20)])) for i in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cell", [4096, 5])
def test_no_link_is_lost_around_the_threshold(spark, cell):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(minhash.near_duplicates(docs, cell=cell)) == plain(rows)


def test_a_pair_at_exactly_the_threshold_is_linked(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g h"),  # 4 of 5 shingles
            (3, "p q r s t u"), (4, "p q r s t u v")]  # 3 of 4
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(minhash.near_duplicates(docs)) == [(1, 4, 1), (2, 5, 1), (3, 3, 3), (4, 4, 4)]


def test_sets_are_the_distinct_shingles():
    texts = ["a b c d e", "", "A  B\tc d E a b c d", "one", "x y", "N\x00L a b c", "é É e f"]
    hashes, bounds = minhash.shingle_sets(texts)
    assert list(np.diff(bounds)) == [len(shingles(t)) for t in texts]
    own = [set(hashes[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for i, s in enumerate(texts):
        for j, t in enumerate(texts):
            assert len(own[i] & own[j]) == len(shingles(s) & shingles(t))


def test_minima_don_t_depend_on_slices(monkeypatch):
    rng = np.random.default_rng(1)
    sizes = [1, 7, 300, 2, 2000, 64]
    hashes = rng.integers(0, 2**64, sum(sizes), dtype=np.uint64)
    bounds = np.r_[0, np.cumsum(sizes)]
    whole = minhash.samples(hashes, bounds)
    for size in (1, 64, 100, 1999):
        monkeypatch.setattr(minhash, "SLICE", size)
        assert (minhash.samples(hashes, bounds) == whole).all()


def test_sketches_tell_similarity():
    """Populations of the XOR follow the exact distribution: pairs at the threshold stay below the limit."""
    rng = np.random.default_rng(2)
    sets, n = [], 200
    for _ in range(400):
        both, a, b = (rng.integers(0, 2**64, k, dtype=np.uint64) for k in (int(n * 0.8), n // 10, n // 10))
        sets += [np.r_[both, a], np.r_[both, b]]  # 160 of 200
    bounds = np.cumsum([0, *map(len, sets)])
    minima = minhash.samples(np.concatenate(sets), bounds)
    alike = (minima[::2] == minima[1::2]).mean()
    assert abs(alike - 0.8) < 0.01
    bits = minhash.odd_sketch(minima)
    ones = np.bitwise_count(bits[::2] ^ bits[1::2]).sum(axis=1)
    differ = 2 * (minima[::2] != minima[1::2]).sum(axis=1)
    assert (ones <= differ).all() and (ones % 2 == differ % 2).all()
    assert ones.max() <= minhash.most_ones() < 130
    assert (np.bitwise_count(bits[:-2:2] ^ bits[2::2]).sum(axis=1) > minhash.most_ones()).all()  # unlike sets


def test_a_group_of_copies_costs_a_pair_each(spark):
    """1,500 near copies of one text: pairs held against each other grow with the copies, not with their square."""
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[:k] + [f"x{i}"] + words[k + 1:])) for i in range(1500) for k in [i * 7 % 200]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    real = minhash._confirmed

    def counted(pairs, sets, percent):
        seen.append(pairs.count())
        return real(pairs, sets, percent)

    minhash._confirmed = counted
    try:
        got = minhash.near_duplicates(docs).select("component_id").distinct().collect()
    finally:
        minhash._confirmed = real
    assert [r[0] for r in got] == [0]
    assert sum(seen) < 1500 * minhash.BANDS
