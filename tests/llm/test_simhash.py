from collections import Counter

import numpy as np
import xxhash
from helpers import SF, awkward, documents, nothing
from pyspark.sql import functions as F

from hourweave.llm import simhash
from hourweave.llm.graph import components


def plain_fingerprint(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    n = min(3, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    """doc_id -> (fingerprint, smallest id reachable); rows without an id count as larger than all."""
    fps = [plain_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    a = np.array(fps, np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[:i]) <= 2).tolist():
            label[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(top(i), []).append(doc_id)
    return Counter((doc_id, fps[i], min((x for x in least[top(i)] if x is not None), default=None))
                   for i, (doc_id, _) in enumerate(rows))


def result(frame):
    return Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in frame.collect())


def test_query_equals_brute_force(spark):
    got = simhash.op6_simhash(spark, SF)
    assert Counter((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in got.collect()) == plain_components(
        documents())


def test_awkward_documents(spark):
    docs = awkward(spark)
    assert result(simhash.near_duplicates(docs)) == plain_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert simhash.near_duplicates(nothing(spark)).count() == 0


def test_stage_keeps_one_of_each_group_and_all_columns(spark):
    docs = awkward(spark)
    kept = simhash.stage(spark, docs, SF)
    assert kept.columns == docs.columns
    want = {c for _, _, c in plain_components([(r["doc_id"], r["text"]) for r in docs.collect()])}
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(want)
    plain = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    want = {c for _, _, c in plain_components([(r["doc_id"], r["text"]) for r in plain.collect()])}
    assert sorted(r["doc_id"] for r in simhash.stage(spark, plain, SF).collect()) == sorted(want)


def near(seed, n):
    """Fingerprints in balls around a few centres, some chained, some alone."""
    r = np.random.default_rng(seed)
    out = set()
    for centre in r.integers(0, 2**64, 6, dtype=np.uint64).tolist():
        for _ in range(n):
            x = centre
            for b in r.choice(64, r.integers(0, 5), replace=False).tolist():
                x ^= 1 << b
            out.add(x)
    return sorted(out)


def linked(fps, edges):
    label = {x: x for x in fps}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for x, y in edges:
        label[top(x)] = top(y)
    groups = {}
    for x in fps:
        groups.setdefault(top(x), set()).add(x)
    return sorted(map(sorted, groups.values()))


def test_links_connect_all_pairs_and_only_those(spark):
    fps = near(5, 60)
    pairs = [(x, y) for x in fps for y in fps if x < y and (x ^ y).bit_count() <= 2]
    frame = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long").repartition(5)
    for rows, some in ((1 << 19, 1 << 28), (40, 1 << 28), (1 << 19, 50)):
        got = [(r[0] % 2**64, r[1] % 2**64) for r in simhash.links(frame, 2, rows, some).collect()]
        assert linked(fps, got) == linked(fps, pairs)


def test_one_anchors_links_are_the_same_in_small_slices():
    fps = np.array(near(6, 200), np.uint64)
    row, anchor, home = simhash.anchors(fps)
    order = np.argsort(anchor, kind="stable")
    whole = simhash._links(anchor[order], fps[row][order], home[order], 2)
    for at_once in (1, 97):
        part = simhash._links(anchor[order], fps[row][order], home[order], 2, at_once)
        assert all((x == y).all() for x, y in zip(whole, part, strict=True))


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(200, 201), (201, 202), (202, 200),
                                                                                     (300, 300)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long").withColumn("z", F.lit(1))).collect())
    want = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)} | {201: 200, 202: 200}
    assert got == want
