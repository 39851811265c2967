"""MinHash near duplicates, verified by odd sketches before full sets are compared.

Every distinct shingle set has SAMPLES MinHash samples.  BANDS bands of ROWS samples deal the sets into buckets,
and the samples are folded into a bitmap by parity: sample i with minimum m flips bit h(i, m).  Samples that two
sets share cancel in the XOR of their bitmaps, so its population count tells how many samples differ, and it is
most precise where few do.  A pair of a bucket goes on only if its count is one that a pair at the threshold
stays below (but for a chance of MISS, computed from the exact distribution) and if the set sizes allow the
threshold; what goes on is confirmed on the full sets.

Links only have to be found where they join what is not yet joined.  First every set of a bucket is held
against the bucket's head, the set that meets most others.  Then only buckets with sets of several components are
looked into, in cells of about CELL sets: a bucket's largest component is dealt out over its cells, the other sets
visit every cell, where a pair is compared in the first band it shares and only while its components differ.
Rows that leave a cell are links between components, so a large group of near copies makes a row for each copy
at most, not for each two.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix64, rows_below, same_id, signed, store, table, texts
from .graph import components
from .words import STEP, Words

SHINGLE = 4
PERCENT = 80
BANDS = 40
ROWS = 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: chance that a pair at the threshold is taken for a lesser one by its sketches
MISS = 1e-9
CELL = 4096
#: pairs of a visitor that are confirmed at once
PAIRS = 64
#: names of sets up to this number (16 bytes each) are broadcast, so that the texts need not be shuffled
FEW = 1 << 21
BATCH_CHARS = 1 << 19
SLICE = 1 << 17

#: word bytes stay (A-Z lower-cased), white space becomes 0, and NUL, a word byte too, one that UTF-8 doesn't use
_WORD = np.arange(256, dtype=np.uint8)
_WORD[0x41:0x5B] += 32
_WORD[0] = 0xFF
_WORD[[0x20, *range(0x09, 0x0E)]] = 0

_seeds = mix64(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64))
_FLIP = (_seeds[:SAMPLES] >> np.uint64(32)).astype(np.uint32)
_FACTOR = (_seeds[SAMPLES:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def shingle_sets(batch: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): text i's set is hashes[bounds[i]:bounds[i + 1]], sorted 64-bit hashes of its shingles."""
    words = Words(batch, _WORD)
    h = words.shingles(size) if len(words.hash) else np.empty(0, np.uint64)
    text = words.text
    for i in np.flatnonzero((words.count > 0) & (words.count < size)):
        own = slice(words.first[i], words.first[i] + words.count[i])  # fewer words: all of them are one shingle
        run = np.array([words.count[i]], np.uint64)
        for x in words.hash[own]:
            run = mix64(run * STEP + x)
        h[own.start] = run[0] | np.uint64(1)
    text, h = text[h != 0], h[h != 0]
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], np.searchsorted(text[new], np.arange(len(batch) + 1))


def samples(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(sets, SAMPLES) minima; the sets must not be empty."""
    out = np.full((len(bounds) - 1, SAMPLES), 0xFFFFFFFF, np.uint32)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(x), SLICE):
        part = x[a:a + SLICE]
        first = int(np.searchsorted(bounds, a, "right")) - 1
        last = int(np.searchsorted(bounds, a + len(part), "left"))
        start = np.maximum(bounds[first:last] - a, 0)
        for j in range(SAMPLES):
            least = np.minimum.reduceat((part ^ _FLIP[j]) * _FACTOR[j], start)
            np.minimum(out[first:last, j], least, out=out[first:last, j])
    return out


def bands(minima: np.ndarray) -> np.ndarray:
    """(sets, BANDS) bucket keys; a band's keys hold its number."""
    rows = minima.astype(np.uint64).reshape(len(minima), BANDS, ROWS)
    key = mix64(np.arange(BANDS, dtype=np.uint64) + np.uint64(1))[None, :].repeat(len(minima), 0)
    for k in range(ROWS):
        key = mix64(key * STEP + rows[:, :, k])
    return key


def odd_sketch(minima: np.ndarray) -> np.ndarray:
    """(sets, SKETCH_BITS / 64) bitmaps: bit b is the parity of the samples that fall on b."""
    place = mix64(minima.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))) % np.uint64(SKETCH_BITS)
    out = np.zeros((len(minima), SKETCH_BITS // 64), np.uint64)
    row = np.arange(len(minima))
    for j in range(SAMPLES):  # one bit a row: no row is named twice
        out[row, place[:, j] // np.uint64(64)] ^= np.uint64(1) << place[:, j] % np.uint64(64)
    return out


@cache
def most_ones(percent: int = PERCENT, miss: float = MISS) -> int:
    """Population count of the XOR that a pair of ``percent`` similarity exceeds with a chance of ``miss`` at most."""
    # samples that differ are binomial; each flips a bit of either bitmap, and the ones of the XOR are a Markov chain
    p = 1 - percent / 100
    differ = [comb(SAMPLES, d) * p**d * (1 - p)**(SAMPLES - d) for d in range(SAMPLES + 1)]
    ones = np.zeros(SKETCH_BITS + 1)
    ones[0] = 1.0
    up = 1 - np.arange(SKETCH_BITS + 1) / SKETCH_BITS
    total = np.zeros(SKETCH_BITS + 1)
    for d in range(SAMPLES + 1):
        total += differ[d] * ones
        for _ in range(2):
            ones = np.r_[0.0, (ones * up)[:-1]] + np.r_[(ones * (1 - up))[1:], 0.0]
    above = np.cumsum(total[::-1])[::-1]  # chance of that many ones or more
    return int(np.flatnonzero(above > miss)[-1])


def _prints(docs: DataFrame, shingle: int) -> DataFrame:
    """Per document: a row number of its own, doc_id, set size, 128-bit set hash, bucket keys, sketch, text."""
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row = TaskContext.get().partitionId() << 32
        for frame in rows_below(frames, "text", BATCH_CHARS):
            hashes, bounds = shingle_sets(frame["text"].tolist(), shingle)
            n = np.diff(bounds)
            full = n > 0
            minima = samples(hashes, np.r_[bounds[:-1][full], len(hashes)])
            digest = np.zeros((2, len(n)), np.uint64)
            for k in range(2):
                digest[k, full] = np.add.reduceat(mix64(hashes * STEP + np.uint64(k)), bounds[:-1][full]) if full.any() else 0
            keys, sketches = [None] * len(n), [None] * len(n)
            for i, key, bits in zip(np.flatnonzero(full).tolist(), signed(bands(minima)), signed(odd_sketch(minima)), strict=True):
                keys[i], sketches[i] = key, bits
            yield pd.DataFrame({"row": row + np.arange(len(n)), "doc_id": _ids(frame["doc_id"]), "n": n,
                                "s1": signed(digest[0]), "s2": signed(digest[1]), "keys": keys, "sketch": sketches,
                                "text": frame["text"]})
            row += len(n)

    named = texts(docs).withColumn("doc_id", F.col("doc_id").cast("string"))  # a null turns longs to doubles in pandas
    return store(named.mapInPandas(read, "row long, doc_id long, n long, s1 long, s2 long, keys array<long>, "
                                         "sketch array<long>, text string"), "minhash-prints")


def _ids(names: pd.Series) -> pd.array:
    return pd.array([None if pd.isna(i) else int(i) for i in names], dtype="Int64")


def _ones(a: str, b: str) -> Column:
    """Population count of the XOR of two sketches."""
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(1, SKETCH_BITS // 64)),
               F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    return (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y, strict=True):
            p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            out.append(100 * both >= percent * (len(p) + len(q) - both))
        return pd.Series(out, dtype=bool)

    x, y = sets.select(F.col("node").alias("a"), F.col("set").alias("x")), sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
    pairs = store(pairs, "minhash-pairs")
    if pairs.count() <= FEW:  # 16 bytes each: the sets need not be shuffled to meet their pairs
        pairs = F.broadcast(pairs)
    return pairs.join(x, "a").join(y, "b").filter(alike("x", "y")).select("a", "b")


class _Cell:
    """The residents of a cell and the links found in it: a visitor is held against residents of other components."""

    def __init__(self, bucket: int, rows: pd.DataFrame, percent: int):
        rows = rows.iloc[np.argsort(rows["n"].to_numpy(), kind="stable")]
        self.bucket, self.percent = bucket, percent
        self.node, self.n, self.root = (rows[c].to_numpy(np.int64) for c in ("node", "n", "root"))
        self.sketch, self.keys = (np.stack(rows[c].to_numpy()).view(np.uint64) for c in ("sketch", "keys"))
        self.sets = [np.frombuffer(x, np.uint64) for x in rows["set"]]
        self.over: dict[int, int] = {}

    def _find(self, root: int) -> int:
        while (up := self.over.get(root, root)) != root:
            root = up
        return root

    def links(self, visitor) -> Iterator[int]:
        """Residents that join the visitor's component to another one, the likeliest tried first."""
        a = np.searchsorted(100 * self.n, self.percent * visitor.n, "left")
        b = np.searchsorted(self.percent * self.n, 100 * visitor.n, "right")
        ones = np.bitwise_count(self.sketch[a:b] ^ visitor.sketch.view(np.uint64)).sum(axis=1, dtype=np.int64)
        near = a + np.flatnonzero((ones <= most_ones(self.percent)) & (self.root[a:b] != visitor.root))
        if not len(near):
            return
        # a pair counts in the first band that it shares only
        shared = self.keys[near] == visitor.keys.view(np.uint64)
        first = shared.argmax(axis=1)
        near = near[self.keys[near, first].view(np.int64) == self.bucket]
        near = near[np.argsort(ones[near - a], kind="stable")]
        own = np.frombuffer(visitor.set, np.uint64)
        for k in range(0, len(near), PAIRS):
            part = [i for i in near[k:k + PAIRS].tolist() if self._find(self.root[i]) != self._find(visitor.root)]
            if not part:
                continue
            size = np.array([len(self.sets[i]) for i in part])
            every = np.concatenate([self.sets[i] for i in part])
            hit = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
            both = np.add.reduceat(hit, np.cumsum(size) - size, dtype=np.int64)
            for i in np.flatnonzero(100 * both >= self.percent * (size + len(own) - both)).tolist():
                x, y = self._find(self.root[part[i]]), self._find(visitor.root)
                if x != y:
                    self.over[max(x, y)] = min(x, y)
                    yield int(self.node[part[i]])


def _across(percent: int):
    """Links of a cell that join components.

    Rows come sorted by (bucket, cell, visitor): a cell's residents first, CELL at most or so, then its visitors.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, residents, cell = None, [], None
        for frame in frames:
            bucket, number = frame["bucket"].to_numpy(np.int64), frame["cell"].to_numpy(np.int64)
            new = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (number[1:] != number[:-1])])
            found = []
            for a, b in zip(new, [*new[1:], len(frame)], strict=True):
                part = frame.iloc[a:b]
                if (now := (bucket[a], number[a])) != here:
                    here, residents, cell = now, [], None
                stay = part[part["visitor"] == 0]
                if len(stay):
                    residents.append(stay)
                for v in part[part["visitor"] == 1].itertuples():
                    cell = cell or _Cell(here[0], pd.concat(residents), percent) if residents else None
                    found += [(v.node, i) for i in cell.links(v)] if cell else []
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    return run


def _open_links(shared: DataFrame, roots: DataFrame, sets: DataFrame, percent: int, cell: int) -> DataFrame:
    """(a, b): links within shared buckets that join different components."""
    rows = shared.join(roots, "node")
    per_root = rows.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("c"))
    split = per_root.groupBy("bucket").agg(F.max_by("root", F.struct("c", "root")).alias("major"), F.sum("c").alias("c"),
                                           F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    rows = rows.join(split.select("bucket", "major", F.ceil(F.col("c") / cell).cast("int").alias("cells")), "bucket")
    rows = store(rows.select("bucket", "node", "root", (F.col("root") != F.col("major")).alias("minor"), "cells"), "minhash-open")
    home = F.pmod(F.xxhash64("node"), F.col("cells").cast("long"))
    stay = rows.select("bucket", home.alias("cell"), F.lit(0).alias("visitor"), "node", "root")
    every = F.sequence(F.lit(0).cast("long"), F.col("cells") - F.lit(1).cast("long"))
    visit = rows.filter("minor").select("bucket", F.explode(every).alias("cell"), F.lit(1).alias("visitor"), "node", "root")
    dealt = stay.unionByName(visit).join(sets, "node")
    return dealt.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell", "visitor").mapInPandas(
        _across(percent), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, cell: int = CELL) -> DataFrame:
    """(doc_id, n_shingles, root, component_id) of every document: the size of its set of word shingles, its
    component over links of Jaccard similarity ``percent`` per cent or more (null where it has no words), and the
    component's smallest doc_id.

    At the threshold of 80 per cent a pair meets in no bucket with a chance of 7e-10, and of 2e-12 at 85 per cent.
    Use ``percent`` from 80 on; lesser thresholds need more bands.

    Edge cases: null and empty texts and texts of white space have no set and are linked with nothing, also not
    with each other: their component_id is their own doc_id.  A document without an id takes part; its
    component_id is null only if no member has one.  Rows that repeat an id each get a row; equal sets are one
    class, whatever their number; an empty table gives an empty result; other columns are not read.  A very
    long text is one batch: its hashes take about 40 bytes for each of its bytes.
    """
    prints = _prints(docs, shingle)
    classes = store(prints.filter("n > 0").groupBy("s1", "s2").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("keys").alias("keys"),
        F.first("sketch").alias("sketch")), "minhash-classes")
    buckets = classes.select("node", F.explode("keys").alias("bucket"))
    size = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = store(buckets.join(size, "bucket"), "minhash-shared")
    # a bucket's head is the set that meets most others: of a group of copies, the one they were made from
    weight = shared.groupBy("node").agg(F.sum("c").alias("w"))
    heads = shared.join(weight, "node").groupBy("bucket").agg(F.max_by("node", F.struct("w", "node")).alias("head"))
    # sketches, keys and full sets of the sets that share a bucket with another
    own = store(classes.join(weight.select("node"), "node").select("node", "n", "sketch", "keys"), "minhash-own")
    named = own.select("node")
    named = F.broadcast(named) if named.count() <= FEW else named
    full = prints.select(F.col("row").alias("node"), "text").join(named, "node").select(
        "node", _set_column(F.col("text"), shingle).alias("set"))
    sets = store(own.join(full, "node"), "minhash-sets")
    facts = sets.select("node", "n", "sketch")
    to_head = shared.join(heads, "bucket").filter("node <> head").select(
        F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"), "head").distinct()
    x, y = (facts.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}")) for c in "ab")
    near = to_head.join(x, "a").join(y, "b").withColumn("ones", _ones("s_a", "s_b")).filter(
        _sizes_allow("n_a", "n_b", percent) & (F.col("ones") <= most_ones(percent)))
    # the likeliest head of each set: what other heads would add is left to the open buckets
    to_head = near.withColumn("set", F.when(F.col("b") == F.col("head"), F.col("a")).otherwise(F.col("b"))).groupBy("set").agg(
        F.min_by(F.struct("a", "b"), F.struct("ones", "a", "b")).alias("pair")).select("pair.a", "pair.b").distinct()
    links = store(_confirmed(to_head, sets, percent), "minhash-links")

    def rooted(links: DataFrame) -> DataFrame:
        found = components(links)
        return facts.select("node").join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root"))

    roots = store(rooted(links), "minhash-roots")
    more = store(_open_links(shared.select("bucket", "node"), roots, sets, percent, cell), "minhash-more")
    if not more.isEmpty():
        roots = rooted(links.union(more))
    named = classes.join(roots, "node", "left").select("s1", "s2", "first", F.coalesce("root", "node").alias("root"))
    named = store(named, "minhash-named")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "root").select("s1", "s2", "root", "component_id")
    full = prints.filter("n > 0").join(named, ["s1", "s2"]).select("doc_id", F.col("n").alias("n_shingles"), "root", "component_id")
    none = prints.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("root"),
                                         F.col("doc_id").alias("component_id"))
    return full.unionByName(none)


def _set_column(text: Column, shingle: int) -> Column:
    @F.pandas_udf("binary")
    def sets(text: pd.Series) -> pd.Series:
        out = []
        for frame in rows_below(iter([text.to_frame("text")]), "text", BATCH_CHARS):
            hashes, bounds = shingle_sets(frame["text"].tolist(), shingle)
            out += [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return pd.Series(out, dtype=object)

    return sets(text)


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", same_id(F.col("doc_id"), F.col("component_id")).alias("kept"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)] END)) AS s FROM d),
g AS (SELECT s, min(doc_id) AS node, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
e AS (SELECT node, n, unnest(s) AS x FROM g),
r AS (SELECT node, n, x, count(*) OVER (PARTITION BY x) AS f FROM e),
pre AS (SELECT node, n, x FROM r QUALIFY row_number() OVER (PARTITION BY node ORDER BY f, x) <= n - (80 * n + 99) // 100 + 1),
c AS (SELECT DISTINCT a.node AS a, b.node AS b FROM pre a JOIN pre b ON a.x = b.x AND a.node < b.node
      WHERE 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n),
l AS (SELECT c.a, c.b FROM c JOIN g x ON x.node = c.a JOIN g y ON y.node = c.b
      WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (x.n + y.n - len(list_intersect(x.s, y.s)))),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
t AS (SELECT node, node AS r FROM g UNION SELECT u.b, t.r FROM t JOIN u ON u.a = t.node WHERE t.r < u.b),
m AS (SELECT node, min(r) AS component_id FROM t GROUP BY node)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(m.component_id, s.doc_id) AS component_id,
       s.doc_id = coalesce(m.component_id, s.doc_id) AS kept
FROM s LEFT JOIN g ON g.s = s.s LEFT JOIN m ON m.node = g.node
"""
