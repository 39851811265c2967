"""SimHash near duplicates: fingerprints meet at the codewords of a covering code.

The 64 bits are four blocks, each with a perfect code: two binary Golay codes (23 bits, radius 3), a
repetition code (17 bits, radius 8) and one free bit (radius 0).  Every block of a fingerprint lies within the
radius of exactly one codeword, so a fingerprint has one home anchor.  If two fingerprints differ in at most t
bits, the second lies within radius plus t of the first one's home, block by block with a total excess of at
most t: each fingerprint is replicated to all such anchors (about 75 for t = 2) and compared there with the
fingerprints at home.  There are 2**26 anchors.  Copies of one fingerprint meet before, as one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import same_id, signed, store, table, texts
from .graph import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: an anchor with more rows or comparisons than this takes the other exact way
ANCHOR_ROWS = 1 << 19
ANCHOR_PAIRS = 1 << 28
PAIRS_AT_ONCE = 1 << 21
GOLAY = 0xC75  # generator polynomial of the binary Golay code
FAR = 100


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the shingles' XXH64; unsigned."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and the six ASCII white space characters
    if not words:
        return 0
    n = min(shingle, len(words))
    count, total = np.zeros(64, np.int64), len(words) - n + 1
    digest = xxhash.xxh64_intdigest
    for a in range(0, total, 1 << 16):
        part = words[a:a + (1 << 16) + n - 1]
        h = np.fromiter((digest(b" ".join(x), SEED) for x in zip(*(part[i:] for i in range(n)))), "<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > total, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def fingerprints(text: pd.Series) -> pd.Series:
        return pd.Series(signed(np.array([fingerprint(t, shingle) for t in text], np.uint64)))

    return fingerprints(F.coalesce(text.cast("string"), F.lit("")))


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit polynomials by the generator."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - 11)), rest)
    return rest


@cache
def _golay(excess: int) -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome: the error patterns of weight up to 3 + excess, and by how much each exceeds 3."""
    found: list[list[tuple[int, int]]] = [[] for _ in range(1 << 11)]
    for weight in range(4 + excess):
        patterns = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        for s, p in zip(_syndromes(patterns).tolist(), patterns.tolist(), strict=True):
            found[s].append((max(0, weight - 3), p))
    width = max(map(len, found))
    over, pattern = np.full((1 << 11, width), FAR, np.int16), np.zeros((1 << 11, width), np.int64)
    for s, own in enumerate(found):
        over[s, :len(own)], pattern[s, :len(own)] = zip(*own, strict=True)
    return over, pattern


def anchors(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of fps, anchor, is it the home) for all anchors within the blocks' radii plus max_bits in all."""
    over, pattern = _golay(max_bits)
    first, second = (fps & np.uint64(0x7FFFFF)).astype(np.int64), (fps >> np.uint64(23) & np.uint64(0x7FFFFF)).astype(np.int64)
    ones = np.bitwise_count(fps >> np.uint64(46) & np.uint64(0x1FFFF)).astype(np.int16)
    free = (fps >> np.uint64(63)).astype(np.int64)
    out = []
    for a in range(0, len(fps), 1024):
        part = slice(a, a + 1024)
        s1, s2 = _syndromes(first[part]), _syndromes(second[part])
        tail = np.stack([np.maximum(ones[part] - 8, 0), np.maximum(9 - ones[part], 0)], 1)  # to all zeros, all ones
        last = np.stack([free[part], 1 - free[part]], 1)  # to 0, to 1
        excess = (over[s1][:, :, None, None, None] + over[s2][:, None, :, None, None]
                  + tail[:, None, None, :, None] + last[:, None, None, None, :])
        row, i, j, t, f = np.nonzero(excess <= max_bits)
        code1 = (first[part][row] ^ pattern[s1[row], i]) >> 11  # a codeword's upper 12 bits name it
        code2 = (second[part][row] ^ pattern[s2[row], j]) >> 11
        out.append((row + a, code1 | code2 << 12 | t << 24 | f << 25, excess[row, i, j, t, f] == 0))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 3


def _links(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, max_bits: int,
           at_once: int = PAIRS_AT_ONCE) -> tuple[np.ndarray, np.ndarray]:
    """A forest (row, row) of the links between homes and rows of the same anchor; rows are sorted by anchor."""
    start = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    size = np.diff(np.r_[start, len(anchor)])
    group = np.repeat(np.arange(len(start)), size)
    here = np.flatnonzero(home & (size[group] > 1))
    label = np.arange(len(anchor))
    ahead = np.cumsum(size[group[here]])
    a = 0
    while a < len(here):
        b = max(a + 1, int(np.searchsorted(ahead, (ahead[a - 1] if a else 0) + at_once, "right")))
        n = size[group[here[a:b]]]
        left = np.repeat(here[a:b], n)
        right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[group[here[a:b]]], n)
        near = np.bitwise_count(fp[left] ^ fp[right]) <= max_bits
        left, right = left[near], right[near]
        while True:
            x, y = label[left], label[right]
            differ = x != y
            if not differ.any():
                break
            left, right, x, y = left[differ], right[differ], x[differ], y[differ]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label = label[label]
        a = b
    hung = np.flatnonzero(label != np.arange(len(label)))
    return hung, label[hung]


def _compare(max_bits: int, most_rows: int, most_pairs: int):
    """Links per anchor from rows sorted by anchor; rows of crowded anchors come out as (fp, null)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, passing = None, None

        def crowd(fp):
            return pd.DataFrame({"a": signed(fp), "b": pd.array([None] * len(fp), dtype="Int64")})

        def close(anchor, fp, home):
            if not len(anchor):
                return
            start = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            size = np.diff(np.r_[start, len(anchor)])
            many = np.repeat(size * np.add.reduceat(home.astype(np.int64), start) > most_pairs, size)
            if many.any():
                yield crowd(fp[many])
                anchor, fp, home = anchor[~many], fp[~many], home[~many]
            x, y = _links(anchor, fp, home, max_bits)
            yield pd.DataFrame({"a": signed(fp[x]), "b": pd.array(signed(fp[y]), dtype="Int64")}).drop_duplicates()

        for frame in frames:
            rows = [frame["anchor"].to_numpy(), frame["fp"].to_numpy(np.int64).view(np.uint64), frame["home"].to_numpy()]
            if passing is not None:
                same = rows[0] == passing
                if same.any():
                    yield crowd(rows[1][same])
                    rows = [x[~same] for x in rows]
            if not len(rows[0]):
                continue
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            cut = int(np.searchsorted(rows[0], rows[0][-1], "left"))
            yield from close(*(x[:cut] for x in rows))
            held = [x[cut:] for x in rows]
            if len(held[0]) > most_rows:
                passing = held[0][0]
                yield crowd(held[1])
                held = None
        if held is not None:
            yield from close(*held)

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, most_rows: int = ANCHOR_ROWS,
          most_pairs: int = ANCHOR_PAIRS) -> DataFrame:
    """(a, b) fingerprints that differ in at most ``max_bits``: enough of them to connect all that are linked.

    ``fps`` has distinct ``fp``.  Fingerprints of a crowded anchor are linked through the words between them
    instead: two that differ in up to 2h bits share a word within h bits of both, and few can share one.
    """

    def replicate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            all_fps = frame["fp"].to_numpy(np.int64).view(np.uint64)
            for a in range(0, len(all_fps), 1 << 13):
                part = all_fps[a:a + (1 << 13)]
                row, anchor, home = anchors(part, max_bits)
                yield pd.DataFrame({"anchor": anchor.astype(np.int32), "fp": signed(part[row]), "home": home})

    def between(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flips = np.array([0, *(sum(1 << b for b in bits) for k in range(1, (max_bits + 1) // 2 + 1)
                               for bits in combinations(range(64), k))], np.uint64)
        for frame in frames:
            fp = frame["fp"].to_numpy(np.int64).view(np.uint64)
            for a in range(0, len(fp), 1 << 10):
                part = fp[a:a + (1 << 10)]
                yield pd.DataFrame({"z": signed((part[:, None] ^ flips).ravel()),
                                    "fp": signed(np.repeat(part, len(flips)))})

    spread = fps.select("fp").mapInPandas(replicate, "anchor int, fp long, home boolean")
    found = store(spread.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(
        _compare(max_bits, most_rows, most_pairs), "a long, b long"), "simhash-links")
    near = found.filter("b IS NOT NULL")
    crowded = found.filter("b IS NULL").select(F.col("a").alias("fp")).distinct()
    if max_bits % 2 == 0 and not crowded.isEmpty():
        words = crowded.mapInPandas(between, "z long, fp long")
        least = words.groupBy("z").agg(F.min("fp").alias("lo"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        near = near.union(words.join(least, "z").filter("fp <> lo").select("fp", "lo"))
    elif not crowded.isEmpty():
        raise ValueError("an anchor is too crowded for an odd max_bits; use the next even number")
    return near


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, root, component_id) of every document: its fingerprint as a signed long, the component's
    least fingerprint, and the smallest doc_id reachable over links of at most ``max_bits`` differing bits.

    Edge cases: null and empty texts, and texts of white space, have fingerprint 0 and are linked like any
    others; a document without an id takes part, and its component_id is null only if no member has one; rows
    that repeat an id each get a row; an empty table gives an empty result.
    """
    prints = store(texts(docs).select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")), "fingerprints")
    return prints.join(_representatives(prints, max_bits), "fp").select(
        "doc_id", "fp", "root", "component_id")


def _representatives(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint."""
    fps = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links(fps, max_bits))
    fps = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = fps.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps.join(least, "root").select("fp", "root", "component_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component of near duplicates the document with the smallest doc_id stays.

    Documents without an id stay unless a member of their component has one; of rows that share a component's
    smallest id (or its missing id) one stays.
    """
    found = store(near_duplicates(docs), "simhash-components")
    if found.groupBy("doc_id").count().filter("count > 1").isEmpty():
        kept = found.filter(same_id(F.col("doc_id"), F.col("component_id"))).select(F.col("doc_id").alias("__id"))
        return docs.join(kept, same_id(docs["doc_id"].cast("long"), F.col("__id")), "left_semi")
    # an id alone does not name a row: the fingerprint tells which rows belong together
    roots = found.select(F.col("fp").alias("__fp"), F.col("root").alias("__root"),
                         F.col("component_id").alias("__first")).distinct()
    marked = docs.withColumn("__fp", fingerprint_column(F.col("text"))).join(roots, "__fp")
    marked = marked.filter(same_id(F.col("doc_id").cast("long"), F.col("__first")))
    return marked.dropDuplicates(["__root"]).select(*docs.columns)
