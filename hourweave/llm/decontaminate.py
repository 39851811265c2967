"""Benchmark decontamination: a prefix-filtered set join of benchmark windows against documents.

A window is WINDOW consecutive words of an item (or a shorter item whole).  Its shingles are the runs of up to
SHINGLE words in it, ordered by rarity over all documents.  Exact containment needs every shingle of the
window, so the necessary prefix is its rarest shingle alone:

1. documents count, per batch, how often each shingle of the benchmark occurs;
2. every distinct window keeps its rarest shingle and that shingle's position in it;
3. documents emit the places of prefix shingles with the words around them;
4. places and windows join on the shingle; the window must start at or after the document's first word and end
   at or before its last one (positional and length bounds), and its words must be the document's there.

A bit table of fixed size (FILTER_BITS, whatever the benchmark's size) keeps shingles that no window has from
leaving the scan; the joins are exact.  Documents travel as word counts and places, never as texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import rows_below, same_id, signed, store, table, texts
from .words import Words, bit_table, in_bits

WINDOW = 10
SHINGLE = 3
TEXT_AT_ONCE = 1 << 19


def windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window, n, words) with their shingles, one row each (shingle, size, offset); and
    (window, item_id) of the items that hold them.  ``window`` is the window's text."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            w = Words(frame["text"].tolist())
            by_size = {k: w.shingles(k) for k in range(1, shingle + 1)}
            for item, first, n in zip(frame["item_id"], w.first, w.count, strict=True):
                size = min(window, int(n))
                words = [w.word(i) for i in range(first, first + n)]
                k = min(shingle, size)
                for a in range(int(n) - size + 1 if size else 0):
                    inner = by_size[k][first + a:first + a + size - k + 1]
                    out.append((item, " ".join(words[a:a + size]), size, k, signed(inner).tolist()))
            yield pd.DataFrame(out, columns=["item_id", "window", "n", "size", "shingles"])

    source = items.select(F.col("item_id").cast("long").alias("item_id"),
                          F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    held = store(source.mapInPandas(cut, "item_id long, window string, n int, size int, shingles array<long>"),
                 "benchmark-windows")
    distinct = held.dropDuplicates(["window"]).select(
        "window", "n", "size", F.posexplode("shingles").alias("offset", "shingle"))
    return distinct, held.select("window", "item_id").distinct()


def shingle_counts(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """(shingle, n): occurrences over all documents of the shingles that the benchmark has (and of some that
    only share their bits, which no later join keeps)."""
    bits = docs.sparkSession.sparkContext.broadcast(bit_table(shingles))
    sizes = [r["size"] for r in shingles.select("size").distinct().collect()]  # SHINGLE rows at most

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows_below(frames, "text", TEXT_AT_ONCE):
            w = Words(frame["text"].tolist())
            for size in sizes:
                found = w.shingles(size)
                found, n = np.unique(found[in_bits(bits.value, found)], return_counts=True)
                yield pd.DataFrame({"shingle": signed(found), "n": n})

    return texts(docs).select("text").mapInPandas(count, "shingle long, n long").groupBy("shingle").agg(
        F.sum("n").alias("n"))


def prefixes(distinct: DataFrame, counts: DataFrame) -> DataFrame:
    """(window, n, size, offset, shingle): each window with its rarest shingle, the first of equals by hash."""
    known = distinct.join(counts.withColumnRenamed("n", "seen"), "shingle")  # unseen: in no document
    least = known.groupBy("window").agg(
        F.min(F.struct("seen", "shingle", "offset", "n", "size")).alias("r"), F.count(F.lit(1)).alias("seen_shingles"))
    # a window one of whose shingles occurs nowhere occurs nowhere
    whole = least.filter(F.col("seen_shingles") == F.col("r.n") - F.col("r.size") + 1)
    return whole.select("window", "r.n", "r.size", "r.offset", "r.shingle")


def places(docs: DataFrame, prefix: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document (row, doc_id, n_words) with the places of prefix shingles: (shingle, at, from, words),
    where ``words`` are those from word ``from`` on that a window over the place could cover."""
    bits = docs.sparkSession.sparkContext.broadcast(bit_table(prefix))
    sizes = [r["size"] for r in prefix.select("size").distinct().collect()]  # SHINGLE rows at most

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row = TaskContext.get().partitionId() << 40
        for frame in rows_below(frames, "text", TEXT_AT_ONCE):
            w = Words(frame["text"].tolist())
            found: list[list[dict]] = [[] for _ in range(len(frame))]
            for size in sizes:
                shingle = w.shingles(size)
                for i in np.flatnonzero(in_bits(bits.value, shingle)).tolist():
                    t = w.text[i]
                    first, n, at = int(w.first[t]), int(w.count[t]), i - int(w.first[t])
                    a, b = max(0, at - window + 1), min(n, at + window)
                    found[t].append({"shingle": int(shingle[i:i + 1].view(np.int64)[0]), "at": at, "from": a,
                                     "words": [w.word(first + j) for j in range(a, b)]})
            yield pd.DataFrame({"row": row + np.arange(len(frame)), "doc_id": frame["doc_id"].astype("Int64"),
                                "n_words": w.count, "places": found})
            row += len(frame)

    return store(texts(docs).mapInPandas(
        find, "row long, doc_id long, n_words long, "
              "places array<struct<shingle: long, at: int, from: int, words: array<string>>>"), "benchmark-places")


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids) per document: words, words inside an occurrence of a benchmark window,
    and the sorted ids (as strings) of the items that have a window there.

    Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters.  Edge cases: null and empty
    texts, on either side, have no words and no windows; items without an id hit words but add no id; rows that
    repeat an id are documents of their own; an empty benchmark hits nothing; an empty table gives no rows; only
    doc_id, item_id and text are read.
    """
    distinct, held = windows(items, window, shingle)
    distinct = store(distinct, "benchmark-shingles")
    prefix = store(prefixes(distinct, store(shingle_counts(docs, distinct), "shingle-counts")), "benchmark-prefixes")
    found = places(docs, prefix, window)
    asked = found.select("row", "n_words", F.explode("places").alias("p")).select("row", "n_words", "p.*")
    start = F.col("at") - F.col("offset")
    hits = (asked.join(prefix, "shingle")
            .filter((start >= 0) & (start + F.col("n") <= F.col("n_words")))  # positional and length bounds
            .filter(F.array_join(F.slice("words", start - F.col("from") + 1, F.col("n")), " ") == F.col("window"))
            .select("row", start.alias("start"), "n", "window"))
    hits = store(hits, "benchmark-hits")
    # words under a union of intervals: each interval adds what no interval that starts before it covers
    before = Window.partitionBy("row").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    stop = F.col("start") + F.col("n")
    fresh = F.greatest(stop - F.greatest("start", F.coalesce(F.max(stop).over(before), F.lit(0))), F.lit(0))
    words = (hits.select("row", "start", "n", fresh.alias("fresh"))
             .groupBy("row").agg(F.sum("fresh").cast("long").alias("n_hit")))
    ids = (hits.select("row", "window").distinct().join(held, "window").filter("item_id IS NOT NULL")
           .groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")))
    return (found.select("row", "doc_id", "n_words").join(words, "row", "left").join(ids, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with a hit word go (rows that share an id go together)."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    gone = found.filter("n_hit > 0").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(gone, same_id(docs["doc_id"].cast("long"), F.col("__id")), "left_anti")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x{7F}]+')"

ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[k:k + least(len(w), {WINDOW}) - 1], ' ') AS win
  FROM b, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS u(k) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS win
  FROM d, lens, unnest(range(1, len(w) - n + 2)) AS u(k)),
hit AS (SELECT doc_id, k, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, k, n FROM hit), unnest(range(k, k + n)) AS u(p) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
