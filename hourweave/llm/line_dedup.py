"""Line dedup: a sharded minimal perfect hash over the distinct line hashes, probed by documents.

1. Every document emits the 128-bit hashes of its distinct long line keys (narrow rows, no text).
2. One aggregation (map-side partials) gives each distinct line its document count and its last holder.
3. Lines are dealt to shards of about SHARD_LINES by hash; each shard becomes one row: the perfect hash and,
   in slot order, arrays of fingerprints, counts and holders.
4. Documents' hashes are routed to the shards and probe the arrays.  A shard with many probes (a line that a
   third of all documents hold) is replicated and its probes are dealt out by document, so no task takes them all.
5. The dropped hashes go back to their documents, which are rewritten in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import same_id, signed, store, table, texts
from .mph import Lookup, build

SPACE = " \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCS = 3
SHARD_LINES = 1 << 16
PROBES = 1 << 18
_LOW = (1 << 64) - 1


def line_hash(line: str, min_chars: int) -> int | None:
    """128-bit hash of a line's key, or None if the key is short."""
    key = line.strip(SPACE)
    return xxhash.xxh3_128_intdigest(key.encode().lower()) if len(key) >= min_chars else None


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, h1, h2): the distinct long line keys of each document."""

    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, found = [], []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                keys = {line_hash(x, min_chars) for x in text.split("\n")} - {None}
                ids.extend([doc_id] * len(keys))
                found.extend(keys)
            yield pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"),
                                "h1": signed(np.array([x >> 64 for x in found], np.uint64)),
                                "h2": signed(np.array([x & _LOW for x in found], np.uint64))})

    frame = texts(docs)
    return frame.mapInPandas(emit, "doc_id long, h1 long, h2 long")


def line_index(hashes: DataFrame, shard_lines: int = SHARD_LINES) -> tuple[DataFrame, DataFrame, int]:
    """The index (one row a shard), the number of probes each shard will get, and the number of shards.

    ``hashes`` are (doc_id, h1, h2), once per document and key.  The holder is the largest doc_id (null if all
    are null).
    """
    lines = store(hashes.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("holder")),
                  "line-counts")
    shards = max(1, -(-lines.count() // shard_lines))
    lines = lines.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (part[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        blob = build(h1, h2)
        order = np.argsort(Lookup(blob).slots(h1, h2))
        holder = part["holder"]
        return pd.DataFrame({
            "shard": [key[0]], "mph": [blob], "fingerprints": [h2[order].tobytes()],
            "counts": [np.minimum(part["n"].to_numpy(np.int64), 2**32 - 1)[order].astype("<u4").tobytes()],
            "holders": [holder.fillna(0).to_numpy(np.int64)[order].astype("<i8").tobytes()],
            "held": [holder.notna().to_numpy()[order].tobytes()]})

    index = lines.groupBy("shard").applyInPandas(
        pack, "shard int, mph binary, fingerprints binary, counts binary, holders binary, held binary")
    return store(index, "line-index"), lines.groupBy("shard").agg(F.sum("n").alias("probes")), shards


def probe(hashes: DataFrame, index: DataFrame, probes: DataFrame, shards: int,
          min_docs: int = MIN_DOCS, per_task: int = PROBES) -> DataFrame:
    """(doc_id, h1, h2) of the lines that a document loses."""
    hot = probes.filter(F.col("probes") > per_task).select(
        "shard", F.ceil(F.col("probes") / per_task).cast("int").alias("copies"))
    asked = hashes.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    asked = asked.join(hot, "shard", "left").withColumn(
        "copy", F.pmod(F.xxhash64("doc_id"), F.coalesce("copies", F.lit(1))).cast("int")).drop("copies")
    copies = index.join(hot, "shard", "left").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")

    def look(asked: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        none = asked.iloc[:0][["doc_id", "h1", "h2"]]
        if not len(asked) or not len(arrays):
            return none
        row = arrays.iloc[0]
        h1, h2 = (asked[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        slot = Lookup(row["mph"]).slots(h1, h2)
        known = slot >= 0
        known &= np.frombuffer(row["fingerprints"], "<u8")[slot] == h2
        counts, holders = np.frombuffer(row["counts"], "<u4")[slot], np.frombuffer(row["holders"], "<i8")[slot]
        held = np.frombuffer(row["held"], bool)[slot]
        own = asked["doc_id"].isna().to_numpy() == ~held
        own &= ~held | (asked["doc_id"].fillna(0).to_numpy(np.int64) == holders)
        return asked.loc[known & (counts >= min_docs) & ~own, ["doc_id", "h1", "h2"]]

    return (asked.groupBy("shard", "copy").cogroup(copies.groupBy("shard", "copy"))
            .applyInPandas(look, "doc_id long, h1 long, h2 long"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Every document with the kept text: all columns of ``docs``, plus kept_text, n_lines, n_dropped.

    A line's key is the line stripped of ASCII white space with A-Z lower-cased.  Keys of ``min_chars`` code
    points or more that ``min_docs`` documents or more hold lose all their lines but in the largest doc_id
    that holds them (there, repeats stay).  Edge cases: null or empty text is one empty line and stays so;
    null doc_ids sort below all others, so such documents keep a shared line only if no holder has an id;
    rows that repeat a doc_id count as documents of their own and keep or lose a line together; an empty
    table gives an empty result; columns of ``docs`` named kept_text, n_lines or n_dropped are replaced.
    """
    base = docs.drop("kept_text", "n_lines", "n_dropped")
    hashes = store(line_hashes(base, min_chars), "line-hashes")
    index, probes, shards = line_index(hashes)
    lost = probe(hashes, index, probes, shards, min_docs).distinct()
    lost = lost.groupBy(F.col("doc_id").alias("__id")).agg(
        F.collect_list(F.struct("h1", "h2")).alias("__lost"))

    @F.pandas_udf("kept_text string, n_lines long, n_dropped long")
    def rewrite(text: pd.Series, lost: pd.Series) -> pd.DataFrame:
        out = []
        for t, gone in zip(text, lost, strict=True):
            lines = t.split("\n")
            if gone is None or not len(gone):
                out.append((t, len(lines), 0))
                continue
            gone = {((x["h1"] & _LOW) << 64) | (x["h2"] & _LOW) for x in gone}
            kept = [x for x in lines if line_hash(x, min_chars) not in gone]
            out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(out, columns=["kept_text", "n_lines", "n_dropped"])

    joined = base.join(lost, same_id(base["doc_id"].cast("long"), lost["__id"]), "left")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (joined.withColumn("__new", rewrite(text, F.col("__lost")))
            .select(*[base[c] for c in base.columns], "__new.*"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents with their kept lines (n_chars follows the new text)."""
    out = dedup_lines(docs).drop("n_lines", "n_dropped")
    fresh = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return out.select(*[(fresh[c].alias(c) if c in fresh else F.col(c)) for c in docs.columns])


#: chr(9) .. chr(13) and the space, as the SQL strips them
_STRIP = " || ".join(["' '", *(f"chr({k})" for k in range(9, 14))])

ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, line, pos, translate(trim(line, {_STRIP}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (
  SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= {MIN_CHARS}
  GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (
  SELECT keyed.doc_id, line, pos, shared.k IS NOT NULL AND shared.holder <> keyed.doc_id AS gone
  FROM keyed LEFT JOIN shared ON keyed.k = shared.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


