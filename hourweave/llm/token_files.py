"""Token files: raw id payloads in doc_id order, and a minimal perfect hash index for keyed access.

Format (a folder per table, written by Spark; any task may be lost and redone):

* ``payload``: one row per block of whole documents, ``shard``, ``block`` (from 0 within the shard), ``start``
  (ids of the shard before it) and ``ids``, the raw little-endian ids, 16 bits each if the vocabulary allows
  it and 32 otherwise.  Shards follow each other in doc_id order; a block holds BLOCK_IDS ids at most, or one
  longer document.
* ``shards``: ``shard``, ``width`` (bytes an id) and ``first`` (ids of all shards before it).
* ``index``: one row per bucket of keys: a minimal perfect hash and, in slot order, arrays of fingerprints
  and of the places (shard, block, offset within the block, length).

A key's place takes a bucket, a slot and a fingerprint comparison, whatever the number of documents; the bytes
are then at a fixed offset of one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import rows_below, store, store_bucketed, table, texts
from .encoding import encoder
from .mph import Lookup, build

BLOCK_IDS = 1 << 18
BUCKET_KEYS = 1 << 15
TEXT_AT_ONCE = 1 << 19
PLACE = [("shard", "<i4"), ("block", "<i4"), ("offset", "<i4"), ("length", "<i4")]


def _vocabulary(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def write_payload(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Encode and write the payload, ordered by doc_id (null first, equal ids in any order).

    The rows also carry the doc_ids and lengths of a block, from which the index is made.
    """
    width = 2 if max(_vocabulary(path), end_id + 1) <= 1 << 16 else 4
    end = np.array([end_id], "<u4").tobytes()

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, shard = encoder(path), TaskContext.get().partitionId()
        block, start, held = 0, 0, ([], [], [])

        def flush():
            nonlocal block, start
            ids = np.frombuffer(b"".join(held[2]), "<u4").astype(f"<u{width}")
            out = pd.DataFrame({"shard": [shard], "block": [block], "start": [start], "width": [width],
                                "n_ids": [len(ids)], "doc_ids": [list(held[0])], "lengths": [list(held[1])],
                                "ids": [ids.tobytes()]})
            block, start = block + 1, start + len(ids)
            for x in held:
                x.clear()
            return out

        for frame in rows_below(frames, "text", TEXT_AT_ONCE):
            ids = [None if pd.isna(x) else int(x) for x in frame["doc_id"]]
            for doc_id, raw in zip(ids, enc.encode(frame["text"].tolist()), strict=True):
                n = len(raw) // 4 + 1
                if held[1] and sum(held[1]) + n > BLOCK_IDS:
                    yield flush()
                held[0].append(doc_id)
                held[1].append(n)
                held[2].append(raw + end)
        if held[1]:
            yield flush()

    parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = texts(docs).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    payload = ordered.mapInPandas(encode, "shard int, block int, start long, width int, n_ids long, "
                                          "doc_ids array<long>, lengths array<int>, ids binary")
    return store_bucketed(payload, "token_payload", "shard", parts)


def write_shards(payload: DataFrame) -> DataFrame:
    """The shards table: one row per written shard (as many as tasks, never as documents)."""
    sizes = payload.groupBy("shard").agg(F.sum("n_ids").alias("n"), F.first("width").alias("width"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return store(sizes.select("shard", "width", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")),
                 "token-shards")


def _key(col: str, copy: str) -> list:
    """128-bit hash of a document key: its id and, for repeated ids, which of them."""
    return [F.xxhash64(col, copy).alias("h1"), F.xxhash64(F.lit(7), copy, col).alias("h2")]


def write_index(payload: DataFrame, bucket_keys: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """The index over all documents, and its number of buckets."""

    def places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                n = np.asarray(row.lengths, np.int64)
                yield pd.DataFrame({"shard": row.shard, "block": row.block, "offset": np.cumsum(n) - n, "length": n,
                                    "doc_id": pd.array(list(row.doc_ids), dtype="Int64")})

    docs = payload.select("shard", "block", "doc_ids", "lengths").mapInPandas(
        places, "shard int, block int, offset int, length int, doc_id long")
    docs = store(docs, "token-places")
    buckets = max(1, -(-docs.count() // bucket_keys))
    order = Window.partitionBy("doc_id").orderBy("shard", "block", "offset")
    keys = (docs.withColumn("copy", F.row_number().over(order))
            .select("shard", "block", "offset", "length", *_key("doc_id", "copy")))

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (part[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        blob = build(h1, h2)
        at = np.argsort(Lookup(blob).slots(h1, h2))
        place = np.empty(len(part), PLACE)
        for name, _ in PLACE:
            place[name] = part[name].to_numpy()
        return pd.DataFrame({"bucket": [key[0]], "mph": [blob], "fingerprints": [h2[at].tobytes()],
                             "places": [place[at].tobytes()]})

    index = (keys.withColumn("bucket", F.pmod("h1", F.lit(buckets)).cast("int")).groupBy("bucket")
             .applyInPandas(pack, "bucket int, mph binary, fingerprints binary, places binary"))
    return store(index, "token-index"), buckets


@dataclass
class TokenFiles:
    """Written files: the three tables and the number of index buckets."""

    payload: DataFrame
    shards: DataFrame
    index: DataFrame
    buckets: int

    def find(self, keys: DataFrame) -> DataFrame:
        """(doc_id, copy, shard, block, offset, length) of the keys that the files hold.

        ``keys`` has doc_id and copy (1 for the first document of an id).  Keys meet their bucket's arrays in
        one task each; keys that are not there are refused by their fingerprint.
        """
        asked = keys.select("doc_id", "copy", *_key("doc_id", "copy"))
        asked = asked.withColumn("bucket", F.pmod("h1", F.lit(self.buckets)).cast("int"))

        def look(asked: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
            out = asked[["doc_id", "copy"]]
            if not len(asked) or not len(arrays):
                return out.iloc[:0].assign(shard=0, block=0, offset=0, length=0)
            row = arrays.iloc[0]
            h1, h2 = (asked[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
            slot = Lookup(row["mph"]).slots(h1, h2)
            known = (slot >= 0) & (np.frombuffer(row["fingerprints"], "<u8")[slot] == h2)
            place = np.frombuffer(row["places"], PLACE)[slot[known]]
            return out[known].assign(**{name: place[name] for name, _ in PLACE})

        return (asked.groupBy("bucket").cogroup(self.index.groupBy("bucket"))
                .applyInPandas(look, "doc_id long, copy int, shard int, block int, offset int, length int"))

    def read(self, keys: DataFrame) -> DataFrame:
        """(doc_id, copy, start, n_tokens, ids) of the keys, cut from the payload's blocks; ids are 32 bits wide.

        The payload is bucketed by shard, so it is read in place: only the keys' places are shuffled.
        """
        places = self.find(keys).join(self.shards.select("shard", "first"), "shard")

        def cut(places: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
            out = []
            at = {r.block: (np.frombuffer(r.ids, f"<u{r.width}"), r.start) for r in blocks.itertuples(index=False)}
            for x in places.itertuples(index=False):
                ids, start = at[x.block]
                piece = ids[x.offset:x.offset + x.length]
                out.append((x.doc_id, x.copy, x.first + start + x.offset, x.length, piece.astype("<u4").tobytes()))
            return pd.DataFrame(out, columns=["doc_id", "copy", "start", "n_tokens", "ids"])

        blocks = self.payload.select("shard", "block", "start", "width", "ids")
        return (places.groupBy("shard").cogroup(blocks.groupBy("shard"))
                .applyInPandas(cut, "doc_id long, copy int, start long, n_tokens long, ids binary"))


def write_tokens(docs: DataFrame, path: str, end_id: int = 0) -> TokenFiles:
    """Encode every whole text with the vocabulary at ``path``, append ``end_id``, write and index the ids.

    Edge cases: null and empty texts hold the end id alone; documents with a null id are written first, under
    the null key; rows that repeat an id are all written, and the key's ``copy`` counts them from 1 in the
    order of the files; an empty table gives empty tables; other columns are not read.
    """
    payload = write_payload(docs, path, end_id)
    index, buckets = write_index(payload)
    return TokenFiles(payload, write_shards(payload), index, buckets)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, asked for by key and read back from the files."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = write_tokens(docs, str(public_tokenizers.path("byte_bpe_50k.json")))
    copies = Window.partitionBy("doc_id").orderBy("doc_id")
    keys = (docs.select(F.col("doc_id").cast("long").alias("doc_id"))
            .withColumn("copy", F.row_number().over(copies)))
    return files.read(keys).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
