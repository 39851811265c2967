"""Token counts without ids: pieces are counted once per distinct pre-token and summed by frequency.

1. Each task cuts its texts into pre-tokens and writes blocks: the block's distinct pre-tokens, dealt into
   buckets by hash, and per document how often it has which of them (a sparse matrix in compact arrays).
2. The blocks' pre-tokens meet bucket by bucket; the tokenizer sees each distinct one once and the numbers of
   pieces go back to the blocks.  A pre-token that all documents hold comes once a block.
3. Each block multiplies its matrix by the numbers of pieces: one total per document.

Ids are never kept: of an encoded pre-token only its length is used.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import rows_below, store, table, texts

LIMIT = 1024
#: characters of text in a block
BLOCK = 12 << 20
PIECES_AT_ONCE = 1 << 15


def squeeze(values: np.ndarray) -> bytes:
    """32-bit integers, byte planes apart and compressed: small on disk and in shuffles alike."""
    planes = values.astype("<i4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def widen(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


class PreTokens:
    """Cuts texts as a byte-level vocabulary file says: its special strings first, then its pattern."""

    def __init__(self, path: str):
        import public_tokenizers

        with open(path, encoding="utf-8") as f:
            special = [x["content"] for x in json.load(f)["added_tokens"]]
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.special = regex.compile("|".join(regex.escape(x) for x in special)) if special else None
        self.strings = special

    def cut(self, text: str) -> list[str]:
        if self.special is None or not any(x in text for x in self.strings):
            return self.pattern.findall(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [*self.pattern.findall(text[at:m.start()]), m[0]]
            at = m.end()
        return out + self.pattern.findall(text[at:])


def write_blocks(docs: DataFrame, path: str, buckets: int, block: int = BLOCK) -> DataFrame:
    """(block, doc_ids, n_bytes, ends, tokens, counts, words): document i has word tokens[k] (stored as steps from
    the one before) counts[k] times for k between ends[i - 1] and ends[i]; ``words`` are the block's distinct
    pre-tokens in that numbering, by bucket: (bucket, their lengths in bytes, their bytes)."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter, part = PreTokens(path), TaskContext.get().partitionId()
        number, held, index = 0, ([], [], [], [], []), {}

        def flush():
            nonlocal number
            ids, n_bytes, ends, tokens, counts = held
            data = [x.encode() for x in index]
            bucket = np.fromiter((zlib.crc32(x) % buckets for x in data), np.int32, len(data))
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order))
            words = []
            for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                if len(own):
                    some = [data[i] for i in own.tolist()]
                    words.append({"bucket": int(bucket[own[0]]), "lengths": squeeze(np.fromiter(map(len, some), "<i4", len(some))),
                                  "data": zstandard.ZstdCompressor(level=3).compress(b"".join(some))})
            out = pd.DataFrame({
                "block": [part << 32 | number], "doc_ids": [list(ids)], "n_bytes": [list(n_bytes)],
                "ends": [np.cumsum(ends, dtype="<i8").tobytes()], "words": [words],
                "tokens": [squeeze(np.diff(np.concatenate([np.sort(place[t]) for t in tokens]), prepend=0))],
                "counts": [squeeze(np.concatenate([c[np.argsort(place[t])] for t, c in zip(tokens, counts, strict=True)]))]})
            for x in (*held, index):
                x.clear()
            number += 1
            return out

        size = 0
        for frame in rows_below(frames, "text", block):
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                if size and size + len(text) > block:
                    yield flush()
                    size = 0
                own = [index.setdefault(w, len(index)) for w in cutter.cut(text)]
                token, count = np.unique(np.array(own, np.int32), return_counts=True)
                for x, value in zip(held, (None if pd.isna(doc_id) else int(doc_id), len(text.encode()), len(token),
                                           token, count), strict=True):
                    x.append(value)
                size += len(text) + 1
        if size:
            yield flush()

    return store(texts(docs).mapInPandas(
        pack, "block long, doc_ids array<long>, n_bytes array<long>, ends binary, "
              "words array<struct<bucket: int, lengths: binary, data: binary>>, tokens binary, counts binary"), "token-blocks")


def count_pieces(words: DataFrame, path: str, buckets: int) -> DataFrame:
    """(block, bucket, pieces) from (block, bucket, lengths, data): each distinct word is encoded once.

    A task holds the distinct words of one bucket; there are as many buckets as shuffle partitions.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        library, bucket, known = Tokenizer.from_file(path), None, {}
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                if row.bucket != bucket:
                    bucket, known = row.bucket, {}
                stop, data = np.cumsum(widen(row.lengths)), zstandard.ZstdDecompressor().decompress(row.data)
                words = [data[a:b] for a, b in zip([0, *stop[:-1].tolist()], stop.tolist(), strict=True)]
                new = [x for x in words if x not in known]
                for a in range(0, len(new), PIECES_AT_ONCE):
                    some = new[a:a + PIECES_AT_ONCE]
                    known |= zip(some, map(len, library.encode_batch_fast([x.decode() for x in some],
                                                                          add_special_tokens=False)), strict=True)
                out.append(squeeze(np.fromiter(map(known.__getitem__, words), "<i4", len(words))))
            yield frame[["block", "bucket"]].assign(pieces=out)

    return (words.repartition(buckets, "bucket").sortWithinPartitions("bucket")
            .mapInPandas(count, "block long, bucket int, pieces binary"))


def token_counts(docs: DataFrame, path: str, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every document; special strings inside texts count as the library has them.

    Edge cases: null and empty texts have 0 bytes and 0 tokens; documents without an id and rows that repeat one
    each get a row; an empty table gives none; only doc_id and text are read.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = write_blocks(docs, path, buckets, block)
    pieces = count_pieces(blocks.select("block", F.explode("words").alias("w")).select("block", "w.*"), path, buckets)

    def total(matrix: pd.DataFrame, pieces: pd.DataFrame) -> pd.DataFrame:
        number = np.concatenate([np.zeros(0, np.int64), *map(widen, pieces.sort_values("bucket")["pieces"])])
        out = [pd.DataFrame({"doc_id": pd.array([], dtype="Int64"), "n_bytes": [], "n_tokens": []})]
        for row in matrix.itertuples(index=False):
            sums = np.r_[0, np.cumsum(number[np.cumsum(widen(row.tokens))] * widen(row.counts))]
            out.append(pd.DataFrame({"doc_id": pd.array(list(row.doc_ids), dtype="Int64"), "n_bytes": row.n_bytes,
                                     "n_tokens": np.diff(sums[np.r_[0, np.frombuffer(row.ends, "<i8")]])}))
        return pd.concat(out[1:] or out)

    matrices = blocks.select("block", "doc_ids", "n_bytes", "ends", "tokens", "counts")
    return (matrices.groupBy("block").cogroup(pieces.groupBy("block"))
            .applyInPandas(total, "doc_id long, n_bytes long, n_tokens long"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = token_counts(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))
    return found.withColumn("over_limit", F.col("n_tokens") > LIMIT)
