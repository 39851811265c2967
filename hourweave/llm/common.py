"""Helpers shared by the corpus operators: reading, writing stages, small column expressions.

Conventions of the whole subpackage: an operator takes a documents frame and reads only the columns it
names (``doc_id``, ``text``); extra columns, also ones named like an output, never reach its working frames.
A null text counts as the empty text.  Rows that share a ``doc_id`` are separate documents unless an
operator's docstring says otherwise; a null ``doc_id`` is an id of its own that sorts below all others.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourweave.session import checkpoint_root


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per application: they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="hourweave-")) / "hourweave.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id and text (null: empty), plus the columns named."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep,
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def store(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write a stage to a new folder under spark.checkpoint.dir and read it back.

    The lineage ends there: a lost executor costs the tasks it ran, not the stages before.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return spark.read.parquet(path)


def store_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Like ``store``, as a table bucketed by ``key``: later joins and groupings on the key don't shuffle it.

    Meant for frames whose tasks each hold few keys (a file is written per task and bucket).
    """
    spark = df.sparkSession
    name = f"{name}_{uuid.uuid4().hex}"
    (df.write.option("compression", "zstd").option("path", os.path.join(checkpoint_root(spark), name))
     .bucketBy(buckets, key).saveAsTable(name))
    return spark.table(name)


def rows_below(frames: Iterator[pd.DataFrame], column: str, limit: int) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches so that each piece holds about ``limit`` characters of ``column`` (one row at least)."""
    for frame in frames:
        if not len(frame):
            continue
        block = (frame[column].str.len().cumsum() // limit).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(frame)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield frame.iloc[a:b].reset_index(drop=True)


def same_id(a, b):
    """Null-safe equality of two id columns."""
    return a.eqNullSafe(b)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over a 64-bit word (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def one_text(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per doc_id with a text of its own, chosen by hash among rows that repeat the id, and the columns
    named, which must be the same in all of them."""
    return rows.groupBy("doc_id").agg(*[F.first(c).alias(c) for c in keep], F.min_by(
        "text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))


def held_out(doc_id):
    """crc32 of the id's decimal text is divisible by 5: such labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
