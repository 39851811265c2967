"""File sources and sinks.

Readers always pass an explicit schema (no inference pass over 100 TB of CSV) and
turn the source's NA tokens into NULL.  Writers write partitioned parquet (or a
single small CSV/JSON file for result tables only).  Upserts write a new path and
never overwrite a path that is being read.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import AIR_RAW_CSV_COLUMNS, AIR_SPEC, PanelSpec, edge_name
from ..operators.windows import global_rank

_INT_COLS = {"No", "year", "month", "day", "hour"}
_STR_COLS = {"wd", "station", "id"}


def panel_csv_schema(columns=AIR_RAW_CSV_COLUMNS) -> T.StructType:
    fields = []
    for c in columns:
        t = T.LongType() if c in _INT_COLS else (T.StringType() if c in _STR_COLS else T.DoubleType())
        fields.append(T.StructField(c, t, True))
    return T.StructType(fields)


def _rename_edge(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(edge_name(c)) for c in df.columns])


def read_panel_csv(spark: SparkSession, path: str, columns=AIR_RAW_CSV_COLUMNS, null_value: str = "NA") -> DataFrame:
    """Raw hourly panel CSV with header; ``NA`` and empty fields become NULL."""
    df = (spark.read.schema(panel_csv_schema(columns)).option("header", True).option("nullValue", null_value)
          .option("mode", "FAILFAST").csv(path))
    return _rename_edge(df)


def wide_csv_schema(spec: PanelSpec = AIR_SPEC, window: int | None = None, raw_names: bool = True) -> T.StructType:
    """S2 schema: ``id, station`` + the lag x column product (names as in the file)."""
    w = window or spec.window
    names = {c: c for c in spec.numeric}
    if raw_names:
        names = {c: ("PM2.5" if c == "PM2_5" else c) for c in spec.numeric}
    fields = [T.StructField("id", T.StringType()), T.StructField("station", T.StringType())]
    for k in range(w, 0, -1):
        for p in ("year", "month", "day", "hour"):
            fields.append(T.StructField(f"{p}_lag_{k}", T.LongType()))
        for c in spec.numeric:
            fields.append(T.StructField(f"{names[c]}_lag_{k}", T.DoubleType()))
        if spec.wind:
            fields.append(T.StructField(f"{spec.wind}_lag_{k}", T.StringType()))
    return T.StructType(fields)


def read_wide_csv(spark: SparkSession, path: str, spec: PanelSpec = AIR_SPEC, null_value: str = "NA") -> DataFrame:
    """Independent windows, one per row."""
    df = (spark.read.schema(wide_csv_schema(spec)).option("header", True).option("nullValue", null_value)
          .option("mode", "FAILFAST").csv(path))
    return _rename_edge(df)


def read_template_csv(spark: SparkSession, path: str, value_col: str = "PM2.5") -> DataFrame:
    """S3: ``id`` (and a value column) with its row position in the file(s).

    Position = order of (file path, row within the file): ``monotonically_increasing_id``
    right after the scan follows a file's row order (its splits keep their offset
    order), and files are ordered by path, so a template written as several ordered
    part files reads back in order.  ``global_rank`` turns the pair into a dense
    0-based position without a single-partition sort.
    """
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField(value_col, T.DoubleType())])
    df = spark.read.schema(schema).option("header", True).csv(path)
    df = df.select("id", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_order"))
    return global_rank(df, ["_file", "_order"], "position").select("id", "position")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Intermediates; row order is never relied on (every window declares its order)."""
    return spark.read.parquet(path)


def write_features(df: DataFrame, path: str, partition_by=("split",)) -> None:
    """Processed hourly frame / sequence index, partitioned by split (pruned on read)."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_result_csv(df: DataFrame, path: str) -> None:
    """Result tables (metrics) as CSV, a part file per partition; readers take the folder."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_predictions(df: DataFrame, path: str) -> None:
    """Predictions with residual, partitioned by model and split."""
    out = df.withColumn("residual", F.col("y_true") - F.col("y_pred")) if "y_true" in df.columns else df
    out.write.mode("overwrite").partitionBy("model", "split").parquet(path)


def write_metadata_json(df: DataFrame, path: str) -> None:
    """One-row metadata record as JSON."""
    df.write.mode("overwrite").json(path)


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Drop the rows of re-run keys, append the new rows."""
    kept = existing.join(new.select(*keys).distinct(), keys, "left_anti")
    out = kept.unionByName(new, allowMissingColumns=True)
    return out.orderBy(*order) if order else out


def upsert_to_path(existing_path: str | None, new: DataFrame, keys: list[str], root: str) -> str:
    """Upsert and write to a *new* path under ``root``; returns it (the caller swaps)."""
    spark = new.sparkSession
    merged = new if not existing_path else upsert(spark.read.parquet(existing_path), new, keys)
    out = os.path.join(root, f"results-{uuid.uuid4().hex}")
    merged.write.mode("error").parquet(out)
    return out


def upsert_partitions(new: DataFrame, path: str, keys: list[str]) -> None:
    """S10/S11 in place: the partitions of the keys in ``new`` are replaced, files of all others stay untouched.

    A key's old rows go as a whole and repeating a write (a retried run) gives the same table; no row is read or
    rewritten beyond ``new``.  A new path starts a table; an empty ``new`` changes nothing.  ``new`` must not
    read from ``path``.  ``keys`` are the partition columns, the same in every write.
    """
    by_key = new.hint("rebalance", *keys)  # few files a key; adaptive execution splits the tasks of a large one
    by_key.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def read_partitions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of ``upsert_partitions``, with the columns and types of ``schema`` (partition values aren't guessed)."""
    return spark.read.schema(schema).parquet(path).select(*T.StructType.fromDDL(schema).names)


def write_submissions(df: DataFrame, path: str) -> None:
    """One answer table per component model (and the blend)."""
    df.write.mode("overwrite").partitionBy("model").parquet(path)
