"""Round trips of the writers."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from hourweave.session import checkpoint_root
from hourweave.sources import files as IO


@pytest.fixture
def path(spark):
    return f"{checkpoint_root(spark)}/writers-{uuid.uuid4().hex}"


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()))


def predictions(spark):
    return spark.createDataFrame([(m, s, i, float(i), i / 2) for m in ("a", "b") for s in ("train", "validation") for i in range(5)],
                                 "model string, split string, i int, y_true double, y_pred double").repartition(3)


def test_features_are_partitioned_by_split(spark, path):
    x = predictions(spark)
    IO.write_features(x, path)
    again = spark.read.parquet(path)
    assert rows(again, *x.columns) == rows(x, *x.columns)
    assert "PartitionFilters: [isnotnull(split" in again.filter("split = 'train'")._jdf.queryExecution().toString()


def test_result_csv(spark, path):
    x = predictions(spark)
    IO.write_result_csv(x, path)
    assert rows(spark.read.schema(x.schema).option("header", True).csv(path), *x.columns) == rows(x, *x.columns)


def test_predictions_carry_their_residuals(spark, path):
    x = predictions(spark)
    IO.write_predictions(x, path)
    again = spark.read.parquet(path)
    assert rows(again, "model", "split", "i", "residual") == rows(x.withColumn("residual", F.col("y_true") - F.col("y_pred")),
                                                                 "model", "split", "i", "residual")


def test_metadata_json(spark, path):
    IO.write_metadata_json(spark.createDataFrame([("x", 3)], "name string, n int"), path)
    assert json.loads(spark.read.text(path).first()[0]) == {"name": "x", "n": 3}


def test_submissions_by_model(spark, path):
    x = predictions(spark)
    IO.write_submissions(x, path)
    assert rows(spark.read.parquet(path).filter("model = 'a'"), "i", "y_pred") == rows(x.filter("model = 'a'"), "i", "y_pred")


def test_upsert_writes_a_new_path(spark, path):
    first = IO.upsert_to_path(None, spark.createDataFrame([("a", 1), ("b", 2)], "model string, v int"), ["model"], path)
    second = IO.upsert_to_path(first, spark.createDataFrame([("b", 3), ("c", 4)], "model string, v int"), ["model"], path)
    assert first != second and rows(spark.read.parquet(first), "model", "v") == [("a", 1), ("b", 2)]
    assert rows(spark.read.parquet(second), "model", "v") == [("a", 1), ("b", 3), ("c", 4)]


def test_upsert_replaces_partitions_in_place(spark, path):
    schema = "model string, v int"
    files = lambda model: sorted(f"{p.getPath()}" for p in _listed(spark, f"{path}/model={model}"))
    IO.upsert_partitions(spark.createDataFrame([("007", 1), ("b", 2), ("b", 5)], schema), path, ["model"])
    kept = files("007")
    for _ in range(2):  # a retry changes nothing
        IO.upsert_partitions(spark.createDataFrame([("b", 3), (None, 4), ("c", 6)], schema), path, ["model"])
        got = IO.read_partitions(spark, path, schema)
        assert sorted(map(tuple, got.collect()), key=str) == [("007", 1), ("b", 3), ("c", 6), (None, 4)]
    assert files("007") == kept and len(files("b")) == 1
    IO.upsert_partitions(spark.createDataFrame([], schema), path, ["model"])
    assert IO.read_partitions(spark, path, schema).count() == 4


def _listed(spark, folder):
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    return [f.getPath().toUri() for f in found if f.getPath().getName().endswith(".parquet")]
