"""Small fixtures for the corpus operators: awkward documents and plain-Python reference results."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
LONG = "the quick brown fox jumps over the lazy dog while the old man reads news"

#: null and empty texts, white space, repeated rows and ids, ties, accents, special strings, a long text
AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t\r\x0b\x0c "), (4, LONG), (4, LONG), (5, LONG.upper()), (6, LONG + "  \n" + LONG),
    (7, "a"), (8, "a b"), (9, "a  b\n\nc <|endoftext|> d<|endoftext|>e"), (None, LONG + "\nnull id"), (None, None),
    (10, "\xc0 la finé 你好 \U0001f600 é  x y \x1cz"), (11, (LONG + "\n") * 400),
    (12, "\n".join(f"line {i} of a long enough text number {i}" for i in range(300))), (13, "Don't we'll 123 4567 !!??"),
]


def awkward(spark: SparkSession) -> DataFrame:
    """AWKWARD with clashing extra columns."""
    rows = [(i, t, "en", "s" + str(k % 3), None, 7, "x") for k, (i, t) in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "score int, start string")


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def documents(sf: str = SF) -> list[tuple]:
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()
