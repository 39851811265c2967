"""Connected components of a graph too large for one machine, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of ``edges`` (a, b) but the roots themselves, the least node it is linked to.

    Each round hangs the greater neighbours of every node on the least node nearby, then does the same for the
    lesser ones; the edges end as one star per component, after a number of rounds logarithmic in its size.  A
    round is a few joins and aggregations with map-side partials: a node with very many neighbours is one row
    on one side of a join and splittable rows on the other.  Each round's edges are written, so a lost
    executor costs one round's tasks at most.
    """
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    stars = store(edges.filter("a <> b").select(hi, lo).distinct(), "edges")
    before = _digest(stars)
    while before[0]:
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            stars.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").filter("v <> m").select(
            F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = store(large, "large-star")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(least, "hi")
        small = joined.select("hi", F.col("m").alias("lo")).union(
            joined.filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))).distinct()
        stars = store(small, "small-star")
        now = _digest(stars)
        if now == before:
            break
        before = now
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
