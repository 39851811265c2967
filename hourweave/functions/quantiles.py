"""Exact quantiles that never put a whole group into one task.

Spark's ``percentile`` / ``median`` aggregates are exact but merge a map of every
distinct value of a group in one task; one group holding a third of 100 TB does not
fit.  ``exact_quantiles`` counts and sorts the distinct values instead, distributed:

1. count rows per (group, value) with map-side partials -- ties collapse, so one value
   that most rows share is one row;
2. range-partition by (group, value), sort, and write that weighted table once with the
   partition as a column (bounds are sampled per plan, so everything else is derived
   from the written rows); a hot group spans many partitions;
3. rows per (partition, group), a table of at most ``partitions + groups`` rows, and a
   running sum inside each partition give the ranks a value covers;
4. keep the values at ranks floor(h) and ceil(h) with h = (n - 1) * p and interpolate
   linearly (the definition used by pandas, numpy, Spark ``percentile`` and DuckDB
   ``quantile_cont``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, value: str | Column, probs: list[float] | tuple[float, ...],
                    groups: list[str] | tuple[str, ...] = (), partitions: int | None = None,
                    few_groups: bool = False) -> DataFrame:
    """One row per group: ``groups..., q_0, q_1, ...`` (exact, linear interpolation).

    NULL and NaN values are ignored; a group without values gets no row.  ``few_groups``
    declares the number of groups bounded (columns, hours, months, splits): the block
    table (at most partitions + groups rows) is then broadcast and the sorted values
    are not shuffled again.  Otherwise the block table is joined by key.
    """
    from ..session import materialize

    groups = list(groups)
    v = F.col(value) if isinstance(value, str) else value
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = df.select(*groups, v.cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    order = [*groups, "_v"]
    x = x.groupBy(*order).agg(F.count(F.lit(1)).alias("_c"))
    x = materialize(x.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
                    .withColumn("_pid", F.spark_partition_id()), "quantile_values")
    blocks = x.groupBy("_pid", *groups).agg(F.sum("_c").alias("_b"))
    wg = Window.partitionBy(*groups) if groups else Window.partitionBy()
    blocks = blocks.select(
        "_pid", *groups,
        F.coalesce(F.sum("_b").over(wg.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_b").over(wg).alias("_n"))
    # the block table has at most partitions + groups rows: broadcasting it is bounded
    # by the partition count, not by the data
    bounded = few_groups or not groups
    inside = Window.partitionBy("_pid", *groups).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    local = x.withColumn("_l", F.coalesce(F.sum("_c").over(inside), F.lit(0)))
    ranked = local.join(F.broadcast(blocks) if bounded else blocks, ["_pid", *groups])
    ranked = ranked.select(*groups, "_v", "_n", "_c", (F.col("_off") + F.col("_l")).alias("_r"))
    hs = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]

    def covers(rank: Column) -> Column:
        return (F.col("_r") <= rank) & (rank < F.col("_r") + F.col("_c"))

    want = F.lit(False)
    for h in hs:
        want = want | covers(F.floor(h)) | covers(F.ceil(h))
    picked = ranked.filter(want)
    aggs = []
    for i, h in enumerate(hs):
        lo = F.max(F.when(covers(F.floor(h)), F.col("_v")))
        hi = F.max(F.when(covers(F.ceil(h)), F.col("_v")))
        frac = F.first(h - F.floor(h))
        aggs.append((lo + (hi - lo) * frac).alias(f"q_{i}"))  # lo + (hi - lo) * d, as quantile_cont
    if groups:
        return picked.groupBy(*groups).agg(*aggs)
    return picked.agg(*aggs)


def exact_median(df: DataFrame, value: str | Column, groups: list[str] | tuple[str, ...] = ()) -> DataFrame:
    return exact_quantiles(df, value, [0.5], groups).withColumnRenamed("q_0", "median")


def quantile_columns(df: DataFrame, columns: list[str], probs, names: list[str] | None = None) -> DataFrame:
    """Exact quantiles of several columns in one sort: rows ``column, <names>...``."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_x")) for c in columns])))
    q = exact_quantiles(long, "_x", probs, ["column"], few_groups=True)
    names = names or [f"q_{i}" for i in range(len(probs))]
    return q.select("column", *[F.col(f"q_{i}").alias(n) for i, n in enumerate(names)])
