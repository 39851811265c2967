"""Audit aggregations of a panel.

Inputs are prepared panels (``preprocess.prepare``: datetime, station, numerics,
wind code, split).  Each audit is one or two aggregations; wide audits are one
``agg`` turned into rows with ``inline`` (no per-column jobs).  Percentiles and
medians are exact (``percentile`` / ``median``); pass ``approx=True`` where offered
to bound the aggregation buffer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SPLITS, PanelSpec
from ..functions.quantiles import exact_quantiles
from .preprocess import split_order

# "sort": exact, distributed (functions.quantiles); "aggregate": Spark's percentile /
# median aggregates (exact, but one group's distinct values meet in one task).
QUANTILE_METHOD = "sort"


def _attach(agg_df: DataFrame, src: DataFrame, value, probs, groups: list, names: list[str],
            few_groups: bool = True) -> DataFrame:
    """``agg_df`` (one row per group) plus exact quantile columns of ``value``."""
    q = exact_quantiles(src, value, probs, groups, few_groups=few_groups)
    q = q.select(*groups, *[F.col(f"q_{i}").alias(n) for i, n in enumerate(names)])
    if groups:
        return agg_df.join(q, groups, "left")
    # no groups: both sides are one row; the quantiles come back as literals
    row = q.first()
    return agg_df.select("*", *[F.lit(row[n] if row else None).cast("double").alias(n) for n in names])

TARGET_PERCENTILES = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
NUMERIC_PERCENTILES = (0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99)


def pct_name(p: float) -> str:
    return f"p{int(round(p * 100))}"


def _percentiles(c: Column, ps, approx: bool) -> Column:
    if approx:
        return F.percentile_approx(c, list(ps), 10000)
    return F.percentile(c, F.array(*[F.lit(p) for p in ps]))


def extent(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """A1: time range, number of series, rows and columns."""
    return df.agg(
        F.min(spec.time).alias("start_datetime"), F.max(spec.time).alias("end_datetime"),
        F.count_distinct(spec.station).alias("stations"), F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
    )


def _null_counts(df: DataFrame) -> DataFrame:
    """Per column dtype, non-null, missing, missing %: one aggregate, no distincts."""
    fields = df.schema.fields
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{f.name}`")).alias(f"nn{i}") for i, f in enumerate(fields)])
    rows = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                     F.col(f"nn{i}").alias("non_null"), (F.col("_rows") - F.col(f"nn{i}")).alias("missing"),
                     ((F.col("_rows") - F.col(f"nn{i}")) * 100.0 / F.col("_rows")).alias("missing_pct"))
            for i, f in enumerate(fields)]
    return one.select(F.inline(F.array(*rows)))


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """A2: per column dtype, non-null, missing, distinct (NULL excluded), missing %.

    Exact distincts count (column, value) pairs after a map-side partial, so no task sees a whole column.
    """
    fields = df.schema.fields
    if approx:
        one = df.agg(*[F.approx_count_distinct(F.col(f"`{f.name}`")).alias(f"d{i}") for i, f in enumerate(fields)])
        distinct = one.select(F.inline(F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"d{i}").alias("distinct"))
                                                 for i, f in enumerate(fields)])))
    else:
        pairs = df.select(F.inline(F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").cast("string").alias("_x"))
                                             for f in fields]))).filter("_x IS NOT NULL")
        distinct = pairs.groupBy("column", "_x").count().groupBy("column").agg(F.count(F.lit(1)).alias("distinct"))
    return (_null_counts(df).join(distinct, "column", "left")
            .select("column", "dtype", "non_null", "missing", F.coalesce("distinct", F.lit(0)).cast("long").alias("distinct"),
                    "missing_pct"))


def missing_summary(df: DataFrame) -> DataFrame:
    """A3: columns with missing values, most missing first."""
    return _null_counts(df).filter(F.col("missing") > 0).select("column", "missing", "missing_pct") \
        .orderBy(F.desc("missing_pct"), "column")


def missing_by_station(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """A4: % missing per series and numeric column (+ wind code)."""
    cols = list(spec.numeric) + ([spec.wind] if spec.wind else [])
    return df.groupBy(spec.station).agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in cols])


def rows_any_missing(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """A5: rows with at least one missing model column."""
    cols = list(spec.numeric) + ([spec.wind] if spec.wind else [])
    anyn = F.greatest(*[F.col(c).isNull().cast("int") for c in cols])
    return df.agg(F.sum(anyn).cast("long").alias("rows_with_missing"), F.count(F.lit(1)).alias("rows"),
                  (F.sum(anyn) * 100.0 / F.count(F.lit(1))).alias("pct"))


def target_describe(df: DataFrame, spec: PanelSpec, approx: bool = False) -> DataFrame:
    """Count, mean, sample std, min, percentiles, max of the observed target."""
    y = F.col(spec.target)
    names = [pct_name(p) for p in TARGET_PERCENTILES]
    src = df.filter(y.isNotNull())
    if approx or QUANTILE_METHOD == "aggregate":
        one = src.agg(
            F.count(y).alias("count"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"), F.min(y).alias("min"),
            _percentiles(y, TARGET_PERCENTILES, approx).alias("_p"), F.max(y).alias("max"))
        return one.select("count", "mean", "std", "min", *[F.col("_p")[i].alias(n) for i, n in enumerate(names)], "max")
    one = src.agg(F.count(y).alias("count"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"),
                  F.min(y).alias("min"), F.max(y).alias("max"))
    return _attach(one, src, spec.target, TARGET_PERCENTILES, [], names).select(
        "count", "mean", "std", "min", *names, "max")


def histogram(df: DataFrame, col: str, bins: int = 100, upper_quantile: float | None = None) -> DataFrame:
    """Equal-width histogram; the maximum falls in the last bin.

    Bounds are two scalars of one aggregate (a tiny driver round trip), so the binning
    itself is a projection plus a group-by with a map-side partial.  With
    ``upper_quantile`` the values above that (exact) quantile are left out first.
    """
    x = df.select(F.col(col).alias("v")).filter(F.col("v").isNotNull())
    if upper_quantile is not None:
        row = exact_quantiles(x, "v", [upper_quantile]).first()
        q = row[0] if row else None
        x = x.filter(F.col("v") <= F.lit(q))
    lo, hi = x.agg(F.min("v"), F.max("v")).first()
    width = (hi - lo) if hi is not None and hi > lo else 1.0
    b = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width) * F.lit(bins)) + 1, F.lit(bins)).cast("long")
    counts = x.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return counts.select("bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width / bins)).alias("lower"),
                         (F.lit(lo) + F.col("bin") * F.lit(width / bins)).alias("upper"), "count")


def target_by_station(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """A9."""
    y = F.col(spec.target)
    if QUANTILE_METHOD == "aggregate":
        return df.groupBy(spec.station).agg(
            F.count(y).alias("count"), F.avg(y).alias("mean"), F.median(y).alias("median"),
            F.stddev_samp(y).alias("std"), F.min(y).alias("min"), F.max(y).alias("max"))
    g = df.groupBy(spec.station).agg(F.count(y).alias("count"), F.avg(y).alias("mean"),
                                     F.stddev_samp(y).alias("std"), F.min(y).alias("min"), F.max(y).alias("max"))
    # one group per series: unbounded, so the block table is joined by key, not broadcast
    return _attach(g, df, spec.target, [0.5], [spec.station], ["median"], few_groups=False).select(
        spec.station, "count", "mean", "median", "std", "min", "max")


def profile(df: DataFrame, spec: PanelSpec, key: Column, name: str) -> DataFrame:
    y = F.col(spec.target)
    if QUANTILE_METHOD == "aggregate":
        return df.groupBy(key.alias(name)).agg(F.avg(y).alias("mean"), F.median(y).alias("median"))
    x = df.select(key.alias(name), y.alias("_y"))
    return _attach(x.groupBy(name).agg(F.avg("_y").alias("mean")), x, "_y", [0.5], [name], ["median"])


def profile_hour(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """A10."""
    return profile(df, spec, F.hour(spec.time).cast("long"), "hour")


def profile_month_series(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Calendar-month series (month start)."""
    return profile(df, spec, F.date_trunc("month", spec.time).cast("timestamp_ntz"), "month_start")


def profile_month_of_year(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """A12."""
    return profile(df, spec, F.month(spec.time).cast("long"), "month")


def series_slice(df: DataFrame, spec: PanelSpec, station: str, start: str, end: str) -> DataFrame:
    """One series, half-open [start, end); both predicates reach the parquet scan."""
    t = F.col(spec.time)
    return df.filter((F.col(spec.station) == station) & (t >= F.lit(start).cast("timestamp_ntz"))
                     & (t < F.lit(end).cast("timestamp_ntz")))


def numeric_describe(df: DataFrame, spec: PanelSpec, approx: bool = False) -> DataFrame:
    """One row per numeric column (count, mean, std, min, percentiles, max)."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in spec.numeric])))
    v = F.col("v")
    names = [pct_name(p) for p in NUMERIC_PERCENTILES]
    if approx or QUANTILE_METHOD == "aggregate":
        g = long.groupBy("column").agg(
            F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
            _percentiles(v, NUMERIC_PERCENTILES, approx).alias("_p"), F.max(v).alias("max"))
        return g.select("column", "count", "mean", "std", "min",
                        *[F.col("_p")[i].alias(n) for i, n in enumerate(names)], "max")
    g = long.groupBy("column").agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                                   F.min(v).alias("min"), F.max(v).alias("max"))
    return _attach(g, long, "v", NUMERIC_PERCENTILES, ["column"], names).select(
        "column", "count", "mean", "std", "min", *names, "max")


def correlation(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Pairwise-complete Pearson matrix, long (column_a, column_b, corr), mirrored."""
    cols = list(spec.numeric)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    one = df.agg(*[F.corr(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs])
    rows = []
    for i, j in pairs:
        rows.append(F.struct(F.lit(cols[i]).alias("column_a"), F.lit(cols[j]).alias("column_b"),
                             F.col(f"c{i}_{j}").alias("corr")))
        if i != j:
            rows.append(F.struct(F.lit(cols[j]).alias("column_a"), F.lit(cols[i]).alias("column_b"),
                                 F.col(f"c{i}_{j}").alias("corr")))
    return one.select(F.inline(F.array(*rows)))


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """Value counts including the NULL group, % of all rows."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return g.withColumn("pct", F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy()))


def split_summary(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Per split rows, time range, series, valid / missing targets, rows with missing features."""
    cols = list(spec.numeric) + ([spec.wind] if spec.wind else [])
    anyn = F.greatest(*[F.col(c).isNull().cast("int") for c in cols])
    y = F.col(spec.target)
    g = df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.min(spec.time).alias("start_datetime"), F.max(spec.time).alias("end_datetime"),
        F.count_distinct(spec.station).alias("stations"), F.count(y).alias("valid_targets"),
        F.sum(anyn).cast("long").alias("rows_with_missing_features"),
        (F.count(F.lit(1)) - F.count(y)).alias("missing_targets"))
    return g.withColumn("split_order", split_order("split"))


def daily_mean(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Mean over all series per calendar day (midnight timestamps); days without
    rows appear with NULL."""
    day = F.date_trunc("day", spec.time).cast("timestamp_ntz")
    daily = df.groupBy(day.alias("day")).agg(F.avg(spec.target).alias("mean"))
    days = daily.agg(F.min("day").alias("lo"), F.max("day").alias("hi")) \
        .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return days.join(daily, "day", "left")


def sequence_summary(index: DataFrame) -> DataFrame:
    """Per split sequences, series, first/last target time, target mean/median/sample std."""
    t = F.col("target")
    g = index.groupBy("split").agg(
        F.count(F.lit(1)).alias("sequences"), F.count_distinct("station").alias("stations"),
        F.min("target_datetime").alias("first_target"), F.max("target_datetime").alias("last_target"),
        F.avg(t).alias("target_mean"), F.stddev_samp(t).alias("target_std"))
    g = _attach(g, index, "target", [0.5], ["split"], ["target_median"])
    return g.select("split", "sequences", "stations", "first_target", "last_target", "target_mean", "target_median",
                    "target_std").withColumn("split_order", split_order("split"))


def sequence_station_summary(index: DataFrame) -> DataFrame:
    """A20."""
    return index.groupBy("split", "station").agg(
        F.count(F.lit(1)).alias("sequences"), F.min("target_datetime").alias("first_target"),
        F.max("target_datetime").alias("last_target"), F.avg("target").alias("target_mean"))


def audit_metadata(df: DataFrame, spec: PanelSpec, dataset: str) -> DataFrame:
    """One record of dataset, target and split-boundary facts.

    Two aggregates: one over the rows, one over the per-series table (duplicates =
    rows - distinct hours, gaps = expected hours - distinct hours).  Both are single
    rows; the record is assembled from them on the driver, like the metadata file it
    stands for.
    """
    y = F.col(spec.target)
    base = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(spec.station).alias("stations"),
        F.min(spec.time).alias("start_datetime"), F.max(spec.time).alias("end_datetime"),
        F.count(y).alias("valid_values"), (F.count(F.lit(1)) - F.count(y)).alias("missing_values"),
        F.avg(y).alias("target_mean"),
        F.min(y).alias("target_min"), F.max(y).alias("target_max")).first().asDict()
    med = exact_quantiles(df, spec.target, [0.5]).first()
    base["target_median"] = med[0] if med else None
    per = df.groupBy(spec.station).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(spec.time).alias("d"),
        ((F.unix_micros(F.max(spec.time).cast("timestamp")) - F.unix_micros(F.min(spec.time).cast("timestamp")))
         / F.lit(3_600_000_000) + 1).cast("long").alias("e"))
    facts = per.agg(F.coalesce(F.sum(F.col("n") - F.col("d")), F.lit(0)).cast("long").alias("duplicate_keys"),
                    F.coalesce(F.sum(F.col("e") - F.col("d")), F.lit(0)).cast("long").alias("timeline_gaps")).first()
    rec = {"dataset": dataset, "target": spec.target, **base, "duplicate_keys": facts[0], "timeline_gaps": facts[1],
           "validation_start": spec.validation_start, "local_test_start": spec.test_start}
    schema = ("dataset string, target string, rows long, stations long, start_datetime timestamp_ntz, "
              "end_datetime timestamp_ntz, valid_values long, missing_values long, target_mean double, "
              "target_median double, target_min double, target_max double, duplicate_keys long, timeline_gaps long, "
              "validation_start string, local_test_start string")
    return df.sparkSession.createDataFrame([rec], schema)


def splits() -> tuple[str, ...]:
    return SPLITS
