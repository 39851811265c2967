"""Data-quality rules.

The reference raises on the first violation; here every rule is a query that
returns the violations (a listing, or ``rule, violations`` counts), so a job can
report all of them at once and decide what to do.  ``assert_clean`` turns a rule
table into an exception for callers that want the raising behaviour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PanelSpec
from ..functions.exprs import epoch_hours, hours, is_finite


def rule_table(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One aggregate pass; one output row per rule with its violation count."""
    one = df.agg(*[F.sum(F.coalesce(c.cast("long"), F.lit(0))).alias(f"r{i}") for i, c in enumerate(rules.values())])
    rows = [F.struct(F.lit(name).alias("rule"), F.coalesce(F.col(f"r{i}"), F.lit(0)).cast("long").alias("violations"))
            for i, name in enumerate(rules)]
    return one.select(F.inline(F.array(*rows)))


def assert_clean(rules: DataFrame) -> None:
    bad = rules.filter(F.col("violations") > 0).collect()
    if bad:
        raise ValueError("data-quality violations: " + ", ".join(f"{r['rule']}={r['violations']}" for r in bad))


def schema_table(spark: SparkSession, checks: list[tuple[str, str, str]]) -> DataFrame:
    """Schema-level checks (computed from ``df.schema`` on the driver)."""
    rows = [(name, exp, act, exp == act) for name, exp, act in checks]
    return spark.createDataFrame(rows, "check string, expected string, actual string, ok boolean")


# ---------------------------------------------------------------- V1, V8, V14, V15


def schema_contract(df: DataFrame, expected_columns: list[str], expected_rows: int | None = None) -> DataFrame:
    """V1: exact column list (and row count when given)."""
    actual_rows = df.count()
    checks = [("columns", ",".join(expected_columns), ",".join(df.columns))]
    checks.append(("rows", str(expected_rows if expected_rows is not None else actual_rows), str(actual_rows)))
    return schema_table(df.sparkSession, checks)


def wide_column_contract(df: DataFrame, columns: list[str], window: int, exact: bool = True) -> DataFrame:
    """V8: every ``<col>_lag_<k>`` for k = window..1 exists; with ``exact`` no other lag column."""
    have = set(df.columns)
    checks = []
    for k in range(window, 0, -1):
        want = {f"{c}_lag_{k}" for c in columns}
        got = {c for c in have if c.endswith(f"_lag_{k}")} if exact else want & have
        checks.append((f"lag_{k}", ",".join(sorted(want)), ",".join(sorted(got))))
    return schema_table(df.sparkSession, checks)


def leakage_guard(feature_cols: list[str], spec: PanelSpec) -> None:
    """The observed-target column must never be a model feature."""
    if spec.observed_target in feature_cols:
        raise ValueError(f"{spec.observed_target} must not be used as a feature")


def feature_order_contract(spark: SparkSession, train_names: list[str], score_names: list[str]) -> DataFrame:
    """Names and order equal between training and scoring."""
    return schema_table(spark, [("feature_names", ",".join(train_names), ",".join(score_names))])


# ---------------------------------------------------------------- V2, V3, V4, V5


def bad_timestamps(raw: DataFrame) -> DataFrame:
    """V2: rows whose year/month/day/hour do not form a valid time."""
    t = F.try_make_timestamp_ntz(F.col("year"), F.col("month"), F.col("day"), F.col("hour"), F.lit(0), F.lit(0))
    return raw.filter(t.isNull())


def duplicate_keys(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """V3: keys present more than once, with their count."""
    return df.groupBy(spec.station, spec.time).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def duplicate_rows(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """V3 (listing): every copy of a duplicated key (``keep=False``).

    A left-semi join against the duplicated keys (an aggregate with map-side
    partials) rather than a count window: a key copied millions of times would put
    all copies into one window task, while a skewed join partition is split by AQE.
    """
    keys = duplicate_keys(df, spec).select(spec.station, spec.time)
    return df.join(keys, [spec.station, spec.time], "left_semi")


def previous_time(df: DataFrame, spec: PanelSpec, name: str = "previous_datetime") -> DataFrame:
    """Timestamp of the previous row of the same series (chunked, with a carry: no
    task holds a whole series even when gaps are longer than a chunk)."""
    from .preprocess import forward_fill

    x = df.select(spec.station, spec.time)
    return forward_fill(x, spec, [spec.time], exclude_current=True, suffix="_prev") \
        .withColumnRenamed(f"{spec.time}_prev", name)


def continuity(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """V4: per series actual rows, expected hourly rows, missing timestamps, non-hourly steps."""
    x = previous_time(df, spec, "_prev")
    step = F.col(spec.time) - F.col("_prev")
    g = x.groupBy(spec.station).agg(
        F.count(F.lit(1)).alias("actual_rows"), F.min(spec.time).alias("start_datetime"),
        F.max(spec.time).alias("end_datetime"), F.count_distinct(spec.time).alias("_distinct"),
        F.sum((F.col("_prev").isNotNull() & (step != hours(1))).cast("long")).alias("non_hourly_intervals"))
    span = (F.unix_micros(F.col("end_datetime").cast("timestamp")) -
            F.unix_micros(F.col("start_datetime").cast("timestamp"))) / F.lit(3_600_000_000)
    g = g.withColumn("expected_rows", (span + 1).cast("long"))
    return g.select(spec.station, "actual_rows", "expected_rows",
                    (F.col("expected_rows") - F.col("_distinct")).alias("missing_timestamps"),
                    "non_hourly_intervals", "start_datetime", "end_datetime")


def non_hourly(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """V5: rows whose predecessor in the same series is not exactly one hour earlier."""
    x = previous_time(df, spec)
    gap = (F.unix_micros(F.col(spec.time).cast("timestamp")) -
           F.unix_micros(F.col("previous_datetime").cast("timestamp"))) / F.lit(3_600_000_000)
    return x.filter(F.col("previous_datetime").isNotNull() & (F.col(spec.time) - F.col("previous_datetime") != hours(1))) \
        .withColumn("gap_hours", gap)


# ---------------------------------------------------------------- V6, V11, V12, V13, V19


def feature_nulls(df: DataFrame, feature_cols: list[str]) -> DataFrame:
    """V6: NULL count per feature column after processing (all must be 0)."""
    return rule_table(df, {c: F.col(c).isNull() for c in feature_cols})


def non_finite(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULL, NaN or infinite values per column, plus an empty-input rule."""
    rules = {c: ~is_finite(c) for c in cols}
    out = rule_table(df, rules)
    empty = df.agg((F.count(F.lit(1)) == 0).cast("long").alias("violations")).select(
        F.lit("empty_input").alias("rule"), "violations")
    return out.unionByName(empty)


def window_index_checks(index: DataFrame, window: int) -> DataFrame:
    """Window length, window end before target, finite target, one row per target."""
    dup = index.groupBy("station", "target_datetime").agg(F.count(F.lit(1)).alias("c")) \
        .agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("long").alias("violations")) \
        .select(F.lit("duplicate_target").alias("rule"), "violations")
    rules = rule_table(index, {
        "window_length": F.col("window_start_datetime") != F.col("target_datetime") - hours(window),
        "window_end": F.col("window_end_datetime") != F.col("target_datetime") - hours(1),
        "target_not_finite": ~is_finite("target"),
    })
    return rules.unionByName(dup)


def target_preserved(raw: DataFrame, processed: DataFrame, spec: PanelSpec) -> DataFrame:
    """NULL-target count before and after processing."""
    before = raw.agg(F.sum(F.col(spec.target).isNull().cast("long")).alias("v")).select(
        F.lit("missing_targets_before").alias("rule"), F.col("v").alias("violations"))
    after = processed.agg(F.sum(F.col(spec.observed_target).isNull().cast("long")).alias("v")).select(
        F.lit("missing_targets_after").alias("rule"), F.col("v").alias("violations"))
    return before.unionByName(after)


def panel_rules(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """P14 / V3 / V5 as one table and one job: rows without a station or a time, repeated rows of a key, and hours
    that a series lacks between its first and its last (``non_hourly``)."""
    series = _hour_blocks(df, spec).groupBy(spec.station).agg(
        F.sum(F.when(F.col(spec.station).isNull(), F.col("_n"))).alias("null_station"),
        F.sum(F.when(F.col("_timeless"), F.col("_n"))).alias("null_time"),
        F.sum(F.when(F.col("_block").isNotNull(), F.col("_n") - F.col("_seen"))).alias("duplicate_key"),
        (F.max("_high") - F.min("_low") + 1 - F.sum("_seen")).alias("non_hourly"))
    names = ("null_station", "null_time", "duplicate_key", "non_hourly")
    one = series.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in names])))


def _hour_blocks(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows, different times and first and last hour per 64 hours of a series.

    The hours seen are bits of one number (one per minute and second, for times off the hour), so a task holds and
    shuffles a 64th of its rows.
    """
    t = F.col(spec.time)
    known = F.col(spec.station).isNotNull() & t.isNotNull()
    hour = F.when(known, epoch_hours(t))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(hour, F.lit(64)).cast("int"))
    rows = df.select(spec.station, t.isNull().alias("_timeless"), F.shiftright(hour, 6).alias("_block"), F.minute(t).alias("_minute"),
                     F.date_part(F.lit("SECOND"), t).alias("_second"), hour.alias("_hour"), bit.alias("_bit"))
    return rows.groupBy(spec.station, "_timeless", "_block", "_minute", "_second").agg(
        F.count(F.lit(1)).alias("_n"), F.bit_count(F.bit_or("_bit")).cast("long").alias("_seen"),
        F.min("_hour").alias("_low"), F.max("_hour").alias("_high"))


def assert_panel(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """The panel itself, or an error that names the broken rules: windows need whole hourly series."""
    assert_clean(panel_rules(df, spec))
    return df


def assert_features(df: DataFrame, feature_cols: list[str], spec: PanelSpec) -> DataFrame:
    """The model frame itself, or an error: no NULL features, no observed target among them."""
    leakage_guard(feature_cols, spec)
    assert_clean(feature_nulls(df, feature_cols))
    return df


def assert_wide(wide: DataFrame, spec: PanelSpec, known: DataFrame, window: int | None = None) -> DataFrame:
    """Independent windows themselves, or an error: all lag columns, unique ids with stations seen at fit time,
    hourly steps."""
    from . import wide as WD

    w = window or spec.window
    missing = [WD.lag_name(c, k) for c in WD.wide_columns(spec) for k in range(w, 0, -1) if WD.lag_name(c, k) not in wide.columns]
    if missing:
        raise ValueError(f"wide windows are missing columns: {missing[:5]}")
    rules = window_ids(wide)
    for name, rows in (("non_hourly", WD.window_steps(wide, spec, w)), ("unknown_station", unknown_stations(wide, known))):
        rules = rules.unionByName(rows.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("rule"), "violations"))
    assert_clean(rules)
    return wide


# ---------------------------------------------------------------- V7, V9, V10, V16-V18


def window_ids(wide: DataFrame, id_col: str = "id", station: str = "station") -> DataFrame:
    """V7: NULL ids, NULL stations, duplicated ids, empty input."""
    rules = rule_table(wide, {"null_id": F.col(id_col).isNull(), "null_station": F.col(station).isNull()})
    dup = wide.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("c")) \
        .agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("long").alias("violations")) \
        .select(F.lit("duplicate_id").alias("rule"), "violations")
    empty = wide.agg((F.count(F.lit(1)) == 0).cast("long").alias("violations")).select(
        F.lit("empty_input").alias("rule"), "violations")
    return rules.unionByName(dup).unionByName(empty)


def window_station(long: DataFrame, id_col: str = "id", station: str = "station") -> DataFrame:
    """V9: windows whose rows carry more than one station."""
    return long.groupBy(id_col).agg(F.count_distinct(station).alias("stations")).filter(F.col("stations") != 1)


def unknown_stations(df: DataFrame, known: DataFrame, station: str = "station") -> DataFrame:
    """Stations at scoring time not seen at fit time (anti-join to the category table)."""
    return df.select(station).distinct().join(known.select(station), station, "left_anti")


def id_alignment(template: DataFrame, submission: DataFrame) -> DataFrame:
    """Same ids in the same order (full outer join on position)."""
    t = template.select("position", F.col("id").alias("_t"))
    s = submission.select("position", F.col("id").alias("_s"))
    j = t.join(s, "position", "full_outer")
    return rule_table(j, {
        "missing_in_submission": F.col("_s").isNull(),
        "extra_in_submission": F.col("_t").isNull(),
        "id_mismatch": F.col("_t").isNotNull() & F.col("_s").isNotNull() & (F.col("_t") != F.col("_s")),
    })


def submission_checks(submission: DataFrame, template: DataFrame, value: str = "prediction") -> DataFrame:
    """V17 rules: columns, row count, unique ids, all template ids present, finite, non-negative."""
    spark = submission.sparkSession
    cols_bad = int(not {"id", value} <= set(submission.columns))
    base = rule_table(submission, {
        "non_finite": ~is_finite(value),
        "negative": F.col(value) < 0,
    })
    n_sub = submission.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("d"))
    dup = n_sub.select(F.lit("duplicate_id").alias("rule"), (F.col("n") - F.col("d")).cast("long").alias("violations"))
    missing = template.select("id").join(submission.select("id"), "id", "left_anti") \
        .agg(F.count(F.lit(1)).alias("violations")).select(F.lit("missing_id").alias("rule"), "violations")
    extra = submission.select("id").join(template.select("id"), "id", "left_anti") \
        .agg(F.count(F.lit(1)).alias("violations")).select(F.lit("extra_id").alias("rule"), "violations")
    columns = spark.range(1).select(F.lit("columns").alias("rule"), F.lit(cols_bad).cast("long").alias("violations"))
    return columns.unionByName(base).unionByName(dup).unionByName(missing).unionByName(extra)


def submission_summary(submission: DataFrame, value: str = "prediction", population_std: bool = True) -> DataFrame:
    """V17 summary: rows, min, max, mean and std (population by default)."""
    v = F.col(value)
    std = F.stddev_pop(v) if population_std else F.stddev_samp(v)
    return submission.agg(F.count(F.lit(1)).alias("rows"), F.min(v).alias("min"), F.max(v).alias("max"),
                          F.avg(v).alias("mean"), std.alias("std"))


def table_fingerprint(df: DataFrame, cols: list[str], scale: int = 6) -> DataFrame:
    """Order-insensitive checksum: row count, XOR and sum of a 60-bit md5 prefix per row.

    Equal rows cancel in the XOR but not in the sum.  Doubles enter as integers of ``round(x * 10^scale)``
    (three digits more first, see ``rounded``) so the text is engine-neutral.
    """
    parts = []
    for c in cols:
        dt = dict(df.dtypes)[c]
        if dt in ("double", "float"):
            parts.append(F.round(F.round(F.col(c) * F.lit(float(10 ** (scale + 3)))) / 1000).cast("long").cast("string"))
        else:
            parts.append(F.col(c).cast("string"))
    h = F.conv(F.substring(F.md5(F.concat_ws("|", *[F.coalesce(p, F.lit("NULL")) for p in parts])), 1, 15), 16, 10)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(h.cast("long")).alias("fingerprint"),
                  F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").cast("string").alias("total"))
