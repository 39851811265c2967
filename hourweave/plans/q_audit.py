"""Registered audit (A1-A21) and data-quality (V1-V6, V11-V13) queries on Panel A."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import EVENTS_SPEC
from ..functions.exprs import epoch_hours, rounded
from ..operators import audit as A
from ..operators import quality as Q
from ..operators import preprocess as P
from ..operators import windows as W
from ..sources.events_panel import events_panel
from . import oracle as O
from .context import context
from .registry import register

S = EVENTS_SPEC
NUM = list(S.numeric)
RAW_COLS = ["year", "month", "day", "hour", "station"] + NUM + ["wd"]
RAW_TYPES = {"year": "int", "month": "int", "day": "int", "hour": "int", "station": "string", "wd": "string",
             **{c: "double" for c in NUM}}


def prep(spark, sf):
    return P.prepare(context(spark, sf).raw(), S)


def sparse(spark, sf):
    """Hourly panel *before* densification: real gaps for the continuity checks."""
    return P.add_datetime(events_panel(spark, sf, "A", S, densify=False, sparse=context(spark, sf).sparse()), S)


def W_(select, **kw):
    return O.wrap(select, **kw)


# ---------------------------------------------------------------- A1-A5


@register("audit_extent", W_(
    "SELECT min(datetime) AS start_datetime, max(datetime) AS end_datetime, count(DISTINCT station) AS stations, "
    "count(*) AS rows, 11 AS columns FROM prep", ints=["stations", "rows", "columns"]))
def q_audit_extent(spark, sf):
    return rounded(A.extent(prep(spark, sf), S))


def _profile_sql():
    parts = []
    for c in RAW_COLS:
        parts.append(f"SELECT '{c}' AS \"column\", '{RAW_TYPES[c]}' AS dtype, count({c}) AS non_null, "
                     f"count(*) - count({c}) AS missing, count(DISTINCT {c}) AS \"distinct\", "
                     f"(count(*) - count({c})) * 100.0 / count(*) AS missing_pct FROM raw")
    return " UNION ALL ".join(parts)


@register("audit_column_profile", W_(_profile_sql(), floats=["missing_pct"], ints=["non_null", "missing", "distinct"]))
def q_audit_column_profile(spark, sf):
    return rounded(A.column_profile(context(spark, sf).raw().select(*RAW_COLS)))


@register("audit_missing", W_(
    f"SELECT \"column\", missing, missing_pct FROM ({_profile_sql()}) p WHERE missing > 0",
    floats=["missing_pct"], ints=["missing"]))
def q_audit_missing(spark, sf):
    return rounded(A.missing_summary(context(spark, sf).raw().select(*RAW_COLS)))


@register("audit_missing_by_station", W_(
    "SELECT station, " + ", ".join(f"avg(CAST({c} IS NULL AS DOUBLE)) * 100 AS {c}" for c in NUM + ["wd"])
    + " FROM prep GROUP BY station", floats=NUM + ["wd"]))
def q_audit_missing_by_station(spark, sf):
    return rounded(A.missing_by_station(prep(spark, sf), S))


_ANYN = "greatest(" + ", ".join(f"CAST({c} IS NULL AS INTEGER)" for c in NUM + ["wd"]) + ")"


@register("audit_rows_any_missing", W_(
    f"SELECT sum({_ANYN}) AS rows_with_missing, count(*) AS rows, sum({_ANYN}) * 100.0 / count(*) AS pct FROM prep",
    floats=["pct"], ints=["rows_with_missing", "rows"]))
def q_audit_rows_any_missing(spark, sf):
    return rounded(A.rows_any_missing(prep(spark, sf), S))


# ---------------------------------------------------------------- A6-A16


def _pcts(col, ps):
    return ", ".join(f"quantile_cont({col}, {p}) AS {A.pct_name(p)}" for p in ps)


@register("audit_target_describe", W_(
    f"SELECT count(y) AS count, avg(y) AS mean, stddev_samp(y) AS std, min(y) AS min, "
    f"{_pcts('y', A.TARGET_PERCENTILES)}, max(y) AS max FROM prep WHERE y IS NOT NULL",
    floats=["mean", "std", "min", "max"] + [A.pct_name(p) for p in A.TARGET_PERCENTILES], ints=["count"]))
def q_audit_target_describe(spark, sf):
    return rounded(A.target_describe(prep(spark, sf), S))


def _hist_sql(bins, p=None):
    src = "SELECT y AS v FROM prep WHERE y IS NOT NULL"
    if p is not None:
        src = f"SELECT v FROM ({src}) s WHERE v <= (SELECT quantile_cont(v, {p}) FROM ({src}) s2)"
    return (f"SELECT bin, lo + (bin - 1) * ((hi - lo) / {bins}.0) AS lower, lo + bin * ((hi - lo) / {bins}.0) AS upper, "
            f"count(*) AS count FROM (SELECT least(floor((v - lo) / (hi - lo) * {bins}) + 1, {bins}) AS bin, lo, hi "
            f"FROM ({src}) x, (SELECT min(v) AS lo, max(v) AS hi FROM ({src}) y) b) z GROUP BY bin, lo, hi")


@register("audit_histogram", W_(_hist_sql(100), floats=["lower", "upper"], ints=["bin", "count"]))
def q_audit_histogram(spark, sf):
    return rounded(A.histogram(prep(spark, sf), S.target, 100))


@register("audit_histogram_p99", W_(_hist_sql(80, 0.99), floats=["lower", "upper"], ints=["bin", "count"]))
def q_audit_histogram_p99(spark, sf):
    return rounded(A.histogram(prep(spark, sf), S.target, 80, upper_quantile=0.99))


@register("audit_target_by_station", W_(
    "SELECT station, count(y) AS count, avg(y) AS mean, median(y) AS median, stddev_samp(y) AS std, min(y) AS min, "
    "max(y) AS max FROM prep GROUP BY station", floats=["mean", "median", "std", "min", "max"], ints=["count"]))
def q_audit_target_by_station(spark, sf):
    return rounded(A.target_by_station(prep(spark, sf), S))


@register("profile_hour", W_("SELECT hour(datetime) AS hour, avg(y) AS mean, median(y) AS median FROM prep GROUP BY 1",
                             floats=["mean", "median"], ints=["hour"]))
def q_profile_hour(spark, sf):
    return rounded(A.profile_hour(prep(spark, sf), S))


@register("profile_month_series", W_(
    "SELECT date_trunc('month', datetime) AS month_start, avg(y) AS mean, median(y) AS median FROM prep GROUP BY 1",
    floats=["mean", "median"]))
def q_profile_month_series(spark, sf):
    return rounded(A.profile_month_series(prep(spark, sf), S))


@register("profile_month_of_year", W_(
    "SELECT month(datetime) AS month, avg(y) AS mean, median(y) AS median FROM prep GROUP BY 1",
    floats=["mean", "median"], ints=["month"]))
def q_profile_month_of_year(spark, sf):
    return rounded(A.profile_month_of_year(prep(spark, sf), S))


@register("series_slice", W_(
    f"SELECT datetime, station, {O._list(NUM)}, wd, split FROM prep WHERE station = 'click' "
    "AND datetime >= TIMESTAMP '2024-01-08 00:00:00' AND datetime < TIMESTAMP '2024-01-15 00:00:00'", floats=NUM))
def q_series_slice(spark, sf):
    return rounded(A.series_slice(prep(spark, sf), S, "click", "2024-01-08 00:00:00", "2024-01-15 00:00:00"))


def _describe_sql():
    parts = []
    for c in NUM:
        parts.append(f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
                     f"min({c}) AS min, {_pcts(c, A.NUMERIC_PERCENTILES)}, max({c}) AS max FROM prep")
    return " UNION ALL ".join(parts)


@register("audit_numeric_describe", W_(_describe_sql(), floats=["mean", "std", "min", "max"]
                                       + [A.pct_name(p) for p in A.NUMERIC_PERCENTILES], ints=["count"]))
def q_audit_numeric_describe(spark, sf):
    return rounded(A.numeric_describe(prep(spark, sf), S))


def _corr_sql():
    parts = [f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS corr FROM prep" for a in NUM for b in NUM]
    return " UNION ALL ".join(parts)


@register("audit_correlation", W_(_corr_sql(), floats=["corr"]))
def q_audit_correlation(spark, sf):
    return rounded(A.correlation(prep(spark, sf), S))


@register("audit_category_counts", W_(
    "SELECT wd, count(*) AS count, count(*) * 100.0 / sum(count(*)) OVER () AS pct FROM prep GROUP BY wd",
    floats=["pct"], ints=["count"]))
def q_audit_category_counts(spark, sf):
    return rounded(A.category_counts(prep(spark, sf), "wd"))


@register("split_summary", W_(
    f"SELECT split, count(*) AS rows, min(datetime) AS start_datetime, max(datetime) AS end_datetime, "
    f"count(DISTINCT station) AS stations, count(y) AS valid_targets, sum({_ANYN}) AS rows_with_missing_features, "
    f"count(*) - count(y) AS missing_targets, CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END "
    f"AS split_order FROM prep GROUP BY split",
    ints=["rows", "stations", "valid_targets", "rows_with_missing_features", "missing_targets", "split_order"]))
def q_split_summary(spark, sf):
    return rounded(A.split_summary(prep(spark, sf), S))


@register("profile_daily", W_(
    "SELECT d.day, m.mean FROM (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day "
    "FROM (SELECT date_trunc('day', datetime) AS day FROM prep) x) d LEFT JOIN "
    "(SELECT date_trunc('day', datetime) AS day, avg(y) AS mean FROM prep GROUP BY 1) m ON d.day = m.day",
    floats=["mean"]))
def q_profile_daily(spark, sf):
    return rounded(A.daily_mean(prep(spark, sf), S))


# ---------------------------------------------------------------- A19-A21


@register("sequence_summary", W_(
    "SELECT split, count(*) AS sequences, count(DISTINCT station) AS stations, min(target_datetime) AS first_target, "
    "max(target_datetime) AS last_target, avg(target) AS target_mean, median(target) AS target_median, "
    "stddev_samp(target) AS target_std, CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END "
    "AS split_order FROM seq GROUP BY split",
    floats=["target_mean", "target_median", "target_std"], ints=["sequences", "stations", "split_order"]))
def q_sequence_summary(spark, sf):
    return rounded(A.sequence_summary(W.sequence_index(context(spark, sf).processed(), S)))


@register("sequence_station_summary", W_(
    "SELECT split, station, count(*) AS sequences, min(target_datetime) AS first_target, "
    "max(target_datetime) AS last_target, avg(target) AS target_mean FROM seq GROUP BY split, station",
    floats=["target_mean"], ints=["sequences"]))
def q_sequence_station_summary(spark, sf):
    return rounded(A.sequence_station_summary(W.sequence_index(context(spark, sf).processed(), S)))


@register("audit_metadata", W_(
    "SELECT 'events_panel_a' AS dataset, 'y' AS target, count(*) AS rows, count(DISTINCT station) AS stations, "
    "min(datetime) AS start_datetime, max(datetime) AS end_datetime, count(y) AS valid_values, "
    "count(*) - count(y) AS missing_values, avg(y) AS target_mean, median(y) AS target_median, min(y) AS target_min, "
    "max(y) AS target_max, (SELECT sum(n - d) FROM (SELECT count(*) AS n, count(DISTINCT datetime) AS d FROM prep "
    "GROUP BY station) t) AS duplicate_keys, (SELECT sum(e - d) FROM (SELECT count(DISTINCT datetime) AS d, "
    "CAST(date_diff('hour', min(datetime), max(datetime)) + 1 AS BIGINT) AS e FROM prep GROUP BY station) t2) "
    f"AS timeline_gaps, '{S.validation_start}' AS validation_start, '{S.test_start}' AS local_test_start FROM prep",
    floats=["target_mean", "target_median", "target_min", "target_max"],
    ints=["rows", "stations", "valid_values", "missing_values", "duplicate_keys", "timeline_gaps"]))
def q_audit_metadata(spark, sf):
    return rounded(A.audit_metadata(prep(spark, sf), S, "events_panel_a"))


# ---------------------------------------------------------------- quality on the panel


def faulty(spark, sf):
    """The raw panel with planted faults: rows of 7 o'clock twice, and 5 o'clock of every tenth day on 30 February."""
    x = context(spark, sf).raw().withColumn("_copy", F.explode(F.when(F.col("hour") == 7, F.array(F.lit(0), F.lit(1)))
                                                             .otherwise(F.array(F.lit(0))))).drop("_copy")
    bad = (F.col("hour") == 5) & (F.col("day") % 10 == 0)
    return x.withColumns({"month": F.when(bad, 2).otherwise(F.col("month")), "day": F.when(bad, 30).otherwise(F.col("day"))})


FAULTY = (f"(SELECT station, datetime, year, CASE WHEN hour = 5 AND day % 10 = 0 THEN 2 ELSE month END AS month, "
          f"CASE WHEN hour = 5 AND day % 10 = 0 THEN 30 ELSE day END AS day, hour, {O._list(NUM)}, wd "
          "FROM raw, range(0, 2) AS g(i) WHERE i = 0 OR hour = 7)")


@register("dq_schema_contract", W_(
    f"SELECT * FROM (VALUES ('columns', '{','.join(RAW_COLS)}', '{','.join(RAW_COLS)}', 1)) v(\"check\", expected, "
    "actual, ok) UNION ALL SELECT 'rows', CAST(any_value(e.n) AS VARCHAR), CAST(count(*) AS VARCHAR), "
    "CAST(count(*) = any_value(e.n) AS BIGINT) FROM raw, (SELECT sum(n) AS n FROM (SELECT date_diff('hour', "
    "date_trunc('hour', min(ts)), date_trunc('hour', max(ts))) + 1 AS n FROM events GROUP BY event_type) t) e", ints=["ok"]))
def q_dq_schema_contract(spark, sf):
    """The expected rows come from the events: the hours of each series from its first to its last."""
    hours = epoch_hours("datetime")
    ends = sparse(spark, sf).groupBy("station").agg((F.max(hours) - F.min(hours) + 1).alias("n"))
    expected = ends.agg(F.sum("n")).first()[0]
    return rounded(Q.schema_contract(context(spark, sf).raw().select(*RAW_COLS), RAW_COLS, expected))


@register("dq_bad_timestamps", W_(
    f"SELECT {O._list(RAW_COLS)} FROM {FAULTY} x WHERE try_strptime(printf('%04d-%02d-%02d %02d', year, month, day, hour), "
    "'%Y-%m-%d %H') IS NULL", floats=NUM, ints=["year", "month", "day", "hour"]))
def q_dq_bad_timestamps(spark, sf):
    return rounded(Q.bad_timestamps(faulty(spark, sf).select(*RAW_COLS)))


@register("dq_duplicate_keys", W_(
    f"SELECT station, datetime, count(*) AS count FROM {FAULTY} x GROUP BY station, datetime HAVING count(*) > 1",
    ints=["count"]))
def q_dq_duplicate_keys(spark, sf):
    return rounded(Q.duplicate_keys(P.prepare(faulty(spark, sf), S), S))


@register("audit_continuity", O.wrap(
    "SELECT station, count(*) AS actual_rows, CAST(date_diff('hour', min(datetime), max(datetime)) + 1 AS BIGINT) "
    "AS expected_rows, CAST(date_diff('hour', min(datetime), max(datetime)) + 1 AS BIGINT) - count(DISTINCT datetime) "
    "AS missing_timestamps, sum(CASE WHEN prev IS NOT NULL AND datetime - prev <> INTERVAL 1 HOUR THEN 1 ELSE 0 END) "
    "AS non_hourly_intervals, min(datetime) AS start_datetime, max(datetime) AS end_datetime FROM "
    "(SELECT station, datetime, lag(datetime) OVER (PARTITION BY station ORDER BY datetime) AS prev FROM agg) t "
    "GROUP BY station", ints=["actual_rows", "expected_rows", "missing_timestamps", "non_hourly_intervals"]))
def q_audit_continuity(spark, sf):
    return rounded(Q.continuity(sparse(spark, sf), S))


@register("dq_non_hourly", O.wrap(
    "SELECT station, datetime, prev AS previous_datetime, date_diff('hour', prev, datetime) * 1.0 AS gap_hours FROM "
    "(SELECT station, datetime, lag(datetime) OVER (PARTITION BY station ORDER BY datetime) AS prev FROM agg) t "
    "WHERE prev IS NOT NULL AND datetime - prev <> INTERVAL 1 HOUR", floats=["gap_hours"]))
def q_dq_non_hourly(spark, sf):
    return rounded(Q.non_hourly(sparse(spark, sf), S))


@register("dq_feature_nulls", W_(
    " UNION ALL ".join(f"SELECT '{c}' AS rule, sum(CAST({c} IS NULL AS BIGINT)) AS violations FROM proc"
                       for c in O.FEATURES), ints=["violations"]))
def q_dq_feature_nulls(spark, sf):
    c = context(spark, sf)
    return rounded(Q.feature_nulls(c.processed(), c.feature_names()))


@register("dq_non_finite", W_(
    "SELECT 'y_true' AS rule, sum(CASE WHEN y_true IS NULL OR isnan(y_true) OR isinf(y_true) THEN 1 ELSE 0 END) "
    "AS violations FROM cpreds UNION ALL SELECT 'y_pred', sum(CASE WHEN y_pred IS NULL OR isnan(y_pred) OR "
    "isinf(y_pred) THEN 1 ELSE 0 END) FROM cpreds UNION ALL SELECT 'empty_input', CAST(count(*) = 0 AS BIGINT) "
    "FROM cpreds", ints=["violations"]))
def q_dq_non_finite(spark, sf):
    from .registry import _preds
    from ..operators import evaluate as E

    return rounded(Q.non_finite(E.prepare_predictions(_preds(spark, sf)), ["y_true", "y_pred"]))


@register("dq_window_index", W_(
    f"SELECT 'window_length' AS rule, sum(CASE WHEN window_start_datetime <> target_datetime - INTERVAL {S.window} HOUR "
    "THEN 1 ELSE 0 END) AS violations FROM seq UNION ALL SELECT 'window_end', sum(CASE WHEN window_end_datetime <> "
    "target_datetime - INTERVAL 1 HOUR THEN 1 ELSE 0 END) FROM seq UNION ALL SELECT 'target_not_finite', "
    "sum(CASE WHEN target IS NULL OR isnan(target) OR isinf(target) THEN 1 ELSE 0 END) FROM seq UNION ALL "
    "SELECT 'duplicate_target', coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM seq GROUP BY station, "
    "target_datetime) t", ints=["violations"]))
def q_dq_window_index(spark, sf):
    return rounded(Q.window_index_checks(W.sequence_index(context(spark, sf).processed(), S), S.window))


@register("dq_target_preserved", W_(
    "SELECT 'missing_targets_before' AS rule, sum(CAST(y IS NULL AS BIGINT)) AS violations FROM raw UNION ALL "
    "SELECT 'missing_targets_after', sum(CAST(target_y IS NULL AS BIGINT)) FROM proc", ints=["violations"]))
def q_dq_target_preserved(spark, sf):
    c = context(spark, sf)
    return rounded(Q.target_preserved(c.raw(), c.processed(), S))


@register("dq_duplicate_rows", W_(
    f"SELECT p.station, p.datetime, {O._list('p.' + c for c in NUM)} FROM {FAULTY} p JOIN (SELECT station, datetime "
    f"FROM {FAULTY} x GROUP BY station, datetime HAVING count(*) > 1) d ON p.station = d.station AND p.datetime = d.datetime",
    floats=NUM))
def q_dq_duplicate_rows(spark, sf):
    return rounded(Q.duplicate_rows(P.prepare(faulty(spark, sf), S), S).select("station", "datetime", *NUM))
