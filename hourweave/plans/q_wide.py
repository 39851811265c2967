"""Registered queries of the independent-window scoring path (W13-W16, F6, F12, V7-V10, V15-V18),
the file sources/sinks (S1, S10, S12) and the streaming scorer."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..config import EVENTS_SPEC
from ..functions.exprs import rounded
from ..operators import ensemble as EN
from ..operators import evaluate as E
from ..operators import forecast as FC
from ..operators import quality as Q
from ..operators import submission as SB
from ..operators import wide as WD
from ..operators import windows as W
from ..session import checkpoint_root, materialize
from ..sources import files as IO
from . import oracle as O
from .context import context
from .registry import _pair, _preds, register

S = EVENTS_SPEC
NUM = list(S.numeric)
WIDE_F = [f"{c}_lag_{k}" for k in range(S.window, 0, -1) for c in NUM]
WIDE_I = [f"{c}_lag_{k}" for k in range(S.window, 0, -1) for c in ("year", "month", "day", "hour")]


def AW(select, **kw):
    return O.wrap(select, ctes=O.all_ctes(), **kw)


def wide(spark, sf):
    """Wide windows of every hour of Panel A that has a whole window before it (written once per session)."""
    c = context(spark, sf)
    return c._memo("wide", lambda: materialize(WD.build_wide_windows(c.raw(), S), "wide"))


def wide_test(spark, sf):
    """Wide windows of the local-test hours, which are scored (written once per session)."""
    c = context(spark, sf)
    return c._memo("wide_test", lambda: materialize(
        WD.build_wide_windows(c.raw(), S, anchor=F.col(S.time) >= F.lit(S.test_start).cast("timestamp_ntz")), "wide_test"))


@register("wide_windows", AW("SELECT * FROM wide", floats=WIDE_F, ints=WIDE_I))
def q_wide_windows(spark, sf):
    return rounded(wide(spark, sf))


@register("wide_to_long", AW(
    f"SELECT id, station, time_step, datetime, {O._list(O.WIDE_COLS)} FROM wlong", floats=NUM,
    ints=["time_step", "year", "month", "day", "hour"]))
def q_wide_to_long(spark, sf):
    return rounded(WD.wide_to_long(wide(spark, sf), S))


_WF = [f for f in O.FEATURES]


@register("wide_windows_features", AW("SELECT * FROM wfeat", floats=_WF, ints=["time_step"]))
def q_wide_windows_features(spark, sf):
    return rounded(WD.wide_features(wide(spark, sf), S, context(spark, sf).params()))


@register("wide_windows_metadata", AW(
    f"SELECT id, station, t - INTERVAL {S.window} HOUR AS window_start_datetime, t - INTERVAL 1 HOUR AS "
    "window_end_datetime, t AS target_datetime FROM anchors"))
def q_wide_windows_metadata(spark, sf):
    return rounded(WD.wide_metadata(wide(spark, sf), S))


_WT_SQL, _WT_NAMES = O.wide_tabular_select()


@register("wide_windows_tabular", AW(_WT_SQL, floats=_WT_NAMES))
def q_wide_windows_tabular(spark, sf):
    return rounded(WD.wide_tabular(wide(spark, sf), S, context(spark, sf).params()))


@register("wide_baselines", AW("SELECT * FROM wbase", floats=["persistence", "window_mean"]))
def q_wide_baselines(spark, sf):
    return rounded(WD.wide_baselines(wide(spark, sf), S, context(spark, sf).params()))


@register("wide_window_steps", AW("SELECT id, lag FROM wide, (VALUES (5), (6)) v(lag) WHERE hour_lag_1 = 3", ints=["lag"]))
def q_wide_window_steps(spark, sf):
    """Windows that end at 3 o'clock get a wrong hour five hours before the target."""
    faulty = wide(spark, sf).withColumn("hour_lag_5", F.when(F.col("hour_lag_1") == 3, (F.col("hour_lag_5") + 2) % 24)
                                        .otherwise(F.col("hour_lag_5")))
    return rounded(WD.window_steps(faulty, S))


@register("dq_window_ids", AW(
    "SELECT 'null_id' AS rule, sum(CAST(id IS NULL AS BIGINT)) AS violations FROM wide UNION ALL "
    "SELECT 'null_station', sum(CAST(station IS NULL AS BIGINT)) FROM wide UNION ALL "
    "SELECT 'duplicate_id', coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM wide GROUP BY id) t UNION ALL "
    "SELECT 'empty_input', CAST(count(*) = 0 AS BIGINT) FROM wide", ints=["violations"]))
def q_dq_window_ids(spark, sf):
    return rounded(Q.window_ids(wide(spark, sf)))


def _contract_sql():
    rows = []
    for k in range(S.window, 0, -1):
        names = ",".join(sorted(f"{c}_lag_{k}" for c in O.WIDE_COLS))
        rows.append(f"('lag_{k}', '{names}', '{names}', 1)")
    counts = " UNION ALL ".join(f"SELECT 'lag_{k}' AS \"check\", {' + '.join(f'count({c}_lag_{k})' for c in O.WIDE_COLS)} AS \"values\" FROM wide"
                               for k in range(S.window, 0, -1))
    return ("SELECT v.*, c.\"values\" FROM (VALUES " + ", ".join(rows) + f") v(\"check\", expected, actual, ok) JOIN ({counts}) c "
            "USING (\"check\")")


@register("dq_wide_contract", AW(_contract_sql(), ints=["ok", "values"]))
def q_dq_wide_contract(spark, sf):
    """The lag columns, and how many values each lag holds."""
    x, cols = wide(spark, sf), WD.wide_columns(S)
    lags = range(S.window, 0, -1)
    sums = x.agg(*[sum((F.count(f"{c}_lag_{k}") for c in cols[1:]), F.count(f"{cols[0]}_lag_{k}")).alias(f"v{k}") for k in lags])
    values = sums.select(F.inline(F.array(*[F.struct(F.lit(f"lag_{k}").alias("check"), F.col(f"v{k}").alias("values")) for k in lags])))
    return rounded(Q.wide_column_contract(x, cols, S.window).join(values, "check"))


@register("dq_window_station", AW("SELECT regexp_extract(id, '[0-9]+$') AS id, count(DISTINCT station) AS stations FROM wlong "
                                  "GROUP BY 1 HAVING count(DISTINCT station) <> 1", ints=["stations"]))
def q_dq_window_station(spark, sf):
    """Windows named by their hour alone mix stations."""
    long = WD.wide_to_long(wide(spark, sf), S).withColumn("id", F.regexp_extract("id", "[0-9]+$", 0))
    return rounded(Q.window_station(long))


@register("dq_unknown_station", AW("SELECT DISTINCT station FROM wide WHERE station NOT IN (SELECT station FROM prep "
                                   "WHERE split = 'train' AND station < (SELECT max(station) FROM prep))"))
def q_dq_unknown_station(spark, sf):
    """The last station is taken out of the categories of the fit."""
    known = context(spark, sf).params().station_table(spark)
    last = known.agg(F.max("station")).first()[0]
    return rounded(Q.unknown_stations(wide(spark, sf), known.filter(F.col("station") < F.lit(last))))


@register("feature_names", AW(" UNION ALL ".join(
    f"SELECT '{f}' AS feature, {i} AS position, (SELECT count({f}) FROM proc) AS panel_values, "
    f"(SELECT count({f}) FROM wfeat) AS window_values" for i, f in enumerate(O.FEATURES)),
    ints=["position", "panel_values", "window_values"]))
def q_feature_names(spark, sf):
    """V15 with data: each feature's position, the same for training and scoring, and its values on either side."""
    c = context(spark, sf)
    scored = WD.wide_features(wide(spark, sf), S, c.params())
    names = c.feature_names()
    Q.assert_clean(Q.feature_order_contract(spark, names, [n for n in scored.columns if n not in ("id", "station", "time_step")])
                   .select(F.col("check").alias("rule"), (~F.col("ok")).cast("long").alias("violations")))

    def counts(df, name):
        one = df.agg(*[F.count(n).alias(n) for n in names])
        return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(i).cast("long").alias("position"),
                                                      F.col(n).alias(name)) for i, n in enumerate(names)])))

    return rounded(counts(c.processed(), "panel_values").join(counts(scored, "window_values"), ["feature", "position"]))


# ---------------------------------------------------------------- answer table

_BW = (f"(SELECT first_weight AS w FROM ({{search}}) s ORDER BY rmse, mae, first_weight LIMIT 1)")


def _bw_sql():
    from .registry import _search_sql

    return _BW.format(search=_search_sql("split = 'validation'"))


def _sub_sql():
    return (f"SELECT t.id, t.position, CASE WHEN bw.w * b.persistence + (1 - bw.w) * b.window_mean < 0 THEN 0.0 ELSE bw.w * b.persistence + (1 - bw.w) * b.window_mean END AS prediction "
            f"FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS position FROM test_ids) t JOIN wbase b ON b.id = t.id, "
            f"{_bw_sql()} bw")


def submission(spark, sf):
    c = context(spark, sf)

    def build():
        w = EN.chosen_weight(_pair(spark, sf), 0.01)
        preds = SB.blended_window_predictions(wide_test(spark, sf), S, c.params(), w)
        template = SB.template_from_ids(wide_test(spark, sf))
        return materialize(SB.build_submission(template, preds), "submission"), template, preds
    return c._memo("submission", build)


@register("submission_build", AW(_sub_sql(), floats=["prediction"], ints=["position"]))
def q_submission_build(spark, sf):
    return rounded(submission(spark, sf)[0])


@register("submission_per_model", AW(
    "SELECT model, id, position, CASE WHEN p < 0 THEN 0.0 ELSE p END AS prediction FROM (SELECT m.model, t.id, t.position, CASE m.model WHEN 'persistence' THEN b.persistence "
    "WHEN 'window_mean' THEN b.window_mean ELSE bw.w * b.persistence + (1 - bw.w) * b.window_mean END AS p "
    "FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS position FROM test_ids) t JOIN wbase b ON b.id = t.id, "
    f"{_bw_sql()} bw, (VALUES ('persistence'), ('window_mean'), ('blend')) m(model)) q3",
    floats=["prediction"], ints=["position"]))
def q_submission_per_model(spark, sf):
    _, template, preds = submission(spark, sf)
    return rounded(SB.component_submissions(template, preds))


@register("dq_id_alignment", AW(
    "SELECT * FROM (VALUES ('missing_in_submission', 0), ('extra_in_submission', 0), ('id_mismatch', 0)) "
    "v(rule, violations)", ints=["violations"]))
def q_dq_id_alignment(spark, sf):
    sub, template, _ = submission(spark, sf)
    return rounded(Q.id_alignment(template, sub))


@register("submission_checks", AW(
    f"SELECT 'columns' AS rule, 0 AS violations UNION ALL SELECT 'non_finite', sum(CASE WHEN prediction IS NULL OR "
    f"isnan(prediction) OR isinf(prediction) THEN 1 ELSE 0 END) FROM ({_sub_sql()}) s UNION ALL SELECT 'negative', "
    f"sum(CASE WHEN prediction < 0 THEN 1 ELSE 0 END) FROM ({_sub_sql()}) s2 UNION ALL SELECT 'duplicate_id', "
    f"count(*) - count(DISTINCT id) FROM ({_sub_sql()}) s3 UNION ALL SELECT 'missing_id', 0 UNION ALL "
    "SELECT 'extra_id', 0", ints=["violations"]))
def q_submission_checks(spark, sf):
    sub, template, _ = submission(spark, sf)
    return rounded(Q.submission_checks(sub, template))


@register("submission_summary", AW(
    f"SELECT count(*) AS rows, min(prediction) AS min, max(prediction) AS max, avg(prediction) AS mean, "
    f"stddev_pop(prediction) AS std FROM ({_sub_sql()}) s", floats=["min", "max", "mean", "std"], ints=["rows"]))
def q_submission_summary(spark, sf):
    return rounded(Q.submission_summary(submission(spark, sf)[0]))


@register("table_fingerprint", AW(
    "SELECT count(*) AS rows, bit_xor(h) AS fingerprint, CAST(coalesce(sum(CAST(h AS HUGEINT)), 0) AS VARCHAR) AS total FROM ("
    "SELECT CAST('0x' || substr(md5(concat_ws('|', id, CAST(position AS VARCHAR), "
    "CAST(CAST(round(round(prediction * 1000000000.0) / 1000.0) AS BIGINT) AS VARCHAR))), 1, 15) AS BIGINT) AS h "
    f"FROM ({_sub_sql()}) s) q2", ints=["rows", "fingerprint"]))
def q_table_fingerprint(spark, sf):
    return rounded(Q.table_fingerprint(submission(spark, sf)[0], ["id", "position", "prediction"]))


@register("score_windows")
def q_score_windows(spark, sf):
    """ridge fitted on the panel's train targets, saved and loaded, scores the independent windows."""
    from .registry import _tab_written

    c = context(spark, sf)
    tab = _tab_written(spark, sf)
    names = [n for n in tab.columns if n not in ("station", "split", "target_datetime", "target")]
    path = os.path.join(checkpoint_root(spark), f"ridge-{uuid.uuid4().hex}")
    FC.save_model(FC.fit_ridge(tab.filter(F.col("split") == "train"), names), path)
    windows = Q.assert_wide(wide_test(spark, sf), S, c.params().station_table(spark))
    return FC.score(FC.load_model(path), WD.wide_tabular(windows, S, c.params()), "ridge", keys=["id", "station"])


# ---------------------------------------------------------------- sources / sinks


@register("read_panel_csv", O.wrap("SELECT year, month, day, hour, station, y, vmax, vmin, vsum, n, users, k, wd FROM raw",
                                   floats=NUM, ints=["year", "month", "day", "hour"]))
def q_read_panel_csv(spark, sf):
    """S1 round trip: the raw panel written as CSV with NA tokens, read back with an explicit schema."""
    cols = ["year", "month", "day", "hour", "station"] + NUM + ["wd"]
    path = os.path.join(checkpoint_root(spark), f"panel-csv-{uuid.uuid4().hex}")
    context(spark, sf).raw().select(*cols).write.option("header", True).option("nullValue", "NA").csv(path)
    return rounded(IO.read_panel_csv(spark, path, columns=cols))


_UPSERTED = O.wrap("SELECT model, split, samples, rmse, mae, r2 FROM movr WHERE model <> 'window_mean' UNION ALL "
                   "SELECT model, split, samples + 1, rmse * 2, mae / 2, NULL FROM movr WHERE model = 'window_mean' AND split <> 'train' "
                   "UNION ALL SELECT 'new', split, samples, rmse, mae, r2 FROM movr WHERE model = 'persistence'",
                   floats=["rmse", "mae", "r2"], ints=["samples"])


def _upsert_case(spark, sf):
    """(metrics, changed metrics of one model without one of its rows and a new model's)."""
    existing = E.metrics_overall(_preds(spark, sf))
    rerun = existing.filter("model = 'window_mean' AND split <> 'train'").select(
        "model", "split", (F.col("samples") + 1).alias("samples"), (F.col("rmse") * 2).alias("rmse"),
        (F.col("mae") / 2).alias("mae"), F.lit(None).cast("double").alias("r2"))
    return existing, rerun.unionByName(existing.filter("model = 'persistence'").withColumn("model", F.lit("new")))


@register("result_upsert", _UPSERTED)
def q_result_upsert(spark, sf):
    """The changed rows upserted into the table."""
    existing, new = _upsert_case(spark, sf)
    return rounded(IO.upsert(existing, new, ["model"]))


@register("result_upsert_partitions", _UPSERTED)
def q_result_upsert_partitions(spark, sf):
    """S10/S11 in place: a table by model whose changed partitions are replaced, twice as after a retry."""
    existing, new = _upsert_case(spark, sf)
    path = os.path.join(checkpoint_root(spark), f"results-{uuid.uuid4().hex}")
    for rows in (existing, new, new):
        IO.upsert_partitions(rows, path, ["model"])
    return rounded(IO.read_partitions(spark, path, "model string, split string, samples long, rmse double, mae double, r2 double"))


@register("stream_score_windows", AW(
    "SELECT b.id, b.station, CASE WHEN bw.w * b.persistence + (1 - bw.w) * b.window_mean < 0 THEN 0.0 ELSE bw.w * b.persistence + (1 - bw.w) * b.window_mean END AS prediction "
    f"FROM wbase b JOIN test_ids USING (id), {_bw_sql()} bw", floats=["prediction"]))
def q_stream_score_windows(spark, sf):
    """Structured Streaming: wide-window files scored as they arrive (availableNow trigger)."""
    from ..streaming.scoring import score_window_files

    c = context(spark, sf)
    root = checkpoint_root(spark)
    tag = uuid.uuid4().hex
    src, sink, ckpt = (os.path.join(root, f"stream-{n}-{tag}") for n in ("in", "out", "ckpt"))
    windows = wide_test(spark, sf)
    windows.write.parquet(src)
    w = EN.chosen_weight(_pair(spark, sf), 0.01)
    score_window_files(spark, src, windows.schema, S, c.params(), w, sink, ckpt)
    return rounded(spark.read.parquet(sink))


@register("read_wide_csv", AW("SELECT * FROM wide", floats=WIDE_F, ints=WIDE_I))
def q_read_wide_csv(spark, sf):
    """S2 round trip: wide windows written as CSV, read back with the generated lag x column schema."""
    path = os.path.join(checkpoint_root(spark), f"wide-csv-{uuid.uuid4().hex}")
    wide(spark, sf).write.option("header", True).option("nullValue", "NA").csv(path)
    return rounded(IO.read_wide_csv(spark, path, S))


@register("read_template_csv", AW("SELECT id, row_number() OVER (ORDER BY id) - 1 AS position FROM wide",
                                  ints=["position"]))
def q_read_template_csv(spark, sf):
    """S3 round trip: an answer template written in id order (range-partitioned part
    files); positions come from file and row order."""
    path = os.path.join(checkpoint_root(spark), f"template-csv-{uuid.uuid4().hex}")
    wide(spark, sf).select("id", F.lit(0.0).alias("y")).orderBy("id").write.option("header", True).csv(path)
    return rounded(IO.read_template_csv(spark, path, value_col="y"))


@register("prediction_sample", O.wrap(
    "SELECT * FROM cpreds ORDER BY md5(concat_ws(':', '42', model, station, strftime(target_datetime, "
    "'%Y-%m-%d %H:%M:%S'))), model, station, target_datetime LIMIT 5000", floats=["y_true", "y_pred"]))
def q_prediction_sample(spark, sf):
    """Seeded sample (<= 5,000 rows, without replacement) behind the actual-vs-predicted plot."""
    p = E.prepare_predictions(_preds(spark, sf)).withColumn(
        "_key", F.concat_ws(":", "model", "station", F.date_format("target_datetime", "yyyy-MM-dd HH:mm:ss")))
    return rounded(W.deterministic_sample(p, 5000, 42, "_key").drop("_key"))
