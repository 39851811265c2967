"""DuckDB oracle SQL for the registered queries (Panel A of the events table).

The SQL is written independently of the Spark code, the way one would state each
result in plain SQL: a CTE chain ``ev -> raw -> prep -> med -> filled -> sc ->
proc`` and per-query SELECTs on top.  Floating outputs are rounded the same way
as on the Spark side (``functions.rounded``).
"""

from __future__ import annotations

from ..config import (COMPASS_DEGREES, DELTA_HOURS, EVENT_WIND_CODES, EVENTS_SPEC, TIME_FEATURES,
                      WIND_FEATURES)

S = EVENTS_SPEC
NUM = list(S.numeric)
PRIMARY = list(S.primary)
CONTEXT = list(S.context)
W = S.window
# Panel A series (the event types of the driver data); they name the one-hot columns.
STATIONS_A = ("click", "error", "purchase", "signup", "view")
FEATURES = (NUM + list(TIME_FEATURES) + list(WIND_FEATURES) + [f"{c}_missing" for c in NUM]
            + [f"station_{s}" for s in STATIONS_A])
WIDE_COLS = ["year", "month", "day", "hour"] + NUM + ["wd"]


def ts(s: str) -> str:
    return f"TIMESTAMP '{s}'"


def _list(xs) -> str:
    return ", ".join(xs)


def _codes() -> str:
    return "[" + ", ".join(f"'{c}'" for c in EVENT_WIND_CODES) + "]"


def _wind_case(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in COMPASS_DEGREES.items())
    return f"(CASE upper({col}) {whens} ELSE NULL END)"


def _split_case(col: str) -> str:
    return (f"CASE WHEN {col} < {ts(S.validation_start)} THEN 'train' "
            f"WHEN {col} < {ts(S.test_start)} THEN 'validation' ELSE 'local_test' END")


def _time_feats(t: str) -> list[str]:
    two_pi = "(2 * pi())"
    return [
        f"sin({two_pi} * hour({t}) / 24.0) AS hour_sin", f"cos({two_pi} * hour({t}) / 24.0) AS hour_cos",
        f"sin({two_pi} * (isodow({t}) - 1) / 7.0) AS day_of_week_sin",
        f"cos({two_pi} * (isodow({t}) - 1) / 7.0) AS day_of_week_cos",
        f"sin({two_pi} * (dayofyear({t}) - 1) / 365.25) AS day_of_year_sin",
        f"cos({two_pi} * (dayofyear({t}) - 1) / 365.25) AS day_of_year_cos",
    ]


def _wind_feats(col: str) -> list[str]:
    d = _wind_case(col)
    return [f"sin(radians(coalesce({d}, 0.0))) AS wd_sin", f"cos(radians(coalesce({d}, 0.0))) AS wd_cos",
            f"CAST({d} IS NULL AS DOUBLE) AS wd_missing"]


def _r2(y: str, e: str) -> str:
    n = "count(*)"
    sst = f"(var_pop({y}) * {n})"
    return (f"CASE WHEN {n} < 2 THEN NULL WHEN {sst} = 0 THEN (CASE WHEN sum({e} * {e}) = 0 THEN 1.0 ELSE 0.0 END) "
            f"ELSE 1 - sum({e} * {e}) / {sst} END")


def metric_cols(y: str = "y_true", p: str = "y_pred") -> str:
    e = f"({y} - {p})"
    return (f"count(*) AS samples, sqrt(avg({e} * {e})) AS rmse, avg(abs({e})) AS mae, {_r2(y, e)} AS r2")


def panel_ctes(key: str = "event_type", other: str = "user_id", stations=STATIONS_A) -> str:
    med = _list(f"median({c}) AS {c}" for c in NUM)
    flags = _list(f"CAST(p.{c} IS NULL AS DOUBLE) AS {c}_missing" for c in NUM)
    fills = _list(f"coalesce(last_value(p.{c} IGNORE NULLS) OVER w, med.{c}) AS {c}" for c in NUM)
    ffill = _list(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in NUM)
    sc = _list(f"avg({c}) AS {c}_m, coalesce(nullif(stddev_pop({c}), 0), 1) AS {c}_s" for c in NUM)
    scaled = _list(f"(f.{c} - sc.{c}_m) / sc.{c}_s AS {c}" for c in NUM)
    onehot = "".join(f", CAST(f.station = '{s}' AS DOUBLE) AS station_{s}" for s in stations)
    return f"""
ev AS (
  SELECT CAST({key} AS VARCHAR) AS station, date_trunc('hour', ts) AS datetime, CAST(value AS DOUBLE) AS value,
         CAST({other} AS VARCHAR) AS other, CAST(json_extract_string(props, '$.k') AS BIGINT) AS kk
  FROM events),
cal AS (SELECT station, unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 HOUR)) AS datetime
        FROM ev GROUP BY station),
agg AS (SELECT station, datetime, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(value), 0) AS y, max(value) AS vmax, min(value) AS vmin, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS vsum,
               count(value) AS n, count(DISTINCT other) AS users, avg(CAST(kk AS DOUBLE)) AS k, sum(kk) AS ksum
        FROM ev GROUP BY station, datetime),
raw AS (
  SELECT c.datetime, year(c.datetime) AS year, month(c.datetime) AS month, day(c.datetime) AS day,
         hour(c.datetime) AS hour, c.station, a.y, a.vmax, a.vmin, a.vsum, CAST(a.n AS DOUBLE) AS n,
         CAST(a.users AS DOUBLE) AS users, a.k,
         CASE WHEN a.ksum IS NULL THEN NULL ELSE ({_codes()})[CAST(a.ksum % {len(EVENT_WIND_CODES)} AS BIGINT) + 1] END AS wd
  FROM cal c LEFT JOIN agg a ON a.station = c.station AND a.datetime = c.datetime),
prep AS (SELECT *, {_split_case('datetime')} AS split FROM raw),
med AS (SELECT {med} FROM prep WHERE split = 'train'),
ffilled AS (
  SELECT station, datetime, split, {ffill} FROM prep
  WINDOW w AS (PARTITION BY station ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
filled AS (
  SELECT p.datetime, p.station, p.split, p.wd, p.y AS target_y, {flags}, {fills}
  FROM prep p, med
  WINDOW w AS (PARTITION BY p.station ORDER BY p.datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
sc AS (SELECT {sc} FROM filled WHERE split = 'train'),
proc AS (
  SELECT f.datetime, f.station, f.target_y, {scaled}, {_list(_time_feats('f.datetime'))},
         {_list(_wind_feats('f.wd'))}, {_list(f'f.{c}_missing' for c in NUM)}{onehot}, f.split
  FROM filled f, sc),
hist AS (
  SELECT *, lag(datetime, {W}) OVER w AS st FROM proc WINDOW w AS (PARTITION BY station ORDER BY datetime)),
seq AS (
  SELECT row_number() OVER (ORDER BY station, datetime) - 1 AS sequence_id, station, split,
         datetime - INTERVAL {W} HOUR AS window_start_datetime, datetime - INTERVAL 1 HOUR AS window_end_datetime,
         datetime AS target_datetime, target_y AS target
  FROM hist WHERE st IS NOT NULL AND st = datetime - INTERVAL {W} HOUR AND target_y IS NOT NULL),
fcw AS (
  SELECT station, split, datetime AS target_datetime, target_y AS y_true,
         lag(y, 1) OVER w AS persistence,
         avg(y) OVER (PARTITION BY station ORDER BY datetime ROWS BETWEEN {W} PRECEDING AND 1 PRECEDING) AS window_mean,
         lag(datetime, {W}) OVER w AS st
  FROM filled WINDOW w AS (PARTITION BY station ORDER BY datetime)),
fc AS (SELECT station, split, target_datetime, y_true, persistence, window_mean FROM fcw
       WHERE st IS NOT NULL AND st = target_datetime - INTERVAL {W} HOUR AND y_true IS NOT NULL),
preds AS (
  SELECT 'persistence' AS model, station, split, target_datetime, y_true, persistence AS y_pred FROM fc
  UNION ALL
  SELECT 'window_mean' AS model, station, split, target_datetime, y_true, window_mean AS y_pred FROM fc),
cpreds AS (SELECT model, station, split, target_datetime, y_true, CASE WHEN y_pred < 0 THEN 0.0 ELSE y_pred END AS y_pred FROM preds),
movr AS (SELECT model, split, {metric_cols()} FROM cpreds GROUP BY model, split),
mst AS (SELECT model, split, station, {metric_cols()} FROM cpreds GROUP BY model, split, station)
"""


def wrap(select: str, floats=(), ints=(), digits: int = 6, ctes: str | None = None, overrides: dict | None = None) -> str:
    """WITH <panel chain> SELECT * REPLACE (rounded floats, bigint ints) FROM (<select>)."""
    overrides = overrides or {}
    rep = []
    for c in floats:
        scale = float(10 ** overrides.get(c, digits))
        rep.append(f"round(round(CAST(\"{c}\" AS DOUBLE) * {scale * 1000}) / 1000.0) / {scale} + 0.0 AS \"{c}\"")
    rep += [f"CAST(\"{c}\" AS BIGINT) AS \"{c}\"" for c in ints]
    head = f"SELECT * REPLACE ({', '.join(rep)})" if rep else "SELECT *"
    return f"WITH {ctes or panel_ctes()}\n{head} FROM (\n{select}\n) AS q"


# ---------------------------------------------------------------- tabular features


def tabular_select(features=FEATURES, window: int = W, where_extra: str = "") -> tuple[str, list[str]]:
    """Tabular features of every valid target from plain window functions over ``proc``."""
    w = window
    part = "PARTITION BY station ORDER BY datetime"
    frame = f"(PARTITION BY station ORDER BY datetime ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
    cols, names = [], []
    for c in features:
        cols.append(f"lag({c}, 1) OVER ({part}) AS latest_{c}")
        names.append(f"latest_{c}")
    for k in range(w, 0, -1):
        cols.append(f"lag(y, {k}) OVER ({part}) AS y_lag_{k}")
        names.append(f"y_lag_{k}")
    for stat, fn in (("mean", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max")):
        for c in NUM:
            cols.append(f"{fn}({c}) OVER {frame} AS {c}_{stat}_{w}")
            names.append(f"{c}_{stat}_{w}")
    for h in DELTA_HOURS:
        if h < w:
            cols.append(f"lag(y, 1) OVER ({part}) - lag(y, {h + 1}) OVER ({part}) AS y_change_{h}h")
            names.append(f"y_change_{h}h")
    sel = f"""
SELECT station, split, target_datetime, target, {_list(names)} FROM (
  SELECT station, split, datetime AS target_datetime, target_y AS target, lag(datetime, {w}) OVER ({part}) AS st,
         {_list(cols)}
  FROM proc) t
WHERE st IS NOT NULL AND st = target_datetime - INTERVAL {w} HOUR AND target IS NOT NULL {where_extra}"""
    return sel, names


# ---------------------------------------------------------------- wide windows


def wide_ctes() -> str:
    """Wide windows of every hour with a whole window before it; ``test_ids`` those of the local test (lags via window functions), their long form
    by a range self-join on the panel, in-window fill, features and baselines."""
    w = W
    lags = _list(f"lag({c}, {k}) OVER w AS {c}_lag_{k}" for k in range(w, 0, -1) for c in WIDE_COLS)
    lag_names = _list(f"{c}_lag_{k}" for k in range(w, 0, -1) for c in WIDE_COLS)
    fills = _list(f"coalesce(last_value(l.{c} IGNORE NULLS) OVER wf, med.{c}) AS {c}" for c in NUM)
    flags = _list(f"CAST(l.{c} IS NULL AS DOUBLE) AS {c}_missing" for c in NUM)
    scaled = _list(f"(f.{c} - sc.{c}_m) / sc.{c}_s AS {c}" for c in NUM)
    onehot = _list(f"CAST(f.station = '{s}' AS DOUBLE) AS station_{s}" for s in STATIONS_A)
    return f"""
wlag AS (SELECT station, datetime, lag(datetime, {w}) OVER w AS st, {lags} FROM raw
         WINDOW w AS (PARTITION BY station ORDER BY datetime)),
anchors AS (SELECT 'w_' || station || '_' || strftime(datetime, '%Y%m%d%H') AS id, station, datetime AS t FROM wlag
            WHERE st IS NOT NULL AND st = datetime - INTERVAL {w} HOUR),
test_ids AS (SELECT id FROM anchors WHERE t >= {ts(S.test_start)}),
wide AS (SELECT a.id, a.station, {lag_names} FROM anchors a JOIN wlag l ON l.station = a.station AND l.datetime = a.t),
wlong AS (SELECT a.id, a.station, CAST(date_diff('hour', a.t - INTERVAL {w} HOUR, r.datetime) AS BIGINT) AS time_step,
                 r.datetime, {_list('r.' + c for c in WIDE_COLS)}
          FROM anchors a JOIN raw r ON r.station = a.station AND r.datetime >= a.t - INTERVAL {w} HOUR AND r.datetime < a.t),
wfill AS (SELECT l.id, l.station, l.time_step, l.datetime, l.wd, {fills}, {flags} FROM wlong l, med
          WINDOW wf AS (PARTITION BY l.id ORDER BY l.time_step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
wfeat AS (SELECT f.id, f.station, f.time_step, {scaled}, {_list(_time_feats('f.datetime'))}, {_list(_wind_feats('f.wd'))},
                 {_list(f'f.{c}_missing' for c in NUM)}, {onehot} FROM wfill f, sc),
wbase AS (SELECT id, station, max(CASE WHEN time_step = {w - 1} THEN y END) AS persistence, avg(y) AS window_mean
          FROM wfill GROUP BY id, station)"""


def wide_tabular_select() -> tuple[str, list[str]]:
    """Tabular features of the wide windows by grouping their long feature rows."""
    w = W
    cols, names = [], []
    for c in FEATURES:
        cols.append(f"max(CASE WHEN time_step = {w - 1} THEN {c} END) AS latest_{c}")
        names.append(f"latest_{c}")
    for k in range(w, 0, -1):
        cols.append(f"max(CASE WHEN time_step = {w - k} THEN y END) AS y_lag_{k}")
        names.append(f"y_lag_{k}")
    for stat, fn in (("mean", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max")):
        for c in NUM:
            cols.append(f"{fn}({c}) AS {c}_{stat}_{w}")
            names.append(f"{c}_{stat}_{w}")
    for h in DELTA_HOURS:
        if h < w:
            cols.append(f"max(CASE WHEN time_step = {w - 1} THEN y END) - max(CASE WHEN time_step = {w - 1 - h} "
                        f"THEN y END) AS y_change_{h}h")
            names.append(f"y_change_{h}h")
    return f"SELECT id, station, {_list(cols)} FROM wfeat GROUP BY id, station", names


def all_ctes() -> str:
    return panel_ctes() + "," + wide_ctes()


# Panel B: one series per user (many sparse series, no one-hot columns)
FEATURES_B = NUM + list(TIME_FEATURES) + list(WIND_FEATURES) + [f"{c}_missing" for c in NUM]


def panel_b_ctes() -> str:
    return panel_ctes("user_id", "event_type", stations=())
