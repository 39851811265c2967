"""Leakage-safe preprocessing of an hourly panel (fit on train rows only).

``fit_params`` learns, from the train split only, the per-column medians of the
*observed* values, the mean and population std of the *imputed* values and the
sorted station list.  ``transform`` turns any panel into the model frame:
missing flags, causal forward fill per series, median fill of leading gaps,
cyclical calendar and circular wind features, station one-hot and
standardisation.  Parameters are a few numbers per column; they are collected
once (like a fitted ``pyspark.ml`` model) and enter the plan as literals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import FEATURE_SETS, TIME_FEATURES, WIND_FEATURES, PanelSpec
from ..functions.exprs import nan_to_null, time_feature_columns, ts_literal, wind_feature_columns
from ..session import dealt, task_count
from .lookback import CHUNK, series_window, with_chunk


# ---------------------------------------------------------------- P1, P2, P14


def add_datetime(df: DataFrame, spec: PanelSpec, strict: bool = True) -> DataFrame:
    """Build ``datetime`` from year/month/day/hour (or parse an existing column).

    ``strict`` raises on an impossible date (ANSI ``make_timestamp_ntz``); otherwise
    the value is NULL (``try_make_timestamp_ntz``) and ``quality.bad_timestamps``
    lists such rows.
    """
    if spec.time in df.columns:
        return df.withColumn(spec.time, F.col(spec.time).cast("timestamp_ntz"))
    make = F.make_timestamp_ntz if strict else F.try_make_timestamp_ntz
    t = make(F.col("year"), F.col("month"), F.col("day"), F.col("hour"), F.lit(0), F.lit(0))
    return df.withColumn(spec.time, t)


def split_column(spec: PanelSpec, t: str | Column | None = None) -> Column:
    t = F.col(t or spec.time) if not isinstance(t, Column) else t
    return (
        F.when(t < ts_literal(spec.validation_start), F.lit("train"))
        .when(t < ts_literal(spec.test_start), F.lit("validation"))
        .otherwise(F.lit("local_test"))
    )


def split_order(c: str | Column = "split") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == "train", 0).when(c == "validation", 1).when(c == "local_test", 2).cast("long")


def assign_split(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.withColumn("split", split_column(spec))


def prepare(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Timestamp, string station, NaN -> NULL in numerics, split label; an observed target that the panel
    already has is kept.  ``quality.assert_panel`` refuses panels with missing stations, repeated or missing hours."""
    missing = [c for c in (spec.station, *spec.numeric) if c not in df.columns]
    if missing:
        raise ValueError(f"panel is missing required columns: {missing}")
    x = add_datetime(df, spec)
    cols = [F.col(spec.time), F.col(spec.station).cast("string").alias(spec.station)]
    cols += [nan_to_null(F.col(c).cast("double")).alias(c) for c in spec.numeric]
    if spec.wind:
        cols.append(F.col(spec.wind).cast("string").alias(spec.wind) if spec.wind in df.columns
                    else F.lit(None).cast("string").alias(spec.wind))
    if spec.observed_target in df.columns:
        cols.append(nan_to_null(F.col(spec.observed_target).cast("double")).alias(spec.observed_target))
    return x.select(*cols).withColumn("split", split_column(spec))


# ---------------------------------------------------------------- P4, P5


def missing_flag_columns(spec: PanelSpec) -> list[Column]:
    return [F.col(c).isNull().cast("double").alias(f"{c}_missing") for c in spec.numeric]


def forward_fill(df: DataFrame, spec: PanelSpec, cols: list[str] | tuple[str, ...] | None = None,
                 exclude_current: bool = False, suffix: str = "") -> DataFrame:
    """Causal forward fill per series: the last earlier non-NULL value, never backwards.

    Chunked form (``spec.chunk_hours``): (1) last observed value per (series, chunk),
    an aggregate with a map-side partial; (2) on that small table, the last observed
    value of any *earlier* chunk of the series (the carry); (3) per (series, chunk), a
    running ``last(ignorenulls)``, falling back to the carry.  The join with the carry
    and the running window share one exchange on (series, chunk), so no task ever
    holds a whole series; its tasks are as many as the rows need (``session.task_count``).

    ``exclude_current`` gives the last non-NULL value strictly *before* each row (the
    previous observation); ``suffix`` keeps the input columns and adds the results
    as ``<col><suffix>``.
    """
    cols = list(cols if cols is not None else spec.numeric)
    st, t = spec.station, spec.time
    end = -1 if exclude_current else 0

    def emit(results: dict[str, Column], source: DataFrame) -> DataFrame:
        if suffix:
            return source.select(*[F.col(c) for c in df.columns], *[results[c].alias(f"{c}{suffix}") for c in cols])
        return source.select(*[results[c].alias(c) if c in cols else F.col(c) for c in df.columns])

    if spec.chunk_hours is None:
        w = Window.partitionBy(st).orderBy(t).rowsBetween(Window.unboundedPreceding, end)
        return emit({c: F.last(c, True).over(w) for c in cols}, df)
    x = with_chunk(df, spec)
    last_obs = x.groupBy(st, CHUNK).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(t))).alias(c) for c in cols]
    )
    cw = Window.partitionBy(st).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = last_obs.select(st, CHUNK, *[F.last(c, True).over(cw).alias(f"_carry_{i}") for i, c in enumerate(cols)])
    w = series_window(spec).rowsBetween(Window.unboundedPreceding, end)
    tasks = task_count(df)
    y = dealt(x, tasks, st, CHUNK).join(dealt(carry, tasks, st, CHUNK), [st, CHUNK], "left")
    return emit({c: F.coalesce(F.last(c, True).over(w), F.col(f"_carry_{i}")) for i, c in enumerate(cols)}, y)


# ---------------------------------------------------------------- P6, P11, P15 (fit)


@dataclass
class FittedParams:
    """Train-only parameters: per numeric column median / mean / std, and the station categories.

    ``stations`` are listed (and name one-hot columns) when one-hot columns were asked for; ``categories`` is the
    written table (station, position) of all train stations, whatever their number.
    """

    columns: list[str]
    medians: dict[str, float]
    means: dict[str, float]
    stds: dict[str, float]
    stations: list[str]
    onehot: bool = True
    categories: DataFrame | None = None

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, float(self.medians[c]), float(self.means[c]), float(self.stds[c])) for c in self.columns]
        return spark.createDataFrame(rows, "column string, median double, mean double, std double")

    def station_table(self, spark: SparkSession) -> DataFrame:
        if self.categories is not None:
            return self.categories
        return spark.createDataFrame([(s, i) for i, s in enumerate(self.stations)], "station string, position long")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the parameters as Parquet under ``path``, on any storage Spark reaches."""
        order = {c: i for i, c in enumerate(self.columns)}
        at = F.create_map(*[F.lit(x) for c, i in order.items() for x in (c, i)])
        self.table(spark).withColumn("position", at[F.col("column")]).withColumn("onehot", F.lit(self.onehot)) \
            .write.mode("error").parquet(f"{path}/columns")
        self.station_table(spark).write.mode("error").parquet(f"{path}/stations")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FittedParams":
        rows = sorted(spark.read.parquet(f"{path}/columns").collect(), key=lambda r: r["position"])
        categories = spark.read.parquet(f"{path}/stations")
        onehot = bool(rows and rows[0]["onehot"])
        stations = [r["station"] for r in categories.orderBy("position").collect()] if onehot else []
        return cls([r["column"] for r in rows], *({r["column"]: r[k] for r in rows} for k in ("median", "mean", "std")),
                   stations, onehot, categories)


def median_table(train: DataFrame, spec: PanelSpec, approx: bool = False) -> DataFrame:
    """P6 as a table ``(column, median)``: median of observed (unfilled) train values.

    Exact by default, by one distributed sort of all numeric columns
    (``functions.quantiles``: no task holds a whole column); ``approx`` uses
    ``percentile_approx`` (one bounded sketch per column, one pass).
    """
    if approx:
        one = train.agg(*[F.percentile_approx(F.col(c), 0.5, 10000).cast("double").alias(c) for c in spec.numeric])
        return one.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).alias("median")) for c in spec.numeric])))
    from ..functions.quantiles import quantile_columns

    # hours with a value only, dealt so that no task counts the distinct values of many million rows
    train = train.filter(F.coalesce(*[F.col(c).cast("double") for c in spec.numeric]).isNotNull())
    train = dealt(train, task_count(train), spec.station, spec.time)
    return quantile_columns(train, list(spec.numeric), [0.5], ["median"])


def scaler_table(imputed_train: DataFrame, spec: PanelSpec) -> DataFrame:
    """P11 as a table ``(column, mean, std)``: population std of imputed train values, 0 -> 1."""
    aggs = []
    for c in spec.numeric:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    one = imputed_train.agg(*aggs)
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m_{c}").alias("mean"),
                 F.coalesce(F.when(F.col(f"s_{c}") != 0, F.col(f"s_{c}")), F.lit(1.0)).alias("std"))
        for c in spec.numeric])))


def fit_medians(train: DataFrame, spec: PanelSpec, approx: bool = False) -> dict[str, float]:
    med = {r["column"]: r["median"] for r in median_table(train, spec, approx).collect()}
    bad = [c for c in spec.numeric if med.get(c) is None]
    if bad:
        raise ValueError(f"no observed training values for: {bad}")
    return {c: float(med[c]) for c in spec.numeric}


def impute(df: DataFrame, spec: PanelSpec, medians: dict[str, float]) -> DataFrame:
    """Forward fill per series, then the training median for leading gaps."""
    filled = forward_fill(df, spec, spec.numeric)
    return filled.select(*[
        F.coalesce(F.col(c), F.lit(medians[c])).alias(c) if c in medians else F.col(c) for c in filled.columns
    ])


def fit_scaler(imputed_train: DataFrame, spec: PanelSpec) -> tuple[dict[str, float], dict[str, float]]:
    rows = {r["column"]: r for r in scaler_table(imputed_train, spec).collect()}
    if any(rows[c]["mean"] is None for c in spec.numeric):
        raise ValueError("cannot fit the scaler on an empty training set")
    return ({c: float(rows[c]["mean"]) for c in spec.numeric}, {c: float(rows[c]["std"]) for c in spec.numeric})


def fit_params(df: DataFrame, spec: PanelSpec, approx_median: bool = False, onehot: bool | None = None,
               imputed: DataFrame | None = None, medians: dict[str, float] | None = None) -> FittedParams:
    """Fit on the train split only.  Because train is the earliest part of every
    series, filling the train rows alone equals filling the panel and filtering --
    so an already imputed panel (``imputed``, built with ``medians``) can be reused."""
    train = prepare(df, spec).filter(F.col("split") == "train")
    if medians is None:
        medians = fit_medians(train, spec, approx=approx_median)
    imputed = impute(train, spec, medians) if imputed is None else imputed.filter(F.col("split") == "train")
    means, stds = fit_scaler(imputed, spec)
    from ..session import materialize
    from .windows import global_rank

    distinct = train.filter(F.col(spec.station).isNotNull()).select(F.col(spec.station).alias("station")).distinct()
    categories = materialize(global_rank(distinct, ["station"], "position"), "stations")
    # one-hot columns are the caller's choice, for any number of series; the names come to the driver only then
    stations = [r["station"] for r in categories.orderBy("position").collect()] if onehot is not False else []
    return FittedParams(list(spec.numeric), medians, means, stds, stations, onehot is not False, categories)


def station_vector(df: DataFrame, spec: PanelSpec, params: FittedParams, name: str = "station_vector") -> DataFrame:
    """P10 as one sparse vector column, for panels with many series; an unknown station is all zeros."""
    from pyspark.ml.feature import OneHotEncoder

    spark = df.sparkSession
    known = params.station_table(spark).select(F.col("station").alias("_known"), F.col("position").cast("double").alias("_at"))
    size = known.count()
    # categories 0 .. size, the last one (dropped) for stations not seen at fit time
    encoder = OneHotEncoder(inputCol="_at", outputCol=name, dropLast=True).fit(
        spark.createDataFrame([(float(size),)], "_at double"))
    joined = df.join(known, df[spec.station] == F.col("_known"), "left").fillna(float(size), ["_at"])
    return encoder.transform(joined).drop("_known", "_at")


# ---------------------------------------------------------------- P8-P12, P15 (transform)


def feature_names(spec: PanelSpec, params: FittedParams) -> list[str]:
    names = list(spec.numeric) + list(TIME_FEATURES)
    if spec.wind:
        names += list(WIND_FEATURES)
    names += [f"{c}_missing" for c in spec.numeric]
    if params.onehot:
        names += [f"{spec.station}_{s}" for s in params.stations]
    return names


def scale_column(c: str, params: FittedParams) -> Column:
    return (F.col(c) - F.lit(params.means[c])) / F.lit(params.stds[c])


def inverse_scale(value: Column, params: FittedParams, column: str) -> Column:
    """Standardised value back to original units."""
    if column not in params.columns:
        raise ValueError(f"{column} is not a numeric input column")
    return value * F.lit(params.stds[column]) + F.lit(params.means[column])


def engineer(filled: DataFrame, spec: PanelSpec, params: FittedParams) -> DataFrame:
    """Imputed frame (with flags and observed target) -> model frame."""
    cols = [F.col(spec.time), F.col(spec.station), F.col(spec.observed_target)]
    cols += [scale_column(c, params).alias(c) for c in spec.numeric]
    cols += time_feature_columns(spec.time)
    if spec.wind:
        cols += wind_feature_columns(spec.wind)
    cols += [F.col(f"{c}_missing") for c in spec.numeric]
    if params.onehot:
        cols += [(F.col(spec.station) == F.lit(s)).cast("double").alias(f"{spec.station}_{s}") for s in params.stations]
    cols.append(F.col("split"))
    return filled.select(*cols)


def impute_with_flags(df: DataFrame, spec: PanelSpec, params: "FittedParams | dict[str, float]") -> DataFrame:
    """Prepared panel + observed target + missing flags, forward filled and median filled.

    Depends on the medians only, so the scaler can be fitted on its train rows."""
    medians = params.medians if isinstance(params, FittedParams) else params
    x = prepare(df, spec)
    if spec.observed_target not in x.columns:
        x = x.withColumn(spec.observed_target, F.col(spec.target))
    x = x.select("*", *missing_flag_columns(spec))
    return impute(x, spec, medians)


def transform(df: DataFrame, spec: PanelSpec, params: FittedParams) -> DataFrame:
    """Datetime, station, observed target, features in order, split."""
    return engineer(impute_with_flags(df, spec, params), spec, params)


def preprocess(df: DataFrame, spec: PanelSpec, **fit_kw) -> tuple[DataFrame, FittedParams]:
    params = fit_params(df, spec, **fit_kw)
    return transform(df, spec, params), params


# ---------------------------------------------------------------- P16


def select_feature_set(names: list[str], spec: PanelSpec, feature_set: str) -> list[str]:
    """``all_features`` or ``pollution_only`` (primary columns, their flags, time, station)."""
    if feature_set not in FEATURE_SETS:
        raise ValueError(f"unknown feature set {feature_set!r}; expected one of {FEATURE_SETS}")
    if feature_set == "all_features":
        return list(names)
    drop = set(spec.context) | {f"{c}_missing" for c in spec.context} | set(WIND_FEATURES)
    return [n for n in names if n not in drop]

