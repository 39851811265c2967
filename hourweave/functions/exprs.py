"""Column expressions shared by the operators.

Everything here is a built-in Spark expression (JVM side, whole-stage codegen);
no Python runs per row.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import COMPASS_DEGREES, DAYS_PER_YEAR, TARGET_RANGES


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hours(n: int) -> Column:
    """A day-time interval of ``n`` hours."""
    return F.expr(f"INTERVAL {int(n)} HOURS")


def ts_literal(value: str) -> Column:
    """A TIMESTAMP_NTZ literal (folded to a constant by the optimiser)."""
    return F.lit(value).cast("timestamp_ntz")


def epoch_hours(t: str | Column) -> Column:
    """Whole hours since 1970-01-01 of a TIMESTAMP_NTZ column, whatever the session's time zone."""
    t = col(t)
    return (F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 24 + F.hour(t)).cast("long")


def nan_to_null(c: str | Column) -> Column:
    """pandas has one kind of missing; Spark has NULL and NaN.  NaN -> NULL at ingest."""
    return F.nanvl(col(c), F.lit(None).cast("double"))


def is_finite(c: str | Column) -> Column:
    x = col(c).cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def wind_degrees(c: str | Column) -> Column:
    """Upper-cased (not trimmed) compass code -> degrees; unknown or NULL -> NULL."""
    mapping = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in COMPASS_DEGREES.items()))
    return F.element_at(mapping, F.upper(col(c)))


def cyclical(value: Column, period: float) -> tuple[Column, Column]:
    angle = F.lit(2.0 * math.pi) * value.cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def time_feature_columns(t: str | Column) -> list[Column]:
    """hour of day / 24, Monday=0 weekday / 7, (day of year - 1) / 365.25 as sin/cos pairs."""
    ts = col(t)
    hs, hc = cyclical(F.hour(ts), 24.0)
    ws, wc = cyclical(F.weekday(ts), 7.0)
    ds, dc = cyclical(F.dayofyear(ts) - 1, DAYS_PER_YEAR)
    names = ("hour_sin", "hour_cos", "day_of_week_sin", "day_of_week_cos", "day_of_year_sin", "day_of_year_cos")
    return [e.alias(n) for e, n in zip((hs, hc, ws, wc, ds, dc), names)]


def wind_feature_columns(c: str | Column) -> list[Column]:
    deg = wind_degrees(c)
    rad = F.radians(F.coalesce(deg, F.lit(0.0)))
    return [F.sin(rad).alias("wd_sin"), F.cos(rad).alias("wd_cos"), deg.isNull().cast("double").alias("wd_missing")]


# ---------------------------------------------------------------- metrics


def regression_metric_columns(y: str | Column, p: str | Column) -> list[Column]:
    """samples, rmse, mae, r2 as aggregate expressions (one pass, map-side partial).

    R^2 = 1 - SSE / SST with SST = n * var_pop(y).  Constant targets give 1.0 on an
    exact fit and 0.0 otherwise; fewer than two samples give NULL.  Rows where either side is
    NULL are no samples.
    """
    y, p = col(y).cast("double"), col(p).cast("double")
    e = y - p
    n = F.count(e)
    sse = F.sum(e * e)
    sst = F.var_pop(F.when(e.isNotNull(), y)) * n
    r2 = (
        F.when(n < 2, F.lit(None).cast("double"))
        .when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(F.lit(1.0) - sse / sst)
    )
    return [
        n.alias("samples"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        r2.alias("r2"),
    ]


def range_labels(y: str | Column, disjoint: bool = False) -> Column:
    """Array of the target-range labels that contain ``y`` (0, 1 or 2 labels).

    Map-side replacement of a non-equi join against the 5-row range table.  With
    the default ranges a value of exactly 250 matches two ranges; ``disjoint``
    makes the last range open at its lower end instead.
    """
    y = col(y).cast("double")
    labels = []
    for i, (label, lo, hi, lo_incl) in enumerate(TARGET_RANGES):
        if disjoint and i == len(TARGET_RANGES) - 1:
            lo_incl = False
        cond = (y >= F.lit(lo)) if lo_incl else (y > F.lit(lo))
        if hi is not None:
            cond = cond & (y <= F.lit(hi))
        labels.append(F.when(cond, F.lit(label)))
    return F.filter(F.array(*labels), lambda x: x.isNotNull())


# ---------------------------------------------------------------- output shaping

def rounded(df: DataFrame, digits: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round floating columns (``+ 0.0`` removes negative zero), widen integers to bigint.

    Values are rounded to three more digits first: inputs with few decimals often give results that sit exactly
    on a decimal tie (38.6213125), and two engines summing in different orders land 1 ulp either side of it;
    after the first rounding both are the tie itself.

    Used at the output boundary of registered queries so results compare equal to
    the DuckDB oracles, which apply the same rounding.
    """
    overrides = overrides or {}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            scale = F.lit(float(10 ** overrides.get(f.name, digits)))
            c = F.round(F.round(c.cast("double") * scale * 1000) / 1000) / scale + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)
