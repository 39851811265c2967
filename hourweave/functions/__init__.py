from .exprs import (  # noqa: F401
    cyclical,
    epoch_hours,
    hours,
    is_finite,
    nan_to_null,
    range_labels,
    regression_metric_columns,
    rounded,
    time_feature_columns,
    ts_literal,
    wind_degrees,
    wind_feature_columns,
)
