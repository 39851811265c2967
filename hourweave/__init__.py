"""hourweave: panel time-series analytics on PySpark.

Audit, leakage-safe preprocessing, look-back windows and features, baseline
forecasts, evaluation, blending, ablation and independent-window scoring for
panels of hourly series, all as DataFrame plans (see README.md).
"""

__version__ = "0.1.0"
