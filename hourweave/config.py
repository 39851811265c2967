"""Panel description and fixed values.

A *panel* is a table with one row per (series, hour).  ``PanelSpec`` names the
key columns, the numeric inputs, the target and the chronological split
boundaries; every operator in the library takes a spec instead of hard-coding
column names, so the same code serves the hourly sensor layout (``AIR_SPEC``)
and the panels derived from the driver's ``events`` table (``EVENTS_SPEC``).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# --------------------------------------------------------------------------
# Fixed values.  These must equal the reference semantics exactly.
# --------------------------------------------------------------------------

# 16-point compass rose -> degrees (north = 0, clockwise, 22.5 degree steps).
COMPASS_DEGREES = {
    "N": 0.0, "NNE": 22.5, "NE": 45.0, "ENE": 67.5,
    "E": 90.0, "ESE": 112.5, "SE": 135.0, "SSE": 157.5,
    "S": 180.0, "SSW": 202.5, "SW": 225.0, "WSW": 247.5,
    "W": 270.0, "WNW": 292.5, "NW": 315.0, "NNW": 337.5,
}

# Target ranges of the range-wise evaluation: (label, lower, upper, lower_inclusive).
# Upper bounds are inclusive, None = unbounded.  "150-250" ends at 250 inclusive and
# "250+" starts at 250 inclusive, so a target of exactly 250 is counted in both.
TARGET_RANGES = (
    ("0-35", 0.0, 35.0, True),
    ("35-75", 35.0, 75.0, False),
    ("75-150", 75.0, 150.0, False),
    ("150-250", 150.0, 250.0, False),
    ("250+", 250.0, None, True),
)

# Split labels in chronological order.
SPLITS = ("train", "validation", "local_test")

# Hours of target change features (skipped when >= window).
DELTA_HOURS = (1, 3, 6, 12)

# Rolling statistics, in output order.
ROLLING_STATS = ("mean", "std", "min", "max")

# Cyclical calendar features, in output order.
TIME_FEATURES = (
    "hour_sin", "hour_cos",
    "day_of_week_sin", "day_of_week_cos",
    "day_of_year_sin", "day_of_year_cos",
)

# Circular wind-direction features, in output order.
WIND_FEATURES = ("wd_sin", "wd_cos", "wd_missing")

# Days per year used by the day-of-year encoding.
DAYS_PER_YEAR = 365.25

# Feature-set names of the ablation.
FEATURE_SETS = ("all_features", "pollution_only")

# Wind codes of the events adapter: index = sum(k) mod 18.  The 16 compass
# points, one lower-case point (exercises upper-casing) and one unknown code.
EVENT_WIND_CODES = tuple(COMPASS_DEGREES) + ("nne", "CALM")


@dataclass(frozen=True)
class PanelSpec:
    """Column roles of an hourly panel.

    ``primary`` plays the role of the pollutant columns (kept by the
    ``pollution_only`` feature set), ``context`` the weather columns.  The
    target must be one of ``primary``.  ``chunk_hours`` bounds the rows of one
    window partition: look-back operators run on (series, chunk) with a halo
    of ``window`` hours, so one long series is spread over many tasks.
    ``None`` falls back to one partition per series.
    """

    station: str = "station"
    time: str = "datetime"
    target: str = "y"
    primary: tuple[str, ...] = ("y", "vmax", "vmin", "vsum")
    context: tuple[str, ...] = ("n", "users", "k")
    wind: str | None = "wd"
    window: int = 24
    validation_start: str = "2024-01-22 00:00:00"
    test_start: str = "2024-01-26 00:00:00"
    chunk_hours: int | None = 168

    @property
    def numeric(self) -> tuple[str, ...]:
        return tuple(self.primary) + tuple(self.context)

    @property
    def observed_target(self) -> str:
        return f"target_{self.target}"

    @property
    def raw_columns(self) -> tuple[str, ...]:
        wind = (self.wind,) if self.wind else ()
        return ("year", "month", "day", "hour", self.station) + self.numeric + wind

    def with_(self, **kw) -> "PanelSpec":
        return replace(self, **kw)


# Panels derived from the driver's ``events`` table (see sources/events_panel.py).
EVENTS_SPEC = PanelSpec()

# The hourly air-quality layout (raw CSV, 18 columns).  Dotted source names are
# renamed at the edge (``PM2.5`` -> ``PM2_5``) so that struct fields and SQL
# identifiers never need quoting.
AIR_SPEC = PanelSpec(
    target="PM2_5",
    primary=("PM2_5", "PM10", "SO2", "NO2", "CO", "O3"),
    context=("TEMP", "PRES", "DEWP", "RAIN", "WSPM"),
    wind="wd",
    validation_start="2015-09-01 00:00:00",
    test_start="2015-12-01 00:00:00",
    chunk_hours=24 * 28,
)

# Raw CSV column order of the air-quality layout (header names as written).
AIR_RAW_CSV_COLUMNS = (
    "No", "year", "month", "day", "hour",
    "PM2.5", "PM10", "SO2", "NO2", "CO", "O3",
    "TEMP", "PRES", "DEWP", "RAIN", "wd", "WSPM", "station",
)


def edge_name(name: str) -> str:
    """Internal, dot-free column name."""
    return name.replace(".", "_")
