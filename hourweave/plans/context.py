"""Shared stages of the registered queries.

Each stage is built once per (session, data folder, panel) and, where later
stages read it many times, written to the checkpoint folder (``materialize``):
raw panel -> fitted parameters -> imputed frame (the model frame is a projection of it).  Lineage is cut at each
written stage, so a lost executor recomputes from parquet, not from ``events``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..config import EVENTS_SPEC, PanelSpec
from ..operators import preprocess as P
from ..operators.quality import assert_panel
from ..session import FILE_ROWS, materialize
from ..sources.events_panel import events_panel, hourly_aggregate

_CACHE: dict[tuple, "PanelContext"] = {}

# One-hot station columns for Panel A (an event type each); Panel B (a series per user) has
# the sparse vector of ``preprocess.station_vector`` instead.
PANEL_ONEHOT = {"A": True, "B": False}


@dataclass
class PanelContext:
    spark: SparkSession
    sf_dir: str
    panel: str
    spec: PanelSpec
    _stages: dict = field(default_factory=dict)

    def _memo(self, name, build):
        if name not in self._stages:
            self._stages[name] = build()
        return self._stages[name]

    def raw(self) -> DataFrame:
        """Raw panel (year, month, day, hour, station, numerics, wd, datetime), written once."""
        # the sparse hourly aggregate is written first, so the events are read once (the
        # hour range and the series list come from it); datetime is kept as a stored
        # column so time predicates reach the parquet scan
        return self._memo("raw", lambda: assert_panel(materialize(
            events_panel(self.spark, self.sf_dir, self.panel, self.spec, with_datetime=True,
                         sparse=self.sparse()), f"raw_{self.panel}", file_rows=FILE_ROWS), self.spec))

    def sparse(self) -> DataFrame:
        """Per (series, hour) aggregate of the events (hours with events only), written once."""
        return self._memo("sparse", lambda: materialize(hourly_aggregate(self.spark, self.sf_dir, self.panel),
                                                        f"sparse_{self.panel}"))

    def medians(self) -> dict[str, float]:
        train = P.prepare(self.raw(), self.spec).filter("split = 'train'")
        return self._memo("medians", lambda: P.fit_medians(train, self.spec))

    def imputed(self) -> DataFrame:
        """Imputed frame with flags and observed target (unscaled), written once.
        It needs the train medians only; the scaler is then fitted on its train rows."""
        # partitioned by split: train-only reads (the scaler fit) prune the other splits
        return self._memo("imputed", lambda: materialize(P.impute_with_flags(self.raw(), self.spec, self.medians()),
                                                         f"imputed_{self.panel}", partition_by=["split"], file_rows=FILE_ROWS))

    def params(self) -> P.FittedParams:
        return self._memo("params", lambda: P.fit_params(self.raw(), self.spec, imputed=self.imputed(),
                                                         medians=self.medians(),
                                                         onehot=PANEL_ONEHOT.get(self.panel)))

    def processed(self) -> DataFrame:
        """Model frame: a map-only projection of the written imputed frame (not written again)."""
        return self._memo("processed", lambda: P.engineer(self.imputed(), self.spec, self.params()))

    def feature_names(self) -> list[str]:
        return P.feature_names(self.spec, self.params())


def context(spark: SparkSession, sf_dir: str, panel: str = "A", spec: PanelSpec = EVENTS_SPEC) -> PanelContext:
    app = spark.sparkContext.applicationId
    for old in [k for k in _CACHE if k[1] != app]:  # stages of ended applications
        del _CACHE[old]
    key = (id(spark), app, sf_dir.rstrip("/"), panel, spec)
    ctx = _CACHE.get(key)
    if ctx is None:
        ctx = _CACHE[key] = PanelContext(spark, sf_dir.rstrip("/"), panel, spec)
    return ctx
