"""Live totals: rows are counted while they are written, by batches and by streams, and gauges follow without a job of their own."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def counts() -> list[Column]:
    """total, quarantined, and rows by their worst severity."""
    worst = [F.count_if(F.col("_max_severity") == s).alias(s.lower()) for s in ("WARNING", "MAJOR", "CRITICAL")]
    return [F.count(F.lit(1)).alias("total"), F.count_if("_is_quarantined").alias("quarantined"), *worst]


def observed(checked: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """A validated frame that counts while it is written once, and what gives the counts afterwards."""
    seen = Observation(name)
    return checked.observe(seen, *counts()), seen


def observed_stream(checked: DataFrame, name: str) -> DataFrame:
    """A validated stream whose micro-batches report their counts under a name; LiveTotals adds them up."""
    return checked.observe(name, *counts())


class LiveTotals(StreamingQueryListener):
    """Adds up what observed streams report with each micro-batch. each: is called with the gauges' lines after a batch, for instance to write them."""

    def __init__(self, names: set[str] | None = None, each: Callable[[list[str]], None] | None = None):
        self.names, self.each, self.lock = names, each, threading.Lock()
        self.totals: dict[str, dict[str, int]] = {}
        self.last: dict[tuple[str, str], int] = {}

    def add(self, query: str, batch: int, name: str, row: dict[str, int]) -> None:
        """Once for each batch of a query, however often its progress is told."""
        with self.lock:
            if (self.names is None or name in self.names) and self.last.get((query, name), -1) < batch:
                self.last[query, name] = batch
                own = self.totals.setdefault(name, {})
                for k, v in row.items():
                    own[k] = own.get(k, 0) + (v or 0)

    def lines(self) -> list[str]:
        """Gauges as Prometheus text."""
        with self.lock:
            return [f'live_rows{{stream="{name}",kind="{kind}"}} {float(n)}' for name, own in sorted(self.totals.items()) for kind, n in sorted(own.items())]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for name, row in (p.observedMetrics or {}).items():
            self.add(str(p.id), p.batchId, name, row.asDict())
        if self.each and p.observedMetrics:
            self.each(self.lines())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def following(spark: SparkSession, **options) -> LiveTotals:
    """A LiveTotals that listens to the session's streams."""
    live = LiveTotals(**options)
    spark.streams.addListener(live)
    return live
