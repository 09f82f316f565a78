"""SPC alerts from a stream that learns its own baseline.

``alert_stream`` keeps one state per (area, metric): the moments of the baseline
(count, sum and sum of squares, exact integers, so they merge in any order) and the
values that came before the baseline was complete. When the watermark passes the baseline's end it is complete: what waited is scored, and
from then on every value is scored as it arrives. So the alerts are those of
``spc_history`` on the same rows, wherever the stream is cut into micro-batches
and whenever it is restarted; state holds the moments and at most the rows of
`lateness` months.

Baseline rows that arrive later than `lateness` behind the newest month are too
late to count, as for any watermark. The first month is a parameter: a stream
cannot know it.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from fractions import Fraction
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerspark.operators.deviation import AREA, LOW_IS_BAD, METRICS

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # executors need not have this package

SCORED = (f"{AREA} string, metric string, period date, value double, baseline_mean double, "
          "baseline_std double, baseline_n long, z double, breach boolean")
SCALE = 20   # digits of a value that count: all that a double of the metrics' size has


def as_units(value: float) -> int:
    """A value in units of its last digit that counts."""
    return round(Fraction(value) * 10 ** SCALE)


def baseline(n: int, s1: int, s2: int) -> tuple[float, float | None]:
    """Mean and sample standard deviation of exact moments (no deviation for one value)."""
    unit = 10 ** SCALE
    std = float(Fraction(n * s2 - s1 * s1, n * (n - 1) * unit * unit)) ** 0.5 if n > 1 else None
    return float(Fraction(s1, n * unit)), std


def judged(value: float | None, metric: str, mean: float, std: float | None, limit: float,
           low_is_bad: Sequence[str] = LOW_IS_BAD) -> tuple[float | None, bool]:
    """(z, breach) as ``deviation.z_and_breach`` has them."""
    if value is None or std is None:
        return None, False
    side = -1.0 if metric in low_is_bad else 1.0
    if std == 0:
        return None, (value - mean) * side > 0
    z = (value - mean) / std
    return z, z * side > limit


class SpcProcessor(StatefulProcessor):
    """Baseline first, alerts after it, for one (area, metric)."""

    def __init__(self, end: dt.datetime, limit: float):
        self.end, self.limit = end, limit
        self.end_ms = int(end.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # integers of any length, as text
        self.moments = handle.getValueState("moments", "n long, s1 string, s2 string")
        self.waiting = handle.getListState("waiting", "period date, value double")

    def _moments(self) -> tuple[int, int, int]:
        got = self.moments.get() if self.moments.exists() else None
        return (got[0], int(got[1]), int(got[2])) if got else (0, 0, 0)

    def _score(self, key: Any, rows: Sequence[tuple]) -> Iterator[Row]:
        n, s1, s2 = self._moments()
        if not n:
            return
        mean, std = baseline(n, s1, s2)
        for period, value in rows:
            z, breach = judged(value, key[1], mean, std, self.limit)
            yield Row(**{AREA: key[0], "metric": key[1], "period": period, "value": value, "baseline_mean": mean,
                         "baseline_std": std, "baseline_n": n, "z": z, "breach": breach})

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        n, s1, s2 = self._moments()
        known, later = n, []
        for r in rows:
            if r.period >= self.end.date():
                later.append((r.period, r.value))
            elif r.value is not None:
                u = as_units(r.value)
                n, s1, s2 = n + 1, s1 + u, s2 + u * u
        if n != known:
            self.moments.update((n, str(s1), str(s2)))
        if timerValues.getCurrentWatermarkInMs() > self.end_ms:
            yield from self._score(key, later)
        elif later:
            for row in later:
                self.waiting.appendValue(row)
            self.handle.registerTimer(self.end_ms)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        rows = [tuple(r) for r in self.waiting.get()]
        self.waiting.clear()
        yield from self._score(key, rows)

    def close(self) -> None:
        pass


def alert_stream(scorecard: DataFrame, first_month: dt.date, metrics: Sequence[str] = METRICS, z: float = 3.0,
                 days: int = 90, lateness: str = "62 days") -> DataFrame:
    """(area, metric, period, value, baseline, z, breach) of every month after the baseline, from a stream of scorecard rows."""
    wide = scorecard.where(F.col(AREA).isNotNull()).select(AREA, "period", F.col("period").cast("timestamp").alias("at"), *[F.col(m).cast("double").alias(m) for m in metrics])
    long = wide.unpivot([AREA, "period", "at"], list(metrics), "metric", "value").withWatermark("at", lateness)
    end = dt.datetime.combine(first_month, dt.time()) + dt.timedelta(days=days)
    return long.groupBy(AREA, "metric").transformWithState(
        SpcProcessor(end, z), outputStructType=SCORED, outputMode="append", timeMode="EventTime")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """The state store that ``transformWithState`` needs, for the streams started inside."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
