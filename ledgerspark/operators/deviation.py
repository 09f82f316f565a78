"""Statistical process control over the monthly scorecard.

A baseline (mean, sample std) is taken per area from the early rows, every
area's latest month is scored against it, and z > limit is a breach
(one-sided, strict; on the low side for uptime and time between failures). Everything is grouped by area (and metric), so the
work spreads over the keys; the only global values are the first month of
the scorecard, attached as a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AREA = "service_area"
METRICS = ("telecom_spend", "incidents", "avg_mttr", "incident_cost", "uptime", "packet_loss",
           "latency", "mtbf", "cost_per_incident")
# Metrics of which a low value is the bad one; any other breaches on the high side.
LOW_IS_BAD = ("uptime", "mtbf")


def _long(sam: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(area, period, metric, value) rows; `stack` is a narrow Expand."""
    wide = sam.select(AREA, "period", *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot([AREA, "period"], list(metrics), "metric", "value")


def spc_baseline_long(long: DataFrame, days: int = 90, start=None) -> DataFrame:
    """Baseline per (area, metric) over rows before `start` + `days` (start: the first
    period, as a scalar subquery over the long rows unless given)."""
    start = start if start is not None else long.select(F.min("period")).scalar()
    return (long.where(F.col("period") < F.date_add(start, days))
            .groupBy(AREA, "metric")
            .agg(F.avg("value").alias("baseline_mean"),
                 F.stddev_samp("value").alias("baseline_std"),
                 F.count("value").alias("baseline_n")))


def spc_baseline(sam: DataFrame, metric: str = "packet_loss", days: int = 90) -> DataFrame:
    """Per-area baseline over rows with period < first period + `days`."""
    return spc_baseline_long(_long(sam, [metric]), days, sam.select(F.min("period")).scalar())


def latest_per_area(sam: DataFrame, keys: Sequence[str] = (AREA,), order: str = "period") -> DataFrame:
    """The row with the greatest `order` per key (max_by: partial-aggregable, no sort)."""
    others = [c for c in sam.columns if c not in keys]
    return (sam.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order)).alias("_r"))
               .select(*keys, "_r.*"))


def z_and_breach(value: Column, metric: Column, z: float, mean: str = "baseline_mean",
                 std: str = "baseline_std") -> tuple[Column, Column]:
    """(z, breach) of a value against its baseline, for batch and stream alike.

    One-sided and strict, on the side that is bad for the metric. Without
    spread in the baseline z is NULL and any step to the bad side is a breach.
    """
    side = F.when(metric.isin(*LOW_IS_BAD), F.lit(-1.0)).otherwise(F.lit(1.0))
    zc = (value - F.col(mean)) / F.nullif(F.col(std), F.lit(0.0))
    over = F.when(F.col(std) == 0, (value - F.col(mean)) * side > 0).otherwise(zc * side > z)
    return zc, F.coalesce(over, F.lit(False))


def _score(base: DataFrame, latest: DataFrame, z: float) -> DataFrame:
    j = base.join(latest, [AREA, "metric"], "left")
    zc, breach = z_and_breach(F.col("latest"), F.col("metric"), z)
    return j.select(AREA, "metric", "baseline_mean", "baseline_std", "baseline_n", "latest",
                    zc.alias("z"), breach.alias("breach"))


def spc_all_metrics(sam: DataFrame, metrics: Sequence[str] = METRICS, z: float = 3.0,
                    days: int = 90) -> DataFrame:
    """C6 (and C4 for one metric): baseline, latest value, z and breach per (area, metric)."""
    long = _long(sam, metrics)
    base = spc_baseline_long(long, days, sam.select(F.min("period")).scalar())
    latest = long.groupBy(AREA, "metric").agg(F.max_by("value", "period").alias("latest"))
    return _score(base, latest, z)


def spc_deviation(sam: DataFrame, metric: str = "packet_loss", z: float = 3.0,
                  days: int = 90) -> DataFrame:
    """C4: one metric; areas come from the baseline, latest joined on the left."""
    return spc_all_metrics(sam, [metric], z, days)


def spc_history(sam: DataFrame, metrics: Sequence[str] = METRICS, z: float = 3.0, days: int = 90) -> DataFrame:
    """C6 for every month after the baseline, not the latest alone: (area, metric, period, value, baseline, z, breach).

    The batch answer to the alert stream: areas and metrics without a baseline have no rows.
    """
    long = _long(sam, metrics)
    start = sam.select(F.min("period")).scalar()
    base = spc_baseline_long(long, days, start)
    j = long.where(F.col("period") >= F.date_add(start, days)).join(base.where("baseline_n > 0"), [AREA, "metric"])
    zc, breach = z_and_breach(F.col("value"), F.col("metric"), z)
    return j.select(AREA, "metric", "period", "value", "baseline_mean", "baseline_std", "baseline_n", zc.alias("z"), breach.alias("breach"))


def control_chart(sam: DataFrame, metric: str = "packet_loss", z: float = 3.0,
                  days: int = 90) -> DataFrame:
    """Full series of the area with the highest z, with mean and upper limit.

    A NULL z never wins; ties go to the smallest area name. The winner is one
    row, joined back on the area.
    """
    dev = spc_deviation(sam, metric, z, days).where(F.col("z").isNotNull())
    top = dev.orderBy(F.col("z").desc(), F.col(AREA).asc()).limit(1).select(AREA, "baseline_mean", "baseline_std")
    series = sam.select(AREA, "period", F.col(metric).cast("double").alias("value"))
    ucl = F.col("baseline_mean") + F.col("baseline_std") * z
    return (series.join(top, AREA, "inner")
                  .select(AREA, "period", "value", F.col("baseline_mean").alias("mean"),
                          ucl.alias("ucl"), (F.col("value") > ucl).alias("above_ucl")))
