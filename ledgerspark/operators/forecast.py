"""Spend forecast (F1-F8): OLS trend, point forecast, Monte Carlo band.

Every step takes `keys`: with no keys there is one global series, with
``keys=["service_area"]`` every area is fitted in the same job. Fits use
the built-in ``regr_slope``/``regr_intercept`` aggregates, so each series is
reduced by a grouped aggregate, never collected. Monte Carlo paths are
generated per (series, month) row with ``explode(sequence(...))`` and draws
are a pure function of (sim, month, series, seed), so results do not depend
on partitioning or on which task recomputes them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.rules import money_sum
from ledgerspark.functions.stats import hashed_normal

# Fixed value: the 90th percentile of the standard normal (for a P10-P90 band).
Z90 = 1.2815515655446004


def _attach(df: DataFrame, per_series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach per-series values: a join on the keys, or scalar subqueries for one series."""
    if keys:
        return df.join(per_series, list(keys), "inner")
    one = per_series.select(F.struct(*per_series.columns).alias("_v")).scalar()  # one subquery
    return df.withColumn("_v", one).select(*df.columns, "_v.*")


def monthly_spend(sam: DataFrame, keys: Sequence[str] = (), value: str = "telecom_spend") -> DataFrame:
    """spend per (keys, period) and t = 0-based position in period order."""
    g = sam.groupBy(*keys, "period").agg(money_sum(value).alias("spend"))
    w = Window.partitionBy(*keys).orderBy("period")   # months per series: aggregated rows
    return g.withColumn("t", F.row_number().over(w) - 1)


def trend_fit(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """slope b1, intercept b0, population std of residuals, n, last period."""
    fit = series.groupBy(*keys).agg(
        F.regr_slope("spend", "t").alias("b1"),
        F.regr_intercept("spend", "t").alias("b0"),
        F.count(F.lit(1)).alias("n"),
        F.max("period").alias("last_period"))
    resid = (_attach(series, fit, keys)
             .groupBy(*keys)
             .agg(F.stddev_pop(F.col("spend") - (F.col("b0") + F.col("b1") * F.col("t")))
                  .alias("resid_std")))
    return _attach(fit, resid, keys)


def forecast_point(fit: DataFrame, horizon: int = 6, keys: Sequence[str] = ()) -> DataFrame:
    """b0 + b1 * t for the next `horizon` month starts."""
    f = fit.select(*keys, "b0", "b1", "n", "last_period", "resid_std",
                   F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    t = F.col("n") - 1 + F.col("h")
    return f.select(*keys, "h", F.add_months("last_period", F.col("h")).alias("period"),
                    t.alias("t"), (F.col("b0") + F.col("b1") * t).alias("point"), "resid_std")


def simulate_paths(points: DataFrame, sims: int = 5000, seed: int = 11,
                   keys: Sequence[str] = ()) -> DataFrame:
    """(keys, h, sim, value): point + resid_std * N(0, 1), independent per month."""
    series_key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
    # Spread the (series, month) seeds over tasks before each explodes `sims` rows. The
    # partition count is explicit: AQE would otherwise merge this tiny frame into one
    # task, and every path of every series would be generated there.
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    p = points.repartition(n, *[F.col(k) for k in keys], F.col("h"))
    p = p.select(*keys, "h", "period", "point", "resid_std",
                 F.explode(F.sequence(F.lit(0), F.lit(sims - 1))).alias("sim"))
    key = F.concat_ws("|", F.col("sim").cast("string"), F.col("h").cast("string"), series_key,
                      F.lit(str(seed)))
    return p.withColumn("value", F.col("point") + F.col("resid_std") * hashed_normal(key))


def forecast_monte_carlo(points: DataFrame, sims: int = 5000, seed: int = 11,
                         keys: Sequence[str] = (), quantiles=(0.1, 0.5, 0.9)) -> DataFrame:
    """P10/P50/P90 per future month (exact, linear interpolation).

    Each (series, month) group holds exactly `sims` values: the exact
    percentile buffer is bounded by the simulation count, not by the data.
    """
    paths = simulate_paths(points, sims, seed, keys)
    q = paths.groupBy(*keys, "h", "period").agg(
        F.max("point").alias("point"),
        F.percentile("value", list(quantiles)).alias("_q"))
    names = [f"p{int(round(x * 100))}" for x in quantiles]
    return q.select(*keys, "h", "period", "point",
                    *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def next_quarter(points: DataFrame, months: int = 3, sims: int = 5000, seed: int = 11,
                 keys: Sequence[str] = ()) -> DataFrame:
    """point sum of the first `months` months; P10/P90 and min of per-sim sums."""
    paths = simulate_paths(points.where(F.col("h") <= months), sims, seed, keys)
    per_sim = paths.groupBy(*keys, "sim").agg(F.sum("value").alias("q"),
                                              F.sum("point").alias("pq"))
    return per_sim.groupBy(*keys).agg(
        F.max("pq").alias("point"),
        F.percentile("q", 0.1).alias("p10"),
        F.percentile("q", 0.9).alias("p90"),
        F.min("q").alias("sim_min"))


def forecast_closed_form(points: DataFrame, months: int = 3, z: float = Z90,
                         keys: Sequence[str] = ()) -> DataFrame:
    """exact normal band, point +/- z * sigma * sqrt(k), per month and for the quarter."""
    monthly = points.select(*keys, F.lit("month").alias("span"), "h", "period", "point",
                            (F.col("point") - z * F.col("resid_std")).alias("p10"),
                            (F.col("point") + z * F.col("resid_std")).alias("p90"))
    band = z * (months ** 0.5)
    q = (points.where(F.col("h") <= months).groupBy(*keys)
               .agg(F.sum("point").alias("point"), F.max("resid_std").alias("_s"),
                    F.max("period").alias("period")))
    quarter = q.select(*keys, F.lit("next_quarter").alias("span"), F.lit(months).alias("h"),
                       "period", "point", (F.col("point") - band * F.col("_s")).alias("p10"),
                       (F.col("point") + band * F.col("_s")).alias("p90"))
    return monthly.unionByName(quarter)


def forecast_accuracy(series: DataFrame, holdout: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """fit on all but the last `holdout` months, score 1 - |F - A| / A on them."""
    n = F.max("t").over(Window.partitionBy(*keys)) + 1   # months per series (aggregated rows)
    s = series.withColumn("_n", n)
    train = s.where(F.col("t") < F.col("_n") - holdout).drop("_n")
    test = s.where(F.col("t") >= F.col("_n") - holdout).select(*keys, "t", F.col("spend").alias("actual"))
    pts = forecast_point(trend_fit(train, keys), holdout, keys)
    j = pts.join(test, list(keys) + ["t"], "inner")
    acc = 1 - F.abs(F.col("forecast") - F.col("actual")) / F.nullif(F.col("actual"), F.lit(0.0))
    monthly = j.select(*keys, F.lit("month").alias("span"), "h", "period", "actual",
                       F.col("point").alias("forecast")).withColumn("accuracy", acc)
    tot = (j.groupBy(*keys).agg(F.sum("actual").alias("actual"), F.sum("point").alias("forecast"),
                                F.max("period").alias("period"))
             .select(*keys, F.lit("holdout").alias("span"), F.lit(holdout).alias("h"), "period",
                     "actual", "forecast").withColumn("accuracy", acc))
    return monthly.unionByName(tot)


def rolling_backtest(series: DataFrame, min_train: int = 12, horizon: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """F7 from every origin: (keys, origin, h, period, actual, forecast, accuracy).

    The origin is the last month of a fit on all months up to it, `min_train`
    at least. Regression moments are sums, so one pass of prefix sums gives the
    fits of all origins; nothing is fitted twice. Spend is summed as DECIMAL,
    and a month's place is counted from the first month, so the moments are exact.
    A month of zero spend has NULL accuracy; origins whose month h ahead is not
    in the series have no row for it.
    """
    upto = Window.partitionBy(*keys).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)   # months per series: aggregated rows
    y = F.col("spend").cast("decimal(20,4)")
    t = F.col("t").cast("decimal(10,0)")
    s = series.select(*keys, "period", "t", "spend", F.count(F.lit(1)).over(upto).alias("_n"),
                      *[F.sum(x).over(upto).cast("double").alias(c) for c, x in (("_t", t), ("_tt", t * t), ("_y", y), ("_ty", t * y))])
    n = F.col("_n").cast("double")
    b1 = (n * F.col("_ty") - F.col("_t") * F.col("_y")) / F.nullif(n * F.col("_tt") - F.col("_t") * F.col("_t"), F.lit(0.0))
    fits = s.where(F.col("_n") >= max(2, min_train)).select(*keys, F.col("period").alias("origin"), F.col("t").alias("_o"), b1.alias("_b1"),
                                                         ((F.col("_y") - b1 * F.col("_t")) / n).alias("_b0"))
    ahead = fits.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn("t", F.col("_o") + F.col("h"))
    j = ahead.join(series.select(*keys, "t", "period", F.col("spend").alias("actual")), [*keys, "t"])
    j = j.withColumn("forecast", F.col("_b0") + F.col("_b1") * F.col("t"))
    return j.select(*keys, "origin", "h", "period", "actual", "forecast",
                    (1 - F.abs(F.col("forecast") - F.col("actual")) / F.nullif(F.col("actual"), F.lit(0.0))).alias("accuracy"))


def backtest_summary(backtest: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, h, origins, mean and worst accuracy) of a backtest: how far ahead the trend can be trusted."""
    return backtest.groupBy(*keys, "h").agg(F.count("accuracy").alias("origins"), F.avg("accuracy").alias("mean_accuracy"),
                                            F.min("accuracy").alias("worst_accuracy"))


def forecast_by_area(sam: DataFrame, horizon: int = 6, key: str = "service_area") -> DataFrame:
    """F8: one trend per area, all areas fitted by the same grouped aggregate."""
    fit = trend_fit(monthly_spend(sam, [key]), [key])
    pts = forecast_point(fit, horizon, [key])
    return pts.join(fit.select(key, "b0", "b1"), key, "inner").select(
        key, "h", "period", "point", "b0", "b1", "resid_std")

