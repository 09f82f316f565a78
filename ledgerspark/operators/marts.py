"""Marts B1-B10: audit, monthly scorecard, budget, vendors, GL.

All of them are narrow projections or low-cardinality grouped aggregates, so
Spark aggregates map-side (partial aggregation) before any shuffle and the
exchanged data is one row per group per task, whatever the size of the
fact tables. Joins happen only *after* aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.rules import (DUPLICATE_RATIO, FINDINGS,
                                         OVERCHARGE_RATIO, decimal_sum,
                                         exact_avg, ladder, line_count, money_sum,
                                         round_decimal, safe_div)

AREA_MONTH = ["service_area", "period"]

# Fixed value: the GL account stamped on every telecom GL row.
GL_ACCOUNT = "6100-Telecom"


def invoice_audit(invoices: DataFrame, dup: float = DUPLICATE_RATIO,
                  over: float = OVERCHARGE_RATIO) -> DataFrame:
    """B1: variance and finding per invoice line (narrow, no shuffle)."""
    billed, contracted = F.col("billed_amount"), F.col("contracted_rate")
    return invoices.select(
        "invoice_id", "ci_id", "vendor", "service_area", "period", "contracted_rate",
        "billed_amount", "ci_status",
        (billed - contracted).alias("variance"),
        ladder(billed, contracted, F.col("ci_status"), FINDINGS, dup, over).alias("finding"),
    )


def monthly_spend_by_area(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy(*AREA_MONTH).agg(money_sum("billed_amount").alias("telecom_spend"))


def telemetry_monthly(telemetry: DataFrame) -> DataFrame:
    """Telemetry averages per (area, month): the rollup B2 joins."""
    return (telemetry.groupBy(*AREA_MONTH)
                     .agg(exact_avg("uptime_pct").alias("uptime"),
                          exact_avg("packet_loss_pct").alias("packet_loss"),
                          exact_avg("latency_ms").alias("latency"),
                          exact_avg("mtbf_hours").alias("mtbf")))


def service_area_monthly(invoices: DataFrame, incidents: DataFrame,
                         telemetry: DataFrame | None = None,
                         telemetry_rollup: DataFrame | None = None) -> DataFrame:
    """B2: spend LEFT JOIN incident stats LEFT JOIN telemetry at (area, month).

    Months without spend are dropped; incident counts and cost default to 0,
    the MTTR average and telemetry stay NULL, cost per incident is NULL when
    a month has no incidents. `telemetry_rollup` (``telemetry_monthly``
    output, for example built while the invoices are still loading) may
    replace the raw telemetry.
    """
    spend = monthly_spend_by_area(invoices)
    inc = (incidents.groupBy("service_area", F.col("opened").alias("period"))
                    .agg(F.count(F.lit(1)).alias("incidents"),
                         exact_avg("mttr_hours").alias("avg_mttr"),
                         money_sum("cost_to_resolve", 4).alias("incident_cost")))
    tel = telemetry_rollup if telemetry_rollup is not None else telemetry_monthly(telemetry)
    j = spend.join(inc, AREA_MONTH, "left").join(tel, AREA_MONTH, "left")
    return j.select(
        "service_area", "period", "telecom_spend",
        F.coalesce(F.col("incidents"), F.lit(0)).cast("long").alias("incidents"),
        "avg_mttr",
        F.coalesce(F.col("incident_cost"), F.lit(0.0)).alias("incident_cost"),
        "uptime", "packet_loss", "latency", "mtbf",
        safe_div(F.col("telecom_spend"), F.col("incidents")).alias("cost_per_incident"),
    )


def budget_variance(invoices: DataFrame, budget: DataFrame) -> DataFrame:
    """Actual spend per area against its annual budget (inner join)."""
    actual = invoices.groupBy("service_area").agg(money_sum("billed_amount").alias("actual_spend"))
    j = budget.select("service_area", "annual_budget").join(actual, "service_area", "inner")
    var = F.col("actual_spend") - F.col("annual_budget")
    return j.select("service_area", "annual_budget", "actual_spend", var.alias("variance"),
                    safe_div(var, F.col("annual_budget")).alias("variance_pct"))


def _vendor_parts(incidents: DataFrame, invoices: DataFrame):
    inv = invoices.groupBy("vendor").agg(money_sum("billed_amount").alias("_spend"))
    inc = incidents.groupBy("vendor").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.countDistinct("incident_id").alias("incidents"),
        exact_avg("mttr_hours").alias("avg_mttr"))
    return inc.join(inv, "vendor", "inner")


def vendor_scorecard(incidents: DataFrame, invoices: DataFrame) -> DataFrame:
    """The scorecard as the mart defines it (incidents JOIN invoices USING vendor).

    The m:n join repeats every invoice once per incident row of its vendor,
    so the joined sum equals (vendor spend) x (vendor incident rows). We
    aggregate each side first and multiply: one row per vendor is joined
    instead of |incidents| x |invoices| rows. AVG and COUNT DISTINCT are not
    changed by the repetition.
    """
    j = _vendor_parts(incidents, invoices)
    total = F.col("_spend") * F.col("_rows")
    return j.select("vendor", total.alias("total_spend"), "incidents", "avg_mttr",
                    safe_div(total, F.col("incidents")).alias("spend_per_incident"))


def vendor_scorecard_corrected(incidents: DataFrame, invoices: DataFrame) -> DataFrame:
    """Vendor spend / vendor incident count, without the fan-out."""
    j = _vendor_parts(incidents, invoices)
    return j.select("vendor", F.col("_spend").alias("total_spend"), "incidents", "avg_mttr",
                    safe_div(F.col("_spend"), F.col("incidents")).alias("spend_per_incident"))


def gl_rollup(invoices: DataFrame, account: str = GL_ACCOUNT) -> DataFrame:
    """GL rows per (area, month); cost centre = zero-based code of the area name."""
    g = invoices.groupBy(*AREA_MONTH).agg(money_sum("billed_amount").alias("amount"))
    # Codes are ranks over the *distinct* areas only (a handful of rows), so
    # the un-partitioned window never sees the facts.
    codes = (g.select("service_area").distinct()
              .withColumn("_code", F.dense_rank().over(Window.orderBy("service_area")) - 1))
    return (g.join(codes, "service_area", "inner")
             .select("service_area", "period", "amount",
                     F.concat(F.lit("CC-"), F.lpad(F.col("_code").cast("string"), 3, "0"))
                      .alias("cost_center"),
                     F.lit(account).alias("gl_account")))


def budget_rollup(cmdb: DataFrame, months: int = 12, uplift: float = 1.05) -> DataFrame:
    """budget = sum of monthly cost of active CIs x months x uplift."""
    return (cmdb.where(F.col("status") == "Active")
                .groupBy("service_area")
                .agg(round_decimal(money_sum("monthly_cost"), months * uplift).alias("annual_budget")))


def gl_reconciliation(gl: DataFrame, invoices: DataFrame) -> DataFrame:
    """GL amount against invoice spend per (area, month), full outer."""
    g = gl.groupBy(*AREA_MONTH).agg(money_sum("amount").alias("gl_amount"))
    s = monthly_spend_by_area(invoices).withColumnRenamed("telecom_spend", "invoice_spend")
    j = g.join(s, AREA_MONTH, "full_outer")
    return j.select("service_area", "period", "gl_amount", "invoice_spend",
                    (F.coalesce(F.col("gl_amount"), F.lit(0.0))
                     - F.coalesce(F.col("invoice_spend"), F.lit(0.0))).alias("difference"))


def spend_rollup(invoices: DataFrame) -> DataFrame:
    """Billed and contracted sums and line counts per (area, month, vendor), of lines or their cube.

    It has the columns of an invoice table that sums by area, month or vendor
    read, so B2-B6, B8 and B9 can take it in place of the lines. The sums stay
    DECIMALs of the input's digits: only the marts round.
    """
    return invoices.groupBy(*AREA_MONTH, "vendor").agg(
        decimal_sum("billed_amount").alias("billed_amount"),
        decimal_sum("contracted_rate").alias("contracted_rate"), line_count(invoices).alias("lines"))


def vendor_spend(invoices: DataFrame) -> DataFrame:
    """Total billed and lines per vendor, from lines or from `spend_rollup`."""
    return invoices.groupBy("vendor").agg(money_sum("billed_amount").alias("total_spend"),
                                          line_count(invoices).alias("invoice_lines"))


def incident_volume(incidents: DataFrame, ts: str | None = None, unit: str = "week") -> DataFrame:
    """Incident count and mean MTTR per area on a weekly (or other) cadence.

    `ts` is the time column: by default `opened_at`, or `opened` where the
    source keeps only that.
    """
    ts = ts or ("opened_at" if "opened_at" in incidents.columns else "opened")
    bucket = F.date_trunc(unit, F.col(ts)).cast("date").alias("period")
    return (incidents.groupBy("service_area", bucket)
                     .agg(F.count(F.lit(1)).alias("incidents"),
                          exact_avg("mttr_hours").alias("avg_mttr")))
