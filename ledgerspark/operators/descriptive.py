"""Headline figures and rankings.

Rankings run on aggregated frames (vendors, areas), where a window without a
partition key is a handful of rows; the fact tables are only ever reduced by
one grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.rules import FINDINGS, line_count, lines_where, money_sum, overbilled, safe_div
from ledgerspark.functions.stats import average_rank

GHOST, DUPLICATE, OVERCHARGE, OK = FINDINGS


def audit_headline(audit: DataFrame) -> DataFrame:
    """Lines, flagged, flagged rate and recoverable amount, one row.

    recoverable = sum of positive variance over flagged lines + billed amount of
    ghost lines (ghost variance counts in both terms, as the reference does).
    `audit` is the audit's lines or their cube.
    """
    flagged = F.col("finding") != OK
    agg = audit.agg(
        line_count(audit).alias("lines"),
        lines_where(audit, flagged).alias("flagged"),
        F.coalesce(money_sum(F.when(flagged, overbilled(audit))),
                   F.lit(0.0)).alias("_pos_var"),
        F.coalesce(money_sum(F.when(F.col("finding") == GHOST, F.col("billed_amount"))),
                   F.lit(0.0)).alias("_ghost"))
    return agg.select("lines", "flagged",
                      safe_div(F.col("flagged").cast("double"), F.col("lines")).alias("flagged_rate"),
                      (F.col("_pos_var") + F.col("_ghost")).alias("recoverable"))


def vendor_rank(scorecard: DataFrame, by: str = "spend_per_incident") -> DataFrame:
    """Rank vendors by `by`, descending, ties share their average rank."""
    return scorecard.select("vendor", by, average_rank(by).alias("rank"))


def top_vendor(scorecard: DataFrame, by: str = "spend_per_incident") -> DataFrame:
    """The vendor with the highest `by` (ties: smallest vendor name). Top-1 per task, then merge."""
    return (scorecard.where(F.col(by).isNotNull())
                     .orderBy(F.col(by).desc(), F.col("vendor").asc()).limit(1)
                     .select("vendor", by))


def spend_trend(sam: DataFrame, areas: list[str] | None = None) -> DataFrame:
    """Period rows x one spend column per area.

    Without `areas` Spark finds the distinct areas itself and refuses more
    than ``spark.sql.pivotMaxValues`` of them, which bounds the width.
    """
    return sam.groupBy("period").pivot("service_area", areas).agg(F.sum("telecom_spend"))


def budget_variance_ranked(bv: DataFrame) -> DataFrame:
    """Budget variance ordered by variance_pct with an over-budget flag."""
    w = Window.orderBy(F.col("variance_pct").asc_nulls_last(), F.col("service_area"))
    return (bv.withColumn("over_budget", F.col("variance_pct") > 0)
              .withColumn("position", F.row_number().over(w))
              .orderBy("position"))


def kpi_summary(audit: DataFrame, spc: DataFrame, scorecard: DataFrame) -> DataFrame:
    """A4: the headline figures as (metric, value) rows, computed lazily."""
    h = audit_headline(audit)
    breaching = spc.agg(F.count_if(F.col("breach")).cast("double").alias("value"))
    top = scorecard.agg(F.max("spend_per_incident").alias("value"))
    def kv(name, col):
        return F.struct(F.lit(name).alias("metric"), F.col(col).cast("double").alias("value"))

    rows = h.select(F.inline(F.array(kv("lines_audited", "lines"), kv("flagged_lines", "flagged"),
                                     kv("flagged_rate", "flagged_rate"),
                                     kv("recoverable", "recoverable"))))
    return (rows.unionByName(breaching.select(F.lit("breaching_areas").alias("metric"), "value"))
                .unionByName(top.select(F.lit("top_vendor_spend_per_incident").alias("metric"),
                                        "value")))
