"""Cost driver bridge (D1-D3): contracted baseline -> actual total cost.

One conditional aggregate over the audit mart and one over incidents; the
incident total joins as a scalar subquery (one value), so there is no join
of facts and no window over facts. The running bar positions are plain
cumulative sums of five numbers in the single aggregated row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.rules import FINDINGS, money_sum, overbilled, safe_div

GHOST, DUPLICATE, OVERCHARGE, OK = FINDINGS

# Bridge step labels, in step order.
STEPS = ("Contracted baseline", "Rate overcharges", "Duplicate charges", "Ghost circuits",
         "Incident resolution", "Actual total cost")


def bridge_totals(audit: DataFrame, incidents: DataFrame) -> DataFrame:
    """The bridge's parts, one row. `audit` is the audit's lines or their cube."""
    finding, var = F.col("finding"), overbilled(audit)

    def s(x):
        return F.coalesce(money_sum(x), F.lit(0.0))

    inc = incidents.agg(F.coalesce(money_sum("cost_to_resolve", 4), F.lit(0.0))).scalar()
    a = audit.agg(
        s(F.when(finding != GHOST, F.col("contracted_rate"))).alias("baseline"),
        s(F.when(finding == OVERCHARGE, var)).alias("overcharges"),
        s(F.when(finding == DUPLICATE, var)).alias("duplicates"),
        s(F.when(finding == GHOST, F.col("billed_amount"))).alias("ghosts"),
        s(F.col("billed_amount")).alias("billed_total"))
    a = a.withColumn("incident_cost", inc)
    return a.withColumn("total", F.col("baseline") + F.col("overcharges") + F.col("duplicates")
                        + F.col("ghosts") + F.col("incident_cost"))


def cost_bridge(audit: DataFrame, incidents: DataFrame) -> DataFrame:
    """(step_no, step, amount, bar_start, bar_end); first and last bars start at 0."""
    t = bridge_totals(audit, incidents)
    c1 = F.col("baseline")
    c2 = c1 + F.col("overcharges")
    c3 = c2 + F.col("duplicates")
    c4 = c3 + F.col("ghosts")
    c5 = c4 + F.col("incident_cost")
    amounts = ["baseline", "overcharges", "duplicates", "ghosts", "incident_cost", "total"]
    starts = [F.lit(0.0), c1, c2, c3, c4, F.lit(0.0)]
    ends = [c1, c2, c3, c4, c5, F.col("total")]
    rows = [F.struct(F.lit(i + 1).alias("step_no"), F.lit(STEPS[i]).alias("step"),
                     F.col(amounts[i]).alias("amount"), starts[i].alias("bar_start"),
                     ends[i].alias("bar_end")) for i in range(6)]
    return t.select(F.inline(F.array(*rows)))


def controllable_overbilling(audit: DataFrame, incidents: DataFrame) -> DataFrame:
    """Overcharges + duplicates + ghosts, and their share of the total cost."""
    t = bridge_totals(audit, incidents)
    c = F.col("overcharges") + F.col("duplicates") + F.col("ghosts")
    return t.select(c.alias("controllable"), F.col("total").alias("total_cost"),
                    safe_div(c, F.col("total")).alias("share"))


def bridge_unexplained(audit: DataFrame, incidents: DataFrame) -> DataFrame:
    """D3: billed + incident cost - bridge total (what the bridge leaves out)."""
    t = bridge_totals(audit, incidents)
    return t.select("billed_total", "incident_cost", F.col("total").alias("bridge_total"),
                    (F.col("billed_total") + F.col("incident_cost") - F.col("total"))
                    .alias("unexplained"))
