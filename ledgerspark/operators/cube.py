"""The audit cube: every figure over invoice lines that adds up, by the columns it is asked by.

One grouped aggregate over the lines, a row per area, month, vendor, finding,
truth and prediction: DECIMAL sums of the input's digits and a line count. The
headline, the bridge, the triage evaluation, the checks and the spend rollup
read it in place of the lines. Sums of its sums are the sums over the lines,
to the digit, so nothing depends on which of the two an operator is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.rules import FINDINGS, decimal_sum, ladder
from ledgerspark.operators.triage import Classifier, classify, with_truth

CUBE_KEYS = ("service_area", "period", "vendor", "finding", "truth", "predicted")


def audit_cube(invoices: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """Lines, billed, contracted and overbilled sums by `CUBE_KEYS`; NULL keys are keys.

    `over` sums what each line bills above its contract (0 where it bills less).
    """
    billed, contracted = F.col("billed_amount"), F.col("contracted_rate")
    lines = with_truth(classify(invoices, classifier)).withColumn(
        "finding", ladder(billed, contracted, F.col("ci_status"), FINDINGS))
    return lines.groupBy(*CUBE_KEYS).agg(
        F.count(F.lit(1)).alias("lines"),
        decimal_sum(billed).alias("billed_amount"), decimal_sum(contracted).alias("contracted_rate"),
        decimal_sum(F.greatest(billed - contracted, F.lit(0.0))).alias("over"))
