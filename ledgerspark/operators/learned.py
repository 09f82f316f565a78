"""A triage classifier whose thresholds are learnt from labelled lines (the second one beside the rules).

The ladder keeps its order - decommissioned, duplicate, overcharge - but its two
ratios come from the data: the duplicate threshold is the billed / contracted
ratio that gives the best F1 for `duplicate`, the overcharge threshold the best
one for `rate_overcharge` among the ratios below. The search is exact: lines
collapse to distinct ratios, prefix sums over the ordered ratios give every
threshold's true and false positives, and no task holds all ratios.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.rules import DECOMMISSIONED, LABELS, ladder
from ledgerspark.functions.stats import suffix_sums
from ledgerspark.operators.triage import Classifier

GHOST, DUPLICATE, OVERCHARGE, NONE = LABELS


def ratio() -> Column:
    """Billed over contracted; NULL without a contracted amount."""
    return F.col("billed_amount") / F.nullif(F.col("contracted_rate"), F.lit(0.0))


def _best_split(per_ratio: DataFrame, positive: str) -> DataFrame:
    """(threshold, f1, lines), one row: `ratio >= threshold` with the best F1 (ties: the smallest); NULLs without positives."""
    total = per_ratio.agg(F.sum(positive)).scalar()
    above = suffix_sums(per_ratio, "_r", ["_n", positive])
    f1 = F.when(total > 0, 2.0 * F.col(positive) / (F.col("_n") + total))
    # a maximum of structs is merged like a sum: no order over all thresholds
    best = above.where(f1.isNotNull()).agg(F.max(F.struct(f1.alias("f1"), (-F.col("_r")).alias("r"))).alias("b"),
                                           F.max("_n").alias("lines"))
    return best.select((-F.col("b.r")).alias("threshold"), F.col("b.f1").alias("f1"), F.coalesce("lines", F.lit(0)).alias("lines"))


def ratio_counts(lines: DataFrame) -> DataFrame:
    """A row for each ratio: lines, duplicates and overcharges among them, from lines with `truth`.

    Decommissioned lines and lines without a ratio teach nothing. The search reads this several times: stage it
    where lines are many.
    """
    open_lines = lines.where((F.col("ci_status") != DECOMMISSIONED) | F.col("ci_status").isNull()).select(ratio().alias("_r"), "truth")
    return open_lines.where(F.col("_r").isNotNull()).groupBy("_r").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("truth") == DUPLICATE).alias("_dup"),
        F.count_if(F.col("truth") == OVERCHARGE).alias("_over"))


def learn_thresholds(per_ratio: DataFrame) -> DataFrame:
    """(label, threshold, f1, lines) of `duplicate` and `rate_overcharge`, from `ratio_counts`.

    `lines` is how many lines the search was over. A label that never occurs has a NULL threshold.
    """
    dup = _best_split(per_ratio, "_dup")
    cut = dup.select("threshold").scalar()
    over = _best_split(per_ratio.where(cut.isNull() | (F.col("_r") < cut)), "_over")
    return dup.select(F.lit(DUPLICATE).alias("label"), "*").unionByName(over.select(F.lit(OVERCHARGE).alias("label"), "*"))


def learned_classifier(thresholds: DataFrame) -> Classifier:
    """The ladder with learnt thresholds, as scalar subqueries: what is learnt stays in the plan.

    A NULL threshold never fires. Lines without a ratio are judged by the rules.
    """
    def at(label: str) -> Column:
        return thresholds.where(F.col("label") == label).agg(F.max("threshold")).scalar()

    def classify(df: DataFrame) -> DataFrame:
        r = ratio()
        rules = ladder(F.col("billed_amount"), F.col("contracted_rate"), F.col("ci_status"), LABELS)
        return df.withColumn("predicted", F.when(r.isNull(), rules).when(F.col("ci_status") == DECOMMISSIONED, GHOST)
                                           .when(r >= at(DUPLICATE), DUPLICATE).when(r >= at(OVERCHARGE), OVERCHARGE).otherwise(NONE))

    return classify
