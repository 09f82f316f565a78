"""Invoice triage and its evaluation (H1-H7).

The classifier is the audit ladder with machine labels, written as a column
expression (no Python UDF); any ``DataFrame -> DataFrame`` that adds a
``predicted`` column can replace it. Evaluation reduces the lines to a
confusion matrix (at most labels x labels rows) with one grouped aggregate,
and every metric is computed from that matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.rules import DECOMMISSIONED, EVAL_LABELS, FINDINGS, LABELS, ladder, line_count, lines_where, safe_div
from ledgerspark.functions.text import dollars

Classifier = Callable[[DataFrame], DataFrame]
GHOST, DUPLICATE, OVERCHARGE, NONE = LABELS


def rule_classifier(df: DataFrame) -> DataFrame:
    return df.withColumn("predicted", ladder(F.col("billed_amount"), F.col("contracted_rate"),
                                             F.col("ci_status"), LABELS))


def classify(df: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """H1: add `predicted` with the rule ladder (or a supplied classifier)."""
    return (classifier or rule_classifier)(df)


def note(pred: str = "predicted") -> F.Column:
    """H2: one sentence per label with amounts as $#,##0."""
    billed, contracted = F.col("billed_amount"), F.col("contracted_rate")
    b, c, o = dollars(billed), dollars(contracted), dollars(billed - contracted)
    p = F.col(pred)
    # Note templates per label (amounts spliced in as $#,##0).
    return (F.when(p == GHOST, F.concat(
                F.lit("Circuit "), F.col("ci_id").cast("string"),
                F.lit(" is decommissioned but billed "), b,
                F.lit(". Action: dispute as a ghost circuit and reclaim "), b, F.lit(".")))
             .when(p == DUPLICATE, F.concat(
                F.lit("Billed "), b, F.lit(" vs contracted "), c,
                F.lit(" (~2x). Action: flag duplicate charge; recover "), o, F.lit(".")))
             .when(p == OVERCHARGE, F.concat(
                F.lit("Billed "), b, F.lit(" exceeds contracted "), c, F.lit(" by "), o,
                F.lit(". Action: request rate correction and credit.")))
             .otherwise(F.lit("Within contract terms; no action.")))


def triage_notes(classified: DataFrame) -> DataFrame:
    return classified.select("invoice_id", "predicted", note().alias("note"))


def with_truth(classified: DataFrame, truth: DataFrame | None = None,
               truth_col: str = "planted_error", id_col: str = "invoice_id") -> DataFrame:
    """Attach the normalised truth label ('' or NULL -> none).

    When the truth sits in another table it is joined on the id (inner, as
    the reference merges); when the classified frame already carries it no
    join (and no shuffle of the facts) is needed.
    """
    df = classified
    if truth is not None:
        df = df.drop(truth_col).join(truth.select(id_col, truth_col), id_col, "inner")
    t = F.col(truth_col)
    return df.withColumn("truth", F.when(t.isNull() | (t == ""), F.lit(NONE)).otherwise(t))


def triage_confusion(df: DataFrame) -> DataFrame:
    """H4: (truth, predicted, n) of classified lines or their cube; at most 16 rows per task are shuffled."""
    return df.groupBy("truth", "predicted").agg(line_count(df).alias("n"))


def triage_eval(df: DataFrame, labels: Sequence[str] = EVAL_LABELS) -> DataFrame:
    """H3: TP, FP, FN, precision, recall, F1 per label; every label present, 0 for 0/0."""
    cm = triage_confusion(df)
    lab = cm.select("*", F.explode(F.array(*[F.lit(x) for x in labels])).alias("label"))
    t, p, n, L = F.col("truth"), F.col("predicted"), F.col("n"), F.col("label")
    agg = lab.groupBy("label").agg(
        F.sum(F.when((p == L) & (t == L), n).otherwise(0)).alias("tp"),
        F.sum(F.when((p == L) & (t != L), n).otherwise(0)).alias("fp"),
        F.sum(F.when((p != L) & (t == L), n).otherwise(0)).alias("fn"))
    # The label vocabulary itself, so a label absent from the data still reports zeros.
    vocab = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(x) for x in labels])).alias("label"))
    m = vocab.join(agg, "label", "left").na.fill(0, ["tp", "fp", "fn"])
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    m = m.select("label", F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
                 F.col("fn").cast("long").alias("fn"), prec.alias("precision"), rec.alias("recall"))
    pr, rc = F.col("precision"), F.col("recall")
    return m.withColumn("f1", F.when(pr + rc > 0, 2 * pr * rc / (pr + rc)).otherwise(0.0))


def triage_accuracy(df: DataFrame) -> DataFrame:
    """H5: share of lines whose prediction equals the truth."""
    right = lines_where(df, F.col("predicted") == F.col("truth"))
    n = line_count(df)
    return df.agg(safe_div(right.cast("double"), n).alias("accuracy"), n.alias("lines"))


def triage_sample(classified: DataFrame, n: int = 3, order: str = "invoice_id") -> DataFrame:
    """H6: the first `n` flagged lines by id, with notes (top-k per task, then merged)."""
    flagged = classified.where(F.col("predicted") != NONE)
    return (flagged.orderBy(order).limit(n)
                   .select("invoice_id", "predicted", note().alias("note")))


def _finding_counts(invoices: DataFrame, *keys: str) -> DataFrame:
    """(keys, before, n): lines by the finding that their own status gives.

    Another status changes a line's finding to ghost or not at all, so these
    counts are all that a re-audit needs: a CI that holds a third of the lines
    is a few rows before any join.
    """
    before = ladder(F.col("billed_amount"), F.col("contracted_rate"), F.col("ci_status"), FINDINGS)
    return invoices.groupBy(*keys, before.alias("before")).agg(F.count(F.lit(1)).alias("n"))


def _changes(judged: DataFrame) -> DataFrame:
    """(finding, n_invoice_status, n_cmdb_status, change) of (before, n, retired)."""
    after = F.when(F.col("retired"), F.lit(FINDINGS[0])).otherwise(F.col("before"))
    zero = F.lit(0).cast("long")
    both = judged.groupBy("before", after.alias("after")).agg(F.sum("n").alias("n")).select(F.inline(F.array(
        F.struct(F.col("before").alias("finding"), F.col("n").alias("b"), zero.alias("a")),
        F.struct(F.col("after").alias("finding"), zero.alias("b"), F.col("n").alias("a")))))
    g = both.groupBy("finding").agg(F.sum("b").alias("n_invoice_status"), F.sum("a").alias("n_cmdb_status"))
    return g.withColumn("change", F.col("n_cmdb_status") - F.col("n_invoice_status"))


def audit_cmdb_status(invoices: DataFrame, cmdb: DataFrame) -> DataFrame:
    """H7: re-audit with the CMDB's status (ghost if either record says decommissioned).

    A CI that the CMDB lists more than once counts once: it is decommissioned if any record says so.
    """
    retired = cmdb.groupBy("ci_id").agg(F.coalesce(F.max(F.col("status") == DECOMMISSIONED), F.lit(False)).alias("retired"))
    return _changes(_finding_counts(invoices, "ci_id").join(retired, "ci_id", "left").withColumn("retired", F.coalesce("retired", F.lit(False))))


def status_spans(history: DataFrame) -> DataFrame:
    """(ci_id, since, until, retired): the months for which a status holds, from (ci_id, status, valid_from).

    A status holds from the month of `valid_from` until the next record's month
    (`until` NULL: to the end). Of records of one month a decommissioning counts;
    records that repeat a status are merged; records without a date are left out.
    """
    month = F.trunc("valid_from", "month").alias("since")
    known = history.where(F.col("valid_from").isNotNull()).groupBy("ci_id", month).agg(
        F.coalesce(F.max(F.col("status") == DECOMMISSIONED), F.lit(False)).alias("retired"))
    of_ci = Window.partitionBy("ci_id").orderBy("since")   # at most a row a month
    turns = known.withColumn("_was", F.lag("retired").over(of_ci)).where(F.col("_was").isNull() | (F.col("_was") != F.col("retired")))
    return turns.select("ci_id", "since", F.lead("since").over(of_ci).alias("until"), "retired")


def audit_status_as_of(invoices: DataFrame, history: DataFrame) -> DataFrame:
    """H7 with the status of the invoice month: an as-of join over the status history.

    Months before a CI's first record, and CIs without any, keep the invoice's status.
    """
    spans = status_spans(history).withColumnRenamed("ci_id", "_ci")
    counts = _finding_counts(invoices, "ci_id", "period")
    held = (F.col("ci_id") == F.col("_ci")) & (F.col("period") >= F.col("since")) & (F.col("until").isNull() | (F.col("period") < F.col("until")))
    return _changes(counts.join(spans, held, "left").withColumn("retired", F.coalesce("retired", F.lit(False))))
