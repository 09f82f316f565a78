"""Learnt triage thresholds: exact against every possible split, better than the rules where these are off, odd lines."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerspark.functions.stats import suffix_sums
from ledgerspark.operators import learned as L
from ledgerspark.operators import triage as H

INV = "contracted_rate double, billed_amount double, ci_status string, planted_error string"


def made(seed, n, dup=2.4, over=1.3, noise=0.1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        r = rng.choice([1.0, 1.05, 1.2, 1.31, 1.7, 2.2, 2.41, 2.5, 3.0, rng.uniform(0.5, 3.5)])
        truth = "duplicate" if r >= dup else "rate_overcharge" if r >= over else "none"
        truth = rng.choice(["duplicate", "none", "", None, "rate_overcharge"]) if rng.random() < noise else truth
        rows.append((100.0, 100.0 * r, rng.choice(["Active", "Active", None, "Decommissioned"]), truth))
    return rows + [(0.0, 5.0, "Active", "duplicate"), (None, 5.0, "Active", "none"), (100.0, None, "Active", "duplicate")]


def learn(lines):
    return L.learn_thresholds(L.ratio_counts(lines))


def brute(rows):
    lines = [(b / c, t) for c, b, s, t in rows if s != "Decommissioned" and c and b is not None]

    def best(lines, label):
        total = sum(t == label for _, t in lines)
        if not total:
            return None, None
        scored = [(2.0 * sum(t == label for r, t in lines if r >= x) / (sum(r >= x for r, _ in lines) + total), -x) for x in {r for r, _ in lines}]
        f1, x = max(scored)
        return -x, f1

    dup = best(lines, "duplicate")
    return {"duplicate": dup, "rate_overcharge": best([x for x in lines if dup[0] is None or x[0] < dup[0]], "rate_overcharge")}


@pytest.mark.parametrize("seed,n", [(1, 400), (2, 60), (3, 1500)])
def test_equals_every_split(spark, seed, n):
    rows = made(seed, n)
    got = learn(H.with_truth(spark.createDataFrame(rows, INV).repartition(5))).collect()
    assert {r.label: (r.threshold, r.f1) for r in got} == brute(rows)


def test_better_than_the_rules_on_other_lines(spark):
    train, later = (H.with_truth(spark.createDataFrame(made(s, 2000, noise=0.02), INV)) for s in (5, 6))
    learnt = L.learned_classifier(learn(train))
    f1 = {name: {r.label: r.f1 for r in H.triage_eval(H.classify(later, c)).collect()} for name, c in (("rules", None), ("learnt", learnt))}
    for label in ("duplicate", "rate_overcharge", "none"):
        assert f1["learnt"][label] > f1["rules"][label] + 0.02, label


def test_labels_that_never_occur(spark):
    lines = H.with_truth(spark.createDataFrame([(10.0, 10.0 * k, "Active", None) for k in range(1, 5)], INV))
    thresholds = learn(lines)
    assert {(r.label, r.threshold, r.f1) for r in thresholds.collect()} == {("duplicate", None, None), ("rate_overcharge", None, None)}
    assert {r.predicted for r in H.classify(lines, L.learned_classifier(thresholds)).collect()} == {"none"}
    empty = learn(lines.limit(0)).collect()
    assert {(r.threshold, r.lines) for r in empty} == {(None, 0)}


def test_lines_without_a_ratio_follow_the_rules(spark):
    df = H.with_truth(spark.createDataFrame([(0.0, 5.0, "Active", None), (0.0, 5.0, "Decommissioned", None), (None, 5.0, "Active", None)], INV))
    c = L.learned_classifier(learn(H.with_truth(spark.createDataFrame(made(1, 50), INV))))
    assert [r.predicted for r in H.classify(df, c).collect()] == [r.predicted for r in H.classify(df).collect()]


def test_suffix_sums(spark):
    rng = random.Random(8)
    values = {round(rng.gauss(0, 3), 2): rng.randint(0, 9) for _ in range(500)}
    df = spark.createDataFrame(list(values.items()), "v double, n long").repartition(7)
    for buckets in (1, 4, 64):
        got = {r.v: r.n for r in suffix_sums(df, "v", ["n"], buckets).collect()}
        assert got == {v: sum(n for w, n in values.items() if w >= v) for v in values}
    assert suffix_sums(df.limit(0), "v", ["n"]).count() == 0
    assert suffix_sums(df.withColumn("v", F.lit(1.0)).groupBy("v").agg(F.sum("n").alias("n")), "v", ["n"]).first().n == sum(values.values())
