"""Goldens: the facts FIXTURES.md section 3 reports for the sf0.01 fixture views."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q():
    return queries()


def test_audit_and_scorecard_facts(spark, q):
    assert q["audit_headline"](spark, SF).collect()[0].flagged == 47_770
    sam = q["service_area_monthly"](spark, SF)
    assert sam.count() == 498 and sam.where("incidents = 0").count() == 22
    src = dict((r.source, r.rows) for r in q["source_profile"](spark, SF).collect())
    assert (src["cmdb"], src["invoices"], src["incidents"], src["telemetry"]) == (2000, 60000, 15000, 60000)


def test_deviation_budget_and_bridge_facts(spark, q):
    dev = q["spc_deviation"](spark, SF).collect()
    assert sum(r.breach for r in dev) == 2
    assert round(min(r.z for r in dev if r.z is not None), 2) == -3.59       # one-sided: no breach
    bv = q["budget_variance"](spark, SF).collect()
    assert (sum(r.variance > 0 for r in bv), sum(r.variance < 0 for r in bv)) == (5, 1)
    assert round(q["bridge_unexplained"](spark, SF).collect()[0].unexplained, 2) == -171_407_747.56


def test_chargeback_and_risk_facts(spark, q):
    leak = q["allocation_leakage"](spark, SF).collect()
    assert (sum(r.weight_sum == 0.999 for r in leak), sum(r.weight_sum == 1.001 for r in leak)) == (2, 1)
    lab = q["risk_labels"](spark, SF)
    assert (lab.agg(F.sum("high_risk")).first()[0], lab.count()) == (125, 498)


def test_triage_and_cmdb_facts(spark, q):
    from ledgerspark.plans.marts import marts_for
    ev = {r.label: r for r in q["triage_eval"](spark, SF).collect()}
    assert round(ev["ghost_circuit"].recall, 2) == 0.50       # the reference's own ghost gap
    cm = {(r.truth, r.predicted) for r in q["triage_confusion"](spark, SF).collect()}
    labels = {"rate_overcharge", "duplicate", "ghost_circuit", "none"}
    assert {t for t, _ in cm} == labels and {p for _, p in cm} == labels
    src = marts_for(spark, SF).src
    mismatch = (src.invoices.join(src.cmdb.select("ci_id", "status"), "ci_id")
                   .where("ci_status <> status").count())
    assert mismatch == 19_212
