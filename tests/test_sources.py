"""File sources with declared schemas, the wide weight matrix, sinks and the runbook."""

import datetime as dt
import os
import tempfile

import pytest

from ledgerspark import schemas
from ledgerspark.operators import chargeback as E
from ledgerspark.operators import marts as M
from ledgerspark.sources.files import load_sources, read_weights_wide, register_views
from ledgerspark.sources.sinks import export_csv, mart_roundtrip


def _write_csv(spark, df, path):
    df.coalesce(1).write.option("header", True).mode("overwrite").csv(path)


def test_load_sources_declared_types(spark):
    base = tempfile.mkdtemp(prefix="ls-raw-")
    d = dt.date(2025, 1, 1)
    rows = {
        "servicenow_cmdb": [("CI-1", "A", "S1", "V", "Router", d, 900.5, "Active")],
        "itom_telemetry": [("CI-1", "A", d, 99.6, 35.2, 0.2, 1500.0)],
        "servicenow_incidents": [("INC1", "CI-1", "A", "S1", "V", "P1", d, 6.5, 700.25)],
        "telecom_invoices": [("INV1", "CI-1", "V", "A", d, 900.5, 1801.0, "Active", "duplicate")],
        "sap_gl": [("A", d, 1801.0, "CC-000", "6100-Telecom")],
        "coupa_pos": [("A", 11346.3, 10500.0)],
    }
    for stem, r in rows.items():
        _write_csv(spark, spark.createDataFrame(r, schemas.RAW_TABLES[stem]), f"{base}/{stem}")
    src = load_sources(spark, base, "csv")
    assert src.invoices.schema == schemas.INVOICES
    assert dict(src.telemetry.dtypes)["mtbf_hours"] == "double"
    audit = M.invoice_audit(src.invoices).collect()[0]
    assert audit.finding == "Duplicate charge" and audit.variance == 900.5
    bv = M.budget_variance(src.invoices, src.budget).collect()[0]
    assert bv.variance == 1801.0 - 11346.3
    register_views(src)
    assert spark.sql("SELECT count(*) FROM telecom_invoices").collect()[0][0] == 1


def _raw(text, stem="coupa_pos"):
    base = tempfile.mkdtemp(prefix="ls-raw-")
    with open(f"{base}/{stem}.csv", "w") as f:
        f.write(text)
    return f"{base}/{stem}.csv"


def test_csv_header_and_cells_are_checked(spark):
    from ledgerspark.sources.files import read_raw
    good = read_raw(spark, _raw("service_area,annual_budget,po_committed\nA,1.5,2\n"), schemas.BUDGET)
    assert good.first() == ("A", 1.5, 2.0)
    for text in ("service_area,po_committed,annual_budget\nA,1,2\n", "service_area,annual_budget,po_committed\nA,n/a,2\n"):
        with pytest.raises(Exception):
            read_raw(spark, _raw(text), schemas.BUDGET).collect()


def test_table_as_file_or_folder(spark):
    from ledgerspark.sources.files import _locate
    path = _raw("service_area,annual_budget,po_committed\nA,1,2\n")
    base = path.rsplit("/", 1)[0]
    assert _locate(spark, base, "coupa_pos", "csv") == path
    os.mkdir(f"{base}/sap_gl")
    assert _locate(spark, f"file://{base}", "sap_gl", "csv") == f"file://{base}/sap_gl"


def test_wide_weight_matrix_to_long(spark):
    path = tempfile.mkdtemp(prefix="ls-w-") + "/w.csv"
    with open(path, "w") as f:
        f.write(",Unit One,Unit Two\nA,0.25,0.75\nB,0.5,0.499\n")
    w = read_weights_wide(spark, path)
    got = {(r.service_area, r.business_unit): r.weight for r in w.collect()}
    assert got == {("A", "Unit One"): 0.25, ("A", "Unit Two"): 0.75,
                   ("B", "Unit One"): 0.5, ("B", "Unit Two"): 0.499}
    cost = spark.createDataFrame([("A", 100.0), ("B", 1000.0)], "service_area string, total_cost double")
    leak = {r.service_area: r.leakage for r in E.allocation_leakage(E.chargeback_allocation(w, cost), cost).collect()}
    assert leak["A"] == 0.0 and round(leak["B"], 6) == 1.0


def test_sinks_roundtrip_and_export(spark):
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 2, 1)
    df = spark.createDataFrame([("i1", d1, 1.5), ("i2", d2, 2.5), ("i3", d1, 3.5)],
                               "invoice_id string, period date, billed_amount double")
    base = tempfile.mkdtemp(prefix="ls-sink-")
    back = mart_roundtrip(df, f"{base}/m", ["period"])
    assert back.schema == df.schema and sorted(back.collect()) == sorted(df.collect())
    assert os.path.isdir(f"{base}/m/period=2025-01-01")
    again = mart_roundtrip(df, f"{base}/m", ["period"])          # idempotent overwrite
    assert again.count() == 3
    prof = {r.mart: r.rows for r in export_csv({"x": df}, f"{base}/csv").collect()}
    assert prof == {"x": 3}


def test_runbook_writes_results(spark, sf_small):
    from ledgerspark.plans.runbook import run
    out = tempfile.mkdtemp(prefix="ls-run-")
    rep = run(spark, sf_small, out, ["audit_headline", "cost_bridge", "risk_scores", "risk_model_auc"],
              parallel=3)
    assert set(rep) == {"audit_headline", "cost_bridge", "risk_scores", "risk_model_auc"}
    assert spark.read.parquet(rep["cost_bridge"]["path"]).count() == 6


def test_marts_and_sources_as_sql_views(spark, sf_small):
    from ledgerspark.plans.marts import marts_for, register_views
    names = register_views(marts_for(spark, sf_small))
    assert {"telecom_invoices", "servicenow_incidents", "fct_invoice_audit",
            "fct_service_area_monthly", "fct_budget_variance", "fct_vendor_scorecard"} <= set(names)
    top = spark.sql("SELECT vendor, spend_per_incident FROM fct_vendor_scorecard "
                    "ORDER BY spend_per_incident DESC, vendor LIMIT 1").collect()
    from __spark_entry__ import queries
    assert [tuple(r) for r in top] == [tuple(r) for r in queries()["top_vendor"](spark, sf_small).collect()]
    n = spark.sql("SELECT count(*) FROM fct_invoice_audit WHERE finding <> 'OK'").collect()[0][0]
    assert n == queries()["audit_headline"](spark, sf_small).collect()[0].flagged


def test_weight_matrix_export_reads_back(spark):
    long = spark.createDataFrame([("A", "X", 0.25), ("A", "Y", 0.75), ("B", "X", 0.5), ("B", "Y", 0.5)],
                                 "service_area string, business_unit string, weight double")
    path = tempfile.mkdtemp(prefix="ls-ww-") + "/w"
    E.weights_wide(long).coalesce(1).write.option("header", True).csv(path)
    back = read_weights_wide(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))


def test_martset_over_csv_layout(spark):
    from ledgerspark.plans.marts import MartSet
    base = tempfile.mkdtemp(prefix="ls-raw2-")
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 2, 1)
    rows = {
        "servicenow_cmdb": [("CI-1", "A", "S1", "V", "Router", d1, 100.0, "Active")],
        "itom_telemetry": [("CI-1", "A", d1, 99.5, 30.0, 0.2, 1500.0), ("CI-1", "A", d2, 99.7, 32.0, 0.4, 1400.0)],
        "servicenow_incidents": [("INC1", "CI-1", "A", "S1", "V", "P1", d1, 6.0, 600.0)],
        "telecom_invoices": [("INV1", "CI-1", "V", "A", d1, 100.0, 100.0, "Active", "none"),
                             ("INV2", "CI-1", "V", "A", d2, 100.0, 190.0, "Active", "duplicate")],
        "sap_gl": [("A", d1, 100.0, "CC-000", "6100-Telecom"), ("A", d2, 190.0, "CC-000", "6100-Telecom")],
        "coupa_pos": [("A", 1260.0, 1200.0)],
    }
    for stem, r in rows.items():
        _write_csv(spark, spark.createDataFrame(r, schemas.RAW_TABLES[stem]), f"{base}/{stem}")
    ms = MartSet(spark, load_sources(spark, base, "csv"), store=f"{base}/marts")
    marts = ms.all()
    sam = {r.period: r for r in marts["fct_service_area_monthly"].collect()}
    assert sam[d1].incidents == 1 and sam[d1].cost_per_incident == 100.0
    assert sam[d2].incidents == 0 and sam[d2].packet_loss == 0.4
    vsc = marts["fct_vendor_scorecard"].collect()[0]
    assert (vsc.total_spend, vsc.spend_per_incident) == (290.0, 290.0)
    bv = marts["fct_budget_variance"].collect()[0]
    assert bv.variance == 290.0 - 1260.0
    rec = M.gl_reconciliation(ms.src.gl, ms.src.invoices).collect()
    assert all(r.difference == 0.0 for r in rec)
