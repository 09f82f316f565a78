"""Bad lines of raw CSV tables are kept apart with a reason; good ones load."""

import pytest

from ledgerspark import schemas
from ledgerspark.plans.marts import MartSet, marts_for
from ledgerspark.sources.files import load_sources
from ledgerspark.sources.rejects import LINE, good, read_lines, reject_summary, rejects

FILES = {
    "servicenow_cmdb": "ci_id,service_area,site,vendor,ci_type,install_date,monthly_cost,status\nc1,A,s,v,t,2020-01-01,10,Active\nc2,A,s,v,t,soon,10,Active\n",
    "itom_telemetry": "ci_id,service_area,period,uptime_pct,latency_ms,packet_loss_pct,mtbf_hours\nc1,A,2025-01-01,99,1,0.1,100\nc1,A,2025-01-01,99,1,0.1\n",
    "servicenow_incidents": "incident_id,ci_id,service_area,site,vendor,priority,opened,mttr_hours,cost_to_resolve\ni1,c1,A,s,v,P1,2025-01-01,1,5\ni2,c1,A,s,v,P1,2025-01-01,x,5\n",
    "telecom_invoices": "invoice_id,ci_id,vendor,service_area,period,contracted_rate,billed_amount,ci_status,planted_error\n"
                        'n1,c1,"v, inc",A,2025-01-01,10,10,Active,\nn2,c1,v,A,2025-13-01,10,abc,Active,\nn3,c1,v,A,2025-01-01,10,30,Active,duplicate\n'
                        "n4,c1,v,A,2025-01-01,10,10,Active,none,more\nn5,c1,v,A,2025-01-01,,,Active,\n",
    "sap_gl": "service_area,period,amount,cost_center,gl_account\nA,2025-01-01,5,CC-000,x\n",
    "coupa_pos": "service_area,annual_budget,po_committed\nA,100,1\n",
}
WANT = {("servicenow_cmdb", "install_date"): 1, ("itom_telemetry", "cells"): 1, ("servicenow_incidents", "mttr_hours"): 1,
        ("telecom_invoices", "period"): 1, ("telecom_invoices", "cells"): 1}


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    for stem, text in FILES.items():
        (d / f"{stem}.csv").write_text(text)
    (d / "chargeback_weights.csv").write_text(",Sales\nA,1.0\n")
    return str(d)


def test_marts_load_good_lines(spark, base):
    ms = marts_for(spark, base)
    assert sorted(r.invoice_id for r in ms.audit.collect()) == ["n1", "n3", "n5"]
    assert LINE not in ms.src.invoices.columns and ms.src.incidents.count() == ms.src.telemetry.count() == ms.src.cmdb.count() == 1
    got = {}
    for r in ms.rejects.collect():
        got[r.source, r.reason] = got.get((r.source, r.reason), 0) + 1
        assert r.line in FILES[r.source].split("\n")
    assert got == WANT
    assert ms.cube.agg({"lines": "sum"}).first()[0] == 3


def test_a_projection_drops_the_same_lines(spark, base):
    """Reading one good column still leaves out lines whose other cells are bad."""
    src = load_sources(spark, base, keep_rejects=True)
    assert sorted(r[0] for r in src.invoices.select("vendor").collect()) == ["v", "v", "v, inc"]
    assert src.invoices.count() == 3


def test_without_the_reject_path_a_bad_cell_ends_the_load(spark, base):
    with pytest.raises(Exception, match="MALFORMED_RECORD|bad record|abc|2025-13"):
        load_sources(spark, base).invoices.collect()


def test_reasons(spark, tmp_path):
    (tmp_path / "b.csv").write_text("A,1,2\nA,x,2\nA,1\n,,\nA,1e3,-5.5\n")
    parsed = spark.createDataFrame(read_lines(spark, str(tmp_path / "b.csv"), schemas.BUDGET, header=False).collect(),
                                   "service_area string, annual_budget double, po_committed double, _line string")
    assert {(r.reason, r.rows) for r in reject_summary(parsed, "b", schemas.BUDGET).collect()} == {("good", 3), ("annual_budget", 1), ("cells", 1)}
    assert {(r.reason, r.line) for r in rejects(parsed, "b", schemas.BUDGET).collect()} == {("annual_budget", "A,x,2"), ("cells", "A,1")}
    assert good(parsed).count() == 3


def test_another_files_header_is_an_error(spark, tmp_path):
    (tmp_path / "h.csv").write_text("service_area,po_committed,annual_budget\nA,1,2\n")
    with pytest.raises(Exception, match="header|CSV"):
        read_lines(spark, str(tmp_path / "h.csv"), schemas.BUDGET).collect()


def test_no_bad_lines(spark, tmp_path):
    for stem, text in FILES.items():
        lines = text.split("\n")
        (tmp_path / f"{stem}.csv").write_text("\n".join(lines[:2]) + "\n")
    ms = marts_for(spark, str(tmp_path))
    assert isinstance(ms, MartSet) and ms.rejects.count() == 0
    ms.cleanup()
    assert marts_for(spark, str(tmp_path)) is not ms
