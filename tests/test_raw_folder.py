"""Every key over a folder of raw CSV tables in the source layout."""

import datetime as dt
import tempfile

import pytest

from ledgerspark import schemas
from ledgerspark.plans.registry import QUERIES

AREAS, VENDORS, MONTHS = ("Backhaul", "Core", "Edge"), ("V1", "V2"), [dt.date(2025, m, 1) for m in range(1, 13)]


@pytest.fixture(scope="module")
def raw(spark):
    base = tempfile.mkdtemp(prefix="ls-rawall-")
    cis = [(f"CI-{a}-{v}", a, "S1", v, "Router", MONTHS[0], 100.0 + i, "Decommissioned" if (a, v) == ("Edge", "V2") else "Active")
           for i, (a, v) in enumerate((a, v) for a in AREAS for v in VENDORS)]
    inv, tel, inc = [], [], []
    for k, p in enumerate(MONTHS):
        for i, (ci, a, _, v, _, _, cost, status) in enumerate(cis):
            ratio, truth = {0: (2.0, "duplicate"), 1: (1.25, "rate_overcharge")}.get((k + i) % 5, (1.0, "none"))
            truth = "ghost_circuit" if status == "Decommissioned" else truth
            inv.append((f"INV{k:02d}{i}", ci, v, a, p, cost, cost * ratio, status, truth))
            tel.append((ci, a, p, 99.0 + i / 10, 30.0 + k, 0.2 + ((k * 7 + i) % 5) / 10, 1500.0 - k))
            inc.append((f"INC{k:02d}{i}", ci, a, "S1", v, "P2", p, 4.0 + i, 50.0 * (k + 1) + (k * i) % 7))
    gl = [(a, p, 1000.0, "CC-000", "6100-Telecom") for a in AREAS for p in MONTHS]
    rows = {"servicenow_cmdb": cis, "itom_telemetry": tel, "servicenow_incidents": inc, "telecom_invoices": inv, "sap_gl": gl,
            "coupa_pos": [(a, 2000.0, 1500.0) for a in AREAS]}
    for stem, r in rows.items():
        spark.createDataFrame(r, schemas.RAW_TABLES[stem]).coalesce(1).write.option("header", True).csv(f"{base}/{stem}.csv")
    with open(f"{base}/chargeback_weights.csv", "w") as f:
        f.write(",Sales,Ops\nBackhaul,0.25,0.75\nCore,0.5,0.499\n")     # Edge has no weights
    return base


@pytest.mark.parametrize("key", list(QUERIES))
def test_key_runs(spark, raw, key):
    assert QUERIES[key](spark, raw).count() > 0


def test_supplied_tables_are_used(spark, raw):
    leak = {r.service_area: r for r in QUERIES["allocation_leakage"](spark, raw).collect()}
    assert leak["Edge"].weight_sum == 0 and leak["Edge"].leakage == leak["Edge"].area_cost
    assert leak["Backhaul"].leakage == 0 and leak["Core"].weight_sum == 0.999
    assert {r.gl_amount for r in QUERIES["gl_reconciliation"](spark, raw).collect()} == {1000.0}
    assert QUERIES["spend_trend"](spark, raw).columns == ["period", *AREAS]
    split = {r.split: r.rows for r in QUERIES["risk_time_split"](spark, raw).collect()}
    assert split == {"train": 27, "test": 9}
