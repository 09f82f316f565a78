"""Edge cases of the audit ladder and the marts on small in-test frames."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerspark.operators import marts as M

D1, D2, D3 = dt.date(2025, 1, 1), dt.date(2025, 2, 1), dt.date(2025, 3, 1)
INV = ("invoice_id string, ci_id string, vendor string, service_area string, period date, "
       "contracted_rate double, billed_amount double, ci_status string, planted_error string")
INC = ("incident_id string, ci_id string, service_area string, vendor string, opened date, "
       "opened_at date, mttr_hours double, cost_to_resolve double")
TEL = ("ci_id string, service_area string, period date, uptime_pct double, latency_ms double, "
       "packet_loss_pct double, mtbf_hours double")


def invoices(spark, rows):
    return spark.createDataFrame(rows, INV)


def test_audit_ladder_edges(spark):
    rows = [
        ("i1", "c", "v", "A", D1, 100.0, 190.0, "Active", "duplicate"),         # exactly 1.9x
        ("i2", "c", "v", "A", D1, 100.0, 110.0, "Active", "none"),              # exactly 1.10x
        ("i3", "c", "v", "A", D1, 100.0, 110.01, "Active", "rate_overcharge"),  # just above
        ("i4", "c", "v", "A", D1, 100.0, 200.0, "Decommissioned", "ghost_circuit"),  # ghost wins
        ("i5", "c", "v", "A", D1, 100.0, 90.0, "Active", "none"),
    ]
    got = {r.invoice_id: (r.finding, r.variance)
           for r in M.invoice_audit(invoices(spark, rows)).collect()}
    assert got["i1"][0] == "Duplicate charge"
    assert got["i2"][0] == "OK"
    assert got["i3"][0] == "Rate overcharge"
    assert got["i4"] == ("Ghost circuit", 100.0)
    assert got["i5"] == ("OK", -10.0)


def test_service_area_monthly_left_joins(spark):
    inv = invoices(spark, [
        ("i1", "c", "v", "A", D1, 10.0, 10.0, "Active", "none"),
        ("i2", "c", "v", "A", D2, 10.0, 30.0, "Active", "none"),   # month without incidents
    ])
    inc = spark.createDataFrame([
        ("n1", "c", "A", "v", D1, D1, 6.0, 100.0),
        ("n2", "c", "A", "v", D1, D1, 12.0, 50.0),
        ("n3", "c", "A", "v", D3, D3, 6.0, 1.0),    # month without spend: dropped
    ], INC)
    tel = spark.createDataFrame([("c", "A", D1, 99.5, 30.0, 0.2, 1000.0)], TEL)
    out = {r.period: r for r in M.service_area_monthly(inv, inc, tel).collect()}
    assert set(out) == {D1, D2}
    jan, feb = out[D1], out[D2]
    assert (jan.incidents, jan.avg_mttr, jan.incident_cost, jan.cost_per_incident) == (2, 9.0, 150.0, 5.0)
    assert (feb.incidents, feb.avg_mttr, feb.incident_cost, feb.cost_per_incident) == (0, None, 0.0, None)
    assert jan.packet_loss == 0.2 and feb.packet_loss is None


def test_budget_variance_zero_budget(spark):
    inv = invoices(spark, [("i1", "c", "v", "A", D1, 10.0, 10.0, "Active", "none"),
                           ("i2", "c", "v", "B", D1, 10.0, 12.0, "Active", "none")])
    budget = spark.createDataFrame([("A", 0.0), ("B", 24.0), ("C", 5.0)],
                                   "service_area string, annual_budget double")
    out = {r.service_area: r for r in M.budget_variance(inv, budget).collect()}
    assert set(out) == {"A", "B"}                       # inner join: C has no spend
    assert out["A"].variance == 10.0 and out["A"].variance_pct is None
    assert out["B"].variance_pct == -0.5


def test_vendor_scorecard_equals_naive_fanout_join(spark):
    inv = invoices(spark, [("i1", "c", "V1", "A", D1, 1.0, 10.0, "Active", "none"),
                           ("i2", "c", "V1", "A", D1, 1.0, 20.0, "Active", "none"),
                           ("i3", "c", "V2", "A", D1, 1.0, 5.0, "Active", "none")])
    inc = spark.createDataFrame([("n1", "c", "A", "V1", D1, D1, 6.0, 1.0),
                                 ("n2", "c", "A", "V1", D1, D1, 12.0, 1.0),
                                 ("n2", "c", "A", "V1", D1, D1, 12.0, 1.0),   # repeated id
                                 ("n3", "c", "A", "V3", D1, D1, 6.0, 1.0)], INC)
    fast = {r.vendor: r for r in M.vendor_scorecard(inc, inv).collect()}
    naive = (inc.join(inv.select("vendor", "billed_amount"), "vendor")
                .groupBy("vendor").agg(F.sum("billed_amount").alias("total_spend"),
                                       F.countDistinct("incident_id").alias("incidents"),
                                       F.avg("mttr_hours").alias("avg_mttr")))
    naive = {r.vendor: r for r in naive.collect()}
    assert set(fast) == set(naive) == {"V1"}
    assert fast["V1"].total_spend == naive["V1"].total_spend == 90.0
    assert fast["V1"].incidents == 2 and fast["V1"].avg_mttr == naive["V1"].avg_mttr == 10.0
    assert fast["V1"].spend_per_incident == 45.0
    corrected = M.vendor_scorecard_corrected(inc, inv).collect()[0]
    assert corrected.total_spend == 30.0 and corrected.spend_per_incident == 15.0


def test_gl_rollup_codes_and_reconciliation(spark):
    inv = invoices(spark, [("i1", "c", "v", "Zeta", D1, 1.0, 1.0, "Active", "none"),
                           ("i2", "c", "v", "Alpha", D1, 1.0, 2.0, "Active", "none"),
                           ("i3", "c", "v", "Alpha", D2, 1.0, 3.0, "Active", "none")])
    gl = M.gl_rollup(inv)
    codes = {r.service_area: r.cost_center for r in gl.collect()}
    assert codes == {"Alpha": "CC-000", "Zeta": "CC-001"}
    rec = M.gl_reconciliation(gl, inv).collect()
    assert len(rec) == 3 and all(r.difference == 0.0 for r in rec)


def test_budget_rollup_active_only(spark):
    cmdb = spark.createDataFrame([("A", 100.0, "Active"), ("A", 50.0, "Decommissioned"),
                                  ("B", 33.33, "Active")],
                                 "service_area string, monthly_cost double, status string")
    out = {r.service_area: r.annual_budget for r in M.budget_rollup(cmdb).collect()}
    assert out == {"A": 1260.0, "B": 419.96}   # 33.33 * 12 * 1.05 = 419.958


def test_incident_volume_weekly(spark):
    inc = spark.createDataFrame([("n1", "c", "A", "v", D1, dt.date(2025, 1, 6), 6.0, 1.0),
                                 ("n2", "c", "A", "v", D1, dt.date(2025, 1, 8), 12.0, 1.0),
                                 ("n3", "c", "A", "v", D1, dt.date(2025, 1, 13), 6.0, 1.0)], INC)
    out = {r.period: (r.incidents, r.avg_mttr) for r in M.incident_volume(inc).collect()}
    assert out == {dt.date(2025, 1, 6): (2, 9.0), dt.date(2025, 1, 13): (1, 6.0)}


def test_vendor_scorecard_equals_naive_join_on_fixture(spark, sf_small):
    from ledgerspark.sources.fixtures import fixture_sources
    src = fixture_sources(spark, sf_small)
    fast = {r.vendor: r for r in M.vendor_scorecard(src.incidents, src.invoices).collect()}
    naive = (src.incidents.join(src.invoices.select("vendor", "billed_amount"), "vendor")
                .groupBy("vendor").agg(F.sum("billed_amount").alias("total_spend"),
                                       F.countDistinct("incident_id").alias("incidents"),
                                       F.avg("mttr_hours").alias("avg_mttr"),
                                       F.count(F.lit(1)).alias("joined_rows")))
    naive = {r.vendor: r for r in naive.collect()}
    assert set(fast) == set(naive) and len(fast) > 5
    assert sum(r.joined_rows for r in naive.values()) > 300_000      # the fan-out avoided
    for v, r in naive.items():
        assert fast[v].incidents == r.incidents
        assert abs(fast[v].avg_mttr - r.avg_mttr) < 1e-9
        assert abs(fast[v].total_spend - r.total_spend) <= 1e-9 * r.total_spend


def test_incident_volume_monthly_and_spend_trend_values(spark):
    from ledgerspark.operators import descriptive as C
    inc = spark.createDataFrame([("n1", "c", "A", "v", D1, dt.date(2025, 1, 6), 6.0, 1.0),
                                 ("n2", "c", "A", "v", D2, dt.date(2025, 2, 8), 12.0, 1.0),
                                 ("n3", "c", "A", "v", D2, dt.date(2025, 2, 13), 6.0, 1.0)], INC)
    out = {r.period: r.incidents for r in M.incident_volume(inc, unit="month").collect()}
    assert out == {D1: 1, D2: 2}
    sam = spark.createDataFrame([("A", D1, 1.0), ("B", D1, 2.0), ("A", D2, 3.0)],
                                "service_area string, period date, telecom_spend double")
    wide = C.spend_trend(sam, areas=["A", "B", "C"])
    assert wide.columns == ["period", "A", "B", "C"]
    got = {r.period: (r.A, r.B, r.C) for r in wide.collect()}
    assert got == {D1: (1.0, 2.0, None), D2: (3.0, None, None)}


def test_fine_digits_outlast_the_staged_rollup(spark):
    rows = [(f"i{k}", "c", "v", "A", dt.date(1950 + k // 12, k % 12 + 1, 1), 0.00003, 0.00004, "Active", "none") for k in range(1000)]
    inv = invoices(spark, rows)
    spend = M.spend_rollup(inv)
    assert spend.count() == 1000
    budget = spark.createDataFrame([("A", 1.0)], "service_area string, annual_budget double")
    for source in (inv, spend):
        assert M.vendor_spend(source).first().total_spend == 0.04
        assert M.budget_variance(source, budget).first().actual_spend == 0.04
    one = M.vendor_spend(spend.withColumn("billed_amount", F.col("contracted_rate"))).first()
    assert (one.total_spend, one.invoice_lines) == (0.03, 1000)
