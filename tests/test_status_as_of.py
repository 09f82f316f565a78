"""H7: CIs listed more than once never inflate counts; the status of the invoice month, by brute force."""

import datetime as dt
import random

from ledgerspark.functions.rules import FINDINGS
from ledgerspark.operators import triage as H

INV = "ci_id string, period date, contracted_rate double, billed_amount double, ci_status string"
MONTHS = [dt.date(2024 + m // 12, m % 12 + 1, 1) for m in range(24)]


def lines(spark, n=500):
    rng = random.Random(2)
    rows = [("hot" if k % 3 == 0 else rng.choice(["a", "b", "c", "none", None]), rng.choice(MONTHS), 10.0, rng.choice([10.0, 12.0, 20.0]),
             rng.choice(["Active", "Decommissioned", None])) for k in range(n)]
    return rows, spark.createDataFrame(rows, INV).repartition(6)


def finding(billed, status):
    return FINDINGS[0] if status == "Decommissioned" else FINDINGS[1] if billed >= 19 else FINDINGS[2] if billed > 11 else FINDINGS[3]


def expect(rows, retired):
    out = {}
    for ci, period, _, billed, status in rows:
        before = finding(billed, status)
        after = FINDINGS[0] if retired(ci, period) else before
        for f, k in ((before, 0), (after, 1)):
            out.setdefault(f, [0, 0])[k] += 1
    return {(f, b, a, a - b) for f, (b, a) in out.items()}


def test_repeated_cis_count_once(spark):
    rows, inv = lines(spark)
    cmdb = spark.createDataFrame([("hot", "Active")] * 5 + [("hot", "Decommissioned"), ("a", "Active"), ("a", "Active"), ("b", None), (None, "Decommissioned")],
                                 "ci_id string, status string")
    assert {tuple(r) for r in H.audit_cmdb_status(inv, cmdb).collect()} == expect(rows, lambda ci, _: ci == "hot")


def test_status_of_the_month(spark):
    rows, inv = lines(spark)
    history = [("hot", "Active", dt.date(2024, 1, 5)), ("hot", "Decommissioned", dt.date(2024, 6, 30)), ("hot", "Decommissioned", dt.date(2024, 8, 1)),
               ("hot", "Active", dt.date(2025, 2, 1)), ("a", "Decommissioned", dt.date(2024, 11, 2)), ("a", "Active", dt.date(2024, 11, 20)),
               ("b", "Active", dt.date(2023, 1, 1)), ("b", None, dt.date(2024, 3, 1)), ("c", "Decommissioned", None), (None, "Decommissioned", dt.date(2020, 1, 1))]

    def retired(ci, period):
        months = {}
        for c, s, at in history:
            if c == ci and c is not None and at is not None and at.replace(day=1) <= period:
                months.setdefault(at.replace(day=1), []).append(s == "Decommissioned")
        return bool(months) and any(months[max(months)])

    df = spark.createDataFrame(history * 3, "ci_id string, status string, valid_from date")      # repeated records change nothing
    assert {tuple(r) for r in H.audit_status_as_of(inv, df).collect()} == expect(rows, retired)
    spans = {(r.ci_id, r.since, r.until, r.retired) for r in H.status_spans(df).collect() if r.ci_id == "hot"}
    assert spans == {("hot", dt.date(2024, 1, 1), dt.date(2024, 6, 1), False), ("hot", dt.date(2024, 6, 1), dt.date(2025, 2, 1), True),
                     ("hot", dt.date(2025, 2, 1), None, False)}


def test_no_history_and_no_lines(spark):
    rows, inv = lines(spark, 40)
    none = spark.createDataFrame([], "ci_id string, status string, valid_from date")
    assert {tuple(r) for r in H.audit_status_as_of(inv, none).collect()} == expect(rows, lambda *_: False)
    assert H.audit_status_as_of(inv.limit(0), none).count() == 0
