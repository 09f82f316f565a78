"""Structured Streaming operators give the batch answer."""

import datetime as dt
import tempfile

from ledgerspark.operators import deviation as V
from ledgerspark.operators import marts as M
from ledgerspark.streaming import monitor as S

INV = ("invoice_id string, ci_id string, vendor string, service_area string, period date, "
       "contracted_rate double, billed_amount double, ci_status string, planted_error string")


def _write_batches(spark, rows, n):
    d = tempfile.mkdtemp(prefix="ls-stream-in-")
    for i in range(n):
        spark.createDataFrame(rows[i::n], INV).coalesce(1).write.mode("append").parquet(d)
    return d


def test_audit_and_watermarked_spend_stream(spark):
    months = [dt.date(2025, m, 1) for m in range(1, 7)]
    rows = [(f"i{k}", "c", "v", a, months[k % 6], 10.0, 10.0 + k, "Active", "none")
            for k, a in enumerate(["A", "B"] * 30)]
    src = _write_batches(spark, rows, 3)
    schema = spark.createDataFrame([], INV).schema
    out = tempfile.mkdtemp(prefix="ls-stream-out-")

    audit = S.run_available(S.audit_stream(S.invoice_stream(spark, src, schema, 1)),
                            f"{out}/audit", f"{out}/ck1")
    batch = M.invoice_audit(spark.createDataFrame(rows, INV))
    assert sorted(map(tuple, audit.collect())) == sorted(map(tuple, batch.collect()))

    complete = S.run_available(S.monthly_spend_stream(S.invoice_stream(spark, src, schema, 1), None),
                               f"{out}/spend", f"{out}/ck2", "complete")
    want = M.monthly_spend_by_area(spark.createDataFrame(rows, INV))
    assert sorted(map(tuple, complete.collect())) == sorted(map(tuple, want.collect()))

    # Append mode with a watermark only emits months the watermark has passed.
    closed = S.run_available(S.monthly_spend_stream(S.invoice_stream(spark, src, schema, 1), "31 days"),
                             f"{out}/closed", f"{out}/ck3", "append")
    got = {r.period for r in closed.collect()}
    assert got and max(got) < months[-1] and got <= set(months)


def test_spc_alert_stream(spark):
    sam = spark.createDataFrame(
        [("A", dt.date(2025, m, 1), float(m % 2), 1.0) for m in range(1, 7)]
        + [("A", dt.date(2025, 7, 1), 9.0, 1.0)],
        "service_area string, period date, packet_loss double, telecom_spend double")
    base = V.spc_baseline(sam)
    d = tempfile.mkdtemp(prefix="ls-sam-") + "/sam"
    sam.write.parquet(d)
    stream = spark.readStream.schema(sam.schema).parquet(d)
    out = tempfile.mkdtemp(prefix="ls-alerts-")
    alerts = S.run_available(S.spc_alert_stream(stream, base), f"{out}/a", f"{out}/ck")
    flagged = {r.period for r in alerts.collect() if r.breach}
    assert flagged == {dt.date(2025, 7, 1)}


def test_a_stream_resumes_from_its_folders(spark):
    """Run again on the same folders it takes only what is new, and nothing twice."""
    rows = [(f"i{k}", "c", "v", "A", dt.date(2025, 1, 1), 10.0, 10.0 + k, "Active", "none") for k in range(20)]
    src = _write_batches(spark, rows[:10], 2)
    schema = spark.createDataFrame([], INV).schema
    out = tempfile.mkdtemp(prefix="ls-stream-resume-")
    run = lambda: S.run_available(S.audit_stream(S.invoice_stream(spark, src, schema, bytes_per_trigger=1)), f"{out}/a", f"{out}/ck")
    assert run().count() == 10 and run().count() == 10
    spark.createDataFrame(rows[10:], INV).coalesce(1).write.mode("append").parquet(src)
    assert sorted(map(tuple, run().collect())) == sorted(map(tuple, M.invoice_audit(spark.createDataFrame(rows, INV)).collect()))


def test_registered_streams_resume(spark, sf_small):
    from ledgerspark.plans.registry import QUERIES
    for key in ("stream_invoice_audit", "stream_monthly_spend"):
        assert QUERIES[key](spark, sf_small).count() == QUERIES[key](spark, sf_small).count() > 0
