"""Incremental refresh: only changed months are written, retries give the same files, failures lose nothing."""

import datetime as dt
import hashlib
import pathlib

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import marts as M
from ledgerspark.plans import refresh as R

INV = ("invoice_id string, ci_id string, vendor string, service_area string, period date, "
       "contracted_rate double, billed_amount double, ci_status string, planted_error string")
MONTHS = [dt.date(2025, m, 1) for m in range(1, 5)]


def lines(spark, n=200, **changed):
    rows = [(f"i{k}", "c", ["v", None][k % 2], "A", MONTHS[k % 4], 10.0, 10.0 + k, "Active", None) for k in range(n)]
    return spark.createDataFrame([changed.get(r[0], r) for r in rows if changed.get(r[0], r)], INV)


def files(path):
    """Month folder -> content hashes of its files."""
    out = {}
    for p in pathlib.Path(path).glob("period=*/*.parquet"):
        out.setdefault(p.parent.name[7:], []).append((hashlib.sha256(p.read_bytes()).hexdigest(), p.name))
    return {k: sorted(v) for k, v in out.items()}


def content(path):
    return {k: [h for h, _ in v] for k, v in files(path).items()}


def actions(log):
    return {str(r.period): r.action for r in log.collect()}


def rows(df):
    return sorted(map(repr, df.collect()))


def test_one_changed_month_rewrites_one_partition(spark, tmp_path):
    path = f"{tmp_path}/m"
    src = lines(spark)
    mart, log = R.refresh(src, path, M.invoice_audit)
    assert rows(mart) == rows(M.invoice_audit(src)) and set(actions(log).values()) == {"new"}
    before = files(path)
    new = lines(spark, i5=("i5", "c", "v", "A", MONTHS[1], 10.0, 99.0, "Active", None))
    mart, log = R.refresh(new, path, M.invoice_audit)
    after = files(path)
    assert actions(log) == {str(m): "changed" if m == MONTHS[1] else "kept" for m in MONTHS}
    assert {k for k in before if before[k] != after[k]} == {str(MONTHS[1])}
    assert rows(mart) == rows(M.invoice_audit(new))
    _, log = R.refresh(new, path, M.invoice_audit)
    assert set(actions(log).values()) == {"kept"} and files(path) == after


def test_months_come_and_go(spark, tmp_path):
    path = f"{tmp_path}/m"
    src = lines(spark)
    nulls = src.withColumn("period", F.when(F.col("period") < F.lit(MONTHS[3]), F.col("period")))
    mart, log = R.refresh(nulls, path, M.invoice_audit)
    assert actions(log)["None"] == "new" and rows(mart) == rows(M.invoice_audit(nulls))
    later = src.where(F.col("period") != F.lit(MONTHS[0]))
    mart, log = R.refresh(later, path, M.invoice_audit)
    assert actions(log) == {str(MONTHS[0]): "gone", "None": "gone", str(MONTHS[1]): "kept", str(MONTHS[2]): "kept", str(MONTHS[3]): "new"}
    assert rows(mart) == rows(M.invoice_audit(later)) and len(files(path)) == 3
    mart, _ = R.refresh(src.limit(0), path, M.invoice_audit)
    assert mart.count() == 0 and not files(path)


def test_a_failed_refresh_is_made_up_for(spark, tmp_path, monkeypatch):
    """The manifest is last: what a failed run wrote is written again, with the same bytes."""
    path, other = f"{tmp_path}/m", f"{tmp_path}/o"
    src = lines(spark)
    R.refresh(src.where(F.col("period") < F.lit(MONTHS[3])), path, M.invoice_audit)
    new = lines(spark, i5=("i5", "c", "v", "A", MONTHS[1], 10.0, 99.0, "Active", None))
    with monkeypatch.context() as m:
        m.setattr(R, "remove", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            R.refresh(new.where(F.col("period") > F.lit(MONTHS[0])), path, M.invoice_audit)   # fails at the gone month
    failed = content(path)
    mart, log = R.refresh(new, path, M.invoice_audit)
    assert actions(log) == {str(MONTHS[0]): "kept", str(MONTHS[1]): "changed", str(MONTHS[2]): "kept", str(MONTHS[3]): "new"}
    assert content(path)[str(MONTHS[1])] == failed[str(MONTHS[1])] and rows(mart) == rows(M.invoice_audit(new))
    R.refresh(new.repartition(7), other, M.invoice_audit)   # another partitioning of the source
    assert content(other) == content(path)


def test_hot_months_are_spread_and_filters_prune(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "ROWS_PER_FILE", 20)
    monkeypatch.setattr(R, "MOST_LITERALS", 2)      # months are joined here
    src = lines(spark, 400).withColumn("period", F.when(F.col("billed_amount") > 110, F.lit(MONTHS[0])).otherwise(F.col("period")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # files this small would be merged
    try:
        mart, _ = R.refresh(src, f"{tmp_path}/m", M.invoice_audit)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files(f"{tmp_path}/m")[str(MONTHS[0])]) > 1
    assert rows(mart) == rows(M.invoice_audit(src))
    one = mart.where(F.col("period") == F.lit(MONTHS[1]))
    assert len(one.inputFiles()) < len(mart.inputFiles()) or "PartitionFilters: [isnotnull(period" in one._jdf.queryExecution().toString()


def test_digests_see_every_change(spark):
    base = lines(spark, 40)
    d = lambda df: rows(R.month_digests(df))
    assert d(base) == d(base.repartition(9).orderBy("vendor"))
    assert d(base) != d(base.unionByName(base.limit(1)))
    assert d(base) != d(base.unionByName(base.limit(1)).unionByName(base.limit(1)))      # pairs cancel in the xor only
    swap = base.withColumns({"vendor": F.col("planted_error"), "planted_error": F.col("vendor")})
    assert d(base) != d(swap)
