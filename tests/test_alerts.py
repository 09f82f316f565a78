"""The alert stream gives the batch answer under any cut into micro-batches, and after restarts."""

import datetime as dt
import itertools
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import deviation as V
from ledgerspark.streaming import alerts as A
from ledgerspark.streaming import monitor as S

SCHEMA = "service_area string, period date, packet_loss double, uptime double"
MONTHS = [dt.date(2025 + m // 12, m % 12 + 1, 1) for m in range(14)]
METRICS = ("packet_loss", "uptime")


def scorecard():
    rng = random.Random(7)
    rows = [(a, m, rng.choice([None, 0.1, 0.25, 1.75, 9.0, 0.3333333333]), 99.0) for a in ("A", "B", None) for m in MONTHS]
    rows += [("flat", m, 0.5 if m < MONTHS[6] else 0.6, 99.0 if m != MONTHS[9] else 98.0) for m in MONTHS]     # no spread in the baseline
    rows += [("late", m, 1.0, 99.0) for m in MONTHS[5:]]                                                      # no baseline at all
    rows += [("once", MONTHS[0], 1.0, 99.0), ("once", MONTHS[8], 5.0, 1.0)]                                   # a baseline of one month
    return rows


def write(spark, path, batches):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, out, files=1):
    stream = spark.readStream.schema(spark.createDataFrame([], SCHEMA).schema).option("maxFilesPerTrigger", files).parquet(path)
    with A.rocksdb(spark):
        return S.run_available(A.alert_stream(stream, MONTHS[0], METRICS), f"{out}/alerts", f"{out}/ck")


def rows(df):
    return sorted(map(repr, df.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]).collect()))


@pytest.fixture(scope="module")
def want(spark):
    got = rows(V.spc_history(spark.createDataFrame(scorecard(), SCHEMA), METRICS))
    assert any("breach=True" in r for r in got) and len(got) > 60
    return got


@pytest.mark.parametrize("cut", [[14], [1, 2, 3, 8], [4] * 3 + [2]])
def test_any_cut_gives_the_batch_answer(spark, want, cut):
    d = tempfile.mkdtemp(prefix="ls-alerts-")
    ends = list(itertools.accumulate(cut))
    batches = [[r for r in scorecard() if MONTHS.index(r[1]) in range(e - n, e)] for e, n in zip(ends, cut)]
    write(spark, f"{d}/in", [b[::-1] for b in batches])
    assert rows(run(spark, f"{d}/in", d)) == want


def test_restart_and_late_rows_within_the_bound(spark, want):
    """Stopped while rows wait for the baseline, resumed twice; a baseline row comes a month late."""
    d = tempfile.mkdtemp(prefix="ls-alerts-")
    data = scorecard()
    late = [r for r in data if r[1] == MONTHS[2] and r[0] == "A"]
    first = [r for r in data if r[1] <= MONTHS[3] and r not in late]
    write(spark, f"{d}/in", [first])
    assert run(spark, f"{d}/in", d).count() == 0      # the watermark has not passed the baseline's end
    write(spark, f"{d}/in", [late + [r for r in data if r[1] == MONTHS[4]]])
    half = run(spark, f"{d}/in", d).count()
    write(spark, f"{d}/in", [[r for r in data if r[1] in MONTHS[5:9]], [r for r in data if r[1] in MONTHS[9:]]])
    got = run(spark, f"{d}/in", d)
    assert half < len(want) and rows(got) == want
    assert rows(run(spark, f"{d}/in", d)) == want      # nothing new, nothing twice


def test_judged_as_in_batch(spark):
    cases = [(v, m, mean, std) for v in (None, 1.0, 2.0, 9.0, -9.0) for m in METRICS for mean in (1.0, 2.0) for std in (None, 0.0, 0.5)]
    df = spark.createDataFrame([(*c, i) for i, c in enumerate(cases)], "v double, m string, baseline_mean double, baseline_std double, i int")
    z, breach = V.z_and_breach(F.col("v"), F.col("m"), 3.0)
    for r in df.select("i", "v", "m", "baseline_mean", "baseline_std", z.alias("z"), breach.alias("b")).collect():
        assert A.judged(r.v, r.m, r.baseline_mean, r.baseline_std, 3.0) == (r.z, r.b), r


def test_moments_are_exact():
    values = [0.1, 0.2, 0.3, 1e9, -5.5, 0.0000000001]
    sums = {(len(values), sum(map(A.as_units, p)), sum(A.as_units(x) ** 2 for x in p)) for p in itertools.permutations(values)}
    assert len(sums) == 1
    mean, std = A.baseline(*sums.pop())
    assert abs(mean - sum(values) / 6) < 1e-6 and abs(std / (sum((v - mean) ** 2 for v in values) / 5) ** 0.5 - 1) < 1e-12
    assert A.baseline(1, A.as_units(2.5), A.as_units(2.5) ** 2) == (2.5, None)
