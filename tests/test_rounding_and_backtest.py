"""Rounding that adds up, backtests against refits, the model-free risk frames: odd inputs."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import chargeback as E
from ledgerspark.operators import forecast as FC
from ledgerspark.operators import risk as G


def test_weights_sum_to_one(spark):
    rng = random.Random(3)
    rows = [(a, f"u{i}", round(rng.random() * 10 ** rng.randint(0, 9), 4)) for a in "ABCDEF" for i in range(7)]
    rows += [("thirds", u, 1.0) for u in "xyz"] + [("zero", u, 0.0) for u in "xy"] + [("one", "x", 5.0), ("big", "x", 9e14), ("big", "y", 1e-4)]
    df = spark.createDataFrame(rows, "service_area string, business_unit string, units double").repartition(5)
    got = {}
    for r in E.consumption_weights_exact(df).collect():
        got.setdefault(r.service_area, {})[r.business_unit] = r.weight
    for area, w in got.items():
        if area == "zero":
            assert set(w.values()) == {None}
            continue
        assert round(sum(w.values()) * 1000) == 1000 and all(abs(x * 1000 - round(x * 1000)) < 1e-9 for x in w.values())
        total = sum(u for a, _, u in rows if a == area)
        assert all(abs(w[b] - u / total) < 0.001 for a, b, u in rows if a == area)
    assert got["thirds"] == {"x": 0.334, "y": 0.333, "z": 0.333}      # ties in the order of the names


def test_statement_parts_sum_to_total(spark):
    rng = random.Random(5)
    rows = [(f"a{i}", f"u{j}", round(rng.random(), 3), round(rng.random() * 1e8, 4)) for i in range(6) for j in range(9)]
    rows += [("a0", "half", 0.5, 1.0), ("a1", "half", 0.5, 2.0), ("a0", "credit", 1.0, -3.7), ("a1", "credit", 1.0, 1.2)]
    alloc = spark.createDataFrame(rows, "service_area string, business_unit string, weight double, area_cost double")
    got = {r.business_unit: r.asDict() for r in E.chargeback_statement_exact(alloc).collect()}
    for unit, r in got.items():
        parts = {k: v for k, v in r.items() if k not in ("business_unit", "TOTAL") and v is not None}
        exact = {a: w * c for a, u, w, c in rows if u == unit}
        assert sum(parts.values()) == r["TOTAL"] and set(parts) == set(exact)
        assert all(abs(parts[a] - exact[a]) < 1 for a in parts) and abs(r["TOTAL"] - sum(exact.values())) <= 0.5 + 1e-6
    assert got["half"]["a0"] == 1 and got["half"]["a1"] == 1 and got["half"]["TOTAL"] == 2     # 0.5 + 1.0 = 1.5
    assert E.chargeback_statement_exact(alloc.limit(0), areas=["a0"]).count() == 0


@pytest.mark.parametrize("keys", [[], ["service_area"]])
def test_backtest_equals_refits(spark, keys):
    rng = random.Random(9)
    months = [dt.date(2020 + m // 12, m % 12 + 1, 1) for m in range(30)]
    areas = ["A", "B"] if keys else ["A"]
    data = [(a, m, 0.0 if (a, i) == ("A", 28) else round(1e6 + 1e4 * i + rng.random() * 1e5, 2)) for a in areas for i, m in enumerate(months)]
    series = FC.monthly_spend(spark.createDataFrame(data, "service_area string, period date, telecom_spend double").repartition(6), keys)
    got = FC.rolling_backtest(series, min_train=10, horizon=3, keys=keys).collect()
    want = {}
    for a in areas:
        y = [v for b, _, v in data if b == a]
        for o in range(9, 30):
            b1, b0 = np.polyfit(range(o + 1), y[:o + 1], 1)
            for h in (1, 2, 3):
                if o + h < 30:
                    f = b0 + b1 * (o + h)
                    want[(a, months[o], h)] = (months[o + h], y[o + h], f, None if y[o + h] == 0 else 1 - abs(f - y[o + h]) / y[o + h])
    assert len(got) == len(want)
    for r in got:
        period, actual, f, acc = want[(r.service_area if keys else "A", r.origin, r.h)]
        assert r.period == period and r.actual == actual and abs(r.forecast - f) < 1e-3
        assert (r.accuracy is None) == (acc is None) and (acc is None or abs(r.accuracy - acc) < 1e-8)
    s = {(r.service_area if keys else "A", r.h): r for r in FC.backtest_summary(spark.createDataFrame(got), keys).collect()}
    for (a, h), r in s.items():
        accs = [x[3] for k, x in want.items() if k[0] == a and k[2] == h and x[3] is not None]
        assert r.origins == len(accs) and abs(r.mean_accuracy - np.mean(accs)) < 1e-8 and abs(r.worst_accuracy - min(accs)) < 1e-8


def test_backtest_of_short_series(spark):
    one = FC.monthly_spend(spark.createDataFrame([("A", dt.date(2025, 1, 1), 5.0)], "service_area string, period date, telecom_spend double"))
    assert FC.rolling_backtest(one, 1).count() == 0 and FC.rolling_backtest(one.limit(0)).count() == 0


def test_risk_frames_need_no_model(spark):
    rows = [(a, dt.date(2025, m, 1), 0.1 * m, 1.0, 2.0, 3.0, float(m)) for a in "AB" for m in range(1, 13)]
    sam = spark.createDataFrame(rows, "service_area string, period date, packet_loss double, latency double, mtbf double, uptime double, incident_cost double")
    lab = G.risk_labels(sam)
    frame = G.risk_frame(lab).toPandas()
    assert (frame.split == "train").sum() == 18 and frame.high_risk.sum() == 6
    assert {r.period for r in G.watch_months(lab).collect()} == {dt.date(2025, 12, 1)}
