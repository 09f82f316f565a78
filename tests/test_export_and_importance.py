"""CSV exports hold what the marts hold; permutation importance against brute force."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import risk as G
from ledgerspark.plans.marts import marts_for
from ledgerspark.sources import sinks


def test_export_contents(spark, sf_small, tmp_path):
    marts = marts_for(spark, sf_small).all()
    counts = {r.mart: r.rows for r in sinks.export_csv(marts, str(tmp_path)).collect()}
    for name, df in marts.items():
        back = sinks.read_export(spark, str(tmp_path), name, df.schema)
        assert counts[name] == df.count()
        assert df.exceptAll(back).count() == 0 and back.exceptAll(df).count() == 0, name


def rows(n=60):
    return [("AB"[i % 2], dt.date(2020 + i // 24, i // 2 % 12 + 1, 1), float(i % 7), float(i % 5), 3.0, 99.0, int(i % 7 > 3)) for i in range(n)]


SCHEMA = "service_area string, period date, packet_loss double, latency double, mtbf double, uptime double, high_risk int"


def auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg)) if pos and neg else None


def plain(r):
    return (r["packet_loss"] * 2.0 + r["latency"] * 0.05 - r["mtbf"] * 0.0001) + (100.0 - r["uptime"])


def brute(data, turns, seed, blocks):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    recs = [dict(zip(names, r)) for r in data]
    base = auc([(plain(r), r["high_risk"]) for r in recs])
    out = {}
    for f in G.FEATURES:
        got = []
        for t in range(turns):
            def h(r, name):
                return hashlib.md5(f"{seed}|{t}|{f}|{name}|{r['service_area']}|{r['period']}".encode()).hexdigest()
            dealt = []
            for b in range(blocks):
                mine = [r for r in recs if int(h(r, "block")[:8], 16) % blocks == b]
                values = [r[f] for r in sorted(mine, key=lambda r: h(r, "from"))]
                dealt += [dict(r, **{f: v}) for r, v in zip(sorted(mine, key=lambda r: h(r, "to")), values)]
            got.append(auc([(plain(r), r["high_risk"]) for r in dealt]))
        out[f] = (base, sum(got) / turns)
    return out


@pytest.mark.parametrize("block_rows", [4096, 20])
def test_importance_equals_brute_force(spark, block_rows):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    score = lambda d: d.withColumn("score", G.plain_score())
    got = {r.feature: r for r in G.permutation_importance(df, score, turns=2, seed=4, block_rows=block_rows).collect()}
    want = brute(rows(), 2, 4, -(-60 // block_rows))
    assert set(got) == set(G.FEATURES)
    for f, (base, mean) in want.items():
        assert abs(got[f].auc - base) < 1e-12 and abs(got[f].permuted_auc - mean) < 1e-12 and abs(got[f].importance - (base - mean)) < 1e-12
    assert got["packet_loss"].importance > 0.2 and got["mtbf"].importance == got["uptime"].importance == 0      # constants don't matter


def test_importance_of_one_class(spark):
    df = spark.createDataFrame(rows(), SCHEMA).withColumn("high_risk", F.lit(0))
    got = G.permutation_importance(df, lambda d: d.withColumn("score", F.col("packet_loss")), turns=1).collect()
    assert {(r.auc, r.importance) for r in got} == {(None, None)}


def test_importance_of_a_model(spark):
    lab = G.time_split(spark.createDataFrame(rows(), SCHEMA), 9)
    model = G.fit_risk_model(lab.where("split = 'train'").select(*G.FEATURES, G.LABEL), trees=5)
    got = {r.feature: r.importance for r in G.permutation_importance(lab.where("split = 'test'"), lambda d: G.score(model, d), turns=1).collect()}
    assert max(got, key=got.get) == "packet_loss"
