"""Source divergence against brute force, through spills, long texts, many sources and odd rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    """{(lang, source, part, item, value, rank)} of (lang, source, text) rows."""
    df, count, groups = {}, {}, {}
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.setdefault(lang, set()).add(source)
        found = TERM.findall((text or "").translate(LOWER))
        for t in set(found):
            df[lang, t] = df.get((lang, t), 0) + 1
        for t in found:
            count[lang, source, t] = count.get((lang, source, t), 0) + 1
    out = set()
    for lang, sources in groups.items():
        kept = [t for (g, t), n in df.items() if g == lang and n >= least]
        v = len(kept)

        def shares(some):
            n = {t: sum(count.get((lang, s, t), 0) for s in some) for t in kept}
            return {t: 1 + 10**9 * (n[t] + 5) // (sum(n.values()) + 5 * v) for t in kept}

        p, q = {s: shares([s]) for s in sources}, shares(sources)
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if count.get((lang, s, t)) and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                for k, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode())), 1):
                    if part == "pair" or k <= top:
                        out.add((lang, s, part, item, value, k))
    return out


def rows(spark, data, parts=4):
    df = spark.createDataFrame(data, "lang string, source string, text string")
    return df.withColumn("term", F.lit(1)).withColumn("counts", F.lit("x")).withColumn("salt", F.lit(2)).withColumn("rank", F.lit(3)).repartition(parts)


def made(seed, n, n_sources):
    rng = random.Random(seed)
    vocabulary = ["a", "The", "é", "ÉTÉ", "don't", "x1y", "東京", "z" * 40] + [f"w{c}" for c in "abcdefghijklmnop"]
    return [(rng.choice(["en", "fr", "", None]), rng.choice([None, "", *(f"s{i}" for i in range(n_sources))]) if rng.random() < 0.6 else "hot",
             None if rng.random() < 0.05 else " ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))) for _ in range(n)]


@pytest.mark.parametrize("cells,piece,dealt,sources", [(400_000, 1 << 20, 250_000, 256), (25, 7, 11, 3)])
def test_equals_brute_force(spark, monkeypatch, cells, piece, dealt, sources):
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "PIECE", piece)
    monkeypatch.setattr(divergence, "DEALT", dealt)
    monkeypatch.setattr(divergence, "SOURCES", sources)
    data = made(cells, 250, 6)
    got = [tuple(r) for r in divergence.audit(rows(spark, data), least=8, top=4).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(data, 8, 4)


def test_groups_without_terms(spark):
    """No term is kept, or none occurs in a group: pairs stay, with what smoothing alone gives."""
    data = [("en", "a", "one two"), ("en", "b", None), ("de", "x", ""), ("de", "y", ""), ("it", "lone", "one")]
    for least in (1, 30):
        got = {tuple(r) for r in divergence.audit(rows(spark, data), least=least).collect()}
        assert got == brute(data, least, 50) and len([r for r in got if r[2] == "pair"]) == 4


def test_hot_and_repeated(spark):
    data = [("en", "hot", "same words here")] * 400 + [("en", f"s{i}", "same other") for i in range(40)]
    got = {tuple(r) for r in divergence.audit(rows(spark, data, 9)).collect()}
    assert got == brute(data, 30, 50)


def test_long_text(spark):
    data = [("en", "a", "word " * 600_000), ("en", "b", "w" * 3_000_000)] + [("en", "c", "word")] * 2
    got = {tuple(r) for r in divergence.audit(rows(spark, data, 2), least=1).collect()}
    assert got == brute(data, 1, 50)


def test_exact_shares(spark):
    """Long division in int64 and DECIMAL division agree with Python's integers, also where a product passes 2^63."""
    import numpy as np

    cases = [(c, n, v) for n in (0, 7, 10**6, 10**15) for v in (1, 3, 10**6) for c in (0, 1, n // 3, n) if c <= n]
    want = [1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in cases]
    assert [int(divergence.shares(np.array([[c]]), np.array([n + 5 * v]))[0, 0]) for c, n, v in cases] == want
    df = spark.createDataFrame([(*x, i) for i, x in enumerate(cases)], "c long, n long, v long, i int").orderBy("i")
    assert [r[0] for r in df.select(divergence.share(F.col("c"), F.col("n"), F.col("v"))).collect()] == want


def test_empty(spark):
    out = divergence.audit(rows(spark, made(1, 3, 2)).limit(0))
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"] and out.count() == 0
