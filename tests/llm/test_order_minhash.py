"""Order MinHash: a plain reimplementation, the edited texts, sensitivity to order, edges."""

import hashlib
import random

import xxhash
from pyspark.sql import functions as F

from ledgerspark.llm import order_minhash as om


def h(*xs):
    """Spark's xxhash64 of longs, ints and strings, one after the other, signed."""
    seed = 42
    for x in xs:
        data = x.encode() if isinstance(x, str) else x[0].to_bytes(4, "little", signed=True) if isinstance(x, tuple) else x.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain(text):
    words = [h(w) for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in text or "").split(" ") if w]
    grams = [h(words[i], words[i + 1] if i + 1 < len(words) else 0) & ~om.PLACE for i in range(max(len(words) - 1, min(len(words), 1)))]
    seen, sketches = {}, {}
    for i, g in enumerate(grams):
        o = seen[g] = seen.get(g, -1) + 1
        e = h(g, (o,)) & ~om.PLACE
        sketches.setdefault((e & (1 << 64) - 1) >> 59, []).append((e, i))
    codes = set()
    for b, elements in sketches.items():
        least = sorted(sorted(elements)[:2], key=lambda x: x[1])
        code = h(*(e for e, _ in least)) & ((1 << 59) - 1) | b << 59
        codes.add(code - (1 << 64) if code >> 63 else code)
    return codes


def test_plain(spark):
    texts = ["", "one", "a b", "a b a b a b a b", "the cat sat on the mat and the cat sat on the mat " * 9, "x " * 500, " \n lead and trail \t", None]
    rows = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, x string")
    got = {r.doc_id: r.codes for r in om.fingerprints(rows).collect()}
    assert [set(got[i]) for i in range(len(texts))] == [plain(t) for t in texts]
    assert all(len(set(c)) == len(c) for c in got.values())


def test_order_and_likeness(spark):
    words = [f"w{i}" for i in range(400)]
    moved = words[200:] + words[:200]
    pairs = [(" ".join(words), " ".join(words)), (" ".join(words), " ".join(moved)), (" ".join(words), " ".join(words[::-1])), (" ".join(words), " ".join(words[:390] + ["z"] * 10)), ("", "")]
    rows = spark.createDataFrame(pairs, "a string, b string")
    rows = om.fingerprints(om.fingerprints(rows, "a", "x"), "b", "y")
    same, swapped, backwards, near, empty = [r.l for r in rows.select(om.likeness(F.col("x"), F.col("y")).alias("l")).collect()]
    assert same == 1 and empty == 1 and backwards == 0 and near > 0.7
    assert swapped < 0.8     # the same k-mers but for one; what changed is their order


def test_unspaced_texts(spark):
    rng = random.Random(4)
    han, other = ("".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(800)) for _ in range(2))
    pairs = [(han, han), (han, han[:400] + "\u4e00" + han[400:]), (han, han[:200] + han[201:]), (han, other), (han, han[400:] + han[:400]), ("a" * 32, "a" * 33)]
    rows = om.fingerprints(om.fingerprints(spark.createDataFrame(pairs, "a string, b string"), "a", "x"), "b", "y")
    same, grown, shorter, apart, swapped, _ = [r.l for r in rows.select(om.likeness(F.col("x"), F.col("y")).alias("l")).collect()]
    assert same == 1 and grown > 0.7 and shorter > 0.7 and apart == 0 and swapped < 0.8


def edited(texts):
    out = []
    for k, t in enumerate(texts):
        nxt, half = texts[(k + 1) % len(texts)], len(t) // 2
        out.append(t[:len(t) - half] + nxt[:half])
    return out


def test_edited(spark, monkeypatch):
    monkeypatch.setattr(om, "ROWS_PER_RANGE", 3)
    texts = ["é" * 11, "", "b" * 4, "c", "dd" * 900, "", "same words here", "same words here", "z z", "last one"]
    ids = [90, 81, 70, 61, 50, 41, 30, 30, 5, None]
    rows = spark.createDataFrame([(i, t or None, "x", 1) for i, t in zip(ids, texts)], "doc_id long, text string, key string, g int").repartition(4)
    got = {(r.doc_id, r.n_chars): r.edited for r in om.edited(rows).collect()}
    assert got == {(i, len(t)): e for i, t, e in zip(ids, texts, edited(texts))}
    one = om.edited(rows.where("doc_id = 90")).collect()
    assert len(one) == 1 and one[0].edited == "é" * 11
    assert om.edited(rows.limit(0)).count() == 0


def test_query(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").orderBy(F.desc("doc_id")).collect()
    texts = [r.text or "" for r in rows]
    got = {r.doc_id: r for r in om.query(spark, sf_small).collect()}
    prints = {}
    for r, t, e in zip(rows, texts, edited(texts)):
        g = got[r.doc_id]
        assert (g.n_chars, g.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert prints.setdefault(t, g.fingerprint) == g.fingerprint and 0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1
