"""Repeated strings: brute force over every string, border and hot cases, edges."""

import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerspark.llm import suffix_dedup as sd


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[s:s + length] for b in data for s in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone) if not g)))
    return out


def test_winnow_is_the_least_of_every_window():
    rng = np.random.default_rng(1)
    for n in (216, 300, 1500):
        raw = rng.integers(97, 100, n).astype(np.uint8)
        at = sd.winnow(raw, 200)
        assert all(((at >= s) & (at < s + 200)).any() for s in range(n - 200 - sd.GRAM + 2))
        shift = sd.winnow(np.concatenate([rng.integers(97, 100, 37).astype(np.uint8), raw]), 200) - 37
        assert set(at[at < n - 400]) <= set(shift)      # the same bytes choose the same places


def test_parts_of_long_texts(monkeypatch):
    raw = np.random.default_rng(5).integers(97, 123, 3000).astype(np.uint8)
    whole = sd.winnow(raw, 200)
    monkeypatch.setattr(sd, "PART", 1024)
    assert set(whole) <= set(sd.winnow(raw, 200)) | set(whole[-1:]) and len(sd.winnow(raw, 200)) < 2 * len(whole) + 20


@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 3)), max_size=60), st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 3)), max_size=9))
@settings(max_examples=100, deadline=None)
def test_order_and_buckets(rows, cuts):
    keys = [np.array([r[i] for r in rows], np.uint64) for i in range(3)]
    order = sd.multikey_order(keys) if rows else np.array([], int)
    assert [rows[i] for i in order] == sorted(rows)
    cuts = sorted(cuts)
    got = sd.bucket_of(keys, [np.array([c[i] for c in cuts], np.uint64) for i in range(3)])
    assert got.tolist() == [sum(c <= r for c in cuts) for r in rows]


def check(spark, texts, length=400):
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, r string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sd.dedup(rows, length=length).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, length)


def test_near_copies_and_passages(spark):
    rng = np.random.default_rng(3)

    def prose(n):
        return "".join(rng.choice(list("abcdefgh é\n"), n))

    passage, base = prose(420), prose(1500)
    texts = [prose(300) + passage + prose(50), passage, prose(10) + passage, base, base, prose(900) + base[300:900] + prose(40), "", None, "short", base[:399], base[:400]]
    for _ in range(25):   # near copies: every one cut somewhere else
        at = int(rng.integers(0, 1400))
        texts.append(base[:at] + prose(3) + base[at + 3:])
    texts += ["ab" * 700, "z" * 2000, passage + passage, base[:401] + "!" + base[402:]]
    check(spark, texts)


def test_empty_table(spark):
    rows = spark.createDataFrame([], "doc_id long, text string")
    assert sd.dedup(rows).count() == 0


def test_query(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").orderBy("doc_id").collect()
    want = brute([r.text for r in rows], 400)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.query(spark, sf_small).collect()}
    assert [got[r.doc_id] for r in rows] == [(a, b, c, hashlib.sha256(k).hexdigest()) for a, b, c, k in want]


def test_passages(spark, sf_small):
    """Every row with a 300-byte string that stands elsewhere is marked, none without a shared 201-byte string."""
    rng = np.random.default_rng(9)

    def prose(n):
        return "".join(rng.choice(list("abcdefgh é\n"), n))

    passage = prose(320)
    texts = [prose(700) + passage, passage[:310] + prose(90), prose(500), prose(150), "", None, "z" * 250, "z" * 700, prose(400) + passage[:180] + prose(50)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id for r in sd.dedup(rows, passage=True).where("repeats").collect()}
    assert {0, 1, 7} <= got <= {0, 1, 6, 7}
    assert sd.dedup(rows.limit(0), passage=True).count() == 0

    rows = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()

    def holders(n):
        at = {}
        for r in rows:
            raw = (r.text or "").encode()
            for i in range(len(raw) - n + 1):
                at.setdefault(raw[i:i + n], set()).add((r.doc_id, i))
        return {d for s in at.values() if len(s) > 1 for d, _ in s}

    got = {r.doc_id for r in sd.query(spark, sf_small).where("repeats").collect()}
    assert holders(sd.PASSAGE) <= got <= holders(sd.PASSAGE - sd.PASSAGE_SPAN + 1)
