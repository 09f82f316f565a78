"""SimHash: fingerprints by definition, the trie join and classes against brute force."""

import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerspark.llm import simhash
from ledgerspark.llm.cells import forest


def by_definition(text, width=4):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, budget=4):
    out = list(range(len(fps)))
    for _ in fps:
        for i, a in enumerate(fps):
            out[i] = min(out[j] for j, b in enumerate(fps) if bin(a ^ b).count("1") <= budget)
    return out


@given(st.text(alphabet="aB É\t\n.,\x0b\x1c", max_size=60))
@settings(max_examples=150, deadline=None)
def test_fingerprint(text):
    assert simhash.simhash(text, 4) == by_definition(text)


def test_trie_join_finds_every_pair():
    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False))) for _ in range(400)]
    fps = np.unique(np.concatenate([seeds, rng.choice(seeds, 400) ^ np.array(flips, np.uint64)]))
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if int(np.bitwise_count(fps[i] ^ fps[j])) <= 4}
    for brute, most, cells in ((1, 3, 5), (64, 1 << 12, 1 << 18)):
        got = [p for i, j in simhash.trie_pairs(fps, np.full(len(fps), 2), 4, brute, most, cells) for p in zip(i.tolist(), j.tolist())]
        assert len(got) == len(set(got)) and set(got) == want
    side = rng.integers(0, 2, len(fps))
    got = {p for i, j in simhash.trie_pairs(fps, side, 4) for p in zip(i.tolist(), j.tolist())}
    assert got == {(i, j) for i, j in want if side[i] != side[j]}


def test_masks_leave_a_key_for_every_close_pair():
    rng = np.random.default_rng(2)
    masks = simhash.block_masks(4)
    for _ in range(300):
        d = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(d & m == 0 for m in masks)


def test_forest():
    assert forest(6, iter([(np.array([1, 4]), np.array([3, 5])), (np.array([3]), np.array([4]))])).tolist() == [0, 1, 2, 1, 1, 1]


def test_hot_keys_in_chunks(spark):
    rng = np.random.default_rng(9)
    base = int(rng.integers(0, 2**62))
    fps = sorted({base ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(120)} | set(rng.integers(0, 2**62, 30).tolist()))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    for chunk in (7, 2048):
        from ledgerspark.llm.components import connected_components
        comp = {r.node: r.component for r in connected_components(simhash.links(nodes, 4, chunk)).collect()}
        want = classes(fps)
        groups, expect = {}, {}
        for i, s in enumerate(signed):
            groups.setdefault(comp.get(s, s), set()).add(i)
            expect.setdefault(want[i], set()).add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_edges(spark, docs_of):
    long = "alpha beta gamma delta epsilon " * 800
    docs = docs_of([long, long, "", None, " \n", "one", "ONE", long, "other words stand in this one"], ids=[5, 3, 8, 2, None, 7, 7, 3, None])
    got = simhash.near_classes(docs).collect()
    assert len(got) == 9
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    assert sorted(x.doc_id for x in by[3]) == [3, 3, 5] and len(by[7]) == 2
    assert {x.doc_id for x in by[2]} == {8, 2, None} and [x.doc_id for x in by[None]] == [None]
    assert all(sum(x.is_first for x in rows) == 1 for rows in by.values())
    assert simhash.near_classes(docs.limit(0)).count() == 0


def test_query(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").orderBy("doc_id").collect()
    fps = [by_definition(r.text) for r in rows]
    comp = [rows[i].doc_id for i in classes(fps)]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.query(spark, sf_small).collect()}
    assert got == {r.doc_id: (f"{f:016x}", c) for r, f, c in zip(rows, fps, comp)}
