"""Mixing: exponent against a plain bisection, budgets, blocks, edges."""

import math

import pandas as pd
import pytest

from ledgerspark.llm import mixing
from ledgerspark.llm.common import stage, with_row_id


def table(spark, sizes, words=40):
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((i, "w " * (words + i % 7), s, "x"))
            i += 1
    return stage(with_row_id(spark.createDataFrame(rows, "doc_id long, text string, source string, weight string")), "test")


def entropy(p, a):
    w = [x ** a for x in p]
    w = [x / sum(w) for x in w]
    return -sum(x * math.log(x) for x in w)


def plain(p, target):
    low, high = 0.0, 1.0
    if entropy(p, 1.0) >= target:
        return 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(p, mid) > target else (low, mid)
    return high


def test_exponent_and_budgets(spark):
    docs = table(spark, {"big": 600, "mid": 150, "small": 40})
    got = mixing.mix(docs, "rid", target_entropy=0.9, max_repeat=5.0, block_tokens=500).toPandas()
    tokens = got.groupby("source").n_tokens.sum()
    p = (tokens / tokens.sum()).to_list()
    a = plain(p, 0.9 * math.log(3))
    # the entropy falls as the exponent grows: the least one that meets the target
    assert abs(got.exponent[0] - a) < 1e-6
    used = got.assign(u=got.n_tokens * got.copies).groupby("source").u.sum()
    weight = got.groupby("source").weight.first()
    assert abs(weight.sum() - 1) < 1e-9
    for s in tokens.index:    # within one document of the budget
        assert 0 <= weight[s] * tokens.sum() - used[s] + 1 <= got.n_tokens.max() + 2
    assert len(got) == 790 and got.groupby("source").copies.agg(lambda c: c.max() - c.min()).max() <= 1


def test_repetition_limit(spark):
    docs = table(spark, {"big": 400, "small": 20})
    got = mixing.mix(docs, "rid", target_entropy=0.999, max_repeat=3.0).toPandas()
    tokens = got.groupby("source").n_tokens.sum()
    repeat = got.groupby("source").weight.first() * tokens.sum() / tokens
    assert repeat.max() <= 3.0 + 1e-6 and repeat.max() > 2.99 and got.copies.max() <= 3
    free = mixing.mix(docs, "rid", target_entropy=0.9, max_repeat=1.0, budget=None).toPandas()
    assert set(free.copies) == {0, 1} and (free[free.source == "small"].copies == 1).all()


def test_tiny_sources_do_not_shrink_the_mix(spark):
    sizes = {f"s{i}": 30 for i in range(20)} | {"hot": 300}
    for tiny in ({}, {None: 1} | {f"t{i}": 1 for i in range(40)}):
        got = mixing.mix(table(spark, sizes | tiny), "rid", target_entropy=0.95, max_repeat=1.0, budget=None).toPandas()
        got["source"] = got.source.fillna("null")
        tokens = got.groupby("source").n_tokens.sum()
        used = got.assign(u=got.n_tokens * got.copies).groupby("source").u.sum()
        assert got.copies.max() == 1 and 0.75 * tokens.sum() < used.sum()
        # only the hot source is cut
        assert (used == tokens)[used.index != "hot"].all() and used["hot"] < 0.75 * tokens["hot"]
        q = used / used.sum()
        assert abs(got.groupby("source").weight.first() - q).max() < 0.002
        if not tiny:   # as far as the entropy asks for and no further, within a document
            assert abs(-(q * q.map(math.log)).sum() / math.log(len(q)) - 0.95) < 0.002


def test_blocks_are_permutations(spark):
    got = mixing.mix(table(spark, {"a": 300, "b": 90}), "rid", block_tokens=800).toPandas()
    for _, g in got.groupby("source"):
        assert sorted(g.block_rank.unique()) == list(range(1, g.block_rank.nunique() + 1)) and g.block_rank.nunique() > 1
        for _, b in g.groupby("block_rank"):
            assert sorted(b.position) == list(range(1, len(b) + 1))
        first = g.sort_values(["block_rank", "position"]).copies.to_list()
        assert first == sorted(first, reverse=True)      # those that come first get the extra copy
    again = mixing.mix(table(spark, {"a": 300, "b": 90}).repartition(7), "rid", block_tokens=800).toPandas()
    assert got.set_index("doc_id").copies.sort_index().equals(again.set_index("doc_id").copies.sort_index())


def test_edges(spark):
    rows = spark.createDataFrame([(1, "a b", None), (1, "a b", None), (None, "c", "s"), (3, None, "empty"), (4, "", "empty"), (5, "w " * 5000, "s")], "doc_id long, text string, source string")
    got = mixing.mix(stage(with_row_id(rows), "test"), "rid").toPandas()
    assert len(got) == 6 and (got[got.source == "empty"].copies == 0).all() and (got[got.source == "empty"].weight == 0).all()
    assert got.source.isna().sum() == 2
    assert mixing.mix(stage(with_row_id(rows.limit(0)), "test"), "rid").count() == 0
    nothing = mixing.mix(stage(with_row_id(rows.where("source = 'empty'")), "test"), "rid").toPandas()
    assert (nothing.copies == 0).all()
