"""Quality: the blocked vote against a plain loop, held-out accuracy, edges."""

import numpy as np

from ledgerspark.llm import quality


def model_of(texts, y):
    x = [quality.term_shares(t) for t in texts]
    at = [np.flatnonzero(v).tolist() for v in x]
    return quality.fit_vectors(at, [v[i].tolist() for v, i in zip(x, at)], np.array(y, float), 8, 7)


GOOD = [f"Some plain sentence number {i}, with words. Then another one follows it here." for i in range(30)]
BAD = [f"BUY!! NOW!! {i} CHEAP!! STUFF!! $$$ *** BUY!! NOW!!" for i in range(30)]


def test_vote_equals_a_plain_loop():
    m = model_of(GOOD + BAD, [1] * 30 + [0] * 30)
    texts = ["A plain sentence, as before.", "WOW!! GREAT!! $$$", "mixed WORDS!! and so on."]
    got = m.score(np.stack([quality.term_shares(t) for t in texts]), 7)
    for t, s in zip(texts, got):
        v = quality.term_shares(t) @ m.weights
        cos = m.vectors @ (v / np.linalg.norm(v))
        near = np.sort(cos)[::-1][:7].astype(float)
        y = m.labels[np.argsort(-cos)[:7]]
        gap = near[0] - near
        w = np.exp(-gap / max(gap.mean(), 1e-6))
        assert abs((w * y).sum() / w.sum() - s) < 1e-3
    assert got[0] > 0.9 and got[1] < 0.1


def test_edges(spark, docs_of):
    docs = docs_of(GOOD + BAD + ["", None, GOOD[0], "word " * 3000, "é" * 500])
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(60)] + [(0, 1), (1, None), (None, 1), (999, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r["_s"] for r in quality.score(docs, model, out="_s").collect()}
    assert len(got) == 65 and all(0 <= s <= 1 for s in got.values())
    assert got[60] == got[61] == model.prior and model.prior == 0.5 and got[0] == got[62]
    assert quality.score(docs.limit(0), model, out="_s").count() == 0
    none = quality.fit(docs, labels.limit(0))
    assert {r["_s"] for r in quality.score(docs, none, out="_s").collect()} == {0.5}


def test_sample_is_bounded_and_repeatable(spark, docs_of):
    docs = docs_of(GOOD + BAD)
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(60)], "doc_id long, quality int")
    a, b = (quality.fit(docs.repartition(n), labels.repartition(n), most=20) for n in (1, 5))
    assert len(a.labels) == 20 and np.array_equal(a.vectors, b.vectors)


def test_words_count():
    rng = np.random.default_rng(5)
    plain, spam = "river stone cloud garden winter letter window".split(), "casino jackpot winner credit lottery prizes bonus".split()
    han = [[chr(0x4E00 + 40 * k + i) for i in range(40)] for k in (0, 1)]
    for kinds, glue in (((plain, spam), " "), (han, "")):   # the same form, other words; a script without spaces
        texts = [glue.join(rng.choice(kinds[k], 60)) for _ in range(40) for k in (0, 1)]
        m = model_of(texts, [1, 0] * 40)
        got = m.score(np.stack([quality.term_shares(glue.join(rng.choice(k, 60))) for k in kinds]), 7)
        assert got[0] > 0.9 and got[1] < 0.1


def test_a_repeated_id_is_one_row_of_the_sample(spark, docs_of):
    docs = docs_of(GOOD + BAD + [f"{t} again" for t in BAD] * 3, ids=[*range(60), *[7] * 90])
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(60)], "doc_id long, quality int")
    a, b = (quality.fit(docs.repartition(n), labels) for n in (1, 5))
    assert len(a.labels) == 60 and np.array_equal(a.vectors, b.vectors)


def test_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.query(spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() >= 0.95
    assert held[held.quality == 1].predicted.mean() >= 0.97


def test_labels_of_other_rows_do_not_fill_the_bound(spark, docs_of):
    docs = docs_of(GOOD + BAD)
    own = spark.createDataFrame([(i, int(i < 30)) for i in range(60)], "doc_id long, quality int")
    other = spark.range(1000, 601_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    assert len(quality.fit(docs, own.unionByName(other)).labels) == 60
