"""Merkle manifest against a direct tree, over group sizes around block borders and odd rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import merkle


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def brute(rows):
    """(id, leaf, subroot, root, siblings) of (id, group, leaf) rows."""
    groups = {}
    for i, g, leaf in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(g, []).append((i, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([leaf for _, leaf in groups[g]]) for g in names}
    crown = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for p, (i, leaf) in enumerate(groups[g]):
            sib = []
            for tree, q in ((trees[g], p), (crown, k)):
                for level in tree[:-1]:
                    sib.append((level[q ^ 1] if (q ^ 1) < len(level) else "", bool(q & 1)))
                    q >>= 1
            out.append((i, leaf, trees[g][-1][0], crown[-1][0], sib))
    return out


def got(df):
    return [(r.doc_id, r.leaf, r.subroot, r.root, [(e.digest, e.right) for e in r.path]) for r in df.collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], [s for s, _ in r[4]]))


def test_shapes(spark, monkeypatch):
    """One node, full and part blocks, several tiers, many groups, repeated and null ids and groups."""
    monkeypatch.setattr(merkle, "ROWS_PER_RANGE", 97)
    monkeypatch.setattr(merkle, "BITS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 4)
    rows = [(i, "hot", sha(f"h{i}")) for i in range(333)]                      # most of the rows, five tiers
    rows += [(7, "same", sha("copy"))] * 70 + [(None, "same", sha(f"n{i % 3}")) for i in range(30)]
    rows += [(i, None, sha(f"z{i}")) for i in range(5)] + [(1, "", sha("e")), (1, "é", sha("u")), (2, "z", sha("v"))]
    rows += [(i, f"g{n}", sha(f"{n}-{i}")) for n in range(1, 18) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string").repartition(7)
    out = merkle.tree(df).select("*", merkle.fold(F.col("leaf"), F.col("path")).alias("folded"))
    assert order(got(out)) == order(brute(rows))
    assert out.where("folded = root").count() == len(rows)


def test_one_changed_bit_shows(spark):
    rows = [(i, "a", sha(str(i))) for i in range(9)]
    out = merkle.tree(spark.createDataFrame(rows, "doc_id long, lang string, leaf string"))
    bad = out.select(merkle.fold(F.lit(sha("other")), F.col("path")).alias("f"), "root")
    assert bad.where("f = root").count() == 0


def test_leaf(spark):
    cols = [F.lit(3).cast("long"), F.lit(None).cast("string"), F.lit(""), F.lit("né\n"), F.lit("4:né")]
    assert spark.range(1).select(merkle.leaf_of(cols)).first()[0] == sha("1:3" + "-" + "0:" + "4:né\n" + "5:4:né")


def test_tables(spark, docs_of):
    docs = docs_of(["a", "", None, "x" * 300_000, "a"], ids=[2, 1, None, 2, 2])
    odd = docs.withColumn("g", F.lit("g")).withColumn("pos", F.lit(1)).withColumn("leaf", merkle.leaf_of([F.col(c) for c in merkle.FIELDS]))
    odd = odd.withColumn("digest", F.lit(9)).withColumn("path", F.lit(8)).withColumn("root", F.lit("r")).withColumn("block", F.lit(0))
    out = merkle.tree(odd, carry=["text", "rid"])
    assert out.columns == ["doc_id", "lang", "leaf", "text", "rid", "path", "subroot", "root"] and out.count() == 5
    assert merkle.tree(odd.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2])
def test_single_rows(spark, n):
    rows = [(i, "a", sha(str(i))) for i in range(n)]
    out = merkle.tree(spark.createDataFrame(rows, "doc_id long, lang string, leaf string"))
    assert order(got(out)) == order(brute(rows))


def test_query(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    leaf = {r.doc_id: sha("".join(field(r[c]) for c in merkle.FIELDS)) for r in rows}
    want = {r[0]: r for r in brute([(r.doc_id, r.lang, leaf[r.doc_id]) for r in rows])}
    out = merkle.query(spark, sf_small).collect()
    assert len(out) == len(rows)
    chars = {r.doc_id: r.n_chars for r in rows}
    for r in out:
        _, lf, sub, root, path = want[r.doc_id]
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == (lf, sub, root, sha("".join(s for s, _ in path)))
        cheat = zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and chars[r.doc_id] is not None
        assert r.verified == (r.folded_root == r.root) == (not cheat)
