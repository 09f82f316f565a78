"""Extra columns named like anything that an operator or the pipeline names inside."""

import ast
import pathlib
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from ledgerspark.llm import bpe, divergence, langid, licenses, merkle, mixing, order_minhash, quality, secrets, simhash, suffix_dedup, token_shards
from ledgerspark.llm.common import stage, with_row_id

ROOT = pathlib.Path(__file__).parents[2]
SHARED = [ROOT / f"ledgerspark/llm/{m}.py" for m in ("common", "spans", "cells", "components")]
OWN = ("doc_id", "text", "lang", "source", "n_chars", "row_id")
TEXTS = ["Under the MIT License: password = hunter22 here", "one two three four five six", "one two three four five six", "", None, "été noël cœur", "x" * 500 + " y"] * 3


def names(*paths):
    """Every word that stands as a string in the modules, and column names in their schema strings."""
    found = {}
    for path in paths:
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Constant) and isinstance(node.value, str) and len(node.value) < 200:
                for word in re.findall(r"\b[A-Za-z_]\w{0,24}\b", node.value):
                    found.setdefault(word.lower(), word)
    return [w for k, w in sorted(found.items()) if k not in OWN]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else "fr", f"s{i % 3}", None if t is None else len(t), i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row_id long")


def model():
    x = [quality.term_shares(t) for t in ("plain words here", "BUY!! NOW!!")]
    at = [i.nonzero()[0] for i in x]
    return quality.fit_vectors(at, [v[i] for v, i in zip(x, at)], quality.np.array([1.0, 0.0]), 2, 7)


RANKS, PATTERN = bpe.vocabulary()
SPEC = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
OPERATORS = {
    "langid": lambda d: langid.predict(d, langid.learn(d)).select("doc_id", "lang_pred", "score"),
    "bpe": lambda d: bpe.decode(bpe.encode(d.drop("ids", "decoded"), RANKS, PATTERN), RANKS).select("doc_id", "ids", "decoded"),
    "quality": lambda d: quality.score(d, model()).select("doc_id", "score"),
    "order_minhash": lambda d: order_minhash.fingerprints(d).select("doc_id", "codes"),
    "secrets": lambda d: secrets.redact(d, owner="source", repo="doc_id", row="row_id").select("doc_id", "text"),
    "suffix_dedup": lambda d: suffix_dedup.dedup(d, length=20).select("doc_id", "n_removed"),
    "simhash": lambda d: simhash.near_classes(d, row="row_id").select("doc_id", "fp", "component"),
    "mixing": lambda d: mixing.mix(d, "row_id").select("doc_id", "weight", "copies"),
    "licenses": lambda d: licenses.scan(d).select("doc_id", "n_words", "base", "found"),
    "merkle": lambda d: merkle.tree(d.withColumn("leaf", merkle.leaf_of([F.col(c) for c in merkle.FIELDS]))).select("doc_id", "leaf", "root"),
    "token_shards": lambda d: token_shards.documents(token_shards.write(d, SPEC)),
    "divergence": lambda d: divergence.audit(d, least=2),
}


def wide(docs, *paths):
    return docs.select("*", *(F.lit("x").alias(n) for n in names(*paths)))


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("operator", list(OPERATORS))
def test_operators(docs, operator):
    more = wide(docs, ROOT / f"ledgerspark/llm/{operator}.py", *SHARED)
    assert len(more.columns) > 30
    assert rows(OPERATORS[operator](more)) == rows(OPERATORS[operator](docs))


def test_columns_that_stay(docs):
    more = wide(docs, *SHARED, ROOT / "ledgerspark/llm/secrets.py")
    assert secrets.redact(more, owner="source", repo="doc_id", row="row_id").columns == more.columns
    assert quality.score(more, model()).columns == [c for c in more.columns if c != "score"] + ["score"]
    more = wide(docs, ROOT / "ledgerspark/llm/order_minhash.py")
    assert order_minhash.fingerprints(more).columns == [c for c in more.columns if c != "codes"] + ["codes"]


@pytest.mark.parametrize("k", range(len(cp.STAGES)))
def test_pipeline(spark, docs, sf_small, k):
    name, step = cp.STAGES[k]
    more = wide(docs, ROOT / "corpus_pipeline.py", *SHARED, *(ROOT / f"ledgerspark/llm/{m}.py" for m in ("quality", "simhash", "secrets", "mixing", "bpe")))
    got, plain = step(spark, more, sf_small), step(spark, docs, sf_small)
    if name != "bpe":
        assert got.columns == more.columns
    assert rows(got.select("doc_id", *([] if name == "bpe" else ["text"]))) == rows(plain.select("doc_id", *([] if name == "bpe" else ["text"])))


def test_row_numbers_of_staged_rows(docs):
    assert stage(with_row_id(docs), "test").select("rid").distinct().count() == len(TEXTS)
