"""Secret spans against Python's regexes, ownership verdicts, redaction, SQL parity, edges."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import secrets
from ledgerspark.llm.common import stage, with_row_id
from ledgerspark.llm.spans import running_sums

KINDS = (("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), lambda m: len(m[2]) >= 6),
         ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
         ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24))


def base_spans(text):
    found = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, p, ok) in enumerate(KINDS) for m in p.finditer(text or "") if ok(m)]
    return [s for _, _, s in sorted(found)]


def texts():
    rng = random.Random(8)
    bits = ["token = ", "PassWord:'", "api_key=", "apikey\":\"", "secret : ", "AKIA", "AKIAAKIA", "deadbeef" * 4, "token=token=abcdefgh", "token=token: abcdefgh",
            "0123456789abcdef" * 2, "ABCDEFGHIJKLMNOP", "é", " ", "\n", "x=", "abcd", "ſecret=abcdefgh", "toKen=abcdefg", "Zz9/" * 6, "=", "\""]
    return ["".join(rng.choices(bits, k=rng.randrange(1, 12))) for _ in range(250)] + ["", None, "token=abcdefgh " * 700]


def test_base_spans(spark, docs_of):
    rows = docs_of(texts()).drop("rid")
    got = secrets.scan(with_row_id(rows), "rid", "source", "doc_id", carry=("doc_id",)).select(
        "doc_id", secrets.listed(F.filter("spans", lambda s: s["kind"] < 3)).alias("b")).collect()
    assert {r.doc_id: r.b for r in got} == {i: ",".join(base_spans(t)) for i, t in enumerate(texts())}


def test_running_sums(spark):
    for n in (0, 1, 2, 3, 10, 37):
        x = list(range(1, n + 1))
        got = spark.createDataFrame([(x,)], "x array<bigint>").select(running_sums(F.col("x")).alias("s")).first().s
        assert got == [sum(x[:i + 1]) for i in range(n)]


def test_ownership(spark, docs_of):
    copied, own = "AKIA" + "Q" * 16, "AKIA" + "7" * 16
    loose, spread = "Ab3" * 8, "Xy9" * 8
    rows = docs_of([f"key {copied} {spread}"] * 4 + [f"mine {own} {loose}", f"again {own} {loose}", f"key {copied}", None],
                   sources=["a", "b", "c", "a", "d", "d", None, "e"], ids=[0, 1, 2, 3, 4, 5, 6, None]).drop("rid")
    got = {r.doc_id: r.spans for r in secrets.scan(with_row_id(rows), "rid", "source", "doc_id", carry=("doc_id",)).collect()}
    assert [(s.name, s.owners, s.repos, s.verdict) for s in got[0]] == [("access", 4, 5, "example")]
    assert [(s.name, s.owners, s.repos, s.verdict) for s in got[4]] == [("access", 1, 2, "live"), ("token", 1, 2, "live")]
    assert got[None] == [] and len(got) == 8
    keyed = stage(with_row_id(rows), "test")
    cut = {r.doc_id: r.text for r in secrets.redact(keyed, "source", "doc_id", "rid").collect()}
    assert cut[4] == "mine [SECRET] [SECRET]" and cut[0] == f"key {copied} {spread}" and cut[None] is None


def test_a_placeholder_of_one_hot_source_is_no_credential(spark, docs_of):
    holder, key, own = "Ab3" * 8, "AKIA" + "7" * 16, "Xy9" * 8
    texts = [f"put {holder} here {key}"] * secrets.MANY + [f"put {holder} here", f"mine {own}", f"again {own}"]
    keyed = stage(with_row_id(docs_of(texts, sources=["hot"] * len(texts)).drop("rid")), "test")
    cut = {r.doc_id: r.text for r in secrets.redact(keyed, "source", "doc_id", "rid").collect()}
    n = secrets.MANY
    # the token is left alone, a key of a known kind goes however often it stands
    assert {cut[i] for i in range(n)} == {f"put {holder} here [SECRET]"} and cut[n] == texts[n]
    assert (cut[n + 1], cut[n + 2]) == ("mine [SECRET]", "again [SECRET]")
    spans = secrets.scan(keyed, "rid", "source", "doc_id", many=n).select(F.explode("spans").alias("s")).select("s.*").collect()
    assert {(s.name, s.repos, s.verdict) for s in spans} == {("access", n, "shared"), ("token", 2, "live")}


def test_redaction_of_overlaps(spark, docs_of):
    rows = stage(with_row_id(docs_of(["é token=0123456789abcdef0123456789abcdef end", "é plain"]).drop("rid")), "test")
    assert [r.text for r in secrets.redact(rows, "source", "doc_id", "rid").orderBy("doc_id").collect()] == ["é [SECRET] end", "é plain"]


def test_empty_table(spark, docs_of):
    assert secrets.scan(with_row_id(docs_of([]).drop("rid")), "rid", "source", "doc_id").count() == 0
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256).alias("x")).first().x
