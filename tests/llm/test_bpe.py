"""Byte-level BPE against a brute-force merger, the tiktoken library and exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerspark.llm import bpe

RANKS, PATTERN = bpe.vocabulary()
CODEC = bpe.Codec(RANKS)
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@given(st.lists(st.sampled_from([b"a", b"b", b"ab", b" the", "é".encode(), b"\xff", b"tion"]), min_size=1, max_size=80).map(b"".join))
@settings(max_examples=200, deadline=None)
def test_tree_equals_library(data):
    assert CODEC.encode(data) == TIKTOKEN._encode_single_piece(data)


@given(st.binary(min_size=0, max_size=60), st.binary(min_size=0, max_size=60))
@settings(max_examples=200, deadline=None)
def test_join_is_a_homomorphism(a, b):
    whole = CODEC.encode(a + b) if a + b else []
    left, right = (CODEC.encode(x) if x else [] for x in (a, b))
    assert CODEC.join(left, right) == whole


def test_long_runs_do_not_cut():
    for data in (b"a" * 5000, b"ab" * 3000, bytes(random.Random(3).choices(b"xyz", k=4000))):
        ids = CODEC.encode(data)
        assert ids == TIKTOKEN._encode_single_piece(data)
        assert b"".join(CODEC.token[i] for i in ids) == data


def test_tables(spark, docs_of):
    texts = ["Hello world's  end", "", None, "naïve  — ١٢ ½ 東京", "x" * 3000, "a\n\n b\t\x1c\x85 c", "Hello world's  end", " ", "😀 ok"]
    docs = docs_of(texts).withColumnRenamed("ids", "decoded_")
    got = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS).orderBy("doc_id").collect()
    assert [r.ids for r in got] == [TIKTOKEN.encode_ordinary(t or "") for t in texts]
    assert [bytes(r.decoded).decode() for r in got] == [t or "" for t in texts]
    assert bpe.encode(docs.limit(0), RANKS, PATTERN).count() == 0


def test_query(spark, sf_small):
    got = {r.doc_id: r for r in bpe.query(spark, sf_small).collect()}
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = TIKTOKEN.encode_ordinary(r.text or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == want
