"""Token shards: ids against the library, exact round trips of the grammar, random access, odd rows."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerspark.llm import token_shards as ts

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPEC = open(PATH, encoding="utf-8").read()
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.encode_special_tokens = True
ENCODER = ts.Encoder(SPEC, 0)


def library(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def shard(docs, n_terminals=300):
    coded = [np.array(d, ts.U32).tobytes() for d in docs]
    return ts.Shard(ts.compress(coded, list(range(len(docs))), n_terminals) | {"before": 0})


@given(st.lists(st.sampled_from(["a", "The", "don't", " ", "  ", "\n", "\t", " \n", " ", "　", "\x1c", "\x85", "é", "東京", "x1", "...", "<|endoftext|>", "😀", "\x00", "᠎"]), max_size=30).map("".join))
@settings(max_examples=300, deadline=None)
def test_encoder_equals_library(text):
    assert ENCODER.by_pieces
    assert np.frombuffer(ENCODER.encode(text), ts.U32).tolist() == library(text)


def test_other_tokenizers_encode_whole_texts():
    spec = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    other, texts = ts.Encoder(spec, 0), ["Hello  World don't", "", "a b\nc"]
    assert not other.by_pieces
    t = Tokenizer.from_str(spec)
    t.encode_special_tokens = True
    assert [np.frombuffer(b, ts.U32).tolist() for b in map(other.encode, texts)] == [[*t.encode(x, add_special_tokens=False).ids, 0] for x in texts]


@given(st.lists(st.lists(st.integers(0, 4), max_size=120).map(lambda d: [*d, 0]), min_size=1, max_size=12), st.data())
@settings(max_examples=200, deadline=None)
def test_round_trip_and_random_access(docs, data):
    s, flat = shard(docs), [t for d in docs for t in d]
    assert [d.tolist() for d in s.documents()] == docs
    assert (s.rules < 300 + np.arange(len(s.rules))[:, None]).all()
    a = data.draw(st.integers(0, len(flat)))
    n = data.draw(st.integers(0, len(flat) + 3))
    assert s.tokens(a, n).tolist() == flat[a:a + n]


def test_grammar():
    """Frequent pairs nest, rules stand at least twice, documents share rules and keep their borders."""
    docs = [[1, 2, 3, 4, 5, 6, 7, 8, 0]] * 200 + [[9] * 5000 + [0]]
    s = shard(docs)
    assert [d.tolist() for d in s.documents()] == docs
    assert len(s.symbols) < len(s.doc_ids) * 2 + 20 and s.spans.max() > 100
    assert len(np.unique(s.rules, axis=0)) == len(s.rules)
    assert (s.spans == s._size(s.rules[:, 0]) + s._size(s.rules[:, 1])).all()
    for k in range(len(docs)):
        assert s.expand(s.symbols[s.doc_symbols[k]:s.doc_symbols[k + 1]]).tolist() == docs[k]


def test_collisions_of_the_rough_counts(monkeypatch):
    """Pairs that share a slot are told apart."""
    monkeypatch.setattr(ts, "SLOT_BITS", 1)
    rng = np.random.default_rng(5)
    docs = [[*rng.integers(1, 40, 300).tolist(), 0] for _ in range(9)] + [[7, 8] * 90 + [0]]
    s = shard(docs)
    assert [d.tolist() for d in s.documents()] == docs and len(s.rules)


def test_wide_symbols():
    """Vocabularies whose symbols need more than 16 bits."""
    docs = [[70_000, 70_001, 0] * 40, [65_536, 1, 0]]
    s = shard(docs, n_terminals=100_000)
    assert [d.tolist() for d in s.documents()] == docs and s.tokens(2, 3).tolist() == [0, 70_000, 70_001] and len(s.rules)


@pytest.mark.parametrize("size,rows,sent", [(1, 3, 0), (50, 2, 100), (1 << 18, 20_000, 100)])
def test_tables(spark, docs_of, monkeypatch, size, rows, sent):
    monkeypatch.setattr(ts, "MOST_SENT", sent)
    monkeypatch.setattr(ts, "SHARD", size)
    monkeypatch.setattr(ts, "ROWS_PER_RANGE", rows)
    texts = ["Hello world", "", None, "the cat the cat " * 200, "é東 ", "Hello world", "x" * 5000, "b"]
    ids = [5, 3, None, 9, -2, 5, 12, 7]
    docs = docs_of(texts, ids=ids).withColumn("t", F.lit(1)).withColumn("h", F.lit(2)).withColumn("range", F.lit(3)).repartition(3)
    shards = ts.write(docs, SPEC)
    out = ts.documents(shards).orderBy("start").collect()
    want = sorted(zip(ids, map(library, texts)), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [(r.doc_id, np.frombuffer(r.ids, ts.U32).tolist()) for r in out] == want
    at = np.cumsum([0, *(len(w) for _, w in want)])
    assert [r.start for r in out] == at[:-1].tolist()
    flat = [t for _, w in want for t in w]
    for first, count in ((0, 5), (3, 700), (len(flat) - 4, 99), (0, len(flat))):
        got = ts.window(shards, first, count).orderBy("start").collect()
        assert [t for r in got for t in np.frombuffer(r.ids, ts.U32).tolist()] == flat[first:first + count]
        assert got[0].start == first
    assert ts.window(shards, len(flat), 5).count() == 0


def test_empty_table_and_text_ids(spark, docs_of):
    docs = docs_of(["a"])
    assert ts.documents(ts.write(docs.limit(0), SPEC)).count() == 0
    named = docs_of(["a", "b"]).withColumn("doc_id", F.concat(F.lit("d"), "text"))
    assert [r.doc_id for r in ts.documents(ts.write(named, SPEC)).orderBy("start").collect()] == ["da", "db"]


def test_query(spark, sf_small):
    start = 0
    got = {r.doc_id: r for r in ts.query(spark, sf_small).collect()}
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = np.array(library(r.text), ts.U32)
        g = got[r.doc_id]
        assert (g.start, g.n_tokens, g.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


ODD = ["a", "The", "don't", "'s", "'", "''", "'re", "'ve", "'ll", "'l", "'r", "x", "re", " ", "  ", "\n", "\t", " \n", "\r\f\v", "é", "Öß", "×", "12", "1é", "...", "_", "\x1c", "\x85", "\x00", "\xa0", "東京", "😀"]


@given(st.lists(st.lists(st.sampled_from(ODD), max_size=20).map("".join), max_size=12))
@settings(max_examples=500, deadline=None)
def test_texts_encoded_together_equal_library(texts):
    assert [np.frombuffer(b, ts.U32).tolist() for b in ENCODER.encode_all(texts)] == [library(t) for t in texts]
    plain = [t for t in texts if t and ts.PLAIN.fullmatch(t)]
    if plain:
        coded = [t.encode() for t in plain]
        begins = np.cumsum([0, *map(len, coded)])
        starts = [*ts.piece_starts(np.frombuffer(b"".join(coded), np.uint8), begins).tolist(), int(begins[-1])]
        assert [b"".join(coded)[a:b].decode() for a, b in zip(starts, starts[1:])] == [p for t in plain for p in ts.PIECE.findall(t)]


def test_texts_share_their_pieces(monkeypatch):
    """A piece of many texts is looked up once, and one met again outlasts any number of those met once."""
    asked = []
    seen = ts.Remembered(lambda k: asked.append(k) or k.encode())
    monkeypatch.setattr(ts, "CACHED", 10)
    for k in range(100):
        assert (seen["often"], seen[f"rare {k}"]) == (b"often", f"rare {k}".encode())
        assert len(seen) <= 10 and len(seen.once) <= 10
    assert asked.count("often") == 1
    e = ts.Encoder(SPEC, 0)
    looked = []
    e.pieces = ts.Remembered(lambda k: looked.append(k) or e._piece(k))
    monkeypatch.setattr(ts, "CACHED", 0)   # nothing outlasts a lookup
    assert e.encode_all(["one two one two", " two one two"])[1] == ENCODER.encode(" two one two")
    assert sorted(looked) == [" one", " two", "one"]
