"""Token ids in grammar-compressed shards with random access (operator 12).

Texts are encoded with the ``tokenizers`` library, an end id closes each document, and documents stand
in the order of their ids: one range partitioning deals them to tasks, and a task writes shards of about
``SHARD`` ids as it reads. Documents are never cut; a longer one is a shard by itself.

A shard is compressed by Re-Pair: the most frequent neighbouring pairs of symbols give way to a
nonterminal each, again and again, until no pair stands ``LEAST`` times. Pairs do not cross documents.
A round replaces the pairs of at least a ``TOP``-th of the most frequent one's count together: an occurrence gives way
where no overlapping pair is more frequent, and a run of one symbol is paired from its start.

The file format is Parquet, a row a shard, arrays as little-endian unsigned 32-bit integers (rules and
symbols of 16 bits where terminals and rules are 2^16 at most):

=============  ====================================================================================
range, seq     the shard's place: which part of the order, which shard of it
before         ids of the shards before it in its part
n_tokens       ids of the shard
doc_ids        the documents' ids
doc_tokens     where each document's ids begin, and their number at the end
doc_symbols    where each document's symbols begin, and their number at the end
n_terminals    symbols below it are token ids; n_terminals + k is nonterminal k
rules          two symbols a nonterminal, both below it
spans          how many ids each nonterminal stands for
symbols        the compressed shard
=============  ====================================================================================

Spans tell where in a shard a position lies, so a few ids are read without expanding the rest.

Null text is empty: its document is the end id alone. Null ids come first; equal ids stand in the order
of a hash of their texts, and each row is a document of its own. Other columns are not looked at. An
empty table gives no shards. A text and its ids are held in memory whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, blank_if_null, ragged_gather, read_table, stage

SHARD = 1 << 17            # ids after which a shard is closed
LEAST = 16                 # a pair that stands less often is left: its rule costs more than it saves
TOP = 8                    # a round takes pairs of at least an eighth of the highest count
ROWS_PER_RANGE = 20_000    # documents of a task
MOST_SENT = 100_000        # parts whose places are sent to every task; more are joined by a shuffle
TOGETHER = 1 << 21         # characters of texts that are encoded together
CACHED, LONGEST = 150_000, 64   # pieces that a worker remembers (met once; more often), and their length

#: A space after a character that is no white space: byte-level patterns always split before it.
CUT = re.compile("(?<=[^\\s\u180e])(?= )")
#: ASCII and the letters of Latin-1, and the byte-level split pattern for texts of these characters.
PLAIN = re.compile("[\\x00-\\x7fÀ-ÖØ-öø-ÿ]*")
PIECE = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+", re.ASCII)

#: Kinds of bytes of such texts: white space, letters (all bytes beyond ASCII), digits, others.
KIND = np.array([0 if b in b" \t\n\r\f\v" else 1 if b >= 128 or chr(b).isalpha() else 2 if chr(b).isdigit() else 3 for b in range(256)], np.uint8)

U16, U32 = np.dtype("<u2"), np.dtype("<u4")
SLOT_BITS = 16             # of the hash table of pairs


def byte_letters() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: b if b in own else next(others) for b in range(256)}


class Encoder:
    """The ids of texts, as bytes. Pieces of texts are given to the library once and remembered."""

    def __init__(self, spec: str, end_id: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True      # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        parts = json.loads(spec)
        split = parts.get("pre_tokenizer") or {}
        self.by_pieces = (parts.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                          and not split.get("add_prefix_space", True) and all(t.get("special") for t in parts.get("added_tokens", [])))
        self.end = np.array([end_id], U32).tobytes()
        self.pieces, self.words = Remembered(self._piece), Remembered(self._word)
        self.letters = byte_letters()
        self.space = chr(self.letters[32])

    def library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, U32).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():   # only the space has another letter
            letters = piece.replace(" ", self.space)
        else:
            letters = piece.encode().decode("latin-1").translate(self.letters)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(letters)])

    def _word(self, word: str) -> bytes:
        return self._plain(word) if PLAIN.fullmatch(word) else self.library([word])[0]

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, PIECE.findall(text)))

    def encode(self, text: str) -> bytes:
        """The ids of one text and the end id."""
        if not self.by_pieces:
            return self.library([text])[0] + self.end
        if PLAIN.fullmatch(text):
            return self._plain(text) + self.end
        return b"".join(map(self.words.__getitem__, CUT.split(text))) + self.end


    def encode_all(self, texts: list[str]) -> list[bytes]:
        """`encode` of each text. Texts of plain characters share the work: each piece that they hold is looked up once."""
        plain = [k for k, text in enumerate(texts) if self.by_pieces and text and PLAIN.fullmatch(text)]
        if not plain:
            return [self.encode(text) for text in texts]
        coded = [texts[k].encode() for k in plain]
        begins = np.cumsum([0, *map(len, coded)])
        text = b"".join(coded)
        starts = piece_starts(np.frombuffer(text, np.uint8), begins)
        bounds = np.append(starts, len(text))
        pieces = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(text)]).dictionary_encode()
        known = list(map(self.pieces.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False)))
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        which = pieces.indices.to_numpy()
        counts = sizes[which]
        ids = ragged_gather(np.frombuffer(b"".join(known), U32), (np.cumsum(sizes) - sizes)[which], counts).tobytes()
        ends = 4 * np.append(0, np.cumsum(counts))[np.searchsorted(bounds, begins)]
        done = {k: ids[a:b] + self.end for k, a, b in zip(plain, ends[:-1].tolist(), ends[1:].tolist())}
        return [done[k] if k in done else self.encode(text) for k, text in enumerate(texts)]


def piece_starts(text: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the matches of `PIECE` begin in the bytes of texts, none empty, that begin at `begins` (and end at its last)."""
    n = len(text)
    text = np.append(text, np.zeros(2, np.uint8))
    kind = KIND[text]
    own = np.zeros(n + 2, bool)   # where a text begins
    own[begins] = own[n + 1] = True
    start = own.copy()
    start[1:n] |= kind[1:n] != kind[:n - 1]
    # the last of some white space before other characters stands apart, a space goes with what follows
    last = np.flatnonzero((kind[:n] == 0) & start[1:n + 1] & ~own[1:n + 1])
    start[last] = True
    start[last[text[last] == 32] + 1] = False
    # an apostrophe that begins a piece takes the letters of a contraction
    at = np.flatnonzero((text[:n] == 39) & start[:n] & ~own[1:n + 1])
    one, two = text[at + 1], np.where(own[at + 2], 0, text[at + 2])
    short = np.isin(one, list(b"stmd"))
    long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)   # re, ve, ll
    start[at[short | long] + 1] = False
    start[at[short] + 2] = True
    start[at[long] + 3] = True
    return np.flatnonzero(start[:n])


class Remembered(dict):
    """Results of a function by argument, a bounded number and none of long arguments.

    Arguments met again are held apart from those met once, so that many rare ones do not displace the frequent.
    """

    def __init__(self, of):
        self.of, self.once = of, {}

    def __missing__(self, key: str) -> bytes:
        value = self.once.pop(key, None)
        if value is None:
            value = self.of(key)
            if len(key) <= LONGEST:
                if len(self.once) >= CACHED:
                    self.once = newer_half(self.once)
                self.once[key] = value
            return value
        if len(self) >= CACHED:
            kept = newer_half(self)
            self.clear()
            self.update(kept)
        self[key] = value
        return value


def newer_half(d: dict) -> dict:
    """The entries of the second half; frequent ones that go are soon met twice again."""
    return dict(islice(d.items(), len(d) // 2, None))


def repair(ids: np.ndarray, ends: np.ndarray, n_terminals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, last-of-document marks, rules, spans) of ids whose documents' last ones are marked."""
    seq, ends = ids.astype(np.int32), ends.copy()
    rules, spans = [np.empty((0, 2), np.int64)], [np.empty(0, np.int64)]
    made, ceiling = 0, None
    while len(seq) > 1:
        # counts by hash are no less than the pairs' own, so few pairs need an exact count
        u = seq.view(np.uint32)
        slot = u[:-1] * np.uint32(0x9E3779B1) + u[1:] * np.uint32(0x85EBCA77)
        slot = ((slot ^ (slot >> np.uint32(15))) >> np.uint32(32 - SLOT_BITS)).astype(np.int64)
        slot[ends[:-1]] = 1 << SLOT_BITS
        # a run of one symbol holds its pair once for every two symbols, from the run's start
        alike = (seq[1:] == seq[:-1]) & ~ends[:-1]
        same = np.flatnonzero(alike[1:] & alike[:-1]) + 1
        if len(same):
            cut = np.flatnonzero(np.diff(same) != 1) + 1
            begin = np.repeat(same[np.concatenate([[0], cut])], np.diff(np.concatenate([[0], cut, [len(same)]])))
            slot[same[(same - begin) % 2 == 0]] = 1 << SLOT_BITS
        rough = np.bincount(slot, minlength=(1 << SLOT_BITS) + 1)
        rough[-1] = 0
        top = int(rough.max())
        if top < LEAST:
            break
        floor = max(LEAST, min(top // TOP, ceiling or top))
        often = rough >= floor
        near = np.flatnonzero(np.take(often, slot))
        key = (seq[near].astype(np.int64) << 32) | seq[near + 1]
        # nearly all occurrences in a slot are of one pair: only the others are told apart by a sort
        which = np.take(np.cumsum(often) - 1, np.take(slot, near))
        pairs = np.zeros(np.count_nonzero(often), np.int64)
        pairs[which] = key
        other = np.flatnonzero(key != np.take(pairs, which))
        more, code = np.unique(key[other], return_inverse=True)
        which[other] = len(pairs) + code
        pairs = np.concatenate([pairs, more])
        counts = np.bincount(which, minlength=len(pairs))
        take = counts >= floor
        if not take.any():   # different pairs shared the slots
            if floor == LEAST:
                break
            ceiling = max(LEAST, floor // 2)
            continue
        pairs, counts, ceiling = pairs[take], counts[take], None
        rank = np.empty(len(pairs), np.int32)
        rank[np.lexsort((pairs, -counts))] = np.arange(len(pairs))
        # an occurrence gives way unless a neighbour that overlaps it has a better rank
        ranks = np.full(len(take), len(pairs), np.int32)
        ranks[take] = rank
        mine = np.full(len(seq) + 1, len(pairs), np.int32)   # of the pair at i: mine[i + 1]
        mine[near + 1] = np.take(ranks, which)
        at = near + 1
        chosen = near[(mine[at] < len(pairs)) & (mine[at] < mine[at - 1]) & (mine[at] < mine[at + 1])]
        # the best pair keeps its places, so each round makes a rule; rules used once are not worth it
        used = np.bincount(mine[chosen + 1], minlength=len(pairs))
        chosen = chosen[used[mine[chosen + 1]] > 1]
        if not len(chosen):
            break
        symbol = np.cumsum(used > 1) - 1 + n_terminals + made
        new = pairs[np.argsort(rank)[used > 1]]
        new = np.column_stack([new >> 32, new & 0xFFFFFFFF])
        have = np.concatenate(spans)
        size = lambda s: np.where(s < n_terminals, 1, have[np.maximum(s - n_terminals, 0)] if len(have) else 1)
        rules.append(new)
        spans.append(size(new[:, 0]) + size(new[:, 1]))
        made += len(new)
        seq[chosen] = symbol[mine[chosen + 1]]
        ends[chosen] = ends[chosen + 1]
        keep = np.ones(len(seq), bool)
        keep[chosen + 1] = False
        left = np.flatnonzero(keep)
        seq, ends = np.take(seq, left), np.take(ends, left)
    return seq, ends, np.concatenate(rules), np.concatenate(spans)


class Shard:
    """A shard of the file format, read."""

    def __init__(self, row: dict):
        of = lambda name, kind=U32: np.frombuffer(row[name], kind).astype(np.int64)
        self.doc_ids, self.before, self.n_tokens = row["doc_ids"], row["before"], row["n_tokens"]
        self.n_terminals = row["n_terminals"]
        self.doc_tokens, self.doc_symbols = of("doc_tokens"), of("doc_symbols")
        self.spans = of("spans")
        kind = U16 if self.n_terminals + len(self.spans) <= 1 << 16 else U32
        self.rules, self.symbols = of("rules", kind).reshape(-1, 2), of("symbols", kind)

    def _size(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), np.int64)
        rule = symbols >= self.n_terminals
        out[rule] = self.spans[symbols[rule] - self.n_terminals]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that symbols stand for: all nonterminals give way together, as often as they are nested."""
        while (rule := symbols >= self.n_terminals).any():
            out = np.repeat(symbols, 1 + rule)
            at = (np.cumsum(1 + rule) - 2)[rule]
            pair = self.rules[symbols[rule] - self.n_terminals]
            out[at], out[at + 1] = pair[:, 0], pair[:, 1]
            symbols = out
        return symbols

    def documents(self) -> Iterator[np.ndarray]:
        """The ids of each document."""
        # each rule is expanded once, then symbols look theirs up
        seen = np.zeros(self.n_terminals + len(self.spans), bool)
        seen[self.symbols] = True
        used, index = np.flatnonzero(seen), (np.cumsum(seen) - 1)[self.symbols]
        sizes = self._size(used)
        ids = ragged_gather(self.expand(used), np.cumsum(sizes) - sizes, sizes) if len(used) else used
        starts = np.cumsum(sizes) - sizes
        ids = ragged_gather(ids, starts[index], sizes[index])
        return (ids[a:b] for a, b in zip(self.doc_tokens[:-1], self.doc_tokens[1:]))

    def tokens(self, first: int, count: int) -> np.ndarray:
        """``count`` ids from position ``first`` of the shard (fewer at its end), the rest left compressed."""
        stop = min(first + count, self.n_tokens)
        if not 0 <= first < stop:
            return np.empty(0, np.int64)
        # documents hold the position index; inside the first one, spans do
        d = np.searchsorted(self.doc_tokens, first, "right") - 1
        e = np.searchsorted(self.doc_tokens, stop, "left")
        symbols = self.symbols[self.doc_symbols[d]:self.doc_symbols[e]]
        at = self.doc_tokens[d] + np.concatenate([[0], np.cumsum(self._size(symbols))])
        lo, hi = np.searchsorted(at, first, "right") - 1, np.searchsorted(at, stop, "left")
        skip, over = first - at[lo], at[hi] - stop
        symbols = symbols[lo:hi].tolist()
        head = self._without(symbols, skip)
        tail = self._without(symbols[::-1], over, last=True)[::-1] if over else None
        if tail is None:
            return self.expand(np.array(head, np.int64))
        if len(symbols) == 1:   # one symbol holds both borders
            return self.expand(np.array(head, np.int64))[:stop - first]
        return self.expand(np.array([*head[:len(head) - 1], *tail[len(symbols) - 1:]], np.int64))

    def _without(self, symbols: list[int], skip: int, last: bool = False) -> list[int]:
        """The symbols without the first ``skip`` ids of the first symbol (seen from the end: ``last``)."""
        out = symbols[:0:-1]
        todo = symbols[0]
        while skip:
            near, far = self.rules[todo - self.n_terminals][::-1 if last else 1].tolist()
            size = int(self._size(np.array([near]))[0])
            if skip < size:
                out.append(far)
                todo = near
            else:
                skip -= size
                todo = far
        return [todo, *out[::-1]]


def _schema(id_type: T.DataType) -> T.StructType:
    binary = [T.StructField(n, T.BinaryType(), False) for n in ("doc_tokens", "doc_symbols", "rules", "spans", "symbols")]
    return T.StructType([T.StructField("range", T.IntegerType(), False), T.StructField("seq", T.IntegerType(), False),
                         T.StructField("before", T.LongType(), False), T.StructField("n_tokens", T.LongType(), False),
                         T.StructField("doc_ids", T.ArrayType(id_type), False), T.StructField("n_terminals", T.IntegerType(), False), *binary])


def compress(coded: list[bytes], ids: list, n_terminals: int) -> dict:
    """The columns of a shard of documents whose ids are given as bytes."""
    raw = np.frombuffer(b"".join(coded), U32)
    sizes = np.array([len(b) // 4 for b in coded], np.int64)
    ends = np.zeros(len(raw), bool)
    ends[np.cumsum(sizes) - 1] = True
    symbols, ends, rules, spans = repair(raw, ends, n_terminals)
    pack = lambda a, kind=U32: np.asarray(a).astype(kind).tobytes()
    kind = U16 if n_terminals + len(rules) <= 1 << 16 else U32
    return {"n_tokens": len(raw), "doc_ids": ids, "n_terminals": n_terminals, "rules": pack(rules.ravel(), kind), "spans": pack(spans), "symbols": pack(symbols, kind),
            "doc_tokens": pack(np.concatenate([[0], np.cumsum(sizes)])), "doc_symbols": pack(np.concatenate([[0], np.flatnonzero(ends) + 1]))}


def write(docs: DataFrame, spec: str, end_id: int = 0, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, compress and write documents as shards in the shared folder; the shards, read back.

    ``spec`` is the tokenizer's JSON; it travels to the tasks as a broadcast of that size.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id].dataType
    rows = docs.select(F.col(id).alias("id"), blank_if_null(F.col(text)).alias("t"))
    parts = max(1, -(-rows.count() // ROWS_PER_RANGE))
    # the last key parts rows that are equal
    rows = rows.withColumn("h", F.xxhash64("t")).withColumn("rid", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(parts, "id", "h", "rid").sortWithinPartitions("id", "h", "rid").select("id", "t")
    shared = spark.sparkContext.broadcast({"spec": spec})
    arrow_batches(spark)
    schema = _schema(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value   # a worker has one: its next task finds the encoder and the pieces it knows
        if end_id not in held:
            held[end_id] = Encoder(held["spec"], end_id)
        encoder = held[end_id]
        n_terminals = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
        place, seq, before = TaskContext.get().partitionId(), 0, 0
        coded, ids, n = [], [], 0

        def close(kind: pa.DataType) -> pa.RecordBatch:
            row = {"range": place, "seq": seq, "before": before} | compress(coded, ids, n_terminals)
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(kind), pa.int32(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], t) for f, t in zip(schema.fields, types)], names=schema.names)

        def encoded() -> Iterator[tuple]:
            keys, texts, chars = [], [], 0
            for batch in batches:
                of = batch.schema.field("id").type
                for key, text in zip(batch.column("id"), batch.column("t")):
                    keys.append((of, key.as_py()))
                    texts.append(text.as_py())
                    chars += len(texts[-1])
                    if chars >= TOGETHER:
                        yield from zip(keys, encoder.encode_all(texts))
                        keys, texts, chars = [], [], 0
            yield from zip(keys, encoder.encode_all(texts))

        for (kind, key), b in encoded():
            coded.append(b)
            ids.append(key)
            n += len(b) // 4
            if n >= SHARD:
                yield close(kind)
                coded, ids, seq, before, n = [], [], seq + 1, before + n, 0
        if ids:
            yield close(kind)

    return stage(rows.mapInArrow(run, schema), "token-shards")


def _bases(shards: DataFrame) -> DataFrame:
    """(range, base): ids before each part; one row for each task that wrote."""
    parts = shards.groupBy("range").agg(F.sum("n_tokens").alias("n"))
    bases = parts.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return F.broadcast(bases) if parts.count() <= MOST_SENT else bases


def documents(shards: DataFrame, id: str = "doc_id") -> DataFrame:
    """(id, start, ids): each document's ids as the file's bytes, and how many ids stand before it."""
    id_type = shards.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField(id, id_type), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):   # a shard at a time
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names if name != "doc_ids"}
                keys = batch.column("doc_ids")[k].values
                shard = Shard(row | {"doc_ids": keys})
                coded = [ids.astype(U32).tobytes() for ids in shard.documents()]
                start = row["base"] + shard.before + shard.doc_tokens[:-1]
                yield pa.RecordBatch.from_arrays([keys, pa.array(start), pa.array(coded, pa.binary())], names=schema.names)

    # bases join the compressed rows, not the documents
    return shards.join(_bases(shards), "range").mapInArrow(run, schema)


def window(shards: DataFrame, first: int, count: int) -> DataFrame:
    """(start, ids): the ids at positions ``first`` to ``first + count`` of the whole order, one row for each shard that holds some.

    Only these shards are read, and of them only the symbols that the positions need are expanded.
    """
    start = F.col("base") + F.col("before")
    held = shards.join(_bases(shards), "range").where((start < first + count) & (start + F.col("n_tokens") > first))
    schema = T.StructType([T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, origin = Shard(row), row["base"] + row["before"]
                a = max(first, origin)
                ids = shard.tokens(a - origin, first + count - a).astype(U32).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([a], pa.int64()), pa.array([ids], pa.binary())], names=schema.names)

    return held.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    shards = write(read_table(spark, sf_dir, "documents"), spec)
    return documents(shards).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
