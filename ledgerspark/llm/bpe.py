"""Byte-level BPE encoding and decoding (operator 2).

A text is a concatenation of pieces (the matches of the split pattern); merges never cross a piece, so
a text's ids are the concatenation of its pieces' ids. Within a piece, encodings form a monoid:

* a piece is halved until a leaf is short, leaves are merged directly;
* two neighbours join by re-encoding a window of tokens around the seam. The window grows until its
  outer tokens are *compatible* with the tokens left outside it. Two tokens are compatible when the
  bytes of both encode to exactly these two tokens; a token sequence is the BPE encoding of its bytes
  if and only if all its neighbours are compatible, so tokens outside the window are then proven final.

Splitting runs in the JVM (``regexp_extract_all``). A worker sees a batch of pieces, encodes each
different piece of the batch once and gathers the ids by array indexing. No shuffle.

Nulls count as empty text; an empty text has no ids. Rows, repeated or not, map one to one. Long texts
and pieces are never cut: joining costs O(n log n) on ordinary pieces, O(n log^2 n) on one long run.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, blank_if_null, ragged_gather, read_table

#: Unicode White_Space, which a Java regex's \s is not.
SPACE = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
LEAF = 24        # bytes merged directly
CACHED = 200_000  # pieces remembered by a worker


def load_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file: one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


def java_pattern(pattern: str) -> str:
    """The split pattern with Unicode white space spelled out."""
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


class Codec:
    """BPE by ranks as a monoid of token lists."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {r: b for b, r in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """Direct merging: the lowest-ranked, leftmost neighbours first."""
        ranks = self.ranks
        if (whole := ranks.get(data)) is not None:
            return [whole]
        if len(data) > 4 * LEAF:
            return self._merge_long(data)
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap over a linked list."""
        ranks, n = self.ranks, len(data)
        end = list(range(1, n + 1))           # end of the part that starts here
        prev, alive = list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, mid, stop = heapq.heappop(heap)
            if not alive[i] or end[i] != mid or mid >= n or not alive[mid] or end[mid] != stop:
                continue
            end[i], alive[mid] = stop, False
            if stop < n:
                prev[stop] = i
                if (r := ranks.get(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, stop, end[stop]))
            if (p := prev[i]) >= 0 and (r := ranks.get(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, i, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:end[i]]])
            i = end[i]
        return out

    def compatible(self, a: int, b: int) -> bool:
        if (known := self.pairs.get((a, b))) is None:
            if len(self.pairs) > CACHED:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(self.token[a] + self.token[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the concatenated bytes of two encodings."""
        if not left or not right or self.compatible(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.merge(b"".join(self.token[t] for t in left[-i:] + right[:j]))
            left_ok = i >= len(left) or self.compatible(left[-i - 1], window[0])
            right_ok = j >= len(right) or self.compatible(window[-1], right[j])
            if left_ok and right_ok:
                return left[:-i] + window + right[j:]
            i, j = (i if left_ok else min(2 * i, len(left))), (j if right_ok else min(2 * j, len(right)))

    def encode(self, data: bytes) -> list[int]:
        if len(data) <= LEAF or data in self.ranks:
            return self.merge(data)
        mid = len(data) // 2
        return self.join(self.encode(data[:mid]), self.encode(data[mid:]))


def _lists(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _list_parts(col: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets from 0 and the flat values of a list column without nulls."""
    offsets = np.asarray(col.offsets, dtype=np.int64)
    return offsets - offsets[0], col.values.slice(offsets[0], offsets[-1] - offsets[0])


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``: the token ids (array<int>) of each text."""
    spark = df.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(ranks)   # as large as the vocabulary file
    pieces = f"{out}__pieces"
    src = df.withColumn(pieces, F.regexp_extract_all(blank_if_null(F.col(text)), F.lit(java_pattern(pattern)), F.lit(0)))
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, known = Codec(shared.value), {}
        for batch in batches:
            offsets, flat = _list_parts(batch.column(pieces))
            coded = flat.dictionary_encode()
            if isinstance(coded, pa.ChunkedArray):
                coded = coded.combine_chunks()
            if len(known) > CACHED:
                known.clear()
            each = []
            for p in coded.dictionary.to_pylist():
                if (ids := known.get(p)) is None:
                    ids = known[p] = np.array(codec.encode(p.encode()), dtype=np.int32)
                each.append(ids)
            lens = np.array([len(x) for x in each], dtype=np.int64)
            index = np.asarray(coded.indices, dtype=np.int64)
            all_ids = np.concatenate(each) if each else np.empty(0, np.int32)
            sizes = lens[index]
            ids = ragged_gather(all_ids, (np.cumsum(lens) - lens)[index], sizes)
            at = np.concatenate([[0], np.cumsum(sizes)])[offsets]
            cols = [batch.column(c) for c in range(batch.num_columns) if batch.schema.names[c] != pieces]
            yield pa.RecordBatch.from_arrays([*cols, _lists(pa.array(ids, pa.int32()), at)],
                                             names=[*(c for c in batch.schema.names if c != pieces), out])

    return src.mapInArrow(run, schema)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the bytes (binary) of each list of token ids; a null list gives no bytes."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(ranks)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())])
    src = df.withColumn(ids, F.coalesce(F.col(ids), F.array().cast("array<int>")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(shared.value.values(), default=-1) + 1
        table: list[bytes] = [b""] * size
        for b, r in shared.value.items():
            table[r] = b
        tokens = pa.array(table, pa.binary())
        for batch in batches:
            offsets, flat = _list_parts(batch.column(ids))
            joined = pc.binary_join(_lists(tokens.take(flat), offsets), b"")
            yield pa.RecordBatch.from_arrays([*batch.columns, joined], names=[*batch.schema.names, out])

    return src.mapInArrow(run, schema)


def vocabulary() -> tuple[dict[bytes, int], str]:
    """The ranks and split pattern that the query uses."""
    import public_tokenizers

    return load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = vocabulary()
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    # the text itself needn't travel beside its pieces
    coded = decode(encode(docs, ranks, pattern).drop("text"), ranks)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
