"""SimHash near-dedup by a binary trie self-join (operator 8).

Fingerprints: words of the text (A-Z lower-cased), shingles of ``width`` words, XXH64 with seed 42 of
each; a bit is set if more than half of the shingles set it. Repeated shingles count each time; a text
with fewer words has one shingle, one without words (also null) has fingerprint zero.

Links: equal texts and equal fingerprints collapse first (a combinable aggregate), so a group of copies
is one node. The 64 bits are cut into ``budget + 2`` blocks: two fingerprints within ``budget`` bits
agree on two blocks at least, so every pair of blocks is a key whose rows form one sub-trie. Inside it
the trie is joined with itself: node pairs are walked together from the root, differing bits add up,
and a pair of nodes whose sum exceeds the budget is pruned with all below it. A sub-trie that grows
beyond ``chunk`` fingerprints is dealt to tasks as pairs of chunks (chosen by hash), each joined alike,
so a hot key never meets in one task and no pair is lost. Tasks emit a spanning forest of what they
linked, never all pairs; distributed connected components finish the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import few_files, read_table, stage, with_row_id
from .cells import bounds, deal, forest, whole_runs
from .components import connected_components

BITS = 64
LOWER = {i: i + 32 for i in range(65, 91)}
WHITE = "\t\n\x0b\x0c\r "


def simhash(text: str | None, width: int) -> int:
    """The fingerprint of one text."""
    import xxhash

    words = (text or "").translate(LOWER).translate(_TO_SPACE).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    digest, join = xxhash.xxh64_digest, " ".join
    h = b"".join([digest(join(words[i:i + width]), 42) for i in range(n)])   # big-endian
    bits = np.unpackbits(np.frombuffer(h, np.uint8)).reshape(n, BITS)
    ones = bits.sum(axis=0, dtype=np.int64) * 2 > n
    return int.from_bytes(np.packbits(ones).tobytes(), "big")


_TO_SPACE = {ord(c): 32 for c in WHITE}


def fingerprints(df: DataFrame, width: int = 4, text: str = "text", out: str = "fp") -> DataFrame:
    """Replace ``text`` by ``out``: the fingerprint as a signed long."""
    rest = [c for c in df.columns if c != text]
    schema = T.StructType([*(df.schema[c] for c in rest), T.StructField(out, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(t.as_py(), width) for t in batch.column(text)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(fps, pa.int64())],
                                             names=[*rest, out])

    return df.select(*rest, text).mapInArrow(run, schema)


def trie_pairs(fps: np.ndarray, side: np.ndarray, budget: int, brute: int = 1024, most: int = 1 << 12,
               cells_at_once: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of the sorted ``fps`` (uint64) within ``budget`` differing bits, in blocks.

    ``side`` restricts which pairs count: both ends on side 2 (a chunk with itself), or one end on
    side 0 and one on side 1. A node is a range of the sorted array that shares its leading bits.
    """
    n = len(fps)
    if n < 2:
        return
    one = np.uint64(1)
    stack = [(0, np.array([[0, n, 0, n, 0]], dtype=np.int64))]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs) > most:    # bounded memory: walk the rest later
            stack.append((depth, pairs[most:]))
            pairs = pairs[:most]
        size = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        done = (size <= brute) | (depth == BITS)
        if done.any():           # leaves: the remaining bits of each pair
            leaf = pairs[done]
            cut = np.searchsorted(np.cumsum(size[done]), np.arange(cells_at_once, int(size[done].sum()), cells_at_once))
            for part in np.split(leaf, np.unique(cut[cut > 0])):
                w = part[:, 3] - part[:, 2]
                cells = (part[:, 1] - part[:, 0]) * w
                if not (total := int(cells.sum())):
                    continue
                of = np.repeat(np.arange(len(part)), cells)
                k = np.arange(total) - np.repeat(np.cumsum(cells) - cells, cells)
                i, j = part[of, 0] + k // w[of], part[of, 2] + k % w[of]
                ok = (i < j) & ((side[i] == 2) | (side[i] != side[j]))
                i, j = i[ok], j[ok]
                near = np.bitwise_count(fps[i] ^ fps[j]) <= budget
                if near.any():
                    yield i[near], j[near]
            pairs = pairs[~done]
        if not len(pairs):
            continue
        bit = np.uint64(BITS - 1 - depth)
        ones = np.concatenate([[0], np.cumsum(((fps >> bit) & one).astype(np.int64))])
        a0, a1, b0, b1, err = pairs.T
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])   # first entry with the bit set
        same = a0 == b0                                                   # a node with itself
        kids = [np.stack([a0, am, b0, bm, err], 1), np.stack([am, a1, bm, b1, err], 1),
                np.stack([a0, am, bm, b1, err + 1], 1), np.stack([am, a1, b0, bm, err + 1], 1)[~same]]
        kids = np.concatenate(kids)
        kids = kids[(kids[:, 0] < kids[:, 1]) & (kids[:, 2] < kids[:, 3]) & (kids[:, 4] <= budget)]
        if len(kids):
            stack.append((depth + 1, kids))


def block_masks(budget: int) -> list[int]:
    """A mask for every pair of the budget + 2 blocks; close fingerprints agree under one at least."""
    n = budget + 2
    edges = [round(k * BITS / n) for k in range(n + 1)]
    blocks = [((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in range(n)]
    return [a | b for a, b in combinations(blocks, 2)]


def links(nodes: DataFrame, budget: int = 4, chunk: int = 2048) -> DataFrame:
    """A spanning forest (a, b) of the different fingerprints ``fp`` (long) within ``budget`` bits."""
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in block_masks(budget)]
    parts = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m))) for k, m in enumerate(signed)])
    keyed = nodes.select("fp", F.explode(parts).alias("key"))
    dealt = deal(keyed, "key", F.xxhash64("fp"), chunk)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells in whole_runs(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _solve(*cells, budget)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _solve(cell: np.ndarray, side: np.ndarray, fp: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for s, e in bounds(cell):
        if e - s > 1:
            mine = fp[s:e].view(np.uint64)
            order = np.argsort(mine, kind="stable")
            root = forest(e - s, trie_pairs(mine[order], side[s:e][order], budget))
            hit = np.flatnonzero(root != np.arange(e - s))
            a.append(fp[s:e][order[hit]])
            b.append(fp[s:e][order[root[hit]]])
    return np.concatenate(a), np.concatenate(b)


def near_classes(docs: DataFrame, width: int = 4, budget: int = 4, id: str = "doc_id", text: str = "text",
                 row: str | None = None) -> DataFrame:
    """(id, fp, component, is_first, rid): every row, its fingerprint, the smallest id that its links reach.

    ``is_first`` marks one row of each class: the one with the smallest id (null ids last; of repeated
    ids any one, but always one). Every row stays, repeated ids and texts included; a null id takes part,
    and a class of null ids only has a null component. Other columns are not looked at. No rows: no rows.
    ``row`` names a column of distinct longs to return as ``rid``; without it rows are numbered here.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), *([F.col(row).alias("rid")] if row else []))
    rows = stage(fingerprints(rows if row else with_row_id(rows), width), "simhash")
    nodes = rows.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("null"), "id", "rid")).alias("least"))
    n = rows.count()
    nodes = stage(few_files(nodes, n), "simhash-nodes")
    comp = connected_components(links(nodes.select("fp"), budget), n).withColumnRenamed("node", "fp")
    classes = nodes.join(comp, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("class"))
    least = classes.groupBy("class").agg(F.min("least").alias("first"))
    named = classes.join(least, "class").select("fp", "first")
    return rows.join(named, "fp").select(F.col("id").alias(id), "fp", F.col("first.id").alias("component"),
                                         (F.col("rid") == F.col("first.rid")).alias("is_first"), "rid")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_classes(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))
