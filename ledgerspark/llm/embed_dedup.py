"""Near-duplicate embeddings by random-hyperplane hashing (operator 7).

Equal vectors collapse to one class first (a combinable aggregate). Several tables hash each class by
the signs of its projections on random hyperplanes; classes that share a bucket of any table are
compared by exact cosine in double precision. Hyperplanes per table follow the number of classes
(``per_bucket`` expected in a bucket), and the number of tables follows from those and ``recall``: the
chance that a pair right at the threshold meets in some table. A bucket of more than ``chunk`` classes is
dealt as pairs of chunks, so none is capped.

A pair that meets in several tables counts in the first of them only (each class carries its buckets).
Tasks emit per class the linked vectors counted and one edge of a spanning forest, never pairs.
Distributed connected components finish the classes.

Vectors that are null, empty or zero, or hold null or non-finite components link with nothing, nor do
vectors of different lengths. Labels and other columns are not looked at. Repeated rows and repeated ids
are vectors of their own; a null id takes part and is never kept. No rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cells import bounds, deal, forest, whole_runs
from .common import read_table, stage, with_row_id
from .components import connected_components


def table_sizes(n: int, threshold: float, per_bucket: int, recall: float) -> tuple[int, int]:
    """(hyperplanes per table, tables) for n classes."""
    planes = max(1, math.ceil(math.log2(max(2, n / per_bucket))))
    meet = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision (scaled first, so that squares neither overflow nor vanish)."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def buckets(classes: DataFrame, planes: int, tables: int, seed: int) -> DataFrame:
    """Add ``sig``: the bucket of each class in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            lens = np.diff(np.asarray(v.offsets))
            sig = np.zeros((len(v), tables), np.int64)
            for dim in np.unique(lens):   # planes depend on the dimension alone
                rows = np.flatnonzero(lens == dim)
                x = unit(np.asarray(v.take(pa.array(rows)).flatten()).reshape(len(rows), dim))
                normal = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), planes * tables))
                signs = (x @ normal > 0).reshape(len(rows), tables, planes)
                sig[rows] = signs @ (1 << np.arange(planes, dtype=np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, tables), pa.int32()), pa.array(sig.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "sig"])

    return classes.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in classes.dtypes) + ", sig array<bigint>")


def _linked(table: np.ndarray, side: np.ndarray, sig: np.ndarray, x: np.ndarray, threshold: float, block: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of one cell whose cosine reaches the threshold and that met in no earlier table."""
    for i0 in range(0, len(x), block):
        near = x[i0:i0 + block] @ x[i0:].T >= threshold
        i, j = np.nonzero(near)
        i, j = i + i0, j + i0
        ok = (i < j) & ((side[i] == 2) | (side[i] != side[j]))
        i, j = i[ok], j[ok]
        for t in range(int(table[0])):
            new = sig[i, t] != sig[j, t]
            i, j = i[new], j[new]
        if len(i):
            yield i, j


def compare(classes: DataFrame, threshold: float, planes: int, tables: int, chunk: int, seed: int) -> DataFrame:
    """(cid, links, root): per class and cell the vectors linked there and an edge towards them."""
    coded = buckets(classes, planes, tables, seed)
    keyed = coded.select("cid", "m", "sig", "v", F.posexplode("sig").alias("t", "bucket"))
    keyed = keyed.select(F.xxhash64("t", "bucket", F.size("v")).alias("key"), "t", "cid", "m", "sig", "v")
    dealt = deal(keyed, "key", F.xxhash64("cid"), chunk)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, side, t, cid, m, sig, v in whole_runs(_same_length(batches)):
            out: list[list] = [[], [], []]
            for s, e in bounds(cell):
                if e - s < 2:
                    continue
                x, mine = unit(v[s:e]), m[s:e]
                links = np.zeros(e - s, np.int64)
                pairs = []
                for i, j in _linked(t[s:e], side[s:e], sig[s:e], x, threshold):
                    np.add.at(links, i, mine[j])
                    np.add.at(links, j, mine[i])
                    pairs.append((i, j))
                root = forest(e - s, iter(pairs))
                hit = np.flatnonzero(links)
                for to, what in zip(out, (cid[s:e][hit], links[hit], cid[s:e][root[hit]])):
                    to.append(what)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *x]), pa.int64()) for x in out],
                                             names=["cid", "links", "root"])

    return dealt.mapInArrow(run, "cid long, links long, root long")


def _same_length(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut batches where the vectors' length changes; a cell holds one length only."""
    for batch in batches:
        lens = np.diff(np.asarray(batch.column("v").offsets))
        cut = np.concatenate([[0], np.flatnonzero(np.diff(lens)) + 1, [len(lens)]])
        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if e > s:
                yield batch.slice(s, e - s)


def near_vectors(rows: DataFrame, threshold: float = 0.9, recall: float = 0.98, per_bucket: int = 256, chunk: int = 2048,
                 id: str = "vec_id", vector: str = "embedding", seed: int = 17) -> DataFrame:
    """(id, n_links, component_id, kept) for every row."""
    v = F.col("v")
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    src = rows.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    src = src.select("id", F.when(F.coalesce(good, F.lit(False)), v).alias("v"))
    # 128 bits stand for the vector
    keys = src.select("id", F.when(v.isNotNull(), F.xxhash64(F.lit(1), v)).alias("k1"), F.when(v.isNotNull(), F.xxhash64(F.lit(2), v)).alias("k2"), "v")
    classes = keys.where("v is not null").groupBy("k1", "k2").agg(F.min("id").alias("least"), F.count("*").alias("m"), F.first("v").alias("v"))
    classes = stage(with_row_id(classes, "cid"), "vectors")
    n = classes.count()
    planes, tables = table_sizes(n, threshold, per_bucket, recall)
    found = stage(compare(classes.select("cid", "m", "v"), threshold, planes, tables, chunk, seed), "vector-links")
    comp = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), n)
    linked = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = classes.drop("v").join(linked, "cid", "left").join(comp.withColumnRenamed("node", "cid"), "cid", "left").select(
        "k1", "k2", "least", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "cid").alias("class"))
    least = named.groupBy("class").agg(F.min("least").alias("component_id"))
    named = named.join(least, "class").select("k1", "k2", "n_links", "component_id")
    out = keys.where("v is not null").select("id", "k1", "k2").join(named, ["k1", "k2"]).select("id", "n_links", "component_id")
    alone = keys.where("v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(alone).select(F.col("id").alias(id), "n_links", "component_id",
                                         F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
