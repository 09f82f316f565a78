"""Self-joins of keyed rows in cells of bounded size.

Rows that share a key are to be compared with each other. A key with more rows than a chunk is dealt as
pairs of chunks, one cell each: rows of a cell are compared within it, and no pair of rows is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deal(rows: DataFrame, key: str, hashed: Column, chunk: int) -> DataFrame:
    """(cell, side, other columns), rows of a cell together in one partition and next to each other.

    side is 2 in the cell of a chunk with itself; in a cell of two chunks it is 0 or 1, and only rows of
    different sides are to be compared. Keys of a single row are left out. ``hashed`` picks the chunk.
    """
    rest = [c for c in rows.columns if c != key]
    sizes = rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1")
    rows = rows.join(sizes, key).withColumn("_chunks", F.ceil(F.col("_n") / F.lit(chunk)).cast("int"))
    rows = rows.withColumn("_c", F.pmod(hashed, F.col("_chunks")).cast("int"))
    rows = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    side = F.when(F.col("_c") == F.col("_o"), 2).when(F.col("_c") < F.col("_o"), 0).otherwise(1)
    cell = F.xxhash64(key, F.least("_c", "_o"), F.greatest("_c", "_o"))
    return rows.select(cell.alias("cell"), side.cast("byte").alias("side"), *rest).repartition("cell").sortWithinPartitions("cell")


def bounds(cell: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and end of each run."""
    cut = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]])
    return zip(cut[:-1].tolist(), cut[1:].tolist())


def as_numpy(col: pa.Array) -> np.ndarray:
    """A column as an array; lists of equal length as rows of a matrix."""
    if pa.types.is_list(col.type):
        width = len(col[0]) if len(col) else 0
        return np.asarray(col.flatten()).reshape(len(col), width)
    return np.asarray(col)


def whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of sorted batches, cut so that no run of the first column is divided.

    A run holds lists of one length only; batches may differ.
    """
    rest: list[np.ndarray] | None = None
    for batch in batches:
        cols = [as_numpy(c) for c in batch.columns]
        if not len(cols[0]):
            continue
        if rest is not None:
            if all(r.shape[1:] == c.shape[1:] for r, c in zip(rest, cols)):
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            else:
                yield rest   # another length begins, so its run is over
        at = int(np.flatnonzero(cols[0] != cols[0][-1])[-1]) + 1 if cols[0][0] != cols[0][-1] else 0
        if at:
            yield [c[:at] for c in cols]
        rest = [c[at:] for c in cols]
    if rest is not None and len(rest[0]):
        yield rest


def forest(n: int, blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For n items, the least item that each reaches by the index pairs given in blocks."""
    root = np.arange(n)
    for i, j in blocks:
        while True:
            a, b = root[i], root[j]
            low = np.minimum(a, b)
            if (a == b).all():
                break
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            while (root != (up := root[root])).any():
                root = up
    return root
