"""Sinks: materialised marts (parquet) and CSV exports, in the shared folder.

Writes are idempotent full overwrites. A partitioned mart is written with a
REBALANCE on its partition column: AQE splits a month that holds a third of
the rows into several files instead of one straggler task, and merges tiny
months, so file sizes stay near the advisory partition size. What a write has
shuffled is removed when it ends, so that the shuffles of one write and not those
of a whole job are on disk.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
COMPRESSION = "zstd"   # of the marts and what is staged for them

_FREEING: dict[int, list] = {}   # per session: how many writes run, the setting before them
_FREEING_LOCK = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries begun in here remove their shuffle files when they end, not when the driver collects garbage.

    Writes run side by side: the first sets the session's setting and the last puts it back.
    """
    key = spark._jsparkSession.hashCode()
    with _FREEING_LOCK:
        state = _FREEING.setdefault(key, [0, spark.conf.get(CLEANUP, None)])
        state[0] += 1
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _FREEING_LOCK:
            state[0] -= 1
            if not state[0]:
                del _FREEING[key]
                if state[1] is None:
                    spark.conf.unset(CLEANUP)
                else:
                    spark.conf.set(CLEANUP, state[1])


def write_mart(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    w = df.hint("rebalance", *partition_by) if partition_by else df
    writer = w.write.mode(mode).option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_freed(df.sparkSession):
        writer.parquet(path)
    return path


def read_mart(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a written mart; with its schema no footer-inference job is needed."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.select(*schema.fieldNames()) if schema is not None else df


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder; 0 if it isn't there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it isn't there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def mart_roundtrip(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """A2: overwrite the mart at `path`, read it back with the original column order and types."""
    write_mart(df, path, partition_by)
    return read_mart(df.sparkSession, path, df.schema)


def export_csv(marts: dict[str, DataFrame], base: str) -> DataFrame:
    """A3: each mart as CSV with a header (no index), then (mart, rows) read back.

    The marts are independent, so they are written as concurrent jobs. The files are gzipped:
    as plain text a line takes four to five times the room.
    """
    def write(item: tuple[str, DataFrame]) -> DataFrame:
        name, df = item
        with shuffles_freed(df.sparkSession):
            df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(f"{base}/{name}")
        back = read_export(df.sparkSession, base, name, df.schema)
        return back.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("mart"), "rows")

    with ThreadPoolExecutor(max_workers=max(1, len(marts))) as pool:
        return reduce(DataFrame.unionByName, pool.map(write, marts.items()))


def read_export(spark: SparkSession, base: str, name: str, schema) -> DataFrame:
    """An exported mart under its schema."""
    return spark.read.schema(schema).option("header", True).csv(f"{base}/{name}")
