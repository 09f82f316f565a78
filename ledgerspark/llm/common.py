"""Helpers shared by the operators: reading tables, staging, training splits, ragged arrays."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.session import shared_folder


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, fixes generated row ids, and lets several
    later jobs read the rows without computing them again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_files(df: DataFrame, rows: int, per_file: int = 250_000) -> DataFrame:
    """As many partitions as so many small rows need, at most: a small table is not written in many files."""
    return df.coalesce(max(1, -(-rows // per_file)))


def arrow_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches of this session hold at most so many rows: whole texts are long rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def fresh(columns: Sequence[str], name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def hidden(df: DataFrame, *results: str) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """``df`` under names that no operator uses, those names, and its columns under their own names again.

    A column named like one of ``results`` is not among the last: the result takes its place.
    """
    names = {c: f"__in{i}" for i, c in enumerate(df.columns)}
    new = {r.lower() for r in results}
    return df.toDF(*names.values()), names, [F.col(n).alias(c) for c, n in names.items() if c.lower() not in new]


def with_row_id(df: DataFrame, name: str = "rid") -> DataFrame:
    """A distinct long for each row. Stable only once the rows are staged."""
    return df.withColumn(name, F.monotonically_increasing_id())


def id_mod(col: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n (NULL for a NULL id)."""
    return F.crc32(F.encode(col.cast("string"), "UTF-8")) % F.lit(n)


def blank_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def ragged_gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenate flat[starts[i] : starts[i] + lens[i]] for all i."""
    total = int(lens.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(lens)
    return flat[np.repeat(starts - (ends - lens), lens) + np.arange(total)]
