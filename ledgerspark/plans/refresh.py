"""Incremental refresh of a mart that is partitioned by month.

A refresh compares the source's months with a manifest of those that the mart
was built from (row count and two order-independent sums of row hashes each),
rebuilds the months that are new or have changed, and drops those that are gone.
Only their partitions are written (dynamic partition overwrite); the others keep
their files. The manifest is written last, as a new version beside the mart: a
refresh that fails half-way leaves the old one, so the next run finds the same
months again and writes the same bytes.

A month is written in as many files as its rows need, rows dealt by their hash and
sorted, so a retry or another partitioning of the source gives equal files and a
month that holds a third of the rows is spread. Rows without a month are a
partition of their own. One refresh at a time may write a mart. Months are written
some at a time, so what is shuffled and sorted for one batch is gone before the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.sources.sinks import COMPRESSION, children, read_mart, remove, shuffles_freed

ROWS_PER_FILE = 2_000_000
MOST_LITERALS = 1000      # months named in a filter; more are joined
ROWS_PER_BATCH = 4_000_000   # rows of months that are written together, at least
MOST_BATCHES = 8          # about: a source that is not kept by month is read once a batch

ACTIONS = ("new", "changed", "kept", "gone")


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns that tells NULLs apart by their place."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(*cols, *(c.isNull() for c in cols))


def month_digests(df: DataFrame, by: str = "period") -> DataFrame:
    """(by, rows, total, mixed): equal for equal sets of rows, in any order and partitioning."""
    h = row_hash(df)
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("total"), F.bit_xor(h).alias("mixed"))


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions of a manifest, ascending."""
    return sorted(int(n) for n in children(spark, path) if n.isdigit() and "_SUCCESS" in children(spark, f"{path}/{n}"))


def compare(now: DataFrame, before: DataFrame | None, by: str = "period") -> DataFrame:
    """(by, rows, total, mixed, action) of every month of either manifest."""
    if before is None:
        return now.withColumn("action", F.lit("new"))
    old = before.select(F.col(by).alias("_by"), F.struct("rows", "total", "mixed").alias("_old"))
    j = now.withColumn("_new", F.struct("rows", "total", "mixed")).join(old, now[by].eqNullSafe(F.col("_by")), "full_outer")
    action = (F.when(F.col("_new").isNull(), "gone").when(F.col("_old").isNull(), "new")
               .when(F.col("_new") == F.col("_old"), "kept").otherwise("changed"))
    return j.select(F.when(F.col("_new").isNull(), F.col("_by")).otherwise(F.col(by)).alias(by), "rows", "total", "mixed", action.alias("action"))


def _months(df: DataFrame, months: list, by: str) -> DataFrame:
    """The rows of these months; named in the filter, so that a scan reads no other partition."""
    if len(months) <= MOST_LITERALS:
        named = [m for m in months if m is not None]
        hit = F.col(by).isin(named) if named else F.lit(False)
        return df.where(hit | F.col(by).isNull() if None in months else hit)
    wanted = df.sparkSession.createDataFrame([(m,) for m in months], df.select(by).schema).withColumnRenamed(by, "_by")
    return df.join(wanted, df[by].eqNullSafe(F.col("_by")), "left_semi")


def batches(months: list, by: str) -> list[list]:
    """Months (rows of the log) in batches of about `ROWS_PER_BATCH` rows or an eighth of all; one empty batch for none."""
    most = max(ROWS_PER_BATCH, sum(r["rows"] for r in months) / MOST_BATCHES)
    out, held = [[]], 0
    for r in sorted(months, key=lambda r: (r[by] is not None, r[by])):
        if out[-1] and held + r["rows"] > most:
            out.append([])
            held = 0
        out[-1].append(r[by])
        held += r["rows"]
    return out


def refresh(source: DataFrame, path: str, build: Callable[[DataFrame], DataFrame] = lambda df: df,
            by: str = "period") -> tuple[DataFrame, DataFrame]:
    """Bring the mart at `path` up to date with `source`; (the mart, the log).

    `build` makes a month's mart rows from that month's source rows and keeps
    the `by` column. The log has (by, rows, action) for every month: new,
    changed, kept or gone (rows NULL).
    """
    spark = source.sparkSession
    versions = _versions(spark, f"{path}.manifest")
    schema = f"{by} {source.schema[by].dataType.simpleString()}, rows long, total decimal(38,0), mixed long"
    before = spark.read.schema(schema).parquet(f"{path}.manifest/{versions[-1]}") if versions else None
    version = versions[-1] + 1 if versions else 1
    # the comparison is written too: what follows reads it, and the log stays as it was
    with shuffles_freed(spark):
        compare(month_digests(source, by), before, by).coalesce(1).write.mode("overwrite").parquet(f"{path}.log/{version}")
    log = spark.read.schema(f"{schema}, action string").parquet(f"{path}.log/{version}")
    todo = log.where("action IN ('new', 'changed')").select(by, "rows").collect()   # one row a month
    files = log.select(F.col(by).alias("_by"), F.greatest(F.lit(1), F.ceil(F.col("rows") / ROWS_PER_FILE)).cast("int").alias("_files"))
    for months in batches(todo, by):
        mart = build(_months(source, months, by))
        dealt = mart.join(files, mart[by].eqNullSafe(F.col("_by"))).withColumn("_file", F.pmod(row_hash(mart), F.col("_files")))
        dealt = dealt.repartition(by, "_file").sortWithinPartitions(by, "_file", *(c for c in mart.columns if c != by)).select(*mart.columns)
        with shuffles_freed(spark):
            (dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
                  .partitionBy(by).parquet(path))
    for r in log.where("action = 'gone'").select(by).collect():
        remove(spark, f"{path}/{by}={'__HIVE_DEFAULT_PARTITION__' if r[by] is None else r[by]}")
    log.where("action <> 'gone'").select(by, "rows", "total", "mixed").coalesce(1).write.mode("overwrite").parquet(f"{path}.manifest/{version}")
    for old in versions[:-1]:   # the one before stays, for who reads it now
        remove(spark, f"{path}.manifest/{old}")
    return read_mart(spark, path, build(source.limit(0)).schema), log.select(by, "rows", "action")
