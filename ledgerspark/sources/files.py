"""Readers for raw domain tables stored as files (one table per file or folder).

The reference keeps each raw table as a CSV named after the table; we read
CSV or parquet under the declared schemas of ``ledgerspark.schemas`` so no
job is spent on inference and every type is fixed up front.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark import schemas
from ledgerspark.sources.model import Sources
from ledgerspark.sources.rejects import good, read_lines


def read_raw(spark: SparkSession, path: str, schema, fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        # The header is held against the schema, and a cell of the wrong type is an error, not a NULL.
        return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
                     .option("mode", "FAILFAST").csv(path))
    return spark.read.schema(schema).format(fmt).load(path)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _locate(spark: SparkSession, base: str, stem: str, fmt: str) -> str:
    """A table is a file (or folder) `stem.fmt`, or a folder `stem`."""
    folder = f"{base.rstrip('/')}/{stem}"
    return folder if not _exists(spark, f"{folder}.{fmt}") and _exists(spark, folder) else f"{folder}.{fmt}"


def read_weights_wide(spark: SparkSession, path: str, key: str = "service_area") -> DataFrame:
    """Wide weight matrix (one column per business unit) -> long rows.

    The business-unit columns are whatever the header holds; the first column
    is the service area (its header may be empty, as pandas writes an index).
    """
    wide = spark.read.option("header", True).option("inferSchema", False).csv(path)
    first = wide.columns[0]
    wide = wide.withColumnRenamed(first, key)
    units = [c for c in wide.columns if c != key]
    return (wide.select(key, *[F.col(f"`{c}`").cast("double").alias(c) for c in units])
                .unpivot([key], units, "business_unit", "weight"))


def raw_format(spark: SparkSession, base: str) -> str | None:
    """The format of the raw tables under ``base``, None if there are none (the fixtures' folders)."""
    for fmt in ("csv", "parquet"):
        if _exists(spark, f"{base.rstrip('/')}/telecom_invoices.{fmt}"):
            return fmt
    return "csv" if _exists(spark, f"{base.rstrip('/')}/telecom_invoices") else None


def parsed_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The raw CSV tables under ``base`` with the text of the lines that cannot be read (see ``rejects``)."""
    return {stem: read_lines(spark, _locate(spark, base, stem, "csv"), sch) for stem, sch in schemas.RAW_TABLES.items()}


def load_sources(spark: SparkSession, base: str, fmt: str = "csv",
                 weights_path: str | None = None, keep_rejects: bool = False) -> Sources:
    """All raw tables under ``base`` as DataFrames with declared schemas (A1).

    The weight matrix is ``weights_path``, or ``chargeback_weights.csv`` under ``base`` if it is there.
    A cell of the wrong type ends the load, or with ``keep_rejects`` its line is left out (``parsed_tables``
    has it).
    """
    supplied = _locate(spark, base, "chargeback_weights", "csv")
    weights_path = weights_path or (supplied if _exists(spark, supplied) else None)
    if keep_rejects and fmt == "csv":
        t = {stem: good(df) for stem, df in parsed_tables(spark, base).items()}
    else:
        t = {stem: read_raw(spark, _locate(spark, base, stem, fmt), sch, fmt)
             for stem, sch in schemas.RAW_TABLES.items()}
    return Sources(
        cmdb=t["servicenow_cmdb"],
        invoices=t["telecom_invoices"],
        incidents=t["servicenow_incidents"],
        telemetry=t["itom_telemetry"],
        budget=t["coupa_pos"],
        gl=t["sap_gl"],
        weights=read_weights_wide(spark, weights_path) if weights_path else None,
    )


def register_views(sources: Sources) -> None:
    """Expose each source as a temp view named after its raw table (for spark.sql users)."""
    for name, df in sources.items():
        df.createOrReplaceTempView(schemas.VIEW_NAMES.get(name, name))
