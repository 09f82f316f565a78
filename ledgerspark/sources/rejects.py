"""Raw CSV tables whose bad lines are kept apart instead of ending the load.

A line that cannot be read under the declared schema - a cell that is not of its
column's type, too few or too many cells - is kept as text with a reason. Good
lines of the same file load. One scan parses both: the parsed rows carry the text
of a bad line in `LINE` (NULL for good ones), so what is staged once serves the
good rows and the rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE = "_line"

CELLS, UNREADABLE = "cells", "unreadable"   # reasons that name no column


def read_lines(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """The rows of a CSV table and `LINE`: the text of those that cannot be read.

    With a header it is held against the schema: another file's header is still an error.
    """
    kept = T.StructType([*schema.fields, T.StructField(LINE, T.StringType(), True)])
    parsed = (spark.read.schema(kept).option("header", header).option("enforceSchema", False).option("mode", "PERMISSIVE")
                   .option("columnNameOfCorruptRecord", LINE).csv(path))
    # Always true, but it reads every cell: Spark looks only at the cells that a query needs, and a line
    # must be bad or good whichever those are.
    return parsed.where(F.hash(*schema.fieldNames()) >= F.lit(-(1 << 31)))


def good(parsed: DataFrame) -> DataFrame:
    """The rows that could be read."""
    return parsed.where(F.col(LINE).isNull()).drop(LINE)


def reason(line: Column, schema: T.StructType) -> Column:
    """Why a line cannot be read: `CELLS` for their number, else the first column whose cell is of another type."""
    text = T.StructType([*(T.StructField(f.name, T.StringType(), True) for f in schema.fields), T.StructField(LINE, T.StringType(), True)])
    cells = F.from_csv(line, text.toDDL(), {"columnNameOfCorruptRecord": LINE, "mode": "PERMISSIVE"})
    out = F.when(cells[LINE].isNotNull(), F.lit(CELLS))
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            out = out.when(cells[f.name].isNotNull() & cells[f.name].try_cast(f.dataType).isNull(), F.lit(f.name))
    return out.otherwise(F.lit(UNREADABLE))


def rejects(parsed: DataFrame, source: str, schema: T.StructType) -> DataFrame:
    """(source, reason, line) of the lines that could not be read."""
    bad = parsed.where(F.col(LINE).isNotNull())
    return bad.select(F.lit(source).alias("source"), reason(F.col(LINE), schema).alias("reason"), F.col(LINE).alias("line"))


def reject_summary(parsed: DataFrame, source: str, schema: T.StructType) -> DataFrame:
    """A1: (source, reason, rows): how many lines are good (reason `good`) and how many are not, and why."""
    why = F.when(F.col(LINE).isNull(), F.lit("good")).otherwise(reason(F.col(LINE), schema))
    return parsed.groupBy(F.lit(source).alias("source"), why.alias("reason")).agg(F.count(F.lit(1)).alias("rows"))
