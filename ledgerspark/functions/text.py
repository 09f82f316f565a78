"""Text helpers that stay inside the JVM (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dollars(x: Column) -> Column:
    """``$#,##0``: thousands separators, no decimals, ties to even."""
    return F.concat(F.lit("$"), F.format_number(x, 0))
