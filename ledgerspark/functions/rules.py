"""The invoice audit ladder: one definition, two vocabularies.

The audit mart and the triage classifier apply the same ordered rules; the
first rule that matches wins:

1. the circuit is decommissioned            -> ghost
2. billed >= duplicate_ratio * contracted   -> duplicate   (inclusive)
3. billed >  overcharge_ratio * contracted  -> overcharge  (strict)
4. otherwise                                -> ok
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference for identical results):
# audit finding names, in ladder order: ghost, duplicate, overcharge, ok
FINDINGS = ("Ghost circuit", "Duplicate charge", "Rate overcharge", "OK")
# triage label names, in ladder order: ghost, duplicate, overcharge, ok
LABELS = ("ghost_circuit", "duplicate", "rate_overcharge", "none")
# status value that marks a retired circuit
DECOMMISSIONED = "Decommissioned"
# ladder thresholds
DUPLICATE_RATIO = 1.9
OVERCHARGE_RATIO = 1.10

# Label order used by the evaluation report.
EVAL_LABELS = ("rate_overcharge", "duplicate", "ghost_circuit", "none")


def ladder(billed: Column, contracted: Column, status: Column,
           names=FINDINGS, dup: float = DUPLICATE_RATIO, over: float = OVERCHARGE_RATIO) -> Column:
    ghost, duplicate, overcharge, ok = names
    return (F.when(status == DECOMMISSIONED, ghost)
             .when(billed >= contracted * dup, duplicate)
             .when(billed > contracted * over, overcharge)
             .otherwise(ok))


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (never an ANSI divide-by-zero)."""
    return num / F.nullif(den, F.lit(0))


# Digits after the point that a value keeps inside a sum: finer than any input's.
INPUT_SCALE = 10


def decimal_sum(col, input_scale: int = INPUT_SCALE) -> Column:
    """Exact sum of values as DECIMAL(28, input_scale), not rounded: for sums that are summed again."""
    return F.sum(_col(col).cast(f"decimal(28,{input_scale})")).cast(f"decimal(28,{input_scale})")


def line_count(df) -> Column:
    """How many invoice lines: the rows of `df`, or the sum of the lines that its rows stand for."""
    return F.coalesce(F.sum("lines"), F.lit(0)) if "lines" in df.columns else F.count(F.lit(1))


def lines_where(df, condition: Column) -> Column:
    """How many invoice lines meet `condition`, of lines or of rows that stand for some."""
    n = F.col("lines") if "lines" in df.columns else F.lit(1)
    return F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).cast("long")


def overbilled(df) -> Column:
    """What lines bill above their contract, 0 where they bill less."""
    return F.col("over") if "over" in df.columns else F.greatest(F.col("variance"), F.lit(0.0))


def money_sum(col, scale: int = 4, input_scale: int = INPUT_SCALE) -> Column:
    """Order-independent sum: values as DECIMAL(28, input_scale), the total rounded to `scale`.

    A DOUBLE sum depends on the order rows arrive in (partitioning, retries);
    a DECIMAL sum does not, so totals are identical run to run and engine to
    engine. Values are not rounded to `scale` one by one: a thousand lines of
    0.004 sum to 4.
    """
    return F.sum(_col(col).cast(f"decimal(28,{input_scale})")).cast(f"decimal(28,{scale})").cast("double")


def exact_avg(col, scale: int = 6) -> Column:
    """Order-independent mean: DECIMAL sum / count (NULL for no values)."""
    return safe_div(money_sum(col, scale), F.count(_col(col)))


def round_decimal(x: Column, factor: float, digits: int = 2) -> Column:
    """round(x * factor, digits) in DECIMAL arithmetic, then DOUBLE.

    Rounding a DOUBLE at an exact half cent depends on how each engine reads
    the binary value; in DECIMAL the half is exact and rounds away from zero.
    """
    return F.round(x.cast("decimal(26,4)") * F.lit(str(factor)).cast("decimal(10,6)"),
                   digits).cast("double")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
