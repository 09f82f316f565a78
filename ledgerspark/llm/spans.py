"""Where a pattern matches, as code point offsets, in plain column expressions.

``regexp_extract_all`` gives the matches and ``split`` the texts between them, both by the same leftmost
non-overlapping scan; running sums of their lengths are the offsets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once: a lambda's variable, where a column would be inlined."""
    return F.get(F.transform(F.array(value), body), 0)


def running_sums(x: Column) -> Column:
    """Inclusive running sums of an array of longs, in blocks of about the square root of its size."""
    return let(x, _running_sums)


def _running_sums(x: Column) -> Column:
    size = F.size(x)
    width = F.greatest(F.ceil(F.sqrt(size)).cast("int"), F.lit(1))
    zero = F.array(F.lit(0).cast("long"))

    def sums(y: Column) -> Column:   # with a leading zero
        return F.aggregate(y, zero, lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))

    blocks = F.transform(F.sequence(F.lit(0), F.ceil(size / width).cast("int") - 1), lambda b: sums(F.slice(x, b * width + 1, width)))
    with_base = F.aggregate(
        blocks, F.struct(F.lit(0).cast("long").alias("base"), F.array().cast("array<array<bigint>>").alias("out")),
        lambda acc, b: F.struct((acc["base"] + F.element_at(b, -1)).alias("base"), F.concat(
            acc["out"], F.array(F.transform(F.slice(b, F.lit(2), F.size(b) - 1), lambda v: v + acc["base"]))).alias("out")),
        lambda acc: F.flatten(acc["out"]))
    return F.when(size > 0, with_base).otherwise(F.array().cast("array<bigint>"))


def find_all(text: Column, pattern: str, gate: str | None = None) -> tuple[Column, Column]:
    """(matches, texts between them) of a pattern; both empty where ``gate`` (or the pattern) is not found."""
    found, none = F.rlike(text, F.lit(gate or pattern)), F.array().cast("array<string>")
    return (F.when(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
            F.when(found, F.split(text, pattern, -1)).otherwise(none))


def starts(matches: Column, between: Column) -> Column:
    """Start offsets of the matches that ``find_all`` gave."""

    def steps(m: Column, b: Column) -> Column:
        return F.transform(m, lambda x, i: (F.length(F.get(b, i)) + F.coalesce(F.length(F.get(m, i - 1)), F.lit(0))).cast("long"))

    return let(matches, lambda m: let(between, lambda b: running_sums(steps(m, b))))
