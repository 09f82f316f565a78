"""Exact ``row_number() over (partition by P order by O)`` that splits hot groups.

A window puts every row of a partition key in one task, so a key that holds a
third of all rows becomes a third of the job in one task. Here a group is cut
into ordered buckets: rows are numbered inside each (P, bucket), and the
number of rows in the group's earlier buckets is added. The bucket counts are
a grouped aggregate (combined map-side), one row per group and bucket. Where
groups are many and nearly all small, `mark_hot` finds those that are worth
splitting, so that only their rows are counted; either way gives the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 1 << 16       # groups are counted together by hash: at most this many rows are broadcast
HOT_ROWS = 500_000    # rows of a slot from which its groups are split


def mark_hot(df: DataFrame, cols: Sequence[str], name: str = "_hot", rows: int = HOT_ROWS) -> DataFrame:
    """`name`: true for the groups of `cols` that may have more than `rows` rows, NULL for the others.

    Rows are counted by the hash of their group, so what is moved does not grow with the number of groups. A small
    group that shares its hash with a large one is marked as well, and a group is marked as a whole or not at all.
    """
    slot = F.pmod(F.xxhash64(*cols), F.lit(SLOTS)).cast("int")
    hot = df.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows)
    marked = df.withColumn("_slot", slot).join(F.broadcast(hot.select("_slot", F.lit(True).alias(name))), "_slot", "left")
    return marked.drop("_slot")


def row_number(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
               bucket: Column, name: str = "row_number", hot: str | None = None) -> DataFrame:
    """Row number by `order_cols` (ascending, nulls first) within `partition_cols`.

    `bucket` must not decrease along `order_cols` (for example a coarsened
    first order column); a NULL bucket comes first. NULL group keys are a
    group, as in a window. `hot`: a column that is true for the groups to
    split, the same for all rows of a group (`mark_hot`); without it all are.
    """
    P = list(partition_cols)
    src = df.withColumn("_b", bucket if hot is None else F.when(F.col(hot), bucket))
    split = src if hot is None else src.where(F.col(hot))
    counts = split.groupBy(*P, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*P).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # one struct stands for group and bucket: structs of NULLs are equal, and the rows stay where the window put them
    part = F.struct(*P, "_b").alias("_part")
    offsets = counts.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_part").orderBy(*order_cols)
    local = src.select(*df.columns, part).withColumn("_local", F.row_number().over(inside))
    return local.join(offsets, "_part", "left").select(*df.columns, (F.col("_local") + F.coalesce("_off", F.lit(0))).alias(name))
