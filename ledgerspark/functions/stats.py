"""Statistical building blocks written as DataFrame expressions.

* ``average_rank``: rank with ties sharing the mean of their positions (the
  pandas ``method="average"`` rule), for already aggregated frames.
* ``rank_auc``: exact ROC-AUC (Mann-Whitney with average tie ranks) that
  never sorts the whole score table in one task: scores are first collapsed
  to distinct values, split into ordered buckets by approximate quantiles,
  and prefix sums are taken per bucket, then across the (few) buckets.
* ``hashed_normal``: a standard normal draw that is a pure function of a key,
  so Monte Carlo results do not depend on partitioning or task retries.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# 2**32 + 1: maps a 32-bit hash h to (h + 1) / (2**32 + 1), strictly inside (0, 1).
_U32_DEN = 4294967297.0


def average_rank(value: str, partition: Sequence[str] = (), descending: bool = True) -> Column:
    """Average-tie rank of ``value`` within ``partition`` (NULL values get NULL).

    Use on aggregated frames only (vendors, areas): a window with no partition
    key runs in a single task.
    """
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    w = Window.partitionBy(*partition).orderBy(order)
    ties = Window.partitionBy(*partition, value)
    r = F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0
    return F.when(F.col(value).isNotNull(), r.cast("double"))


def _u32(hex_digest: Column, start: int) -> Column:
    return F.conv(F.substring(hex_digest, start, 8), 16, 10).cast("double")


def hashed_normal(key: Column) -> Column:
    """Box-Muller normal from md5(key): hex 1-8 -> u1, hex 9-16 -> u2."""
    h = F.md5(key)
    u1 = (_u32(h, 1) + 1.0) / _U32_DEN
    u2 = (_u32(h, 9) + 1.0) / _U32_DEN
    return F.sqrt(F.log(u1) * -2.0) * F.cos(u2 * (2.0 * math.pi))


def rank_auc(df: DataFrame, score: str, label: str, keys: Sequence[str] = (),
             buckets: int = 64) -> DataFrame:
    """Exact ROC-AUC of ``score`` against a 0/1 ``label`` per group of ``keys``.

    AUC = sum over distinct scores s of pos(s) * (neg_below(s) + neg(s) / 2),
    divided by P * N; NULL when a group has only one class. Every step is a
    grouped aggregate or a window partitioned by (keys, bucket), so a hot
    score value collapses to one row before anything is ordered.
    """
    out_keys = list(keys)
    keys = out_keys or ["_g"]
    lab = F.col(label).cast("int")
    src = df if out_keys else df.withColumn("_g", F.lit(0))
    per_score = (src.where(F.col(score).isNotNull() & F.col(label).isNotNull())
                    .groupBy(*keys, F.col(score).cast("double").alias("_s"))
                    .agg(F.sum(F.when(lab == 1, 1).otherwise(0)).cast("double").alias("_pos"),
                         F.sum(F.when(lab == 0, 1).otherwise(0)).cast("double").alias("_neg")))
    # Ordered buckets from approximate quantiles of the distinct scores; a
    # bucket is a function of the score, so equal scores share a bucket.
    # `bounds` has one row per group; a single group takes it as a scalar subquery.
    probs = [i / buckets for i in range(1, buckets)]
    bounds = per_score.groupBy(*keys).agg(
        F.percentile_approx("_s", probs, 10000).alias("_bounds"))
    bucketed = (per_score.join(bounds, keys, "inner") if out_keys
                else per_score.withColumn("_bounds", bounds.select("_bounds").scalar()))
    bucketed = bucketed.withColumn(
        "_b", F.size(F.filter("_bounds", lambda b: b < F.col("_s")))).drop("_bounds")
    # Negatives in all lower buckets (few rows per group: at most `buckets`).
    btot = bucketed.groupBy(*keys, "_b").agg(F.sum("_neg").alias("_bneg"))
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = btot.withColumn("_off", F.coalesce(F.sum("_bneg").over(wb), F.lit(0.0))).drop("_bneg")
    # Negatives in the same bucket with a lower score.
    ws = Window.partitionBy(*keys, "_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    scored = (bucketed.join(offsets, keys + ["_b"], "inner")
                      .withColumn("_below", F.col("_off") + F.coalesce(F.sum("_neg").over(ws),
                                                                      F.lit(0.0))))
    # No keys: a global aggregate, so an empty input still yields one NULL row.
    res = scored.groupBy(*out_keys).agg(
        F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2.0)).alias("_u"),
        F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"))
    auc = F.when((F.col("positives") > 0) & (F.col("negatives") > 0),
                 F.col("_u") / (F.col("positives") * F.col("negatives")))
    return res.select(*out_keys, auc.alias("auc"),
                      F.coalesce(F.col("positives"), F.lit(0.0)).cast("long").alias("positives"),
                      F.coalesce(F.col("negatives"), F.lit(0.0)).cast("long").alias("negatives"))


def exact_percentile(df: DataFrame, value: str, q: float, keys: Sequence[str] = (),
                     buckets: int = 64) -> DataFrame:
    """Exact linear-interpolated percentile of `value` per group, without unbounded buffers.

    Same result as ``percentile(value, q)``: with n values the position is
    q * (n - 1) and the answer interpolates between the values at its floor and
    ceiling ranks. Values collapse to (value, count); ordered buckets from
    approximate quantiles give per-bucket counts and offsets; only the rows of
    the bucket(s) holding the two target ranks are ordered, per bucket. A group
    without values has a NULL percentile; a NULL key is a group.
    """
    out_keys = list(keys)
    keys = ["_g"]
    # one struct stands for the group: structs of NULLs join, NULL keys would not
    group = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(out_keys)]) if out_keys else F.lit(0)
    df = df.withColumn("_g", group)
    src = df
    vals = (src.where(F.col(value).isNotNull())
               .groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    probs = [i / buckets for i in range(1, buckets)]
    meta = vals.groupBy(*keys).agg(F.sum("_c").alias("_n"),
                                   F.percentile_approx("_v", probs, 10000).alias("_bounds"))
    meta = meta.withColumn("_pos", (F.col("_n") - 1) * float(q))
    meta = meta.withColumns({"_lo": F.floor("_pos"), "_hi": F.ceil("_pos")})
    if out_keys:
        b = vals.join(meta, keys, "inner")
    else:   # one group: attach its single row as a scalar subquery (no constant-key join)
        m = meta.drop("_g")
        b = vals.withColumn("_m", m.select(F.struct(*m.columns)).scalar()).select("*", "_m.*")
    b = b.withColumn(
        "_b", F.size(F.filter("_bounds", lambda x: x < F.col("_v")))).drop("_bounds", "_m")
    # Rows before each bucket (a handful of rows per group).
    btot = b.groupBy(*keys, "_b").agg(F.sum("_c").alias("_bc"))
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = btot.withColumn("_off", F.coalesce(F.sum("_bc").over(wb), F.lit(0))).withColumn(
        "_end", F.col("_off") + F.col("_bc"))
    b = b.join(off, keys + ["_b"], "inner")
    # Keep the bucket(s) that contain rank _lo or _hi (0-based), then rank inside them.
    hit = (((F.col("_lo") >= F.col("_off")) & (F.col("_lo") < F.col("_end")))
           | ((F.col("_hi") >= F.col("_off")) & (F.col("_hi") < F.col("_end"))))
    ws = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    r = b.where(hit).withColumn("_upto", F.col("_off") + F.sum("_c").over(ws))   # ranks < _upto
    r = r.withColumn("_from", F.col("_upto") - F.col("_c"))
    at = lambda rank: F.min(F.when((F.col(rank) >= F.col("_from")) & (F.col(rank) < F.col("_upto")),
                                   F.col("_v")))
    res = r.groupBy(*keys).agg(at("_lo").alias("_vlo"), at("_hi").alias("_vhi"),
                               F.first("_pos").alias("_pos"), F.first("_lo").alias("_l"),
                               F.first("_hi").alias("_h"))
    pct = F.when(F.col("_h") == F.col("_l"), F.col("_vlo")).otherwise(
        (F.col("_h") - F.col("_pos")) * F.col("_vlo") + (F.col("_pos") - F.col("_l")) * F.col("_vhi"))
    res = res.select("_g", pct.alias("percentile"))
    if not out_keys:
        return res.agg(F.max("percentile").alias("percentile"))   # one row, also for no values
    return (df.select("_g").distinct().join(res, "_g", "left")
              .select(*[F.col(f"_g.k{i}").alias(k) for i, k in enumerate(out_keys)], "percentile"))


def suffix_sums(per_value: DataFrame, value: str, sums: Sequence[str], buckets: int = 64) -> DataFrame:
    """(value, sums): the totals of `sums` over all rows whose value is this one or greater.

    `per_value` has one row for each value. Values fall into ordered buckets by
    approximate quantiles; sums are taken inside a bucket and the totals of the
    buckets above (a handful of rows) are added, so no task orders all values.
    """
    probs = [i / buckets for i in range(1, buckets)]
    bounds = per_value.agg(F.percentile_approx(value, probs, 10000)).scalar()
    b = per_value.select(value, *sums).withColumn("_bounds", bounds)
    # one bucket, or no rows: no bounds
    below = F.size(F.filter("_bounds", lambda x: x < F.col(value)))
    b = b.withColumn("_b", F.when(F.col("_bounds").isNull(), 0).otherwise(below)).drop("_bounds")
    above = Window.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    totals = b.groupBy("_b").agg(*[F.sum(c).alias(c) for c in sums])
    totals = totals.select("_b", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"_above_{c}") for c in sums])
    inside = Window.partitionBy("_b").orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = b.select(value, "_b", *[F.sum(c).over(inside).alias(c) for c in sums]).join(totals, "_b")
    return out.select(value, *[(F.col(c) + F.col(f"_above_{c}")).alias(c) for c in sums])
