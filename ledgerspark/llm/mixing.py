"""Mixing sources to target weights by temperature (operator 9).

A source's weight is its share of the tokens raised to an exponent, normalised: 1 keeps the natural mix,
0 makes it uniform. The exponent is bisected until the entropy of the weights meets its target, and then
raised, if the budget would repeat a source more often than allowed, until it doesn't. A round of the
bisection is one aggregate over the sources for 16 exponents at once, so four halvings cost one job and
only sums reach the driver.

Without a budget the mix is the largest one that meets an entropy and uses no source more often than
allowed: every source gives all it may, up to a level that is the same for all (for any size of the mix
that gives the greatest entropy), and the level is bisected in the same way. So a source that is small
gives everything it has and doesn't limit what others give. The entropy to meet is the target's part of the
greatest one of mixes of ``LEAST_SIZE`` or more of what may be used: sources too small to weigh in such a mix,
however many, do not ask for a smaller one.

Weights become documents by budgeted block permutations: the documents of a source are dealt by hash to
blocks of about ``block_tokens`` tokens, the blocks stand in a hashed order, and so do the documents in a
block. A source whose budget holds its tokens e times in full gives every document e copies, and those
that stand before the rest of the budget ends one more. Running sums go over blocks and inside blocks,
so a source with a third of all rows never meets in one task; a source has ``MOST_BLOCKS`` blocks at most.

Tokens are words between white space. Null and empty texts have none. A null source is a source of its
own. A source without tokens has weight 0 and its documents no copies. Rows of one id in one source are
dealt alike but count one by one, in the order of their row ids. Empty tables give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blank_if_null, read_table, stage, with_row_id

SECTIONS, ROUNDS = 16, 8     # together 32 halvings
LEAST_SIZE = 0.5
MOST_BLOCKS = 4096
SALTS = 64
NULL_SOURCE = "\0null"


def _at(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """For each exponent a: sum of p^a, entropy of the weights, largest weight per share."""
    lp = F.log("p")
    cols = []
    for k, a in enumerate(exponents):
        cols += [F.sum(F.exp(lp * a)).alias(f"z{k}"), F.sum(F.exp(lp * a) * lp).alias(f"e{k}"), F.max(F.exp(lp * (a - 1.0))).alias(f"m{k}")]
    r = shares.agg(*cols).first()
    return [(r[f"z{k}"], math.log(r[f"z{k}"]) - a * r[f"e{k}"] / r[f"z{k}"], r[f"m{k}"] / r[f"z{k}"]) for k, a in enumerate(exponents)]


def _cut(shares: DataFrame, levels: list[float], max_repeat: float) -> list[tuple[float, float]]:
    """For each level: the size of the mix that is cut there, in shares of the table, and its entropy."""
    cols = []
    for k, most in enumerate(levels):
        u = F.least(F.col("p") * F.lit(max_repeat), F.lit(most))
        cols += [F.sum(u).alias(f"u{k}"), F.sum(u * F.log(u)).alias(f"e{k}")]
    r = shares.agg(*cols).first()
    return [(r[f"u{k}"], math.log(r[f"u{k}"]) - r[f"e{k}"] / r[f"u{k}"]) for k in range(len(levels))]


def _least(at, fits, low: float) -> float:
    """The point of [low, 1] from which on ``fits`` holds for what ``at`` gives, by bisection; 1 if it never does."""
    high = 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * k / SECTIONS for k in range(SECTIONS + 1)]
        first = next((k for k, x in enumerate(at(grid)) if fits(x)), SECTIONS)
        if first == 0:
            return grid[0]
        low, high = grid[first - 1], grid[first]
    return high


def exponent(shares: DataFrame, target_entropy: float, repeat: float, max_repeat: float) -> float:
    """The exponent for sources with shares ``p`` above 0.

    target_entropy: the part of the largest possible entropy that the weights may have at most; a mix
    that is naturally above it stays. repeat: budget over tokens.
    """
    most = target_entropy * math.log(max(1, shares.count()))
    a = _least(lambda grid: _at(shares, grid), lambda x: x[1] <= most + 1e-12, 0.0)
    return _least(lambda grid: _at(shares, grid), lambda x: x[2] * repeat <= max_repeat + 1e-9, a)


def level(shares: DataFrame, target_entropy: float, max_repeat: float) -> float:
    """The level, as a share of the table, of the largest mix whose entropy meets the target."""
    top, bottom = shares.agg(F.max("p"), F.min("p")).first()
    down = math.log(bottom / top)   # from the largest source (nothing is cut) to the smallest (all alike)

    def height(x: float) -> float:
        return top * max_repeat * math.exp(down * x)

    def cut(grid: list[float]) -> list[tuple[float, float]]:
        return _cut(shares, [height(x) for x in grid], max_repeat)

    small = _least(cut, lambda x: x[0] <= LEAST_SIZE * max_repeat, 0.0)
    least = target_entropy * cut([small])[0][1]
    return height(_least(cut, lambda x: x[1] >= least - 1e-12, 0.0))


def mix(docs: DataFrame, row: str, target_entropy: float = 0.95, max_repeat: float = 2.0, budget: float | None = 1.0,
        block_tokens: int = 1 << 16, id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 11) -> DataFrame:
    """(row, id, source, n_tokens, exponent, weight, block_rank, position, copies), a row per document.

    ``budget``: tokens of the mix over tokens of the table; None for as many as ``max_repeat`` and the
    entropy allow: the exponent is then 1 if the natural mix stands, or else 0, as sources are cut at a level.
    ``row`` is a column of distinct longs. Sorting by (block_rank, position) gives a source's permutation.
    """
    rows = docs.select(F.col(row).alias("r"), F.col(id).alias("id"), F.coalesce(F.col(source).cast("string"), F.lit(NULL_SOURCE)).alias("s"),
                       F.regexp_count(blank_if_null(F.col(text)), F.lit(r"[^\s]+")).cast("long").alias("n"))
    rows = stage(rows, "mix-rows")
    sums = stage(rows.groupBy("s").agg(F.sum("n").alias("tokens")), "mix-sources")
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    shares = sums.where("tokens > 0").select("s", "tokens", (F.col("tokens") / F.lit(float(max(total, 1)))).alias("p"))
    if budget or not total:
        a = exponent(shares, target_entropy, budget, max_repeat) if total else 1.0
        norm = _at(shares, [a])[0][0] if total else 1.0
        share_of_total = min(budget or 0.0, max_repeat)
        weighted = shares.withColumn("w", F.exp(F.log("p") * a) / norm)
    else:
        most = level(shares, target_entropy, max_repeat)
        share_of_total = _cut(shares, [most], max_repeat)[0][0]
        a = 1.0 if shares.where(F.col("p") * F.lit(max_repeat) > F.lit(most)).isEmpty() else 0.0
        weighted = shares.withColumn("w", F.least(F.col("p") * F.lit(max_repeat), F.lit(most)) / F.lit(share_of_total))
    # times the source is used: whole epochs, and tokens of the epoch begun
    weighted = weighted.withColumn("want", F.col("w") * F.lit(share_of_total * total)).withColumn("epochs", F.floor((F.col("want") + 0.5) / F.col("tokens")))
    weighted = weighted.withColumn("rest", F.greatest(F.lit(0.0), F.col("want") - F.col("epochs") * F.col("tokens")))
    weighted = sums.select("s").join(weighted, "s", "left").withColumn(
        "blocks", F.least(F.lit(MOST_BLOCKS), F.greatest(F.lit(1), F.ceil(F.coalesce("tokens", F.lit(0)) / F.lit(block_tokens)))).cast("int"))

    key = F.xxhash64(F.lit(seed), F.col("id"))
    # a hot source meets its number of blocks in SALTS tasks, and its documents the rest by block
    salted = weighted.select("s", "blocks", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("r"), F.lit(SALTS)).cast("int")).join(salted, ["s", "salt"])
    dealt = dealt.select("r", "id", "s", "n", key.alias("h"), F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.col("blocks")).alias("b"))
    sizes = dealt.groupBy("s", "b").agg(F.sum("n").alias("size"))
    order = Window.partitionBy("s").orderBy(F.xxhash64(F.lit(seed + 2), "s", "b"), "b")
    begun = sizes.select("s", "b", F.row_number().over(order).alias("block_rank"), (F.sum("size").over(order) - F.col("size")).alias("before"))
    begun = begun.join(weighted.select("s", "w", "epochs", "rest"), "s")
    inside = Window.partitionBy("s", "b").orderBy("h", "id", "r")
    out = dealt.select("*", F.row_number().over(inside).alias("position"), F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
    out = out.join(begun, ["s", "b"])
    more = (F.col("before") + F.col("upto") <= F.col("rest") + 0.5) & (F.col("rest") >= 0.5)
    copies = F.coalesce(F.col("epochs") + more.cast("long"), F.lit(0)).cast("long")
    return out.select(F.col("r").alias(row), F.col("id").alias(id), F.when(F.col("s") != NULL_SOURCE, F.col("s")).alias(source), F.col("n").alias("n_tokens"),
                      F.lit(a).alias("exponent"), F.coalesce("w", F.lit(0.0)).alias("weight"), "block_rank", "position", copies.alias("copies"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_row_id(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mix(docs, "rid").drop("rid")
