"""Merkle manifest of a data set: a digest a row, inclusion proofs, and their check (operator 11).

A row's leaf is the sha256 of its fields, each length-prefixed. The leaves of a group (a language),
in the order of their ids, are the bottom of a binary tree; the groups' roots, in the order of the
groups, are the bottom of one more tree, and its root stands for the data set.

Leaves get their place by one range partitioning: rows are sorted inside a range, and a range's start
in its group is a sum over the ranges before it, so a group may hold any share of the rows. ``BLOCK``
consecutive leaves are one row then, which keeps each level of its subtree as one string of hex digests.
A level's parents are the hashes of its substrings of two digests' width, and a leaf's siblings are the
substrings that flank it and its ancestors. The blocks' roots are the leaves of the next tier, until
each group has one node. Paths come down the other way: a block's path is joined to its row, so joins
move blocks, never leaves.

An id that repeats stands in the order of its leaves; null ids and the null group come first. Null
fields count as ``-``, the empty text as ``0:``. Rows map one to one, repeated rows too. Columns that
are not named are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import few_files, id_mod, read_table, stage

BITS = 8
BLOCK = 1 << BITS          # nodes in a block
WIDTH = 64                 # hex digits of a digest
ROWS_PER_RANGE = 250_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(col: Column) -> Column:
    return F.sha2(col, 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    """The digest of a row: its fields one after another, each with its length in bytes."""
    parts = []
    for c in fields:
        s = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return sha(F.concat(*parts))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda acc, e: sha(F.when(e["right"], F.concat(e["digest"], acc)).otherwise(F.concat(acc, e["digest"]))))


def proof(path: Column) -> Column:
    """One digest of all siblings on a path."""
    return sha(F.array_join(F.transform(path, lambda e: e["digest"]), ""))


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Staged rows (g, ...) with their place ``pos`` in their group, from 0, and the group's size ``n``."""
    # rows that agree in all of the order may part anywhere, so their own number ends it
    rows = stage(rows.withColumn("rid", F.monotonically_increasing_id()), "merkle-leaves")
    by = ["g", *order, "rid"]
    parts = max(1, -(-rows.count() // ROWS_PER_RANGE))
    rows = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("rid")
    rows = stage(rows.withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("at", 33)
    runs = rows.groupBy("g", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("size"))
    group = Window.partitionBy("g")
    before = F.sum("size").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("g", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("size").over(group).alias("n"))
    return rows.withColumn("part", part).join(runs, ["g", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _levels(bottom: Column, height: Column) -> Column:
    """The strings of a block's levels, from the bottom up."""

    def parents(level: Column) -> Column:
        pairs = F.sequence(F.lit(0), ((F.length(level) - 1) / (2 * WIDTH)).cast("int"))
        return F.array_join(F.transform(pairs, lambda i: sha(F.substring(level, i * (2 * WIDTH) + 1, F.lit(2 * WIDTH)))), "")

    steps = F.slice(F.sequence(F.lit(1), F.lit(BITS)), F.lit(1), height)
    return F.aggregate(steps, F.array(bottom), lambda acc, _: F.concat(acc, F.array(parents(F.element_at(acc, -1)))))


def _siblings(levels: Column, height: Column, pos: Column) -> Column:
    """A node's path inside its block: at each level the flanking digest, empty for a run of one node."""

    def flank(j: Column) -> Column:
        at = F.call_function("shiftright", F.pmod(pos, F.lit(BLOCK)).cast("int"), j)
        right = F.pmod(at, F.lit(2)) == 1
        beside = F.when(right, at - 1).otherwise(at + 1)
        return F.struct(F.substring(F.element_at(levels, j + 1), beside * WIDTH + 1, F.lit(WIDTH)).alias("digest"), right.alias("right"))

    return F.transform(F.slice(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(1), height), flank)


NO_PATH = "array<struct<digest:string,right:boolean>>"


def climb(nodes: DataFrame, carry: Sequence[str], top) -> DataFrame:
    """Nodes (g, n, pos, digest, carried columns) -> (g, pos, digest, carried columns, path, and what ``top`` adds).

    ``top`` takes one row a group (g, digest: the group's root) and gives (g, path above it, other columns).
    """
    # levels of a block: all of a full block's where the group has more, else as many as the group needs
    height = F.when(F.col("n") > BLOCK, BITS).otherwise(F.ceil(F.log2(F.col("n").cast("double")))).cast("int")
    member = F.struct("pos", "digest", *carry)
    blocks = nodes.groupBy("g", "n", F.shiftright("pos", BITS).alias("block")).agg(F.sort_array(F.collect_list(member)).alias("m"))   # at most BLOCK
    blocks = blocks.withColumn("h", height).withColumn("levels", _levels(F.array_join(F.transform("m", lambda e: e["digest"]), ""), F.col("h")))
    blocks = stage(blocks, "merkle-blocks")
    tops = blocks.select("g", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("pos"), F.element_at("levels", -1).alias("digest"))
    if (tops.agg(F.max("n")).first()[0] or 1) > 1:
        above = climb(tops, [], top).drop("digest")
    else:
        above = top(tops.select("g", "digest")).withColumn("pos", F.lit(0).cast("long"))
    rest = [c for c in above.columns if c not in ("g", "pos", "path")]
    above = above.withColumnRenamed("pos", "block").withColumnRenamed("path", "upper")
    path = lambda e: F.concat(_siblings(F.col("levels"), F.col("h"), e["pos"]), F.col("upper"))
    rows = F.transform("m", lambda e: F.struct(*(e[c].alias(c) for c in ("pos", "digest", *carry)), path(e).alias("path")))
    return blocks.join(above, ["g", "block"]).select("g", F.explode(rows).alias("e"), *rest).select("g", "e.*", *rest)


def tree(leaves: DataFrame, id: str = "doc_id", group: str = "lang", carry: Sequence[str] = ()) -> DataFrame:
    """(id, group, leaf, carried columns) -> those and path, subroot, root: each row's place in the trees.

    ``path`` lists the siblings from the leaf to the root: digest (empty where the node is alone) and
    ``right``, whether the node stands to the right of it.
    """
    names = [f"c{k}" for k in range(len(carry))]
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))   # null before all others
    rows = leaves.select(g.alias("g"), F.col(id).alias("id"), F.col(group).alias("group"), F.col("leaf").alias("digest"),
                         *(F.col(c).alias(n) for c, n in zip(carry, names)))
    empty = F.array().cast(NO_PATH)

    def whole(roots: DataFrame) -> DataFrame:
        return roots.select("g", empty.alias("path"), F.col("digest").alias("root"))

    def groups(roots: DataFrame) -> DataFrame:
        order = numbered(few_files(roots, 1).select(F.lit("").alias("g"), F.col("g").alias("name"), "digest"), ["name"])
        return climb(order, ["name"], whole).select(F.col("name").alias("g"), F.col("digest").alias("subroot"), "root", "path")

    out = climb(numbered(rows, ["id", "digest"]), ["id", "group", *names], groups)
    return out.select(F.col("id").alias(id), F.col("group").alias(group), F.col("digest").alias("leaf"),
                      *(F.col(n).alias(c) for c, n in zip(carry, names)), "path", "subroot", "root")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    original = [F.col(c) for c in FIELDS]
    altered = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    tampered = F.when(id_mod(F.col("doc_id"), 7) == 0, leaf_of(altered))
    leaves = docs.select("doc_id", "lang", leaf_of(original).alias("leaf"), tampered.alias("tampered"))
    rows = tree(leaves, carry=["tampered"])
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
                       fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def _field(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


_LEAF = "sha256(" + " || ".join(map(_field, FIELDS)) + ")"
_ALTERED = "sha256(" + " || ".join(_field("(n_chars + 1)" if c == "n_chars" else c) for c in FIELDS) + ")"
#: Bitwise CRC-32 (reflected polynomial 0xEDB88320) of an id's digits.
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

SQL = f"""WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {_LEAF} AS leaf, CASE WHEN {_CRC} % 7 = 0 THEN {_ALTERED} ELSE {_LEAF} END AS shown FROM documents)),
tree AS (
  SELECT lang, 0 AS lvl, pos, leaf AS d, n FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (max(n) + 1) // 2 FROM tree WHERE n > 1 GROUP BY lang, lvl, pos // 2),
subs AS (
  SELECT lang, d AS subroot, lvl AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
crown AS (
  SELECT 0 AS lvl, pos, subroot AS d, n FROM subs
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (max(n) + 1) // 2 FROM crown WHERE n > 1 GROUP BY lvl, pos // 2),
top AS (SELECT d AS root, lvl AS height FROM crown WHERE n = 1),
steps AS (
  SELECT l.lang, l.pos, t.lvl, ((l.pos >> t.lvl) & 1) = 1 AS is_right, s.d
  FROM leaves l JOIN (SELECT DISTINCT lang, lvl FROM tree WHERE n > 1) t ON l.lang IS NOT DISTINCT FROM t.lang
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM l.lang AND s.lvl = t.lvl AND s.pos = xor(l.pos >> t.lvl, 1)
  UNION ALL
  SELECT l.lang, l.pos, u.height + t.lvl, ((u.pos >> t.lvl) & 1) = 1, s.d
  FROM leaves l JOIN subs u ON l.lang IS NOT DISTINCT FROM u.lang JOIN (SELECT DISTINCT lvl FROM crown WHERE n > 1) t ON true
  LEFT JOIN crown s ON s.lvl = t.lvl AND s.pos = xor(u.pos >> t.lvl, 1)),
proofs AS (SELECT lang, pos, sha256(coalesce(string_agg(d, '' ORDER BY lvl), '')) AS p FROM steps GROUP BY lang, pos),
folded AS (
  SELECT lang, pos, 0 AS lvl, shown AS d FROM leaves
  UNION ALL
  SELECT f.lang, f.pos, f.lvl + 1, sha256(CASE WHEN s.is_right THEN s.d || f.d ELSE f.d || coalesce(s.d, '') END)
  FROM folded f JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.pos = f.pos AND s.lvl = f.lvl)
SELECT l.doc_id, l.leaf, u.subroot, top.root, coalesce(p.p, sha256('')) AS proof_sha256, f.d AS folded_root, f.d = top.root AS verified
FROM leaves l JOIN subs u ON l.lang IS NOT DISTINCT FROM u.lang CROSS JOIN top
LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.pos = l.pos
JOIN folded f ON f.lang IS NOT DISTINCT FROM l.lang AND f.pos = l.pos AND f.lvl = u.height + top.height"""
