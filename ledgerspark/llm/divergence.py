"""How far apart the sources of a language stand in their words (operator 13).

Tasks fold whole documents into stripes, in the mapper: hash tables from a term to the number of documents
that hold it and, source by source, to its occurrences. Tables that reach ``CELLS`` entries are spilled:
their cells are emitted and folding starts anew. So a term of every document is as few rows as there are
tasks, spills and sources, however many documents hold it. Cells meet by term and are added up to one
stripe each. A language keeps the terms of at least ``least`` of its documents.

A kept term's share of a group's words is smoothed and held in whole billionths:
p = 1 + floor(10^9 (count + 5) / (N + 5 V)), for N occurrences of the V kept terms in the group. All
arithmetic is exact (up to 9 * 10^15 words a group). Merged stripes give the divergences directly:

* pairs of sources: the sum over kept terms of the difference of their p. Kept stripes are dealt in cells
  of ``TERMS`` terms and two blocks of ``SOURCES`` sources; a cell sums up its pairs, sums are added.
* terms of a source: those more frequent in it than in its language, by difference, the first ``top``.

Terms are runs of letters, ASCII ones in lower case, and of all characters beyond ASCII. Null text,
language and source count as ''. A group without a kept term, or a language without any, keeps its rows of pairs.
Texts of any length are folded piece by piece. Ties are in the order of the items' UTF-8 bytes. Repeated rows are documents
of their own. Other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blank_if_null, read_table, stage

CELLS = 1_000_000      # entries of a task's tables before they spill
PIECE = 1 << 20        # bytes of a text that are words at once
DEALT, SOURCES = 250_000, 256
SMOOTH, UNIT = 5, 1_000_000_000

CELL = "lang string, term string, source string, n long"   # without a source: n documents

#: Letters in lower case; ASCII that is no letter becomes a space; bytes beyond ASCII stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of a bounded size."""
    data = text.encode().translate(FOLD)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def fold(docs: DataFrame) -> DataFrame:
    """(lang, source, text) -> cells of stripes, several of a term: some for each task and spill that saw it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the stripes of a language lie side by side: documents of each term (source None), occurrences by source
        tables: dict[tuple[str, str | None], Counter] = {}
        cells = 0

        def emit() -> Iterator[pa.RecordBatch]:
            for (lang, source), table in tables.items():
                terms = pa.array(list(table), pa.binary()).cast(pa.string())
                n = pa.array(np.fromiter(table.values(), np.int64, len(table)))
                whole = pa.RecordBatch.from_arrays([pa.array([lang] * len(terms), pa.string()), terms, pa.array([source] * len(terms), pa.string()), n],
                                                   names=["lang", "term", "source", "n"])
                for at in range(0, len(terms), 50_000):
                    yield whole.slice(at, 50_000)

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                spread, counts = (tables.setdefault(k, Counter()) for k in ((lang, None), (lang, source)))
                cells -= len(spread) + len(counts)
                held: set[bytes] = set()
                for some in words(text.as_py()):
                    counts.update(some)
                    held.update(some)
                spread.update(held)
                cells += len(spread) + len(counts)
                if cells >= CELLS:
                    yield from emit()
                    tables.clear()
                    cells = 0
        yield from emit()

    return docs.mapInArrow(run, CELL)


def merge(cells: DataFrame, least: int) -> DataFrame:
    """(lang, term, df, sources, counts): one stripe of each term of ``least`` documents or more.

    One shuffle, by term: cells are added up there, then gathered; a stripe has an entry a source.
    """
    sums = cells.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    cell = F.when(F.col("source").isNotNull(), F.struct("source", "n"))
    stripes = sums.groupBy("lang", "term").agg(F.max(F.when(F.col("source").isNull(), F.col("n"))).alias("df"), F.collect_list(cell).alias("cells"))
    return stripes.where(F.col("df") >= least).select("lang", "term", "df", F.col("cells.source").alias("sources"), F.col("cells.n").alias("counts"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a term with so many occurrences among so many of the kept terms."""
    over = (F.lit(UNIT).cast("decimal(10,0)") * (count + SMOOTH).cast("decimal(20,0)"))
    return F.call_function("div", over, (total + kept * SMOOTH).cast("decimal(20,0)")) + 1


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same for a matrix of counts and smoothed totals by column: long division, three digits at a time."""
    rest = counts + SMOOTH
    out, rest = rest // total, rest % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each two sources of a language, both ways."""
    blocks = F.ceil(F.col("size") / SOURCES).cast("int")
    salts = F.greatest(F.lit(1), F.ceil(F.col("v") * F.col("size") / DEALT)).cast("int")
    sides = groups.withColumn("b", F.floor((F.col("idx") - 1) / SOURCES).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    sides = sides.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    sides = sides.select("lang", F.least("b", "other").alias("bi"), F.greatest("b", "other").alias("bj"), "salt",
                         "b", "source", (F.col("total") + F.col("v") * SMOOTH).alias("total"))
    plan = groups.groupBy("lang").agg(F.first(blocks).alias("blocks"), F.first(salts).alias("salts"))
    dealt = kept.join(plan, "lang").withColumn("bi", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("bj", F.explode(F.sequence("bi", F.col("blocks") - 1)))
    dealt = dealt.select("lang", "bi", "bj", F.pmod(F.xxhash64("term"), "salts").cast("int").alias("salt"), "sources", "counts")

    def cell(stripes: pa.Table, sides: pa.Table) -> pa.Table:
        sides = sides.combine_chunks()
        block, names, total = (np.asarray(sides["b"]), sides["source"].combine_chunks(), np.asarray(sides["total"]))
        first = np.flatnonzero(block == block.min())
        second = np.flatnonzero(block == block.max())
        sums = np.zeros((len(first), len(second)), np.int64)
        step = max(1, 2_000_000 // max(1, len(total)))
        for at in range(0, stripes.num_rows, step):
            some = stripes.slice(at, step).combine_chunks()
            lists, n = some["sources"].combine_chunks(), some["counts"].combine_chunks().flatten()
            where = pc.index_in(lists.flatten(), value_set=names)   # null: a source of another block
            row = np.repeat(np.arange(some.num_rows), np.asarray(pc.list_value_length(lists)))
            here = np.asarray(where.is_valid())
            counts = np.zeros((some.num_rows, len(total)), np.int64)
            counts[row[here], np.asarray(where.drop_null())] = np.asarray(n)[here]
            p = shares(counts, total)
            right = np.ascontiguousarray(p[:, second])
            for k, i in enumerate(first):
                sums[k] += np.abs(right - p[:, i:i + 1]).sum(0)
        a, b = np.repeat(first, len(second)), np.tile(second, len(first))
        value, unlike = sums.ravel(), a != b
        a, b, value = a[unlike], b[unlike], value[unlike]
        if block.min() != block.max():   # the other way round too
            a, b, value = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([value, value])
        lang = pa.array([sides["lang"][0].as_py()] * len(a), pa.string())
        return pa.table([lang, names.take(pa.array(a)), names.take(pa.array(b)), pa.array(value)], names=["lang", "source", "item", "value"])

    keys = ("lang", "bi", "bj", "salt")
    parts = dealt.groupBy(*keys).cogroup(sides.groupBy(*keys)).applyInArrow(cell, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = 30, top: int = 50, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): both parts, in the form of the query."""
    docs = docs.select(blank_if_null(F.col(lang)).alias("lang"), blank_if_null(F.col(source)).alias("source"), blank_if_null(F.col(text)).alias("text"))
    kept = stage(merge(fold(docs), least), "divergence-stripes")
    cells = kept.select("lang", "term", F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c).alias("all"),
                        F.explode(F.arrays_zip("sources", "counts")).alias("e")).select("lang", "term", "all", F.col("e.sources").alias("source"), F.col("e.counts").alias("count"))
    totals = cells.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    here = Window.partitionBy("lang")
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.fillna(0, ["total", "v"]).withColumn("whole", F.sum("total").over(here)).withColumn("size", F.count("*").over(here))
    groups = stage(groups.withColumn("idx", F.row_number().over(here.orderBy("source"))), "divergence-groups")

    pairs = pair_sums(kept, groups).withColumn("part", F.lit("pair"))
    p, q = share(F.col("count"), F.col("total"), F.col("v")), share(F.col("all"), F.col("whole"), F.col("v"))
    terms = cells.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).where("value > 0").withColumn("part", F.lit("term"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order).alias("rank")
    cols = ("lang", "source", "part", "item", "value")
    return pairs.select(*cols, rank).unionByName(terms.select(*cols, rank).where(F.col("rank") <= top))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents").select("lang", "source", "text"))


def _share(count: str, total: str) -> str:
    return f"CAST(1 + (1000000000::HUGEINT * ({count} + 5)) // ({total} + 5 * v) AS BIGINT)"


SQL = f"""WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS rid,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
occ AS (SELECT lang, source, rid, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
langs AS (SELECT lang, sum(n) AS whole, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM occ JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(t.total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(c) AS total FROM counts GROUP BY ALL) t USING (lang, source)),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, {_share("coalesce(c.c, 0)", "g.total")} AS p, {_share("k.n", "l.whole")} AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
both_parts AS (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM both_parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50"""
