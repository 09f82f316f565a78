"""Removing repeated strings by a distributed sparse suffix array (operator 6).

Every byte covered by a string of ``length`` bytes that starts anywhere else too is removed; strings do
not cross documents and are judged on the input.

Sorting every suffix would move a multiple of the text. Instead each window of ``span`` start positions
gives the suffix at the least hash of the bytes that follow (winnowing): equal strings give the same
suffix at the same offset, so no repeat is missed, at about two suffixes per ``span`` bytes. Suffixes are
records: their leading bytes as a number, a hash of the bytes that all strings near this suffix share
(the core), and a hash of all bytes that these strings cover (the cover). Splitters sampled from the
records range-partition them by (leading bytes, core, cover, salt); each bucket is sorted by multikey
quicksort (ties of one key are sorted by the next) and neighbours are compared, across bucket borders
too. A core that no neighbour shares settles that nothing here repeats. A cover that is shared settles
that all of it repeats. What is left - places near the end of a repeat, and one record of each settled
cover for them to meet - goes to the next level, with the start positions divided by ``FINER``, down to
single strings. Equal records may be cut by splitters
anywhere (the salt), so copies by the thousand spread over buckets; every row is only ever compared
with its neighbours.

Texts are shuffled once, into a table bucketed by row, to which each level joins its few records.

Null is empty. Texts shorter than ``length`` keep everything; texts of any length are read whole. Rows
map one to one, and repeated rows are occurrences of their own. Other columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.session import shared_folder

from .common import blank_if_null, read_table, stage, with_row_id

LENGTH = 400
SPAN = 200                 # start positions that share a suffix at first
FINER = (5, 5, 8)          # each level divides them; together SPAN
PASSAGE, PASSAGE_SPAN = 300, 100   # bytes of about fifty words, and start positions that share a suffix
GRAM = 16                  # bytes hashed to choose suffixes
PART = 1 << 20             # bytes of a text that are winnowed at once
SAMPLE_DOCS, SAMPLE_RECORDS = 2000, 100_000
MIX = np.uint64(0x9E3779B97F4A7C15)
RECORD = "lead long, core long, cover long, salt long, r long, at int"


def winnow(raw: np.ndarray, span: int, gram: int = GRAM) -> np.ndarray:
    """The positions that hold the least hash of some ``span`` neighbouring positions (leftmost of equal ones)."""
    found, last = [], len(raw) - gram - span + 1     # last window
    for begin in range(0, last + 1, PART):
        part = raw[begin:min(begin + PART - 1, last) + span + gram - 1]
        h = (part.astype(np.uint64) + np.uint64(1)) * MIX
        step = 1
        while step < gram:    # hashes of 1, 2, 4 .. gram bytes
            h = h[:-step] * MIX + (h[step:] ^ (h[step:] >> np.uint64(29)))
            step *= 2
        h = (h ^ (h >> np.uint64(31))) * MIX
        low = (h & ~np.uint64(2 * PART - 1)) | np.arange(len(h), dtype=np.uint64)
        have = 1
        while have < span:    # least of 1, 2, 4 .. span positions
            shift = min(have, span - have)
            low = np.minimum(low[:-shift], low[shift:])
            have += shift
        low &= np.uint64(2 * PART - 1)
        found.append(low[np.concatenate([[True], low[1:] != low[:-1]])].astype(np.int64) + begin)
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def describe(raw: np.ndarray, at: np.ndarray, span: int, length: int, r: int) -> list[np.ndarray]:
    """Records of the strings that start at at-span+1 .. at, for each ``at``."""
    from xxhash import xxh3_64_intdigest as digest

    data, n = raw.tobytes(), len(raw)
    shared = length - span + 1
    lead = np.zeros(len(at), np.uint64)
    for k in range(min(8, shared)):
        lead = (lead << np.uint64(8)) | raw[at + k].astype(np.uint64)
    core = np.array([digest(data[p:p + shared]) for p in at.tolist()], np.uint64)
    # a cover cut by an end of the text differs from a whole one by the seed and its size
    cover = core if span == 1 else np.array([digest(data[max(0, p - span + 1):p + length], min(p, span - 1)) for p in at.tolist()], np.uint64)
    salt = (at.astype(np.uint64) * MIX + np.uint64(r)) * MIX
    return [lead, core, cover, salt ^ (salt >> np.uint64(32)), np.full(len(at), r, np.int64), at.astype(np.int32)]


def _record_batch(rows: list[list[np.ndarray]]) -> pa.RecordBatch:
    kinds = [np.uint64] * 4 + [np.int64, np.int32]
    cols = [np.concatenate([np.empty(0, k), *(row[i] for row in rows)]) for i, k in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if i < 4 else c) for i, c in enumerate(cols)],
                                      names=["lead", "core", "cover", "salt", "r", "at"])


def _some(rows: Iterator[list[np.ndarray]], size: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Records in batches of bounded size."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += len(row[0])
        if n >= size:
            yield _record_batch(held)
            held, n = [], 0
    yield _record_batch(held)


def _bytes(text: pa.StringScalar) -> np.ndarray:
    return np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid and text.as_buffer().size else np.empty(0, np.uint8)


def suffixes(texts: DataFrame, length: int, span: int) -> DataFrame:
    """The first level's records of texts (r, t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[list[np.ndarray]]:
            for batch in batches:
                for r, t in zip(batch.column("r").to_pylist(), batch.column("t")):
                    raw = _bytes(t)
                    if len(raw) >= length:
                        yield describe(raw, winnow(raw[:len(raw) - length + span + GRAM - 1], span), span, length, r)

        yield from _some(rows())

    return texts.select("r", "t").mapInArrow(run, RECORD)


def finer(texts: DataFrame, left: DataFrame, length: int, span: int, parts: int) -> DataFrame:
    """The next level's records: the start positions of each record of ``left`` (r, at) in ``parts`` parts."""
    each = span // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[list[np.ndarray]]:
            for batch in batches:
                for r, t, ats in zip(batch.column("r").to_pylist(), batch.column("t"), batch.column("ats")):
                    raw = _bytes(t)
                    at = np.unique(np.asarray(ats.values, np.int64)[:, None] - each * np.arange(parts))
                    # some of the strings must lie inside the text
                    yield describe(raw, at[(at >= 0) & (at - each + 1 <= len(raw) - length)], each, length, r)

        yield from _some(rows())

    grouped = left.groupBy("r").agg(F.collect_list("at").alias("ats"))   # positions of one text
    return texts.join(grouped, "r").select("r", "t", "ats").mapInArrow(run, RECORD)


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """The order of rows by several keys: sort by the first, then each run of ties by the next."""
    order = np.argsort(keys[0], kind="stable")
    run = np.cumsum(np.concatenate([[0], keys[0][order][1:] != keys[0][order][:-1]]))
    for key in keys[1:]:
        tied = np.concatenate([[False], run[1:] == run[:-1]])
        tied |= np.append(tied[1:], False)
        if not tied.any():
            break
        place = np.flatnonzero(tied)
        rows = order[place]
        order[place] = rows[np.lexsort((key[rows], run[place]))]
        k = key[order]
        run = np.cumsum(np.concatenate([[0], (run[1:] != run[:-1]) | (k[1:] != k[:-1])]))
    return order


def bucket_of(keys: list[np.ndarray], splitters: list[np.ndarray]) -> np.ndarray:
    """How many splitters (sorted rows of the same keys) are at or below each row."""
    lo, hi = np.searchsorted(splitters[0], keys[0], "left"), np.searchsorted(splitters[0], keys[0], "right")
    out = lo.copy()
    tied = np.flatnonzero(lo < hi)
    if len(tied):
        if len(keys) == 1:
            out[tied] = hi[tied]
        else:
            for first in np.unique(lo[tied]):
                rows = tied[lo[tied] == first]
                last = hi[rows[0]]
                out[rows] = first + bucket_of([k[rows] for k in keys[1:]], [s[first:last] for s in splitters[1:]])
    return out


def sample_splitters(sample: DataFrame, buckets: int) -> list[np.ndarray]:
    """Cuts of the records' order into about equal buckets, from at most SAMPLE_RECORDS records."""
    got = sample.select("lead", "core", "cover", "salt").orderBy(F.xxhash64("salt")).limit(SAMPLE_RECORDS).toArrow()
    keys = [np.asarray(got.column(i).combine_chunks() if got.num_rows else [], np.int64).view(np.uint64) for i in range(4)]
    keys = [k[multikey_order(keys)] for k in keys] if got.num_rows else keys
    at = np.unique(np.arange(1, buckets) * got.num_rows // buckets) if got.num_rows else np.empty(0, int)
    return [k[at] for k in keys]


def shared_records(records: DataFrame, splitters: list[np.ndarray], partitions: int) -> DataFrame:
    """(r, at, shared, whole, down, edge, keys) of records whose core a neighbour has, whole if also the cover; and of bucket borders."""
    cuts = records.sparkSession.sparkContext.broadcast(splitters)   # as many rows as buckets
    out = "r long, at int, shared boolean, whole boolean, down boolean, edge boolean, lead long, core long, cover long"

    def keys_of(cols: list[np.ndarray]) -> list[np.ndarray]:
        return [c.view(np.uint64) for c in cols]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = keys_of([np.asarray(batch.column(i)) for i in range(4)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bucket_of(keys, cuts.value), pa.int32())],
                                             names=[*batch.schema.names, "bucket"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[np.asarray(c) for c in b.columns] for b in batches]
        if not held:
            return
        lead, core, cover, _, r, at, bucket = (np.concatenate(x) for x in zip(*held))
        del held
        order = multikey_order([bucket, *keys_of([lead, core, cover])])
        lead, core, cover, r, at, bucket = (x[order] for x in (lead, core, cover, r, at, bucket))
        new_bucket = bucket[1:] != bucket[:-1]
        same = ~new_bucket & (lead[1:] == lead[:-1]) & (core[1:] == core[:-1])
        both = same & (cover[1:] == cover[:-1])
        has = np.append(same, False) | np.insert(same, 0, False)
        whole = np.append(both, False) | np.insert(both, 0, False)
        edge = np.append(new_bucket, True) | np.insert(new_bucket, 0, True)
        # go down: what isn't settled, and of each settled cover one for the others of its core to meet
        run = np.cumsum(np.insert(~same, 0, False))
        open_run = np.bincount(run, weights=~whole | edge) > 0
        down = ~whole | (np.insert(~both, 0, True) & open_run[run])
        for i in range(0, len(r), 100_000):
            s = i + np.flatnonzero((has | edge)[i:i + 100_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(r[s]), pa.array(at[s]), pa.array(has[s]), pa.array(whole[s]), pa.array(down[s]), pa.array(edge[s]),   # keys are needed at the borders only
                 *(pa.array(np.where(edge[s], x[s], 0), mask=~edge[s]) for x in (lead, core, cover))],
                names=["r", "at", "shared", "whole", "down", "edge", "lead", "core", "cover"])

    typed = records.mapInArrow(assign, RECORD + ", bucket int").repartition(partitions, "bucket")
    return stage(typed.mapInArrow(compare, out), "suffix-shared")


def settle(found: DataFrame) -> DataFrame:
    """Join the borders: the first and last record of each bucket, two rows per bucket, are compared by key."""
    edges = found.where("edge")
    same = edges.groupBy("lead", "core").agg(F.count("*").alias("n")).where("n > 1").select("lead", "core", F.lit(True).alias("met"))
    both = edges.groupBy("lead", "core", "cover").agg(F.count("*").alias("m")).where("m > 1").select("lead", "core", "cover", F.lit(True).alias("again"))
    kept = edges.join(same, ["lead", "core"], "left").join(both, ["lead", "core", "cover"], "left")
    return kept.where(F.col("shared") | F.col("met")).select("r", "at", (F.col("whole") | F.coalesce("again", F.lit(False))).alias("whole"), F.lit(True).alias("down"))


def bucketed(rows: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """A table in the shared folder, bucketed by ``key``: joins on it need not move it again."""
    spark = rows.sparkSession
    table = f"llm_{name}_{uuid.uuid4().hex}"
    (rows.repartition(buckets, key).write.bucketBy(buckets, key).option("compression", "zstd")
     .option("path", f"{shared_folder(spark)}/{table}").saveAsTable(table))
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")   # its entry in the catalogue only: the files are read from their folder
    return out


def covered(texts: DataFrame, length: int = LENGTH, span: int = SPAN, finer_by: tuple[int, ...] = FINER) -> DataFrame:
    """(r, start, stop) of byte ranges of texts (r, t) that repeat; they may overlap."""
    spark = texts.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = texts.count()
    records, ranges = suffixes(texts, length, span), []
    sample = suffixes(texts.where(F.pmod(F.xxhash64("r"), F.lit(max(1, n // SAMPLE_DOCS))) == 0), length, span)
    for parts in (*finer_by, 0):
        found = shared_records(records, sample_splitters(sample, 4 * partitions), partitions)
        found = found.where("not edge").select("r", "at", "whole", "down").unionByName(settle(found))
        whole = found.where("whole") if span > 1 else found
        ranges.append(whole.select("r", F.greatest(F.col("at") - span + 1, F.lit(0)).alias("start"), (F.col("at") + length).alias("stop")))
        if parts:
            left = found.where("down").select("r", "at")
            records = finer(texts, left, length, span, parts)
            sample = finer(texts, left.where(F.pmod(F.xxhash64("r"), F.lit(max(1, n // SAMPLE_DOCS))) == 0), length, span, parts)
            span //= parts
    out = ranges[0]
    for more in ranges[1:]:
        out = out.unionByName(more)
    return out


def passages(texts: DataFrame, length: int = PASSAGE, span: int = PASSAGE_SPAN) -> DataFrame:
    """(r), each once: texts (r, t) with a passage that stands elsewhere too.

    The operator's first level alone: suffixes chosen among ``span`` neighbours, equal in the
    ``length - span + 1`` bytes that follow. Every repeated string of ``length`` bytes is found, none
    shorter than those bytes.
    """
    partitions, n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), texts.count()
    sample = suffixes(texts.where(F.pmod(F.xxhash64("r"), F.lit(max(1, n // SAMPLE_DOCS))) == 0), length, span)
    found = shared_records(suffixes(texts, length, span), sample_splitters(sample, 4 * partitions), partitions)
    return found.where("shared and not edge").select("r").unionByName(settle(found).select("r")).distinct()


def keep_masks(starts: np.ndarray, stops: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """Which bytes stay, and how many maximal runs go."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(starts, n), 1)
    np.add.at(edge, np.minimum(stops, n), -1)
    gone = np.cumsum(edge[:n]) > 0
    return ~gone, int((gone[1:] & ~gone[:-1]).sum() + (gone[:1].sum() if n else 0))


def dedup(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), length: int = LENGTH, passage: bool = False) -> DataFrame:
    """Carried columns, n_bytes, n_removed, n_spans and ``kept`` (binary: the bytes that stay) for every row.

    With ``passage`` also ``repeats``: whether the row holds a passage of about fifty words, too short to be
    removed maybe, that stands elsewhere too (``passages``).
    """
    spark = docs.sparkSession
    keyed = with_row_id(docs.select(*carry, blank_if_null(F.col(text)).alias("t")), "r")
    texts = bucketed(keyed, "r", int(spark.conf.get("spark.sql.shuffle.partitions")), "texts")
    ranges = covered(texts.select("r", "t"), length).groupBy("r").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    rows = texts.join(ranges, "r", "left")
    if passage:
        rows = rows.join(passages(texts.select("r", "t")).withColumn("repeats", F.lit(True)), "r", "left").withColumn("repeats", F.coalesce("repeats", F.lit(False)))
    extra = ("repeats",) if passage else ()
    schema = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in carry) + ", n_bytes long, n_removed long, n_spans long, kept binary" + (", repeats boolean" if passage else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, spans, kept = [], [], [], []
            for t, a, b in zip(batch.column("t"), batch.column("starts"), batch.column("stops")):
                raw = _bytes(t)
                if a.is_valid:
                    stay, runs = keep_masks(np.asarray(a.values, np.int64), np.asarray(b.values, np.int64), len(raw))
                    left = raw[stay].tobytes()
                else:
                    left, runs = raw.tobytes(), 0
                n.append(len(raw))
                removed.append(len(raw) - len(left))
                spans.append(runs)
                kept.append(left)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(spans, pa.int64()), pa.array(kept, pa.binary()), *(batch.column(c) for c in extra)],
                                             names=[*carry, "n_bytes", "n_removed", "n_spans", "kept", *extra])

    return rows.select(*carry, "t", "starts", "stops", *extra).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"), passage=True)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
                      F.octet_length("kept").cast("long").alias("n_kept"), "repeats")
