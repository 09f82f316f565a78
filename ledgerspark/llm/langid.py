"""Language identification by rank-order n-gram profiles (operator 1).

A text becomes runs of letters, lower-cased, with one separator between runs; its n-grams are 1 to 3
letters long and may hold a separator at either end only. A profile is the ``top`` most frequent
n-grams in order of frequency (ties: by code). A document's out-of-place distance to a language sums,
over its profile, how far each n-gram's rank lies from its rank in the language's profile, and ``top``
for one that the language lacks. The nearest language wins (ties: the name that sorts first).

Training counts every n-gram of every training text: workers combine counts per language, Spark sums
them, and at most ``top`` candidates per language and bucket reach the driver, where the profiles
(languages x top entries) are put together and sent to the executors. Scoring is one pass, no shuffle.

A null text or one without letters is ``und`` with score 0, as is any text if nothing was learned.
Rows map one to one; whole texts are read; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_mod, read_table

TOP = 300
BUCKETS = 16
UNKNOWN = "und"
SEGMENT = 1 << 20    # characters of a text, or counts of a language, that are in memory at once
BLANK = re.compile(r"\s")


def letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def gram_codes(text: str, letters: np.ndarray) -> np.ndarray:
    """The n-grams of a text as numbers: 21 bits a character, 1 for a separator, code point + 1 else."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters[points]
    if not is_letter.any():
        return np.empty(0, np.uint64)
    seq = np.where(is_letter, points.astype(np.uint64) + np.uint64(1), np.uint64(1))
    seq = np.concatenate([[np.uint64(1)], seq, [np.uint64(1)]])
    sep = seq == 1
    keep = np.ones(len(seq), bool)
    keep[1:] = ~(sep[1:] & sep[:-1])      # one separator between runs
    seq, sep = seq[keep], sep[keep]
    two = (seq[:-1] << np.uint64(21)) | seq[1:]
    three = (two[:-1] << np.uint64(21)) | seq[2:]
    return np.concatenate([seq[~sep], two, three[~sep[1:-1]]])


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """A long text in parts cut at white space: their n-grams are together those of the text."""
    start = 0
    while len(text) - start > size:
        cut = BLANK.search(text, start + size)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order and how often each occurs."""
    codes = np.sort(codes)
    at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, int)
    return codes[at], np.diff(np.append(at, len(codes)))


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sum of several counts."""
    if len(parts) == 1:
        return parts[0]
    codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(place, weights=np.concatenate([n for _, n in parts]), minlength=len(codes)).astype(np.int64)


def text_counts(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return merged([counted(gram_codes(part, letters)) for part in segments(text)])


def profile(codes: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent codes, the most frequent first."""
    if len(codes) > top:   # only those that can be among the first
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.argsort(-counts, kind="stable")][:top]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> dict[str, np.ndarray]:
    """Profiles of all non-null languages of ``docs``, from all their texts."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            held: dict[str, list] = {}
            size: dict[str, int] = {}
            for name, body in zip(batch.column("lang").to_pylist(), batch.column("text")):
                new = text_counts(body.as_py(), letters)
                held.setdefault(name, []).append(new)
                size[name] = size.get(name, 0) + len(new[0])
                if size[name] > SEGMENT:     # a bounded number of counts waits
                    held[name] = [merged(held[name])]
                    size[name] = 0
            for name, parts in held.items():
                grams, n = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams.view(np.int64)),
                                                  pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    sums = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # buckets only spread the work: each gives its first `top`, so no candidate is lost
    order = Window.partitionBy("lang", "bucket").orderBy(F.desc("n"), "gram")
    first = sums.withColumn("bucket", F.pmod(F.hash("gram"), F.lit(BUCKETS))).withColumn("r", F.row_number().over(order)).where(F.col("r") <= top)
    found: dict[str, list] = {}
    for r in first.select("lang", "gram", "n").collect():   # languages x BUCKETS x top rows at most
        found.setdefault(r.lang, []).append((-r.n, r.gram))
    return {name: np.array([g for _, g in sorted(rows)[:top]], dtype=np.int64).view(np.uint64) for name, rows in sorted(found.items())}


class Ranker:
    """Distances of documents to the profiles."""

    def __init__(self, profiles: dict[str, np.ndarray], top: int):
        self.names, self.top = list(profiles), top
        self.grams = np.unique(np.concatenate([np.empty(0, np.uint64), *profiles.values()]))
        # rank of each known gram (last row: an unknown one) in each language; 2 * top stands for none
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), 2 * top, dtype=np.int64)
        for j, p in enumerate(profiles.values()):
            self.ranks[np.searchsorted(self.grams, p), j] = np.arange(len(p))

    def best(self, codes: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        if not len(codes) or not self.names:
            return UNKNOWN, 0.0
        own = profile(codes, counts, self.top)
        at = np.searchsorted(self.grams, own)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != own)] = len(self.grams)
        gap = np.minimum(np.abs(self.ranks[at] - np.arange(len(own))[:, None]), self.top)
        gap[self.ranks[at] == 2 * self.top] = self.top
        total = gap.sum(axis=0)
        j = int(np.argmin(total))
        return self.names[j], 1.0 - float(total[j]) / (len(own) * self.top)


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text", top: int = TOP) -> DataFrame:
    """Replace ``text``, and columns of these names, by lang_pred and score (1: every n-gram in its place)."""
    rest = [c for c in docs.columns if c != text and c.lower() not in ("lang_pred", "score")]
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(profiles)   # languages x top numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, ranker = letter_table(), Ranker(shared.value, top)
        for batch in batches:
            out = [ranker.best(*text_counts(t.as_py() or "", letters)) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array([x for x, _ in out], pa.string()),
                                              pa.array([y for _, y in out], pa.float64())], names=[*rest, "lang_pred", "score"])

    return docs.select(*rest, text).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    profiles = learn(docs.where(~held_out))
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), profiles)
