"""Quality by nearest-neighbour voting in a latent-semantic space (operator 3).

Terms describe how a text is written and what it says. How: every run of lower case, capitals, digits or
white space counts as one symbol, each punctuation mark as itself; terms are the runs of 1 to 3 symbols
(hashed), and, for words, whether each repeats the word before it or any earlier one. What: the words
(hashed), and the pairs of neighbouring non-ASCII characters, for scripts without spaces. Weights are the
square root of a term's share times its inverse document frequency among the labelled sample; what a text
says counts ``SAYS`` times as much as how.

Fitting takes at most ``most_labels`` labelled rows (in the order of a hash of their id, so the same
rows at any partitioning). Their sparse vectors, bounded by that number, go to the driver, where a
randomised SVD gives the latent space. The projection and the labelled latent vectors are broadcast
(``most_labels`` x ``rank`` floats). Scoring is one pass without a shuffle: each block of documents is
multiplied with all labelled vectors (exact cosines), and the ``k`` nearest vote with weights that fall
with their distance from the nearest.

Null counts as empty. A text without terms has no direction: it gets the mean label of labelled texts
without terms, or else of all labelled rows; with no labels at all every score is 0.5. Of repeated
labels of one id the smallest counts, null labels don't. Whole texts are read, rows map one to one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_mod, read_table

DIMS = 2048          # hashed terms of how a text is written; the last four hold the repeats of words
WORDS = 2048         # hashed words and characters, behind them
SAYS = 0.5
MOST_LABELS = 6000   # the bound of the labelled sample
RANK = 32
NEIGHBOURS = 25


def _symbols() -> np.ndarray:
    """The symbol of each byte; bytes of non-ASCII characters count as lower case."""
    table = np.full(256, 1, np.uint32)
    table[65:91], table[48:58] = 2, 3
    table[[32, 9, 11, 12, 13]], table[10] = 4, 5
    marks = [c for c in range(128) if table[c] == 1 and not 97 <= c < 123]
    table[marks] = np.arange(6, 6 + len(marks))
    return table


SYMBOL = _symbols()


def term_counts(text: str) -> np.ndarray:
    """Counts of the hashed terms of one text."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    out = np.zeros(DIMS + WORDS)
    if not len(raw):
        return out
    sym = SYMBOL[raw]
    keep = np.ones(len(sym), bool)
    keep[1:] = (sym[1:] != sym[:-1]) | (sym[1:] > 5)   # marks repeat, other runs are one symbol
    s = sym[keep]
    two = s[:-1] * np.uint32(211) + s[1:]
    three = two[:-1] * np.uint32(211) + s[2:]
    terms = np.concatenate([s, two + np.uint32(1 << 20), three + np.uint32(1 << 26)])
    terms = (terms * np.uint32(2654435761)) >> np.uint32(7)
    out += np.bincount(terms % np.uint32(DIMS - 4), minlength=DIMS + WORDS)
    # words: polynomial hashes of runs between white space
    white = (sym == 4) | (sym == 5)
    ends = np.flatnonzero(np.append(white, True) & np.insert(~white, 0, False))
    starts = np.flatnonzero(np.append(~white, False) & np.insert(white, 0, True))
    if len(starts):
        sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(MULTIPLIER, len(raw)))])
        # shifted back to the word's start by the inverse power, so that equal words agree
        words = (sums[ends] - sums[starts]) * _powers(INVERSE, len(raw))[starts]
        same = words[1:] == words[:-1]
        first = len(np.unique(words))
        out[DIMS - 4] = same.sum()
        out[DIMS - 3] = len(words) - 1 - same.sum()
        out[DIMS - 2] = len(words) - first
        out[DIMS - 1] = first
        out[DIMS:] += np.bincount(_word_dim(words), minlength=WORDS)
    if raw.max() >= 128:
        points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        both = (points[:-1] >= 128) & (points[1:] >= 128)
        out[DIMS:] += np.bincount(_word_dim((points[:-1] * MULTIPLIER + points[1:])[both]), minlength=WORDS)
    return out


def _word_dim(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(32)) % np.uint64(WORDS)).astype(np.int64)


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, base)]))


def term_shares(text: str | None) -> np.ndarray:
    """Square roots of the shares: those of the symbols' terms, of the words' repeats and of the words."""
    counts = term_counts(text or "")
    marks, repeats, words = counts[:DIMS - 4], counts[DIMS - 4:DIMS], counts[DIMS:]
    shares = [marks / max(1.0, marks.sum()), repeats / max(1.0, repeats.sum()), words * SAYS ** 2 / max(1.0, words.sum())]
    return np.sqrt(np.concatenate(shares)).astype(np.float32)


@dataclass
class Model:
    """What scoring needs: arrays whose size the bounds above limit."""

    weights: np.ndarray   # (DIMS + WORDS) x rank: inverse document frequencies, then the latent directions
    vectors: np.ndarray   # labelled x rank, of length one
    labels: np.ndarray
    prior: float          # mean label of texts without a direction

    def score(self, shares: np.ndarray, k: int) -> np.ndarray:
        """Scores (0 to 1) of a block of rows of term shares."""
        if not len(self.labels):
            return np.full(len(shares), self.prior)
        latent = shares @ self.weights
        norm = np.linalg.norm(latent, axis=1)
        cosine = (latent / np.maximum(norm, 1e-9)[:, None]) @ self.vectors.T
        k = min(k, len(self.labels))
        at = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        near = np.take_along_axis(cosine, at, axis=1).astype(np.float64)
        gap = near.max(axis=1, keepdims=True) - near
        vote = np.exp(-gap / np.maximum(gap.mean(axis=1, keepdims=True), 1e-6))
        score = (vote * self.labels[at]).sum(axis=1) / vote.sum(axis=1)
        return np.where(norm > 1e-9, np.clip(score, 0, 1), self.prior)


def labelled(docs: DataFrame, labels: DataFrame, most: int, id: str, text: str, label: str) -> DataFrame:
    """(id, y, text) of at most ``most`` labelled ids that have a document, in hash order; a row each.

    Of the rows of a repeated id the one whose text has the least hash counts.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull()).groupBy(F.col(id).alias("k")).agg(F.min(F.col(label)).alias("y"))
    rows = docs.select(F.col(id).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # ids without a document go before the bound is drawn, so it counts rows to learn from
    chosen = known.join(rows.select("k").distinct(), "k", "left_semi").orderBy(F.xxhash64("k"), "k").limit(most)
    # at most `most` ids: small enough to send to every task by construction
    rows = rows.join(F.broadcast(chosen), "k")
    # combined before the shuffle: an id that many rows have is no hot key
    return rows.groupBy("k", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.xxhash64(F.lit(1), "text"))).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS, rank: int = RANK, id: str = "doc_id",
        text: str = "text", label: str = "quality", seed: int = 7) -> Model:
    """Learn from labelled rows of ``labels`` whose id is in ``docs``."""

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [term_shares(t.as_py()) for t in batch.column("text")]
            at = [np.flatnonzero(v).astype(np.int32) for v in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("y"), pa.array(at, pa.list_(pa.int32())),
                 pa.array([v[i] for v, i in zip(x, at)], pa.list_(pa.float32()))], names=["k", "y", "at", "v"])

    rows = labelled(docs, labels, most, id, text, label).select(F.col("k").cast("long").alias("k"), F.col("y").cast("int").alias("y"), "text")
    found = rows.mapInArrow(featurise, "k long, y int, at array<int>, v array<float>").toArrow().sort_by([("k", "ascending"), ("y", "ascending")])
    # arrays, not lists of Python numbers: words make rows longer
    return fit_vectors([x.values.to_numpy() for x in found.column("at")], [x.values.to_numpy() for x in found.column("v")],
                       np.array(found.column("y").to_pylist(), dtype=np.float64), rank, seed)


def fit_vectors(at: list, values: list, y: np.ndarray, rank: int, seed: int) -> Model:
    if not len(y):
        return Model(np.zeros((DIMS + WORDS, rank), np.float32), np.zeros((0, rank), np.float32), y, 0.5)
    x = np.zeros((len(y), DIMS + WORDS), np.float32)
    for row, i, v in zip(x, at, values):
        row[i] = v
    idf = np.log1p(len(y) / (1.0 + (x > 0).sum(axis=0))).astype(np.float32)
    x *= idf
    # randomised range finder with power iterations, then an exact SVD of the small rest
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(x @ rng.standard_normal((DIMS + WORDS, rank + 16)).astype(np.float32))[0]
    for _ in range(4):
        basis = np.linalg.qr(x @ (x.T @ basis))[0]
    directions = np.linalg.svd(basis.T @ x, full_matrices=False)[2][:rank]
    latent = x @ directions.T
    norm = np.linalg.norm(latent, axis=1)
    empty = norm <= 1e-9
    prior = float(y[empty].mean() if empty.any() else y.mean())
    return Model((idf[:, None] * directions.T).astype(np.float32), (latent[~empty] / norm[~empty, None]).astype(np.float32), y[~empty], prior)


def score(docs: DataFrame, model: Model, k: int = NEIGHBOURS, text: str = "text", out: str = "score", block: int = 256) -> DataFrame:
    """Add ``out``: how likely label 1 is (0 to 1). All columns of ``docs`` stay but one that is named so."""
    rest = [f for f in docs.schema.fields if f.name.lower() != out.lower()]
    schema = T.StructType([*rest, T.StructField(out, T.DoubleType(), False)])
    # arrays only: a broadcast names the classes it holds, which executors need not have
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.vectors, model.labels, model.prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Model(*shared.value)
        for batch in batches:
            scores = [ready.score(np.stack([term_shares(t.as_py()) for t in batch.column(text).slice(i, block)]), k)
                      for i in range(0, batch.num_rows, block)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                                             names=schema.names)

    return docs.mapInArrow(run, schema)


def fit_tables(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """The query's model: from labels whose crc32(doc_id) mod 5 isn't 0."""
    return fit(docs, read_table(spark, sf_dir, "labels").where(id_mod(F.col("doc_id"), 5) != 0))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, fit_tables(spark, docs, sf_dir))
    return out.select("doc_id", F.coalesce(id_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
