"""Document fingerprints by Order MinHash (operator 4). DataFrame functions only.

A text's k-mers are its runs of two neighbouring words (a text of one word has that word). A word of more
than ``LONG_WORD`` characters, as in scripts without spaces, gives way to its overlapping runs of
``CHARS`` characters, so that an edit changes only the few that hold it. The o-th
occurrence of a k-mer is an element of its own: the pair (k-mer, o) is hashed once. The leading bits of
the hash say which of 32 sketches the element belongs to (one permutation split into bins, in place of
32 permutations of all elements). A sketch keeps its two minimal elements and hashes them as a tuple in
the order in which they stand in the text. So a fingerprint changes when words change, repeat a
different number of times or trade places: it is sensitive to edit distance, not to the word set alone.

The likeness of two fingerprints is the part of the sketches that agree among those filled in either;
two fingerprints without any sketch (no words) have likeness 1. Equal texts have equal fingerprints.

All work on a text happens in array expressions of its row: O(n log n) in its words, no explode. Nulls
are empty texts. Texts may be of any length up to 2^26 words (or characters of long ones) without k-mers
trading places. A column of the input named like the result gives way to it; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blank_if_null, hidden, read_table

SKETCH_BITS = 5
LONG_WORD, CHARS = 32, 6
PLACE = (1 << 26) - 1      # low bits of an element: where it stands
ROWS_PER_RANGE, MOST_RANGES = 1000, 16384


def _hash_bits(x: Column) -> Column:
    return x.bitwiseAND(F.lit(~PLACE))


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit(PLACE))


def _sketch(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - SKETCH_BITS)


def fingerprints(df: DataFrame, text: str = "text", out: str = "codes") -> DataFrame:
    """Add ``out``: array<bigint>, one code per filled sketch (its number in the leading bits)."""
    df, names, rest = hidden(df, out)
    df = df.withColumn("_words", F.regexp_extract_all(blank_if_null(F.col(names[text])), F.lit(r"[^\s]+"), F.lit(0)))

    def runs_of(w: Column) -> Column:   # a look-ahead has no width, so there is a match at every character
        return F.when(F.length(w) <= LONG_WORD, F.array(w)).otherwise(F.regexp_extract_all(w, F.lit(rf"(?=([^\s]{{{CHARS}}}))"), F.lit(1)))

    cut = F.when(F.exists("_words", lambda w: F.length(w) > LONG_WORD), F.flatten(F.transform("_words", runs_of))).otherwise(F.col("_words"))
    df = df.withColumn("_words", cut)
    df = df.withColumn("_w", F.transform("_words", lambda w: F.xxhash64(w))).drop("_words")
    size = F.greatest(F.size("_w") - 1, F.least(F.size("_w"), F.lit(1)))
    df = df.withColumn("_k", F.sort_array(F.transform(F.slice("_w", F.lit(1), size), lambda h, i: _hash_bits(
        F.xxhash64(h, F.coalesce(F.get("_w", i + 1), F.lit(0).cast("long")))).bitwiseOR(_place(i.cast("long")))))).drop("_w")
    # equal k-mers stand together now, in text order: their places in the run number the occurrences
    first = F.filter(F.transform("_k", lambda x, i: F.when(
        (i == 0) | (_hash_bits(F.coalesce(F.get("_k", i - 1), F.lit(0).cast("long"))) != _hash_bits(x)), i)), lambda i: i.isNotNull())
    df = df.withColumn("_first", first)

    def element(x: Column, occurrence: Column) -> Column:
        return _hash_bits(F.xxhash64(_hash_bits(x), occurrence)).bitwiseOR(_place(x))

    runs = F.transform("_first", lambda s, b: F.transform(
        F.slice("_k", s + 1, F.coalesce(F.get("_first", b + 1), F.size("_k")) - s), lambda x, o: element(x, o)))
    plain = F.transform("_k", lambda x: element(x, F.lit(0)))   # the same where nothing repeats
    df = df.withColumn("_e", F.sort_array(F.when(F.size("_first") == F.size("_k"), plain).otherwise(F.flatten(runs)))).drop("_k", "_first")
    # sorted by sketch, then hash: the two minimal elements of each sketch
    df = df.withColumn("_e", F.filter("_e", lambda x, i: (i < 2) | (_sketch(F.get("_e", i - 2)) != _sketch(x))))

    def code(x: Column, i: Column) -> Column:
        other, before = F.get("_e", i + 1), F.get("_e", i - 1)
        ordered = F.when(_place(x) <= _place(other), F.xxhash64(_hash_bits(x), _hash_bits(other))).otherwise(F.xxhash64(_hash_bits(other), _hash_bits(x)))
        both = F.coalesce(_sketch(other) == _sketch(x), F.lit(False))
        tuple_hash = F.when(both, ordered).otherwise(F.xxhash64(_hash_bits(x)))
        kept = F.shiftrightunsigned(F.shiftleft(tuple_hash, SKETCH_BITS), SKETCH_BITS).bitwiseOR(F.shiftleft(_sketch(x), 64 - SKETCH_BITS))
        return F.when((i == 0) | (_sketch(before) != _sketch(x)), kept)

    df = df.withColumn("_codes", F.filter(F.transform("_e", code), lambda c: c.isNotNull()))
    return df.select(*rest, F.col("_codes").alias(out))


def likeness(a: Column, b: Column) -> Column:
    """How alike two fingerprints are, 0 to 1."""
    filled = F.size(F.array_union(F.transform(a, _sketch), F.transform(b, _sketch)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def as_text(codes: Column) -> Column:
    """A fingerprint as hexadecimal codes joined by commas."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.hex(c))), ",")


def _range_of(id: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts lie below the id (-1 for a null id), found in two steps of about the square root."""
    step = max(1, round(len(cuts) ** 0.5))
    below = lambda a: F.size(F.filter(a, lambda c: c < id))
    whole = F.array(*(F.lit(c).cast("long") for c in cuts))
    block = F.greatest(below(F.array(*(F.lit(c).cast("long") for c in cuts[::step]))) - 1, F.lit(0)) * step
    return F.when(id.isNull(), -1).otherwise(block + below(F.slice(whole, block + 1, F.lit(step)))) if cuts else F.when(id.isNull(), -1).otherwise(0)


def edited(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, codes, edited, next_codes): each text with its last half replaced by the start of the next.

    The last floor(n_chars / 2) code points give way to as many first ones of the next text, or all of it.
    The next row is the one with the next smaller id (null ids last, equal ids in the order of their
    texts); after the last comes the first. One row follows itself; no rows give no rows; repeated rows
    follow each other.

    Ranges of ids of about equal size are windows of their own, so texts are shuffled once. The first row
    of every range stands behind the range before it as a guest; only the ranges' largest ids, one each,
    pass through the driver. An id is taken to repeat a bounded number of times.
    """
    rows = docs.select(F.col(id).cast("long").alias("key"), F.col(id).alias("id"), blank_if_null(F.col(text)).alias("t"))
    ranges = max(1, min(MOST_RANGES, rows.count() // ROWS_PER_RANGE))
    at = [k / ranges for k in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("key", at, 50 * MOST_RANGES)).first()[0] if at else []
    rows = rows.withColumn("g", _range_of(F.col("key"), sorted(set(cuts or []))).cast("int"))
    heads = sorted(rows.groupBy("g").agg(F.max("key").alias("key")).collect(), key=lambda r: -r.g)   # at most MOST_RANGES + 1
    ring = [(heads[k - 1].g, r.key) for k, r in enumerate(heads)]   # a range, and the id that its guest has
    guests = docs.sparkSession.createDataFrame(ring, "host int, head long")
    guests = rows.join(F.broadcast(guests), F.col("key").eqNullSafe(F.col("head"))).groupBy("host").agg(F.min("t").alias("t"))
    guests = guests.select(F.lit(None).cast("long").alias("key"), F.lit(None).cast(rows.schema["id"].dataType).alias("id"), "t", F.col("host").alias("g"), F.lit(True).alias("guest"))
    order = Window.partitionBy("g").orderBy("guest", F.col("key").desc_nulls_last(), "t")
    out = rows.withColumn("guest", F.lit(False)).unionByName(guests).withColumn("next", F.lead("t").over(order))
    out = fingerprints(out, "t").withColumn("next_codes", F.lead("codes").over(order)).where(~F.col("guest"))
    n = F.length("t")
    kept = F.expr("substring(t, 1, length(t) - cast(floor(length(t) / 2) as int))")
    return out.select(F.col("id").alias(id), n.cast("long").alias("n_chars"), "codes",
                      F.concat(kept, F.expr("substring(next, 1, cast(floor(length(t) / 2) as int))")).alias("edited"), "next_codes")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = edited(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    both = fingerprints(both.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "edited_codes").drop("edited")
    return both.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("codes")).alias("fingerprint"), as_text(F.col("edited_codes")).alias("edited_fingerprint"),
                       likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"), likeness(F.col("codes"), F.col("next_codes")).alias("near_next"))
