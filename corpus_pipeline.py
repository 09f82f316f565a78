"""Documents to training tokens: quality, near copies, secrets, source mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet in the shared
folder and read again as the next stage's documents. All stages but the last return the columns of
their input, extra ones included; the last one returns the token ids of each document that is left.
Stages that join decisions back to rows number the rows first and stage them, so repeated rows, repeated
or null ids and lost executors do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import bpe, mixing, quality, secrets, simhash
from ledgerspark.llm.common import fresh, read_table, stage, with_row_id


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows staged with a number each, in a column of a name that none has."""
    row = fresh(docs.columns, "_row")
    return stage(with_row_id(docs, row), "keyed"), row


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score under 0.3) go."""
    model = quality.fit_tables(spark, docs, sf_dir)
    mark = fresh(docs.columns, "_score")
    return quality.score(docs, model, out=mark).where(F.col(mark) >= 0.3).drop(mark)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints linked at 4 bits or fewer stays: the smallest id."""
    rows, row = keyed(docs)
    first = simhash.near_classes(rows, row=row).where("is_first").select(F.col("rid").alias(row))
    return rows.join(first, row, "left_semi").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts, except examples that many sources copy; every document stays."""
    rows, row = keyed(docs)
    out = secrets.redact(rows, owner="source", repo="doc_id", row=row)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weighted by temperature to 95 % of the greatest entropy, as many tokens as came in and two uses of a source at most.

    The exponent is bisected as in op 9; where a small source would be used more than twice, it is raised (towards the natural mix)
    instead of making the corpus smaller. A natural mix that is already that even stays as it is, each document once.
    """
    rows, row = keyed(docs)
    times, copy = fresh(docs.columns, "_times"), fresh(docs.columns, "_copy")
    mixed = mixing.mix(rows, row, target_entropy=0.95, max_repeat=2.0, budget=1.0).where("copies > 0").select(row, F.col("copies").cast("int").alias(times))
    return rows.join(mixed, row).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and their count."""
    ranks, pattern = bpe.vocabulary()
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, pattern, out="ids")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality", quality_filter), ("near_dedup", near_dedup), ("secrets", secret_scan), ("mix", source_mix), ("bpe", encode)]

#: The classifier, the XXH64 fingerprints and BPE can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
