"""Structured Streaming versions of the row-wise audit and the monthly rollup.

* ``audit_stream``: the audit ladder is row-wise, so the batch operator runs
  unchanged on a streaming DataFrame (stateless, append).
* ``monthly_spend_stream``: spend per (area, month) with a watermark on the
  month; a month is emitted once, when the watermark passes it, and state
  for it is dropped (bounded state, append mode).
* ``spc_alert_stream``: every monthly scorecard row that arrives is scored
  against the static per-area baseline (stream-static join, no state).
* ``run_available``: runs a stream over everything available now into a
  parquet table in the shared folder, with its checkpoint there as well: run
  again with the same folders it resumes from the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.rules import money_sum
from ledgerspark.operators.deviation import z_and_breach
from ledgerspark.operators.marts import invoice_audit


def invoice_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None,
                   bytes_per_trigger: int | None = None) -> DataFrame:
    """A file stream of invoice parquet files under `path` (declared schema).

    A micro-batch takes at most so many files, or files of so many bytes in all.
    """
    reader = spark.readStream.schema(schema)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    elif files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def audit_stream(invoices: DataFrame) -> DataFrame:
    """B1 on a stream: the same operator, stateless."""
    return invoice_audit(invoices)


def monthly_spend_stream(invoices: DataFrame, lateness: str | None = "62 days") -> DataFrame:
    """Spend per (area, month) on a stream.

    With `lateness` the month carries a watermark: in append mode a month is
    emitted once, when the watermark passes it, and its state is dropped. With
    ``lateness=None`` run it in complete mode: the state is one row per
    (area, month) and every batch restates the whole (small) table.
    """
    ts = invoices.withColumn("_month_ts", F.col("period").cast("timestamp"))
    if lateness:
        ts = ts.withWatermark("_month_ts", lateness)
    return (ts.groupBy("service_area", "_month_ts")
              .agg(money_sum("billed_amount").alias("telecom_spend"))
              .select("service_area", F.col("_month_ts").cast("date").alias("period"),
                      "telecom_spend"))


def spc_alert_stream(scorecard_rows: DataFrame, baseline: DataFrame, metric: str = "packet_loss",
                     z: float = 3.0) -> DataFrame:
    """Score arriving (area, month) rows against a static baseline (C2 output)."""
    b = baseline.where(F.col("metric") == metric).select(
        "service_area", "baseline_mean", "baseline_std")
    j = scorecard_rows.join(b, "service_area", "inner")
    zc, breach = z_and_breach(F.col(metric), F.lit(metric), z)
    return j.select("service_area", "period", F.col(metric).alias("value"), zc.alias("z"),
                    breach.alias("breach"))


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append",
                  timeout_s: float | None = None) -> DataFrame:
    """Run `stream` over all input available now into parquet at `path`; read it back.

    Append mode uses the parquet file sink. Complete mode overwrites the
    table from each micro-batch (``foreachBatch``); replaying a batch after a
    failure writes the same table again, so the result stays exact. The
    stream may take as long as it needs unless the caller sets `timeout_s`.
    """
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if mode == "append":
        w = w.format("parquet").option("path", path)
    else:
        w = w.foreachBatch(lambda batch, _epoch: batch.write.mode("overwrite").parquet(path))
    q = w.trigger(availableNow=True).start()
    if timeout_s is None:
        q.awaitTermination()
    else:
        q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream into {path} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
