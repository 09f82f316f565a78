"""Run every operator once over one data set and write each result as a table.

    python -m ledgerspark.plans.runbook --sf-dir /root/testdata/sf0.1 [--out DIR] [--only k1,k2]

This is the whole reference flow (marts, analysis, bridge, chargeback,
forecast, risk, triage, checks) as one Spark application: the marts are
built once, then every result is written as parquet under ``--out`` (by
default ``<spark.checkpoint.dir>/ledgerspark/results``). The written
results are the outputs, nothing is collected to the driver except the
per-result row counts of the summary line.
"""

from __future__ import annotations

import argparse
import json
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from ledgerspark.plans.marts import marts_for
from ledgerspark.plans.registry import QUERIES
from ledgerspark.session import build_session, shared_folder


def run(spark: SparkSession, sf_dir: str, out: str | None = None,
        only: list[str] | None = None, parallel: int = 4) -> dict[str, dict]:
    """Build the marts once, then write every result; `parallel` results are written as
    concurrent jobs of the session (they are independent once the marts exist)."""
    out = out or f"{shared_folder(spark)}/ledgerspark/results"
    marts_for(spark, sf_dir).all()

    def one(name: str) -> tuple[str, dict]:
        t = time.perf_counter()
        path = f"{out}/{name}"
        QUERIES[name](spark, sf_dir).write.mode("overwrite").parquet(path)
        return name, {"path": path, "sec": round(time.perf_counter() - t, 3)}

    names = [n for n in QUERIES if not only or n in only]
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return dict(pool.map(one, names))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sf-dir", "--raw-dir", required=True, help="a fixture folder, or a folder of raw tables")
    ap.add_argument("--out", default=None)
    ap.add_argument("--only", default="")
    ap.add_argument("--parallel", type=int, default=4, help="results written concurrently")
    ap.add_argument("--master", default=None, help="local[N] for a laptop run; omit on a cluster")
    a = ap.parse_args(argv)
    spark = (build_session(a.master) if a.master
             else SparkSession.builder.appName("ledgerspark-runbook").getOrCreate())
    only = [k for k in a.only.split(",") if k] or None
    print(json.dumps(run(spark, a.sf_dir, a.out, only, a.parallel)))


if __name__ == "__main__":
    main()
