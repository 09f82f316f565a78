"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries"
(seconds per query), "sf"}. Each query runs to completion through the
``noop`` sink (the full plan executes, nothing is collected). The marts are
built (written and read back) once up front and timed as ``build_marts``,
as the reference builds its marts before its analyses run. Session start
and one trivial warm-up job are not timed. ``value`` is the total of the
reference's own queries; queries that go beyond it (``registry.BEYOND``: refresh,
rejects, backtests, learnt thresholds and the like) are timed after them, under ``beyond``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerspark.plans.marts import marts_for  # noqa: E402
from ledgerspark.plans.registry import BEYOND, QUERIES  # noqa: E402
from ledgerspark.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    scratch = tempfile.mkdtemp(prefix="ledgerspark-bench-")
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus * 2))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=parts, app_name="ledgerspark-bench",
                          extra={"spark.checkpoint.dir": f"{scratch}/ckpt",
                                 "spark.eventLog.enabled": "false",
                                 # partitions sized to this data scale (tens of MB, not TB)
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes":
                                     os.environ.get("BENCH_ADVISORY", "4m")})
    spark.sparkContext.setCheckpointDir(f"{scratch}/ckpt")
    spark.range(1).count()   # JVM warm-up (session start, not a query)
    times: dict[str, float] = {}
    t0 = time.perf_counter()
    marts_for(spark, sf_dir).all()
    times["build_marts"] = round(time.perf_counter() - t0, 3)
    beyond: dict[str, float] = {}
    for name in sorted(QUERIES, key=lambda k: k in BEYOND):   # the reference's first, in their order
        if only and name not in only:
            continue
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        (beyond if name in BEYOND else times)[name] = round(time.perf_counter() - t, 3)
    total = round(sum(times.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "beyond": beyond, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
