"""Every query with Python workers that cannot import the package."""

import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).parents[2]
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from __spark_entry__ import queries
from ledgerspark.session import build_session

spark = build_session("local[4]", 4)

def probe(batches):
    import importlib.util
    import pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_pydict({{"n": [int(importlib.util.find_spec("ledgerspark") is not None)]}})

assert {{r.n for r in spark.range(4).mapInArrow(probe, "n long").collect()}} == {{0}}, "workers see the package"
for name, query in queries().items():
    if name.startswith("op") or name == "pipeline":
        print(name, query(spark, {sf!r}).count(), flush=True)
"""


def test_bare_executors(tmp_path, sf_small):
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(root=str(ROOT), sf=sf_small)], cwd=tmp_path, capture_output=True, text=True, timeout=900,
                         env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"})
    assert run.returncode == 0, run.stdout + run.stderr[-3000:]
    assert len(run.stdout.split("\n")) >= 14
