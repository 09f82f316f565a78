"""The registered queries: SQL parity, native plans, isolation from the rest of the library."""

import contextlib
import io
import pathlib
import re

import pytest

from __spark_entry__ import oracle_sql, queries
from ledgerspark.llm.queries import ORACLE_SQL, QUERIES
from oracle_check import compare, duck


@pytest.mark.parametrize("key", list(ORACLE_SQL))
def test_sql_parity(spark, sf_small, key):
    r = compare(spark, key, sf_small, duck(sf_small))
    assert r["status"] == "ok" and r["spark_rows"] > 0 and (key == "op13_divergence" or r["spark_rows"] == 200), r


@pytest.mark.parametrize("n", [4, 5, 10])
def test_native_plans(spark, sf_small, n):
    name = next(k for k in QUERIES if k.startswith(f"op{n}_"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[name](spark, sf_small).explain()
    assert not re.search("Python|Pandas|Arrow", buf.getvalue())


def test_registered():
    assert {k for k in queries() if k.startswith("op")} == set(QUERIES) and len(QUERIES) == 13
    assert "pipeline" in queries() and set(ORACLE_SQL) <= set(oracle_sql())


def test_nothing_else_imports_the_subpackage():
    root = pathlib.Path(__file__).parents[2]
    for p in [*(root / "ledgerspark").rglob("*.py"), *(root / "tests").glob("*.py"), root / "bench.py"]:
        if "llm" not in p.relative_to(root).parts:
            assert "llm" not in p.read_text(), p
