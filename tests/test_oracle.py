"""Every registered query against its DuckDB oracle on the smallest fixture (the driver uses sf0.01)."""

import pytest

from __spark_entry__ import oracle_sql, queries
from ledgerspark.plans.registry import QUERIES
from oracle_check import compare, duck

KEYS = list(QUERIES)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, con, key):
    r = compare(spark, key, sf_small, con)
    assert r["status"] in ("ok", "rows-only"), r
    assert r["spark_rows"] > 0, r


def test_every_oracle_works_as_a_view(con):
    for key in KEYS:
        if key in oracle_sql():
            con.execute(f"CREATE OR REPLACE VIEW as_view AS {oracle_sql()[key]}")
            con.execute("SELECT count(*) FROM as_view").fetchall()


def test_oracle_keys_are_registered():
    assert set(oracle_sql()) <= set(queries())


def test_rows_only_keys_are_model_based():
    assert set(QUERIES) - set(oracle_sql()) == {
        "risk_scores", "risk_model_auc", "risk_feature_importance", "risk_watchlist"}


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["service_area", "period", "telecom_spend", "incidents", "avg_mttr",
                          "incident_cost", "uptime", "packet_loss", "latency", "mtbf",
                          "cost_per_incident"]
    assert df.count() > 0
