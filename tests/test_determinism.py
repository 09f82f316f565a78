"""Answers do not depend on partitioning (what a retried or recomputed task sees)."""

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import forecast as FC
from ledgerspark.operators import marts as M
from ledgerspark.session import shared_folder
from ledgerspark.sources.fixtures import fixture_sources


def _rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("parts", [1, 7])
def test_money_sums_and_monte_carlo_are_partition_independent(spark, sf_small, parts):
    src = fixture_sources(spark, sf_small)
    inv = src.invoices.drop("invoice_id")
    shuffled = inv.repartition(parts, F.rand(seed=parts))       # a different row order and split
    base = M.service_area_monthly(inv, src.incidents, src.telemetry)
    again = M.service_area_monthly(shuffled, src.incidents.repartition(parts), src.telemetry)
    assert _rows(base) == _rows(again)                           # bit-identical, not approximately

    series = FC.monthly_spend(base)
    pts = FC.forecast_point(FC.trend_fit(series))
    a = FC.forecast_monte_carlo(pts, sims=2000).select("h", "p10", "p50", "p90")
    b = FC.forecast_monte_carlo(pts.repartition(parts), sims=2000).select("h", "p10", "p50", "p90")
    assert _rows(a) == _rows(b)


class _FakeContext:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return {"spark.checkpoint.dir": None}


class _FakeConf:
    def get(self, key, default=None):
        return default


class _FakeSession:
    def __init__(self, master):
        self.sparkContext = _FakeContext(master)
        self.conf = _FakeConf()


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_FakeSession("yarn"))
