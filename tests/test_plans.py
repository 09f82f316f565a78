"""Physical-plan properties that matter at scale, read from explain()."""

import io
import contextlib

import pytest

from ledgerspark.operators import marts as M
from ledgerspark.plans.marts import marts_for
from ledgerspark.plans.registry import QUERIES
from ledgerspark.sources.fixtures import fixture_sources, lines_view
from ledgerspark.sources.sinks import children

# Keys whose construction itself runs a write or a stream (checked in test_oracle).
SIDE_EFFECT = {"mart_roundtrip", "export_csv", "stream_invoice_audit", "stream_monthly_spend", "stream_spc_alerts",
               "mart_refresh", "mart_refresh_log", "source_rejects"}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", [k for k in QUERIES if k not in SIDE_EFFECT])
def test_no_cartesian_or_nested_loop_join(spark, sf_small, key):
    p = plan(QUERIES[key](spark, sf_small))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_scan_prunes_columns_and_id_window(spark, sf_small):
    src = fixture_sources(spark, sf_small)
    p = plan(M.service_area_monthly(src.invoices, src.incidents, src.telemetry))
    assert "Window" not in p                  # invoice_id is not read, so its window is dropped
    lineitem_schemas = [l for l in p.splitlines() if l.startswith("ReadSchema: struct<l_")]
    assert lineitem_schemas and all("l_comment" not in l and "l_linenumber" not in l
                                    for l in lineitem_schemas)


def test_filter_reaches_parquet_scan(spark, sf_small):
    src = fixture_sources(spark, sf_small)
    # Without invoice_id the id window is pruned and the filters reach the scans.
    p = plan(src.invoices.drop("invoice_id").where("service_area = 'SMALL' AND vendor = 'FRANCE'"))
    assert "PushedFilters: [IsNotNull(p_type), EqualTo(p_type,SMALL)" in p
    assert "EqualTo(n_name,FRANCE)" in p
    # With it, a filter must stay above the row-number window: pushing it below
    # would renumber the lines of an (order, line) pair.
    p = plan(src.invoices.where("service_area = 'SMALL'"))
    assert "EqualTo(p_type,SMALL)" not in p


def test_aggregates_are_partial_before_shuffle(spark, sf_small):
    src = fixture_sources(spark, sf_small)
    p = plan(M.vendor_scorecard(src.incidents, src.invoices))
    assert p.count("HashAggregate") >= 4      # partial + final on each side, before the join
    assert "partial_count(distinct" in p or "partial_count" in p


CUBE_KEYS = ("audit_headline", "kpi_summary", "cost_bridge", "controllable_overbilling", "bridge_unexplained", "triage_eval",
             "triage_confusion", "triage_accuracy", "dq_checks", "triage_gate")


@pytest.mark.parametrize("key", CUBE_KEYS)
def test_additive_figures_scan_no_lines(spark, sf_small, key):
    p = plan(QUERIES[key](spark, sf_small))
    assert "stg_lines" not in p and "lineitem" not in p
    assert "stg_cube" in p


def test_month_filter_prunes_staged_lines(spark, sf_small):
    p = plan(QUERIES["invoice_audit"](spark, sf_small).where("period = date'1997-03-01'"))
    assert "PartitionFilters: [isnotnull(period" in p and "period" not in p.split("PushedFilters")[1].split("\n")[0]


def test_lines_are_joined_once(spark, sf_small):
    ms = marts_for(spark, sf_small)
    for df in (ms.cube, ms.spend, ms.src.telemetry, ms.src.invoices, ms.src.budget):
        assert "lineitem" not in plan(df)


def test_numbering_moves_the_lines_once(spark, sf_small):
    p = plan(lines_view(spark, sf_small))
    # the offsets meet the lines where the window put them: the lines are not dealt again by the keys of a null-safe join
    assert "hashpartitioning(_part" in p and "hashpartitioning(coalesce(" not in p


@pytest.mark.parametrize("key, staged", [("triage_sample", set()), ("audit_cmdb_status", set()), ("triage_thresholds", {"stg_cube", "triage_ratios", "triage_thresholds"}),
                                         ("mart_refresh_log", {"stg_cube"})])
def test_what_reads_lines_stages_nothing_else(spark, sf_small, key, staged):
    folder = f"{sf_small}{'/.' * (1 + ['triage_sample', 'audit_cmdb_status', 'triage_thresholds', 'mart_refresh_log'].index(key))}"   # a mart set of its own
    QUERIES[key](spark, folder)
    ms = marts_for(spark, folder)
    assert set(children(spark, ms.store)) == staged | {"stg_lines"}
    ms.cleanup()


def test_what_only_sums_lines_numbers_none(spark, sf_small):
    folder = f"{sf_small}{'/.' * 5}"   # a mart set of its own
    rows = sorted(QUERIES["allocation_leakage"](spark, folder).collect())
    ms = marts_for(spark, folder)
    assert set(children(spark, ms.store)) == {"stg_measures", "stg_incidents", "stg_cube", "stg_telemetry_monthly", "stg_consumption", "stg_spend", "fct_service_area_monthly"}
    assert "_hot" not in plan(ms.feeds.measures) and not {"invoice_id", "ci_id"} & set(ms.feeds.measures.columns)
    summed = {name: sorted(df.collect(), key=str) for name, df in {"cube": ms.cube, "sam": ms.sam, "consumption": ms.consumption}.items()}
    ms.cleanup()
    again = marts_for(spark, folder)   # with the lines staged first the sums are taken from them
    again.invoices
    assert sorted(QUERIES["allocation_leakage"](spark, folder).collect()) == rows
    assert "stg_lines" in children(spark, again.store) and "stg_measures" not in children(spark, again.store)
    assert summed == {name: sorted(df.collect(), key=str) for name, df in {"cube": again.cube, "sam": again.sam, "consumption": again.consumption}.items()}
    again.cleanup()
