"""

Each entry is ``(spark, sf_dir) -> DataFrame``. Sums and means are exact
(DECIMAL) inside the operators, so most outputs are bit-identical whatever
the partitioning; only statistics that depend on evaluation order (std,
regression, percentiles, sums of weighted shares) are rounded at the edge:
money to cents, ratios to 6 places.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators import bridge as D
from ledgerspark.operators import chargeback as E
from ledgerspark.operators import descriptive as C
from ledgerspark.operators import deviation as V
from ledgerspark.operators import forecast as FC
from ledgerspark.operators import learned as L
from ledgerspark.operators import marts as M
from ledgerspark.operators import quality as Q
from ledgerspark.operators import risk as G
from ledgerspark.operators import triage as H
from ledgerspark.plans.marts import MartSet, marts_for
from ledgerspark.plans.refresh import refresh
from ledgerspark.schemas import INCIDENTS
from ledgerspark.session import shared_folder
from ledgerspark.sources import sinks
from ledgerspark.sources.rejects import read_lines, reject_summary
from ledgerspark.streaming import alerts as A
from ledgerspark.streaming import monitor as S

# Fixture parameter: the driver data spans 83 months, so train on the first 62.
N_TRAIN = 62
# Fixture parameter: the service areas of the driver data (part types), the columns of wide results.
AREAS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
# Of a folder of raw tables: the operators' own training span, and areas as the data has them.
RAW_N_TRAIN = 9


def _is_raw(spark: SparkSession, sf: str) -> bool:
    return _ms(spark, sf).derive is None


def _areas(spark: SparkSession, sf: str) -> list[str]:
    """The columns of wide results: one row per area, from the small scorecard."""
    if not _is_raw(spark, sf):
        return AREAS
    return sorted(r[0] for r in _ms(spark, sf).sam.select("service_area").distinct().collect())


def _n_train(spark: SparkSession, sf: str) -> int:
    return RAW_N_TRAIN if _is_raw(spark, sf) else N_TRAIN


def rnd(df: DataFrame, d2=(), d4=(), d6=(), d3=()) -> DataFrame:
    """Round the named columns to 2/4/6/3 places (output edge only)."""
    spec = {**{c: 2 for c in d2}, **{c: 4 for c in d4}, **{c: 6 for c in d6},
            **{c: 3 for c in d3}}
    return df.select(*[F.round(F.col(f"`{c}`"), spec[c]).alias(c) if c in spec
                       else F.col(f"`{c}`") for c in df.columns])


def as_long(df: DataFrame, *cols) -> DataFrame:
    return df.select(*[F.col(c).cast("long").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def _ms(spark: SparkSession, sf: str) -> MartSet:
    return marts_for(spark, sf)


def _tag(sf: str) -> str:
    return hashlib.sha1(sf.rstrip("/").encode()).hexdigest()[:12]


# ---- A: sources and sinks -------------------------------------------------

def q_source_profile(spark, sf):
    src = _ms(spark, sf).src
    out = None
    for name, df in src.items():
        if name == "status_history":   # a view of the CMDB
            continue
        r = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("source"), "rows")
        out = r if out is None else out.unionByName(r)
    return out


def q_source_rejects(spark, sf):
    """A1: the incidents written as CSV lines, some of them damaged, and read back: good rows and rejects by reason."""
    ms = _ms(spark, sf)

    def build() -> DataFrame:
        path = f"{_app_folder(spark, sf, 'rejects')}/servicenow_incidents"
        have = ms.incidents
        fields = INCIDENTS.fieldNames()
        cell = {f: F.coalesce(F.col(f).cast("string"), F.lit("")) if f in have.columns else F.lit("") for f in fields}
        mark = F.substring(F.md5(cell["incident_id"]), 1, 2)
        cell["mttr_hours"] = F.when(mark == "07", "n/a").otherwise(cell["mttr_hours"])
        cell["opened"] = F.when(mark.isin("13", "07"), "2024-99-01").otherwise(cell["opened"])
        whole = F.concat_ws(",", *cell.values())
        short = F.concat_ws(",", *list(cell.values())[:-1])
        have.select(F.when(mark == "21", short).otherwise(whole).alias("value")).write.mode("overwrite").text(path)
        parsed = ms.keep("stg_incident_lines", lambda: read_lines(spark, path, INCIDENTS, header=False))
        return reject_summary(parsed, "servicenow_incidents", INCIDENTS)

    return ms.once("source_rejects", build)


def q_mart_roundtrip(spark, sf):
    ms = _ms(spark, sf)
    path = f"{shared_folder(spark)}/ledgerspark/roundtrip/{_tag(sf)}/fct_invoice_audit"
    return sinks.mart_roundtrip(ms.audit, path, ["period"])


def _app_folder(spark, sf, name):
    """A folder of this application and data set."""
    return f"{shared_folder(spark)}/ledgerspark/{name}/{spark.sparkContext.applicationId}/{_tag(sf)}"


def _refreshed(spark, sf):
    """The audit mart and the log of its second refresh: the first one knew neither the last month
    nor the decommissioned lines of the third last."""
    ms = _ms(spark, sf)

    def build() -> tuple[DataFrame, DataFrame]:
        path = f"{_app_folder(spark, sf, 'refresh')}/fct_invoice_audit"
        lines = ms.invoices
        months = sorted(r[0] for r in ms.cube.select("period").distinct().collect())
        part = lines.where((F.col("period") < F.lit(months[-1]))
                           & ((F.col("period") != F.lit(months[-3:][0])) | (F.col("ci_status") == "Active")))
        refresh(part, path, M.invoice_audit)
        return refresh(lines, path, M.invoice_audit)

    return ms.once("refreshed", build)


def q_mart_refresh(spark, sf):
    """A2: the partitioned audit mart after an incremental refresh."""
    return _refreshed(spark, sf)[0]


def q_mart_refresh_log(spark, sf):
    """A2: what the refresh did to each month."""
    return _refreshed(spark, sf)[1]


def q_export_csv(spark, sf):
    """The four marts, the chargeback statement and the (wide) weight matrix as CSV."""
    ms = _ms(spark, sf)
    out = {**ms.all(), "fct_chargeback": E.chargeback_statement(_alloc(spark, sf), areas=_areas(spark, sf)),
           "chargeback_weights": E.weights_wide(_weights(spark, sf))}
    return sinks.export_csv(out, f"{shared_folder(spark)}/ledgerspark/export/{_tag(sf)}")


def q_kpi_summary(spark, sf):
    ms = _ms(spark, sf)
    k = C.kpi_summary(ms.cube, V.spc_deviation(ms.sam), ms.vendor_scorecard)
    return k


# ---- B: marts ------------------------------------------------------------------

def q_invoice_audit(spark, sf):
    return _ms(spark, sf).audit


def q_service_area_monthly(spark, sf):
    return _ms(spark, sf).sam


def q_budget_variance(spark, sf):
    return _ms(spark, sf).budget_variance


def q_vendor_scorecard(spark, sf):
    return _ms(spark, sf).vendor_scorecard


def q_vendor_scorecard_corrected(spark, sf):
    ms = _ms(spark, sf)
    return M.vendor_scorecard_corrected(ms.incidents, ms.spend)


def q_gl_rollup(spark, sf):
    return M.gl_rollup(_ms(spark, sf).spend)


def q_budget_rollup(spark, sf):
    return M.budget_rollup(_ms(spark, sf).raw.cmdb)


def q_gl_reconciliation(spark, sf):
    """Against the supplied GL; the fixture's GL is the order totals (the incidents' cost, in full)."""
    ms = _ms(spark, sf)
    gl = ms.raw.gl if ms.raw.gl is not None else ms.incidents.select(
        "service_area", F.col("opened").alias("period"), (F.col("cost_to_resolve") * 100).alias("amount"))
    return M.gl_reconciliation(gl, ms.spend)


def q_vendor_spend(spark, sf):
    return M.vendor_spend(_ms(spark, sf).spend)


def q_incident_volume(spark, sf):
    return M.incident_volume(_ms(spark, sf).incidents)


# ---- C: descriptive and deviation -------------------------------------------------

def q_audit_headline(spark, sf):
    return C.audit_headline(_ms(spark, sf).cube)


SPC6 = ("baseline_mean", "baseline_std", "z")


def q_spc_baseline(spark, sf):
    return rnd(V.spc_baseline(_ms(spark, sf).sam), d6=SPC6)


def q_latest_per_area(spark, sf):
    return V.latest_per_area(_ms(spark, sf).sam)


def q_spc_deviation(spark, sf):
    return rnd(V.spc_deviation(_ms(spark, sf).sam), d6=SPC6)


def q_control_chart(spark, sf):
    return rnd(V.control_chart(_ms(spark, sf).sam), d6=("mean", "ucl"))


def q_spc_all_metrics(spark, sf):
    return rnd(V.spc_all_metrics(_ms(spark, sf).sam), d6=SPC6)


def q_spc_history(spark, sf):
    return rnd(V.spc_history(_ms(spark, sf).sam), d6=SPC6)


def q_vendor_rank(spark, sf):
    return C.vendor_rank(_ms(spark, sf).vendor_scorecard)


def q_top_vendor(spark, sf):
    return C.top_vendor(_ms(spark, sf).vendor_scorecard)


def q_spend_trend(spark, sf):
    return C.spend_trend(_ms(spark, sf).sam, _areas(spark, sf))


def q_budget_variance_ranked(spark, sf):
    return as_long(C.budget_variance_ranked(_ms(spark, sf).budget_variance), "position")


# ---- D: bridge --------------------------------------------------------------------

def q_cost_bridge(spark, sf):
    ms = _ms(spark, sf)
    return D.cost_bridge(ms.cube, ms.incidents)


def q_controllable_overbilling(spark, sf):
    ms = _ms(spark, sf)
    return D.controllable_overbilling(ms.cube, ms.incidents)


def q_bridge_unexplained(spark, sf):
    ms = _ms(spark, sf)
    return D.bridge_unexplained(ms.cube, ms.incidents)


# ---- E: chargeback ---------------------------------------------------------------

def _weights(spark, sf):
    ms = _ms(spark, sf)
    if ms.raw.weights is None and ms.raw.consumption is None:
        raise ValueError("chargeback needs chargeback_weights.csv beside the raw tables, or measured consumption")
    return ms.raw.weights if ms.raw.weights is not None else E.consumption_weights(ms.consumption)


def _alloc(spark, sf):
    return E.chargeback_allocation(_weights(spark, sf), E.area_total_cost(_ms(spark, sf).sam))


def q_area_total_cost(spark, sf):
    return E.area_total_cost(_ms(spark, sf).sam)


def q_consumption_weights(spark, sf):
    return _weights(spark, sf)


def q_consumption_weights_exact(spark, sf):
    ms = _ms(spark, sf)
    if ms.raw.consumption is None:   # a supplied matrix: its weights stand for the measured units
        return E.consumption_weights_exact(_weights(spark, sf).withColumnRenamed("weight", "units"))
    return E.consumption_weights_exact(ms.consumption)


def q_chargeback_statement_exact(spark, sf):
    return E.chargeback_statement_exact(_alloc(spark, sf), areas=_areas(spark, sf))


def q_chargeback_allocation(spark, sf):
    return _alloc(spark, sf)


def q_showback(spark, sf):
    return as_long(rnd(E.showback(_alloc(spark, sf)), d2=("allocated",), d6=("share",)), "position")


def q_chargeback_statement(spark, sf):
    return E.chargeback_statement(_alloc(spark, sf), areas=_areas(spark, sf))


def q_allocation_leakage(spark, sf):
    cost = E.area_total_cost(_ms(spark, sf).sam)
    return rnd(E.allocation_leakage(_alloc(spark, sf), cost), d3=("weight_sum",),
               d2=("allocated", "leakage"))


def q_allocation_leakage_partial(spark, sf):
    """E6 with an area left out of the weights: it must show up with all its cost."""
    cost = E.area_total_cost(_ms(spark, sf).sam)
    alloc = E.chargeback_allocation(_weights(spark, sf).where(F.col(E.AREA) != _areas(spark, sf)[0]), cost)
    return rnd(E.allocation_leakage(alloc, cost), d3=("weight_sum",), d2=("allocated", "leakage"))


# ---- F: forecast --------------------------------------------------------------

def _series(spark, sf, keys=()):
    return FC.monthly_spend(_ms(spark, sf).sam, keys)


def _points(spark, sf):
    return FC.forecast_point(FC.trend_fit(_series(spark, sf)))


def q_monthly_spend(spark, sf):
    return as_long(_series(spark, sf), "t")


def q_trend_fit(spark, sf):
    f = FC.trend_fit(_series(spark, sf))
    return rnd(f.select("b1", "b0", "resid_std", "n", "last_period"), d6=("b1",),
               d2=("b0", "resid_std"))


def q_forecast_point(spark, sf):
    return as_long(rnd(_points(spark, sf).select("h", "period", "t", "point"), d2=("point",)),
                   "h", "t")


def q_forecast_monte_carlo(spark, sf):
    return as_long(rnd(FC.forecast_monte_carlo(_points(spark, sf)),
                       d2=("point", "p10", "p50", "p90")), "h")


def q_next_quarter(spark, sf):
    return rnd(FC.next_quarter(_points(spark, sf)), d2=("point", "p10", "p90", "sim_min"))


def q_forecast_closed_form(spark, sf):
    return as_long(rnd(FC.forecast_closed_form(_points(spark, sf)), d2=("point", "p10", "p90")),
                   "h")


def q_forecast_accuracy(spark, sf):
    return as_long(rnd(FC.forecast_accuracy(_series(spark, sf)), d2=("forecast",),
                       d6=("accuracy",)), "h")


def q_forecast_by_area(spark, sf):
    return as_long(rnd(FC.forecast_by_area(_ms(spark, sf).sam), d2=("point", "b0", "resid_std"),
                       d6=("b1",)), "h")


def q_forecast_backtest(spark, sf):
    min_train = max(3, _n_train(spark, sf) - 3)
    return as_long(rnd(FC.rolling_backtest(_series(spark, sf), min_train), d2=("forecast",), d6=("accuracy",)), "h")


def q_forecast_backtest_by_area(spark, sf):
    min_train = max(3, _n_train(spark, sf) - 3)
    back = FC.rolling_backtest(_series(spark, sf, ["service_area"]), min_train, keys=["service_area"])
    return as_long(rnd(FC.backtest_summary(back, ["service_area"]), d6=("mean_accuracy", "worst_accuracy")), "h", "origins")


# ---- G: risk -------------------------------------------------------------------

_LOCK = threading.RLock()   # queries may be built from several threads (runbook)


def _labeled(spark, sf):
    """Labelled scorecard months (one row per area and month), kept for the G family."""
    ms = _ms(spark, sf)
    return ms.keep("risk_labels", lambda: G.risk_labels(ms.sam))


def q_risk_labels(spark, sf):
    return _labeled(spark, sf)


def q_risk_time_split(spark, sf):
    return G.risk_time_split(_labeled(spark, sf), _n_train(spark, sf))


def q_risk_frame(spark, sf):
    return G.risk_frame(_labeled(spark, sf), _n_train(spark, sf))


def q_risk_watch_months(spark, sf):
    return G.watch_months(_labeled(spark, sf))


def q_risk_auc(spark, sf):
    test = G.time_split(_labeled(spark, sf), _n_train(spark, sf)).where(F.col("split") == "test")
    return G.risk_auc(test, "packet_loss")


def q_risk_separation(spark, sf):
    return G.risk_separation(_labeled(spark, sf), _n_train(spark, sf))


_MODELS: dict[tuple[str, str], tuple] = {}


def _model(spark, sf):
    """The breach-risk forest of a data set, fitted once and shared by G3, G5, G6."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"))
    with _LOCK:
        if key not in _MODELS:
            lab = _labeled(spark, sf)
            model, scored = G.risk_scores(lab, _n_train(spark, sf))
            _MODELS[key] = (lab, model, _ms(spark, sf).keep("risk_scores", lambda: scored))   # test months only: small
        return _MODELS[key]


def q_risk_scores(spark, sf):
    return rnd(_model(spark, sf)[2], d6=("score",))


def q_risk_model_auc(spark, sf):
    return rnd(G.risk_auc(_model(spark, sf)[2], "score"), d6=("auc",))


def q_risk_feature_importance(spark, sf):
    return rnd(G.risk_feature_importance(spark, _model(spark, sf)[1]), d6=("importance",))


def q_risk_permutation_importance(spark, sf):
    test = G.time_split(_labeled(spark, sf), _n_train(spark, sf)).where(F.col("split") == "test")
    out = G.permutation_importance(test, lambda df: df.withColumn("score", G.plain_score()))
    return rnd(out, d6=("auc", "permuted_auc", "importance"))


def q_risk_watchlist(spark, sf):
    lab, model, _ = _model(spark, sf)
    return as_long(rnd(G.risk_watchlist(model, lab), d6=("risk_score",)), "position")


# ---- H: triage --------------------------------------------------------------

def q_triage_classify(spark, sf):
    c = H.classify(_ms(spark, sf).invoices)
    return c.select("invoice_id", "ci_status", "contracted_rate", "billed_amount", "predicted")


def q_triage_notes(spark, sf):
    return H.triage_notes(H.classify(_ms(spark, sf).invoices))


def q_triage_eval(spark, sf):
    return H.triage_eval(_ms(spark, sf).cube)


def q_triage_confusion(spark, sf):
    return H.triage_confusion(_ms(spark, sf).cube)


def q_triage_accuracy(spark, sf):
    return H.triage_accuracy(_ms(spark, sf).cube)


def _train_and_later(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The lines with their truth, of the training months and of those after."""
    lines = H.with_truth(_ms(spark, sf).invoices)
    months = _ms(spark, sf).cube.select("period").distinct()
    cut = G.time_split(months, _n_train(spark, sf)).select(F.max("cut")).scalar()
    return lines.where(F.col("period") < cut), lines.where(F.col("period") >= cut)


def _thresholds(spark, sf):
    ms = _ms(spark, sf)
    ratios = ms.keep("triage_ratios", lambda: L.ratio_counts(_train_and_later(spark, sf)[0]))
    return ms.keep("triage_thresholds", lambda: L.learn_thresholds(ratios))


def q_triage_thresholds(spark, sf):
    return _thresholds(spark, sf)


def q_triage_learned_eval(spark, sf):
    """The rules and the learnt thresholds on the months that nothing was learnt from."""
    later = _train_and_later(spark, sf)[1]
    both = {"rules": H.rule_classifier, "learned": L.learned_classifier(_thresholds(spark, sf))}
    parts = [H.triage_eval(H.classify(later, c)).withColumn("classifier", F.lit(name)) for name, c in both.items()]
    return parts[0].unionByName(parts[1])


def q_triage_sample(spark, sf):
    return H.triage_sample(H.classify(_ms(spark, sf).invoices))


def q_audit_cmdb_status(spark, sf):
    ms = _ms(spark, sf)
    return H.audit_cmdb_status(ms.invoices, ms.raw.cmdb)


def q_audit_status_as_of(spark, sf):
    ms = _ms(spark, sf)
    # raw tables keep one status a CI: it holds from the installation
    history = ms.raw.status_history if ms.raw.status_history is not None else ms.raw.cmdb.select(
        "ci_id", "status", F.col("install_date").alias("valid_from"))
    return H.audit_status_as_of(ms.invoices, history)


# ---- streaming ------------------------------------------------------------------

def _stream_paths(spark, sf, name):
    # one pair per application and data set: asked again, a stream resumes and takes only what is new
    base = f"{_app_folder(spark, sf, 'stream')}/{name}"
    return f"{base}/out", f"{base}/checkpoint"


def _staged_invoice_stream(spark, sf):
    path, schema, invoices = _ms(spark, sf).invoice_files
    return invoices(S.invoice_stream(spark, path, schema, bytes_per_trigger=4 << 30))


def q_stream_invoice_audit(spark, sf):
    out, ck = _stream_paths(spark, sf, "audit")
    return S.run_available(S.audit_stream(_staged_invoice_stream(spark, sf)), out, ck, "append")


def q_stream_monthly_spend(spark, sf):
    out, ck = _stream_paths(spark, sf, "monthly_spend")
    stream = S.monthly_spend_stream(_staged_invoice_stream(spark, sf), lateness=None)
    return S.run_available(stream, out, ck, "complete")


def q_stream_spc_alerts(spark, sf):
    """C6 on a stream of scorecard rows, some two years a file and a file a batch: the stream learns the baseline itself."""
    ms = _ms(spark, sf)

    def feed() -> tuple[str, list]:
        path = f"{_app_folder(spark, sf, 'scorecard_feed')}/rows"
        months = sorted(r[0] for r in ms.sam.select("period").distinct().collect())   # one value a month
        for k in range(0, len(months), 28):
            ms.sam.where(F.col("period").isin(months[k:k + 28])).coalesce(1).write.mode("append").parquet(path)
        return path, months

    path, months = ms.once("scorecard_feed", feed)
    out, ck = _stream_paths(spark, sf, "spc_alerts")
    stream = spark.readStream.schema(ms.sam.schema).option("maxFilesPerTrigger", 1).parquet(path)
    with A.rocksdb(spark):
        alerts = S.run_available(A.alert_stream(stream, months[0]), out, ck, "append")
    return rnd(alerts, d6=SPC6)


# ---- I: quality checks -------------------------------------------------------

def q_dq_checks(spark, sf):
    ms = _ms(spark, sf)
    alloc = _alloc(spark, sf)
    chk = Q.dq_checks(ms.sam, ms.cube, ms.budget_variance, E.chargeback_statement(alloc, areas=_areas(spark, sf)), alloc,
                      E.area_total_cost(ms.sam))
    return rnd(chk, d6=("value",))


def q_triage_gate(spark, sf):
    cube = _ms(spark, sf).cube
    return Q.triage_gate(H.triage_eval(cube), H.triage_accuracy(cube))


def q_mart_presence(spark, sf):
    return Q.mart_presence(_ms(spark, sf).all())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "source_profile": q_source_profile,
    "source_rejects": q_source_rejects,
    "mart_roundtrip": q_mart_roundtrip,
    "mart_refresh": q_mart_refresh,
    "mart_refresh_log": q_mart_refresh_log,
    "export_csv": q_export_csv,
    "kpi_summary": q_kpi_summary,
    "invoice_audit": q_invoice_audit,
    "service_area_monthly": q_service_area_monthly,
    "budget_variance": q_budget_variance,
    "vendor_scorecard": q_vendor_scorecard,
    "vendor_scorecard_corrected": q_vendor_scorecard_corrected,
    "gl_rollup": q_gl_rollup,
    "budget_rollup": q_budget_rollup,
    "gl_reconciliation": q_gl_reconciliation,
    "vendor_spend": q_vendor_spend,
    "incident_volume": q_incident_volume,
    "audit_headline": q_audit_headline,
    "spc_baseline": q_spc_baseline,
    "latest_per_area": q_latest_per_area,
    "spc_deviation": q_spc_deviation,
    "control_chart": q_control_chart,
    "spc_all_metrics": q_spc_all_metrics,
    "spc_history": q_spc_history,
    "vendor_rank": q_vendor_rank,
    "top_vendor": q_top_vendor,
    "spend_trend": q_spend_trend,
    "budget_variance_ranked": q_budget_variance_ranked,
    "cost_bridge": q_cost_bridge,
    "controllable_overbilling": q_controllable_overbilling,
    "bridge_unexplained": q_bridge_unexplained,
    "area_total_cost": q_area_total_cost,
    "consumption_weights": q_consumption_weights,
    "consumption_weights_exact": q_consumption_weights_exact,
    "chargeback_statement_exact": q_chargeback_statement_exact,
    "chargeback_allocation": q_chargeback_allocation,
    "showback": q_showback,
    "chargeback_statement": q_chargeback_statement,
    "allocation_leakage": q_allocation_leakage,
    "allocation_leakage_partial": q_allocation_leakage_partial,
    "monthly_spend": q_monthly_spend,
    "trend_fit": q_trend_fit,
    "forecast_point": q_forecast_point,
    "forecast_monte_carlo": q_forecast_monte_carlo,
    "next_quarter": q_next_quarter,
    "forecast_closed_form": q_forecast_closed_form,
    "forecast_accuracy": q_forecast_accuracy,
    "forecast_by_area": q_forecast_by_area,
    "forecast_backtest": q_forecast_backtest,
    "forecast_backtest_by_area": q_forecast_backtest_by_area,
    "risk_labels": q_risk_labels,
    "risk_frame": q_risk_frame,
    "risk_watch_months": q_risk_watch_months,
    "risk_time_split": q_risk_time_split,
    "risk_scores": q_risk_scores,
    "risk_auc": q_risk_auc,
    "risk_model_auc": q_risk_model_auc,
    "risk_feature_importance": q_risk_feature_importance,
    "risk_permutation_importance": q_risk_permutation_importance,
    "risk_watchlist": q_risk_watchlist,
    "risk_separation": q_risk_separation,
    "triage_classify": q_triage_classify,
    "triage_notes": q_triage_notes,
    "triage_eval": q_triage_eval,
    "triage_confusion": q_triage_confusion,
    "triage_accuracy": q_triage_accuracy,
    "triage_thresholds": q_triage_thresholds,
    "triage_learned_eval": q_triage_learned_eval,
    "triage_sample": q_triage_sample,
    "audit_cmdb_status": q_audit_cmdb_status,
    "audit_status_as_of": q_audit_status_as_of,
    "dq_checks": q_dq_checks,
    "triage_gate": q_triage_gate,
    "mart_presence": q_mart_presence,
    "stream_invoice_audit": q_stream_invoice_audit,
    "stream_monthly_spend": q_stream_monthly_spend,
    "stream_spc_alerts": q_stream_spc_alerts,
}

# Keys whose result comes from a trained model (MLlib trees): checked by rows only.
ROWS_ONLY = ("risk_scores", "risk_model_auc", "risk_feature_importance", "risk_watchlist")

# Keys that go beyond the reference's own results (variants, other mechanisms); the rest are its operators.
BEYOND = ("source_rejects", "mart_refresh", "mart_refresh_log", "spc_history", "consumption_weights_exact", "chargeback_statement_exact",
          "forecast_backtest", "forecast_backtest_by_area", "risk_frame", "risk_watch_months", "risk_permutation_importance",
          "triage_thresholds", "triage_learned_eval", "audit_status_as_of", "stream_spc_alerts")
