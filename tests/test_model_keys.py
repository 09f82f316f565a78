"""The model-based keys (no SQL oracle) checked against brute force on the small fixture."""

import pytest

from __spark_entry__ import queries


def _brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    if not pos or not neg:
        return None
    return sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))


def test_model_auc_is_the_rank_auc_of_the_scores(spark, sf_small):
    q = queries()
    scored = q["risk_scores"](spark, sf_small).collect()
    assert scored and all(0.0 <= r.score <= 1.0 for r in scored)
    auc = q["risk_model_auc"](spark, sf_small).collect()[0]
    want = _brute_auc([r.score for r in scored], [r.high_risk for r in scored])
    assert (auc.auc is None and want is None) or auc.auc == pytest.approx(want, abs=1e-6)
    assert auc.positives + auc.negatives == len(scored)


def test_feature_importances_and_watchlist(spark, sf_small):
    q = queries()
    imp = q["risk_feature_importance"](spark, sf_small).collect()
    assert {r.feature for r in imp} == {"packet_loss", "latency", "mtbf", "uptime"}
    assert sum(r.importance for r in imp) == pytest.approx(1.0, abs=1e-5)
    assert [r.importance for r in imp] == sorted((r.importance for r in imp), reverse=True)
    watch = q["risk_watchlist"](spark, sf_small).collect()
    areas = q["latest_per_area"](spark, sf_small).select("service_area").collect()
    assert sorted(r.service_area for r in watch) == sorted(r.service_area for r in areas)
    assert sorted(r.position for r in watch) == list(range(1, len(watch) + 1))
    ranked = sorted(watch, key=lambda r: r.position)
    assert [r.risk_score for r in ranked] == sorted((r.risk_score for r in ranked), reverse=True)
