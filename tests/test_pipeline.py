"""The whole run, and plan shapes that must hold at scale."""

import io
from contextlib import redirect_stdout

import pytest

from remitlens.operators import boosting, models
from remitlens.operators.boosting import Boost
from remitlens.plans import pipeline
from remitlens.plans.catalog import PATTERN_GROUP


def plan(df) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


SMALL = {"Hist_Gradient_Boosting": Boost(rounds=3, leaves=6, patience=2), "Gradient_Boosting": Boost(rounds=2, leaves=4, depth=2)}


@pytest.mark.parametrize("model", ["Gradient_Boosting", "best"])
def test_run_writes_every_stage_and_report(spark, stages, tmp_path, model):
    grid_of = lambda name, est: boosting.grid(est, rounds=[2, 4])
    out = pipeline.run(stages.rvu, stages.gpci, stages.payments, str(tmp_path / "out"), model, tuple(PATTERN_GROUP), SMALL, grid_of)
    assert out["cleaned"].count() + out["excluded"].count() == out["claims"].count() == stages.claims.count()
    assert out["queue"].count() == stages.queue.count()
    assert out["queue"].where("collection_probability is null").count() == 0
    reports = {p.name for p in (tmp_path / "out" / "reports").iterdir()}
    assert {"executive_summary", "cleaning_summary", "queue_summary", "threshold_tuning_results", "regression_validation", "feature_importance"} <= reports
    assert {"summary_gap_by_provider_type", "summary_underpaid_by_state", "summary_hcpcs_stats", "summary_correlation_matrix"} <= reports
    if model == "best":
        assert {"model_comparison", "hyperparameter_tuning"} <= reports
        tuned = spark.read.option("header", True).csv(str(tmp_path / "out" / "reports" / "hyperparameter_tuning")).collect()
        assert len(tuned) == 2 and sum(r["best"] == "true" for r in tuned) >= 1
        saved = models.load_model(spark, str(tmp_path / "out" / "model"))
        assert saved.name in SMALL and 2 <= len(saved.model.trees) <= 4


def test_no_cartesian_product_in_pricing(stages):
    for df in (stages.benchmark, stages.expected, stages.claims_lazy):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(stages):
    text = plan(stages.queue.where("priority_tier = 'Critical'").select("HCPCS_Cd", "estimated_recovery"))
    assert "EqualTo(priority_tier,Critical)" in text
    assert "ReadSchema: struct<HCPCS_Cd:string,estimated_recovery:double,priority_tier:string>" in text


def test_lines_combine_before_they_move(stages):
    text = plan(stages.payments)
    assert "partial_sum" in text and "PushedFilters" in text
