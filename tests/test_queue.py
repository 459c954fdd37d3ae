"""Queue order, sums that must add up, views and their guards."""

import pytest
from pyspark.sql import functions as F

from remitlens import constants as C
from remitlens.operators import queue, reports


def test_rank_is_a_permutation_in_score_order(stages):
    rows = stages.queue.select("rank", "priority_score").orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    assert all(a["priority_score"] >= b["priority_score"] for a, b in zip(rows, rows[1:]))
    assert len(rows) == stages.modeling.where("Is_Underpaid").count()


def test_totals_add_up(stages):
    total = stages.queue.agg(F.sum("estimated_recovery")).first()[0]
    for build in (reports.by_hcpcs, reports.by_state, reports.by_provider_type, reports.by_payer):
        table = build(stages.queue)
        assert table.agg(F.sum("total_estimated_recovery")).first()[0] == pytest.approx(total, rel=1e-9)
        assert table.agg(F.sum("underpaid_rows")).first()[0] == stages.queue.count()
    summary = queue.queue_summary_row(stages.queue, stages.modeling).first()
    split = summary["modifier_review_estimated_recovery"] + summary["estimated_recovery_excluding_modifier_review"]
    assert split == pytest.approx(summary["total_estimated_recovery"], rel=1e-9)
    assert len(summary) == 14
    assert {r["metric"] for r in reports.executive_summary(stages.queue).collect()} >= {"top_state_by_recovery", "unique_states"}
    assert reports.executive_summary(stages.queue).count() == 15


def test_model_probability_replaces_the_rule(spark, stages):
    base = stages.modeling.where("Is_Underpaid").limit(4)
    scored = queue.score_candidates(base.withColumn("collection_probability", F.lit(0.4)), "m", 0.4)
    assert {(r["confidence_score"], r["predicted_high_priority"]) for r in scored.collect()} == {(0.4, True)}
    rules = queue.score_candidates(base)
    assert rules.where(F.col("confidence_score") != F.col("rule_confidence_score")).count() == 0
    assert rules.where("predicted_high_priority").count() == 0


def test_empty_queue_is_an_error_when_asked(stages):
    with pytest.raises(ValueError):
        queue.queue_candidates(stages.modeling.where(~F.col("Is_Underpaid")), require_rows=True)


def test_view_treats_the_search_literally(stages):
    assert queue.queue_filter(stages.queue, code_contains=".").count() == 0
    lower = queue.queue_filter(stages.queue, code_contains="j").count()
    assert lower == queue.queue_filter(stages.queue, code_contains="J").count()
    with pytest.raises(ValueError):
        queue.queue_view(stages.queue, 0)
    with pytest.raises(ValueError):
        queue.queue_view(stages.queue, 5, "HCPCS_Cd")


def test_attach_payer_by_key(spark):
    q = spark.createDataFrame([(1, "c", "O"), (2, "c", "O")], "Rndrng_NPI long, HCPCS_Cd string, Place_Of_Srvc string")
    f = spark.createDataFrame([(1, "c", "O", "P")] * 3, "Rndrng_NPI long, HCPCS_Cd string, Place_Of_Srvc string, payer_type_proxy string")
    got = {r["Rndrng_NPI"]: r["payer_type_proxy"] for r in reports.attach_payer(q, f).collect()}
    assert got == {1: "P", 2: C.PAYER_UNKNOWN}


def test_report_view_limit(stages):
    assert reports.report_view(reports.by_state(stages.queue), 3).count() == 3
    with pytest.raises(ValueError):
        reports.report_view(reports.by_state(stages.queue), 0)
