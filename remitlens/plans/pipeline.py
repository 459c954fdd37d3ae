"""End-to-end run: inputs in, stage tables and reports out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from remitlens import constants as C
from remitlens.operators import (
    anomalies, cleaning, eda, evaluation, features, models, outliers, pricing, profiling, queue, regression, reports, target, variance,
)
from remitlens.operators.tables import metrics_long
from remitlens.sources.sinks import audit_sample, write_report, write_stage


def run(
    rvu: DataFrame,
    gpci: DataFrame,
    payments: DataFrame,
    out: str,
    model: str | None = None,
    pattern_keys: tuple[str, ...] = tuple(C.PATTERN_KEYS),
    candidates: dict | None = None,
    grid_of: Callable = models.grids,
) -> dict[str, DataFrame]:
    """Every step in order; returns the stage tables. ``model`` names a classifier candidate, or is ``best`` for the whole
    choice (compare, search, fit with the parameters found), or None for rule-based confidence. ``candidates`` and ``grid_of`` replace
    the usual candidates and search grids."""
    def report(df: DataFrame, name: str) -> None:
        write_report(df, f"{out}/reports/{name}")

    # price, join, measure
    report(pricing.spot_check(pricing.expected_payment(rvu, gpci)), "sanity_check_known_codes")
    payments = write_stage(payments, out, "payments")  # a CSV is parsed once; four readers follow
    benchmark = write_stage(pricing.claim_benchmark(payments, rvu, gpci), out, "benchmark")
    claims = write_stage(variance.claims_with_variance(payments, benchmark), out, "claims_with_variance")
    report(metrics_long(variance.join_audit(payments, benchmark)), "join_audit")
    missing = variance.unmatched(payments, benchmark)
    report(variance.top_unmatched(missing), "top_unmatched")
    report(variance.unmatched_sample(missing), "unmatched_sample")

    # audit and clean
    report(profiling.detect_missing(claims), "null_detection_summary")
    usable = outliers.usable_rows(claims)
    bounds = outliers.fit_bounds(usable, C.GAP_COLUMNS)
    report(outliers.outlier_comparison(usable, bounds), "outlier_summary")
    marked = outliers.outlier_flags(claims, bounds["Payment_Gap_Pct"])
    report(outliers.outliers_by_code(marked), "outlier_summary_by_hcpcs")
    report(outliers.outlier_sample(marked), "outlier_sample")
    flagged = write_stage(cleaning.flag_claims(claims), out, "claims_flagged")
    cleaned, excluded = cleaning.split_clean(flagged)
    write_stage(excluded, out, "excluded_rows")
    report(cleaning.cleaning_summary(flagged), "cleaning_summary")
    report(cleaning.before_after(flagged), "cleaning_before_after")
    report(cleaning.applicability_audit(cleaned), "benchmark_applicability_audit")
    report(cleaning.headline_stats(cleaned), "headline_stats")
    report(cleaning.reason_counts(flagged), "zero_benchmark_reasons")

    # chart tables
    by_type = eda.group_mean(cleaned, "Rndrng_Prvdr_Type", "Payment_Gap_Pct", "Mean_Gap_Pct")
    report(eda.extremes(by_type, "Mean_Gap_Pct", 15, False), "summary_gap_by_provider_type")
    by_state = eda.group_rate(cleaned, "Rndrng_Prvdr_State_Abrvtn", "Is_Underpaid", "Underpaid_Rate_Pct")
    report(eda.extremes(by_state, "Underpaid_Rate_Pct"), "summary_underpaid_by_state")
    report(eda.code_stats(cleaned), "summary_hcpcs_stats")
    report(eda.corr_matrix(cleaned), "summary_correlation_matrix")

    # features, target, confidence
    modeling = write_stage(target.with_target(features.build_features(cleaned)), out, "modeling")
    report(target.class_balance(modeling), "class_balance")
    report(target.leakage_audit(modeling), "leakage_audit")
    trained = None
    if model is not None:
        candidates = candidates or models.candidates()
        if model == "best":
            chosen = models.choose(modeling, candidates, grid_of)
            trained, held = chosen.trained, chosen.held
            report(chosen.comparison, "model_comparison")
            report(chosen.tuning, "hyperparameter_tuning")
        else:
            trained, held = models.fit_final(modeling, model, candidates[model])
        models.save_model(trained, f"{out}/model")
        importance = models.importances if trained.has_importances else models.coefficients
        report(importance(trained), "feature_importance")
        report(evaluation.threshold_table(held, evaluation.pr_curve(held), business=False), "threshold_tuning_results")
        report(regression.compare_regressors(modeling, regression.regressors()), "regression_validation")
    scored = models.score(modeling, trained)
    ranked = queue.build_queue(
        scored, trained.name if trained else C.RULE_MODEL_NAME, trained.threshold if trained else C.DEFAULT_THRESHOLD
    )
    ranked = write_stage(ranked, out, "queue")
    report(queue.top_queue(ranked), "queue_top")
    report(queue.queue_summary(ranked, modeling), "queue_summary")
    report(queue.confidence_methodology(ranked), "confidence_methodology")

    # publish
    report(reports.top_underpayments(ranked), "top_underpayments")
    for name, build in (
        ("hcpcs", reports.by_hcpcs), ("state", reports.by_state),
        ("provider_type", reports.by_provider_type), ("payer_type", reports.by_payer),
    ):
        report(build(ranked), f"summary_by_{name}")
    report(reports.executive_summary(ranked), "executive_summary")
    patterns = anomalies.underpayment_patterns(modeling, pattern_keys)
    found = write_stage(anomalies.rank_anomalies(anomalies.detect_anomalies(patterns, pattern_keys), pattern_keys), out, "anomaly_patterns")
    report(anomalies.anomaly_summary(modeling, found, pattern_keys), "anomaly_summary")
    report(audit_sample(found.where("anomaly_flag"), 500, pattern_keys), "anomaly_sample")
    return {
        "benchmark": benchmark, "claims": claims, "flagged": flagged, "cleaned": cleaned, "excluded": excluded,
        "modeling": modeling, "queue": ranked, "patterns": found,
    }
