"""Registered queries: one per operator, all over the whole stage tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens import constants as C
from remitlens.functions import scalars as S
from remitlens.operators import (
    anomalies, claims_api, cleaning, eda, encoding, evaluation, features, models, ordering, outliers,
    pricing, profiling, queue, regression, reports, splits, tables, target, variance,
)
from remitlens.plans.stages import Stages, open_stages
from remitlens.session import shared_dir
from remitlens.sources import files, sinks

_QUERIES: dict[str, Callable[[Stages], DataFrame]] = {}


def query(fn: Callable[[Stages], DataFrame]) -> Callable[[Stages], DataFrame]:
    _QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, places: int = 6, **exceptions: int) -> DataFrame:
    """Round every double for reporting; sums of money take 2 places."""
    return df.select(*[
        S.round_mean(F.col(f"`{f.name}`"), exceptions.get(f.name, places)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


STATE, TYPE, CODE, PLACE = "Rndrng_Prvdr_State_Abrvtn", "Rndrng_Prvdr_Type", "HCPCS_Cd", "Place_Of_Srvc"
KEY = [*C.CLAIM_KEY, STATE]


# ---- pricing ------------------------------------------------------------------------
@query
def recovery_by_state(st: Stages) -> DataFrame:
    """Flagship: raw tables -> benchmark -> gaps -> recovery dollars per state, one lazy plan."""
    claims = st.claims_lazy.where(~cleaning.excluded_condition() & S.benchmark_applicable() & F.col("Is_Underpaid"))
    return rounded(claims.groupBy(F.col(STATE).alias("provider_state")).agg(
        F.count(F.lit(1)).alias("underpaid_rows"), F.sum(S.estimated_recovery()).alias("total_estimated_recovery"),
        F.avg("Payment_Gap_Pct").alias("avg_gap_pct"),
    ), total_estimated_recovery=2)


@query
def usable_rvu(st: Stages) -> DataFrame:
    return rounded(pricing.clean_rvu(st.rvu))


@query
def conversion_factor(st: Stages) -> DataFrame:
    return rounded(pricing.resolve_conversion_factor(pricing.clean_rvu(st.rvu)))


@query
def expected_payment(st: Stages) -> DataFrame:
    return rounded(st.expected)


@query
def state_average(st: Stages) -> DataFrame:
    return rounded(pricing.state_average(st.expected))


@query
def state_benchmark(st: Stages) -> DataFrame:
    return rounded(st.benchmark)


@query
def spot_check(st: Stages) -> DataFrame:
    states = [f"NATION_{i}" for i in (1, 4, 7)]
    return rounded(pricing.spot_check(st.expected, C.SPOT_CHECK_CODE, states))


@query
def coercion_audit(st: Stages) -> DataFrame:
    text = st.rvu.select("WORK_RVU", "MP_RVU", F.col("HCPCS").alias("HCPCS_as_number"))
    return profiling.coercion_audit(text, text.columns)


# ---- variance -----------------------------------------------------------------------
@query
def payments(st: Stages) -> DataFrame:
    return rounded(st.payments)


@query
def join_benchmark(st: Stages) -> DataFrame:
    return rounded(st.joined.select(*KEY, "Expected_Payment_NonFacility_Avg", "Expected_Payment_Facility_Avg",
                                    "Expected_Payment_NonFacility_Min", "Expected_Payment_NonFacility_Max", "Locality_Count"))


@query
def unmatched_anti(st: Stages) -> DataFrame:
    return rounded(variance.unmatched(st.payments, st.benchmark).select(*KEY, TYPE, "Avg_Mdcr_Pymt_Amt"))


@query
def unmatched_sample(st: Stages) -> DataFrame:
    return rounded(variance.unmatched_sample(variance.unmatched(st.payments, st.benchmark)))


@query
def match_rate(st: Stages) -> DataFrame:
    return rounded(variance.match_rate(st.joined))


@query
def variance_rows(st: Stages) -> DataFrame:
    return rounded(st.claims, Total_Dollar_Gap=4)


@query
def variance_summary(st: Stages) -> DataFrame:
    return rounded(variance.variance_summary(st.claims), total_underpaid_dollars=2)


@query
def join_audit(st: Stages) -> DataFrame:
    return variance.join_audit(st.payments, st.benchmark)


@query
def top_unmatched(st: Stages) -> DataFrame:
    return variance.top_unmatched(variance.unmatched(st.payments, st.benchmark))


# ---- profiling ----------------------------------------------------------------------
@query
def profile_columns(st: Stages) -> DataFrame:
    return profiling.profile_columns(st.payments.select(
        "Rndrng_NPI", STATE, TYPE, CODE, PLACE, "Rndrng_Prvdr_Mdcr_Prtcptg_Ind", "Rndrng_Prvdr_Ent_Cd"))


@query
def missing_counts(st: Stages) -> DataFrame:
    return profiling.missing_counts(st.rvu)


@query
def missing_detect(st: Stages) -> DataFrame:
    return profiling.detect_missing(st.claims)


@query
def missing_by_column(st: Stages) -> DataFrame:
    n = st.claims.agg(F.count(F.lit(1)).alias("n")).scalar()
    return profiling.missing_by_column(profiling.detect_missing(st.claims), n)


@query
def missing_totals(st: Stages) -> DataFrame:
    return profiling.missing_totals(st.claims, profiling.detect_missing(st.claims))


@query
def negative_share(st: Stages) -> DataFrame:
    return rounded(profiling.negative_share(st.claims))


@query
def describe_exact(st: Stages) -> DataFrame:
    return rounded(profiling.describe_exact(st.claims, ["Avg_Mdcr_Alowd_Amt", "Payment_Gap", "Expected_Payment_Used"]), 4)


@query
def cardinalities(st: Stages) -> DataFrame:
    return profiling.cardinalities(st.claims, [CODE, STATE, TYPE])


@query
def value_counts_type(st: Stages) -> DataFrame:
    return profiling.value_counts(st.claims, TYPE)


# ---- outliers -----------------------------------------------------------------------
@query
def outlier_bounds(st: Stages) -> DataFrame:
    rows = outliers.usable_rows(st.claims)
    return rounded(outliers.bounds_table(outliers.fit_bounds(rows, C.GAP_COLUMNS), rows), 4)


@query
def outlier_comparison(st: Stages) -> DataFrame:
    rows = outliers.usable_rows(st.claims)
    return outliers.outlier_comparison(rows, outliers.fit_bounds(rows, C.GAP_COLUMNS))


def _outlier_flagged(st: Stages) -> DataFrame:
    rows = outliers.usable_rows(st.claims)
    return outliers.outlier_flags(st.claims, outliers.fit_bounds(rows, ["Payment_Gap_Pct"])["Payment_Gap_Pct"])


@query
def outlier_flags(st: Stages) -> DataFrame:
    return _outlier_flagged(st).select(
        *KEY, "zero_expected_payment_flag", "outlier_domain_rule", "outlier_modified_zscore", "outlier_any_flag")


@query
def outlier_overlap(st: Stages) -> DataFrame:
    return rounded(outliers.outlier_overlap(_outlier_flagged(st)))


@query
def outliers_by_code(st: Stages) -> DataFrame:
    return rounded(outliers.outliers_by_code(_outlier_flagged(st), 30))


@query
def outlier_sample(st: Stages) -> DataFrame:
    return outliers.outlier_sample(_outlier_flagged(st)).select(*KEY, "outlier_domain_rule", "outlier_modified_zscore")


# ---- cleaning -----------------------------------------------------------------------
@query
def review_flag(st: Stages) -> DataFrame:
    return st.flagged.select(*KEY, "review_flag", "zero_expected_reason", "duplicate_key_flag", "benchmark_applicable")


@query
def zero_reason_counts(st: Stages) -> DataFrame:
    return rounded(cleaning.reason_counts(st.flagged))


@query
def duplicate_flag(st: Stages) -> DataFrame:
    """(provider, place) repeats for most claims here, which exercises large duplicate groups."""
    return cleaning.with_duplicate_flag(st.claims.select(*KEY), ["Rndrng_NPI", PLACE])


@query
def clean_rows(st: Stages) -> DataFrame:
    return rounded(st.cleaned.select(*KEY, "Payment_Gap_Pct", "review_flag", "benchmark_applicable"))


@query
def excluded_rows(st: Stages) -> DataFrame:
    return rounded(st.excluded.select(*KEY, "Avg_Mdcr_Alowd_Amt", "zero_expected_reason"))


@query
def before_after(st: Stages) -> DataFrame:
    return cleaning.before_after(st.flagged)


@query
def cleaning_summary(st: Stages) -> DataFrame:
    return cleaning.cleaning_summary(st.flagged)


@query
def applicability_audit(st: Stages) -> DataFrame:
    return cleaning.applicability_audit(st.cleaned)


@query
def headline_stats(st: Stages) -> DataFrame:
    return cleaning.headline_stats(st.cleaned)


# ---- features and target ------------------------------------------------------------
@query
def procedure_category(st: Stages) -> DataFrame:
    return st.claims.groupBy(S.procedure_category().alias("procedure_category")).agg(F.count(F.lit(1)).alias("row_count"))


@query
def payer_proxy(st: Stages) -> DataFrame:
    return profiling.value_counts(st.modeling, "payer_type_proxy")


@query
def severity_bins(st: Stages) -> DataFrame:
    return profiling.value_counts(st.modeling, "claim_severity_proxy")


@query
def balance_bins(st: Stages) -> DataFrame:
    return profiling.value_counts(st.modeling, "balance_size_bucket")


@query
def row_features(st: Stages) -> DataFrame:
    return rounded(st.modeling.select(
        *KEY, "procedure_category", "payer_type_proxy", "claim_severity_proxy", "balance_size_bucket",
        *[f"{c}_log" for c in features.BASE_LOGS], "services_per_beneficiary"))


@query
def context_features(st: Stages) -> DataFrame:
    return rounded(st.modeling.select(
        *KEY, *features.CONTEXT_LOGS, "hcpcs_state_row_share", "provider_service_share",
        "hcpcs_service_share_in_state", *[f"{c}_log" for c in features.CONTEXT_LOGS]))


@query
def skew_report(st: Stages) -> DataFrame:
    return rounded(features.skew_report(st.modeling), 5)


@query
def recovery_target(st: Stages) -> DataFrame:
    return st.modeling.select(*KEY, C.TARGET)


@query
def class_balance(st: Stages) -> DataFrame:
    return rounded(target.class_balance(st.modeling))


@query
def leakage_audit(st: Stages) -> DataFrame:
    return target.leakage_audit(st.modeling)


# ---- queue --------------------------------------------------------------------------
@query
def rule_confidence(st: Stages) -> DataFrame:
    return queue.confidence_methodology(st.queue)


@query
def modifier_review(st: Stages) -> DataFrame:
    return rounded(st.queue.where("requires_modifier_review").select(
        *KEY, "is_surgical_hcpcs", "Payment_Gap_Pct", "estimated_recovery", "modifier_review_reason"))


@query
def queue_ranked(st: Stages) -> DataFrame:
    return rounded(st.queue)


@query
def queue_top(st: Stages) -> DataFrame:
    return rounded(queue.top_queue(st.queue).select("rank", *KEY, "priority_score", "priority_tier"))


@query
def queue_summary(st: Stages) -> DataFrame:
    return queue.queue_summary_row(st.queue, st.modeling)


@query
def queue_summary_long(st: Stages) -> DataFrame:
    counted = queue.queue_summary_row(st.queue, st.modeling).select(
        "total_modeling_rows", "underpaid_queue_rows", "model_used", "model_scored_rows", "rule_fallback_rows",
        "predicted_high_priority_rows", "modifier_review_rows", "critical_tier_rows", "high_tier_rows")
    return queue.metrics_long(counted)


VIEW = dict(provider_types=["Cardiology", "Optometry", "Internal Medicine"], tiers=["Critical", "High"], code_contains="j0", min_recovery=500.0)


@query
def queue_view(st: Stages) -> DataFrame:
    return rounded(queue.queue_view(st.queue, 500, "Payment_Gap_Pct", True, **VIEW).select("rank", *KEY, "estimated_recovery", "Payment_Gap_Pct", "confidence_score", "priority_tier"))


@query
def queue_kpis(st: Stages) -> DataFrame:
    return rounded(queue.queue_kpis(queue.queue_filter(st.queue, **VIEW)), total_estimated_recovery=2)


@query
def filter_options(st: Stages) -> DataFrame:
    return queue.filter_options(st.queue)


@query
def max_recovery(st: Stages) -> DataFrame:
    return rounded(queue.max_recovery(st.queue), 2)


@query
def top_view_bars(st: Stages) -> DataFrame:
    return rounded(queue.top_view_bars(st.queue), 2)


# ---- reports ------------------------------------------------------------------------
@query
def rollup_code(st: Stages) -> DataFrame:
    return reports.by_hcpcs(st.queue)


@query
def rollup_state(st: Stages) -> DataFrame:
    return reports.by_state(st.queue)


@query
def rollup_type(st: Stages) -> DataFrame:
    return reports.by_provider_type(st.queue)


@query
def rollup_payer(st: Stages) -> DataFrame:
    return rounded(reports.by_payer(st.queue))


@query
def rollup_all(st: Stages) -> DataFrame:
    return reports.all_rollups(st.queue)


@query
def executive_summary(st: Stages) -> DataFrame:
    return reports.executive_summary_row(st.queue)


@query
def top_ranked_report(st: Stages) -> DataFrame:
    return rounded(reports.top_underpayments(st.queue).select("report_rank", *KEY, "estimated_recovery", "priority_tier"), 2)


@query
def report_view(st: Stages) -> DataFrame:
    return reports.report_view(reports.by_hcpcs(st.queue), 25)


@query
def attach_payer(st: Stages) -> DataFrame:
    return reports.attach_payer(st.queue.select(*KEY), st.modeling)


# ---- chart tables -------------------------------------------------------------------
@query
def histogram_pct(st: Stages) -> DataFrame:
    return rounded(eda.histogram(st.cleaned, "Payment_Gap_Pct", -150, 150, 80))


@query
def histogram_outlier_view(st: Stages) -> DataFrame:
    return rounded(eda.histogram(outliers.usable_rows(st.claims), "Payment_Gap_Pct", -200, 300, 100))


@query
def histogram_dollars(st: Stages) -> DataFrame:
    return rounded(eda.histogram(st.cleaned, "Total_Dollar_Gap", -10000, 10000, 80))


@query
def underpaid_share(st: Stages) -> DataFrame:
    return rounded(eda.share(st.cleaned, "Is_Underpaid"))


@query
def worst_types(st: Stages) -> DataFrame:
    return rounded(eda.extremes(eda.group_mean(st.cleaned, TYPE, "Payment_Gap_Pct", "Mean_Gap_Pct"), "Mean_Gap_Pct", 15, False))


@query
def best_types(st: Stages) -> DataFrame:
    return rounded(eda.extremes(eda.group_mean(st.cleaned, TYPE, "Payment_Gap_Pct", "Mean_Gap_Pct"), "Mean_Gap_Pct", 15, True))


@query
def rate_by_state(st: Stages) -> DataFrame:
    return rounded(eda.extremes(eda.group_rate(st.cleaned, STATE, "Is_Underpaid", "Underpaid_Rate_Pct"), "Underpaid_Rate_Pct"))


@query
def box_by_place(st: Stages) -> DataFrame:
    return rounded(eda.box_stats(st.cleaned, PLACE, "Payment_Gap_Pct", -150, 150))


@query
def box_by_outlier(st: Stages) -> DataFrame:
    return rounded(eda.box_stats(_outlier_flagged(st), "outlier_any_flag", "Payment_Gap_Pct", -300, 400))


@query
def code_stats(st: Stages) -> DataFrame:
    return rounded(eda.code_stats(st.cleaned, 100))


@query
def worst_codes(st: Stages) -> DataFrame:
    return rounded(eda.extremes(eda.code_stats(st.cleaned, 100), "Mean_Gap_Pct", 15, False))


@query
def dollars_by_type(st: Stages) -> DataFrame:
    return rounded(eda.extremes(eda.group_sum(st.cleaned, TYPE, "Total_Dollar_Gap", "Total_Gap"), "Total_Gap", 15, False), 2)


@query
def dollars_by_state(st: Stages) -> DataFrame:
    low = F.col("Is_Underpaid")
    return rounded(eda.extremes(eda.group_sum(st.cleaned, STATE, "Total_Dollar_Gap", "Total_Gap", low), "Total_Gap", 15, False), 2)


@query
def review_rate_by_type(st: Stages) -> DataFrame:
    return rounded(eda.extremes(eda.group_rate(st.cleaned, TYPE, "review_flag", "Review_Rate_Pct"), "Review_Rate_Pct"))


@query
def outlier_rate_by_place(st: Stages) -> DataFrame:
    return rounded(eda.group_rate(_outlier_flagged(st), PLACE, "outlier_any_flag", "Outlier_Rate_Pct"))


@query
def locality_distribution(st: Stages) -> DataFrame:
    return profiling.value_counts(st.cleaned, "Locality_Count", by="key")


@query
def median_by_locality(st: Stages) -> DataFrame:
    return rounded(eda.group_median(st.cleaned, "Locality_Count", "Payment_Gap_Pct", "Median_Gap_Pct"))


@query
def rate_by_entity(st: Stages) -> DataFrame:
    return rounded(eda.group_rate(st.cleaned, "Rndrng_Prvdr_Ent_Cd", "Is_Underpaid", "Underpaid_Rate_Pct"))


@query
def rate_by_review_flag(st: Stages) -> DataFrame:
    return rounded(eda.group_rate(st.cleaned, "review_flag", "Is_Underpaid", "Underpaid_Rate_Pct"))


@query
def corr_matrix(st: Stages) -> DataFrame:
    return rounded(eda.corr_matrix(st.cleaned))


@query
def pair_correlation(st: Stages) -> DataFrame:
    return rounded(eda.pair_correlation(st.cleaned, "Tot_Benes", "Tot_Srvcs"))


@query
def volume_by_type(st: Stages) -> DataFrame:
    return eda.extremes(eda.group_count(st.cleaned, TYPE), "row_count")


@query
def scatter_sample(st: Stages) -> DataFrame:
    return rounded(eda.scatter_sample(st.cleaned, ("Tot_Srvcs", None, 500.0), ("Payment_Gap_Pct", -150.0, 150.0), keys=KEY), 4)


@query
def scatter_charge(st: Stages) -> DataFrame:
    return rounded(eda.scatter_sample(st.cleaned, ("Avg_Sbmtd_Chrg", None, 1000.0), ("Avg_Mdcr_Alowd_Amt", None, 1000.0), keys=KEY), 4)


@query
def scatter_volume(st: Stages) -> DataFrame:
    return rounded(eda.scatter_sample(st.cleaned, ("Tot_Benes", None, 300.0), ("Tot_Srvcs", None, 300.0), keys=KEY), 4)


# ---- evaluation ---------------------------------------------------------------------
@query
def pr_curve(st: Stages) -> DataFrame:
    return rounded(evaluation.pr_curve(st.scored), 9)


@query
def average_precision(st: Stages) -> DataFrame:
    return rounded(evaluation.average_precision(evaluation.pr_curve(st.scored)))


@query
def roc_auc(st: Stages) -> DataFrame:
    return rounded(evaluation.roc_auc(evaluation.pr_curve(st.scored)))


@query
def best_f1(st: Stages) -> DataFrame:
    return rounded(evaluation.best_f1(evaluation.pr_curve(st.scored)))


@query
def recall_threshold(st: Stages) -> DataFrame:
    return rounded(evaluation.recall_threshold(evaluation.pr_curve(st.scored)))


@query
def threshold_metrics(st: Stages) -> DataFrame:
    return evaluation.metrics_at(st.scored, [("default_0_50", 0.5), ("business_operating_0_40", 0.4)])


@query
def threshold_table(st: Stages) -> DataFrame:
    return evaluation.threshold_table(st.scored, evaluation.pr_curve(st.scored))


@query
def confusion(st: Stages) -> DataFrame:
    return evaluation.confusion(st.scored, 0.5)


@query
def class_report(st: Stages) -> DataFrame:
    return rounded(evaluation.class_report(st.scored, 0.5))


@query
def class_weights(st: Stages) -> DataFrame:
    return rounded(evaluation.class_weights(st.modeling))


@query
def formula_baseline(st: Stages) -> DataFrame:
    _, test = splits.split(regression.regression_rows(st.modeling), 0.2)
    return evaluation.regression_metrics(test, C.REGRESSION_TARGET, C.REGRESSION_FORMULA)


@query
def target_encoding(st: Stages) -> DataFrame:
    train, _ = splits.split(regression.regression_rows(st.modeling), 0.2)
    return rounded(encoding.fit_target_encoding(train, CODE, C.REGRESSION_TARGET))


@query
def target_encoded_rows(st: Stages) -> DataFrame:
    train, test = splits.split(regression.regression_rows(st.modeling), 0.2)
    mean = train.agg(F.avg(C.REGRESSION_TARGET).alias("m")).first()["m"]
    table = encoding.fit_target_encoding(train, TYPE, C.REGRESSION_TARGET)
    return rounded(encoding.apply_encoding(test, table, TYPE, mean).select(*KEY, f"{TYPE}_target_enc"))


@query
def onehot(st: Stages) -> DataFrame:
    """Ones per encoded column: every kept level, the alphabetically first one dropped."""
    vocab = encoding.fit_onehot(st.modeling)
    names = encoding.onehot_names(vocab)
    one = encoding.apply_onehot(st.modeling, vocab).agg(*[F.sum(f"`{n}`").cast("long").alias(n) for n in names])
    return tables.one_to_rows(one, [{"feature": F.lit(n), "ones": F.col(f"`{n}`")} for n in names])


@query
def split_counts(st: Stages) -> DataFrame:
    train, held = splits.stratified_split(st.modeling.select(*splits.SPLIT_KEYS, C.TARGET), C.TARGET)
    both = train.select(F.lit(False).alias("is_test"), C.TARGET).unionByName(held.select(F.lit(True).alias("is_test"), C.TARGET))
    return both.groupBy("is_test", F.col(C.TARGET).alias("label")).agg(F.count(F.lit(1)).alias("row_count"))


@query
def fold_counts(st: Stages) -> DataFrame:
    return splits.stratified_folds(st.modeling.select(*splits.SPLIT_KEYS, C.TARGET), C.TARGET).groupBy("fold", F.col(C.TARGET).alias("label")).agg(F.count(F.lit(1)).alias("row_count"))


@query
def stratified_sample(st: Stages) -> DataFrame:
    return ordering.stratified_sample(st.modeling.select(*KEY, C.TARGET), C.TARGET, 1000, KEY)


@query
def random_sample(st: Stages) -> DataFrame:
    """The large-sample path: hash cut-off, then a global rank of the candidates."""
    return ordering.sample_n(st.modeling.select(*KEY), 1000, KEY, small=0)


@query
def risk_factors(st: Stages) -> DataFrame:
    names = ["Tot_Srvcs_log", "Tot_Benes_log", "Avg_Sbmtd_Chrg_log", "services_per_beneficiary", "provider_service_share"]
    return st.modeling.select(*KEY, F.concat_ws("; ", S.top_risk_factors(names)).alias("top_risk_factors"))


@query
def probability_tiers(st: Stages) -> DataFrame:
    tier = S.probability_tier("score", C.BUSINESS_THRESHOLD)
    return st.scored.select(*KEY, tier.alias("priority_tier"), S.probability_action(tier).alias("recommended_action"),
                            S.recovery_signal("score").alias("estimated_recovery_signal"))


# ---- patterns -----------------------------------------------------------------------
PATTERN_GROUP = [STATE, TYPE, "procedure_category", PLACE]


@query
def patterns(st: Stages) -> DataFrame:
    """Single codes are too sparse in these tables for 20 rows, so code category stands in."""
    return rounded(anomalies.underpayment_patterns(st.modeling, PATTERN_GROUP), total_estimated_recovery=2, avg_recovery_per_row=4)


@query
def patterns_by_code(st: Stages) -> DataFrame:
    return rounded(anomalies.underpayment_patterns(st.modeling, C.PATTERN_KEYS, 2), total_estimated_recovery=2, avg_recovery_per_row=4)


@query
def isolation_forest(st: Stages) -> DataFrame:
    found = anomalies.underpayment_patterns(st.modeling, PATTERN_GROUP)
    return anomalies.rank_anomalies(anomalies.detect_anomalies(found, PATTERN_GROUP), PATTERN_GROUP)


@query
def anomaly_summary(st: Stages) -> DataFrame:
    found = anomalies.underpayment_patterns(st.modeling, PATTERN_GROUP)
    flagged = anomalies.detect_anomalies(found, PATTERN_GROUP)
    return anomalies.anomaly_summary(st.modeling, flagged, PATTERN_GROUP)


@query
def anomaly_concentration(st: Stages) -> DataFrame:
    found = anomalies.underpayment_patterns(st.modeling, PATTERN_GROUP)
    return anomalies.anomaly_concentration(anomalies.detect_anomalies(found, PATTERN_GROUP), TYPE)


def _fixed_anomalies(st: Stages) -> DataFrame:
    """Patterns flagged on a fixed arithmetic score: what follows the forest, checkable value by value."""
    found = anomalies.underpayment_patterns(st.modeling, C.PATTERN_KEYS, 2)
    mix = (F.col("row_count") * 7919 + F.col("underpaid_rows") * 31 + F.length(TYPE) * 1709 + F.length(STATE) * 577 + F.substring(CODE, 2, 4).cast("long") * 13) % 9973
    return anomalies.flag_contamination(found.withColumn("raw_score", S.round_even(mix.cast("double") / 9973.0, 6)))


@query
def fixed_anomalies(st: Stages) -> DataFrame:
    return _fixed_anomalies(st).select(*C.PATTERN_KEYS, "anomaly_flag", "anomaly_score")


@query
def fixed_anomaly_concentration(st: Stages) -> DataFrame:
    return anomalies.anomaly_concentration(_fixed_anomalies(st), TYPE)


@query
def fixed_anomaly_summary(st: Stages) -> DataFrame:
    return anomalies.anomaly_summary(st.modeling, _fixed_anomalies(st), C.PATTERN_KEYS, 2)


@query
def fixed_cv_table(st: Stages) -> DataFrame:
    """The comparison table of two fixed arithmetic scores in five folds."""
    fold = (F.col("Rndrng_NPI") % 5).cast("int").alias("fold")
    rows = st.scored.select(F.explode(F.array(F.struct(F.lit("A").alias("Model"), F.col("score")), F.struct(F.lit("B").alias("Model"), S.round_even(F.col("score") * F.col("score"), 3).alias("score")))).alias("m"), "label", fold)
    return models.cv_table(rows.select("m.Model", "m.score", "label", "fold"))


@query
def fixed_linear_regression(st: Stages) -> DataFrame:
    """Least squares of the allowed amount on the charge, as the regression step fits it."""
    from pyspark.ml.feature import VectorAssembler

    rows = st.modeling.select("Avg_Sbmtd_Chrg", C.REGRESSION_TARGET)
    est = regression.regressors()["Linear_Regression"]
    fitted = est.fit(VectorAssembler(inputCols=["Avg_Sbmtd_Chrg"], outputCol="features").transform(rows))
    return st.modeling.sparkSession.createDataFrame([(float(fitted.coefficients[0]), float(fitted.intercept))], "slope double, intercept double").select(
        S.round_even(F.col("slope"), 6).alias("slope"), S.round_even(F.col("intercept"), 4).alias("intercept"))


# ---- file path: the tables written as published files, and read back through the scans ----
def _as_file(df: DataFrame, header: str, preamble: int, name: str) -> str:
    """One text file: notes, a header with repeated names, rows with missing-value tokens, blank rows."""
    spark = df.sparkSession
    line = F.to_csv(F.struct(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NA")).alias(f"c{i}") for i, c in enumerate(df.columns)]))
    top = [(i, f'"note {i}, with a comma",,') for i in range(preamble)] + [(preamble, header), (preamble + 1, "," * (len(df.columns) - 1))]
    rows = spark.createDataFrame(top, "at long, value string").unionByName(df.select(F.lit(preamble + 2).cast("long").alias("at"), line.alias("value")))
    path = f"{shared_dir(spark)}/remitlens/{name}-{uuid.uuid4().hex}"
    rows.repartition(1).sortWithinPartitions("at").select("value").write.text(path)
    return path


@query
def files_rvu(st: Stages) -> DataFrame:
    header = "HCPCS,DESCRIPTION,CODE,RVU,PE RVU,PE RVU,RVU,FACTOR"
    return rounded(files.read_rvu(st.rvu.sparkSession, _as_file(st.rvu, header, files.RVU_HEADER_LINE, "rvu-file")))


@query
def files_gpci(st: Stages) -> DataFrame:
    return rounded(files.read_gpci(st.gpci.sparkSession, _as_file(st.gpci, ",".join(files.GPCI_COLUMNS), files.GPCI_HEADER_LINE, "gpci-file")))


@query
def files_payments(st: Stages) -> DataFrame:
    """The newest of two payments files under one folder."""
    spark = st.payments.sparkSession
    root = f"{shared_dir(spark)}/remitlens/payments-{uuid.uuid4().hex}"
    text = st.payments.select(*[F.coalesce(F.col(c).cast("string"), F.lit("N/A")).alias(c) for c in st.payments.columns])
    text.limit(3).repartition(1).write.option("header", True).csv(f"{root}/2022")
    text.write.option("header", True).csv(f"{root}/2023")  # a folder of parts
    return rounded(files.read_payments(spark, root, "part-*.csv"))


@query
def stage_sink(st: Stages) -> DataFrame:
    """The queue written as a partitioned stage table and read back."""
    root = f"{shared_dir(st.queue.sparkSession)}/remitlens/sink-{uuid.uuid4().hex}"
    return sinks.write_stage(st.queue.select("rank", *KEY, "priority_tier"), root, "queue", ["priority_tier"])


@query
def report_sink(st: Stages) -> DataFrame:
    """A roll-up written as one CSV file and read back."""
    spark = st.queue.sparkSession
    path = f"{shared_dir(spark)}/remitlens/report-{uuid.uuid4().hex}"
    report = reports.by_state(st.queue)
    sinks.write_report(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


# ---- models --------------------------------------------------------------------------
def _compared(name: str) -> Callable[[Stages], DataFrame]:
    return lambda st: models.cv_table(st.cross_validated(name))


CANDIDATES = ["Logistic_Regression", "Random_Forest", "Hist_Gradient_Boosting", "Gradient_Boosting", "Weighted_Gradient_Boosting"]
for _name in CANDIDATES:
    _QUERIES[f"cv_{_name.lower()}"] = _compared(_name)


@query
def model_compare(st: Stages) -> DataFrame:
    """The candidates side by side, best first; shares the held-out scores of the single comparisons."""
    return models.cv_table(st.cross_validated(*CANDIDATES))


@query
def tune_logistic_regression(st: Stages) -> DataFrame:
    """The search grid of one candidate, best point first, on all rows."""
    est = models.candidates()["Logistic_Regression"]
    found = models.tune(st.training, est, models.grids("Logistic_Regression", est))
    return found.table(st.training.sparkSession)


@query
def model_score(st: Stages) -> DataFrame:
    """The queue ranked by model confidence instead of the rules."""
    trained, _ = st.model
    return queue.build_queue(models.score(st.modeling, trained), trained.name, trained.threshold)


@query
def model_holdout(st: Stages) -> DataFrame:
    trained, held = st.model
    return evaluation.metrics_at(held, [("default_0_50", 0.5), ("business_operating_0_40", trained.threshold)])


@query
def importances(st: Stages) -> DataFrame:
    return models.importances(st.model[0])


@query
def coefficients(st: Stages) -> DataFrame:
    est = models.candidates()["Logistic_Regression"]
    return models.coefficients(models.fit_final(st.modeling, "Logistic_Regression", est)[0])


@query
def permutation_importance(st: Stages) -> DataFrame:
    return models.permutation_importance(st.model[0], st.modeling)


@query
def claim_score(st: Stages) -> DataFrame:
    """Every claim as a partial scorer record: some fields given, the rest derived."""
    records = st.modeling.select(
        *KEY, "procedure_category", "payer_type_proxy", F.col(PLACE).alias("place_of_service"),
        F.col("Tot_Srvcs").alias("tot_srvcs"), F.col("Tot_Benes").alias("tot_benes"), F.col("Avg_Sbmtd_Chrg").alias("avg_sbmtd_chrg"),
    ).withColumnsRenamed({PLACE: "place"})
    return models.score_claims(records, st.model[0], keep=["Rndrng_NPI", CODE, "place"])


@query
def claim_batch_summary(st: Stages) -> DataFrame:
    return claims_api.batch_summary(claim_score(st))


FIXED_WEIGHTS = {"Tot_Srvcs_log": 0.9, "services_per_beneficiary": -0.02, "avg_charge_per_beneficiary_log": -0.45}


def _fixed_model(st: Stages) -> models.Trained:
    spec = models.FeatureSpec(list(FIXED_WEIGHTS), {})
    return models.fixed_logistic(st.modeling.sparkSession, spec, list(FIXED_WEIGHTS.values()), -0.5)


@query
def fixed_claim_score(st: Stages) -> DataFrame:
    """Batch claim scoring with given coefficients."""
    records = st.modeling.select(*KEY, F.col("Tot_Srvcs").alias("tot_srvcs"), F.col("Tot_Benes").alias("tot_benes")).withColumnsRenamed({PLACE: "place"})
    scored = models.score_claims(records, _fixed_model(st), keep=["Rndrng_NPI", CODE, "place"])
    return scored.withColumn("top_risk_factors", F.array_join("top_risk_factors", "; "))


@query
def fixed_claim_summary(st: Stages) -> DataFrame:
    return claims_api.batch_summary(fixed_claim_score(st))


@query
def fixed_model_score(st: Stages) -> DataFrame:
    """The queue's confidence from a model with given coefficients."""
    ranked = queue.build_queue(models.score(st.modeling, _fixed_model(st)), "Fixed_Logistic", C.BUSINESS_THRESHOLD)
    return ranked.select(*KEY, S.round_even(F.col("confidence_score"), 4).alias("confidence_score"), "predicted_high_priority")


FIXED_LEVELS = {"O": 0.3, "not seen": -0.7}  # of the place of service; a level that a batch lacks counts 0


@query
def save_load_score(st: Stages) -> DataFrame:
    """A model with given coefficients and levels, saved, loaded and used for scoring."""
    spark = st.modeling.sparkSession
    spec = models.FeatureSpec(list(FIXED_WEIGHTS), {PLACE: list(FIXED_LEVELS)})
    path = f"{shared_dir(spark)}/remitlens/model-{uuid.uuid4().hex}"
    models.save_model(models.fixed_logistic(spark, spec, [*FIXED_WEIGHTS.values(), *FIXED_LEVELS.values()], -0.5), path)
    scored = models.score(st.modeling, models.load_model(spark, path))
    return scored.select(*KEY, S.round_even(F.col("collection_probability"), 4).alias("collection_probability"))


@query
def complete_claims(st: Stages) -> DataFrame:
    """Derived defaults of partial scorer records."""
    records = st.modeling.select(
        "Rndrng_NPI", CODE, F.col(PLACE).alias("place_of_service"), F.col("Tot_Srvcs").alias("tot_srvcs"), F.col("Tot_Benes").alias("tot_benes"))
    return rounded(claims_api.complete_claims(records).select(
        "Rndrng_NPI", CODE, PLACE, "procedure_category", "Avg_Sbmtd_Chrg", "Tot_Srvcs_log", "services_per_beneficiary",
        "avg_charge_per_beneficiary", "Locality_Count", "avg_charge_per_beneficiary_log"))


@query
def regressor_compare(st: Stages) -> DataFrame:
    return regression.compare_regressors(st.modeling)


def bind(fn: Callable[[Stages], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(open_stages(spark, sf_dir))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: bind(fn) for name, fn in _QUERIES.items()}
