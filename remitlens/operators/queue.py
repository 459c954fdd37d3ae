"""The ranked work queue, its views and its summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens import constants as C
from remitlens import schemas
from remitlens.functions import scalars as S
from remitlens.operators.ordering import global_rank, top_n
from remitlens.operators.tables import metrics_long, one_to_rows

TIE_BREAK = ["Rndrng_NPI", "HCPCS_Cd", "Place_Of_Srvc", "Rndrng_Prvdr_State_Abrvtn"]


def queue_candidates(modeling: DataFrame, require_rows: bool = False) -> DataFrame:
    out = modeling.where("Is_Underpaid")
    if require_rows and out.isEmpty():
        raise ValueError("no underpaid rows: the queue would be empty")
    return out


def score_candidates(
    candidates: DataFrame, model_name: str = C.RULE_MODEL_NAME, threshold: float = C.DEFAULT_THRESHOLD
) -> DataFrame:
    """Recovery, modifier review, confidence, score, tier and action.

    ``collection_probability`` is used where the input has it; the rules fill the rest.
    """
    df = candidates
    if "collection_probability" not in df.columns:
        df = df.withColumn("collection_probability", F.lit(None).cast("double"))
    return (
        df.withColumn("estimated_recovery", S.estimated_recovery())
        .withColumn("is_surgical_hcpcs", S.is_surgical())
        .withColumn("requires_modifier_review", S.requires_modifier_review())
        .withColumn("modifier_review_reason", S.modifier_review_reason())
        .withColumn("rule_confidence_score", S.rule_confidence())
        .withColumn("collection_model_name", F.lit(model_name))
        .withColumn("model_operating_threshold", F.lit(float(threshold)))
        .withColumn("predicted_high_priority", S.predicted_high("model_operating_threshold"))
        .withColumn("confidence_score", S.confidence_score())
        .withColumn("priority_score", S.priority_score())
        .withColumn("priority_tier", S.score_tier())
        .withColumn("recommended_action", S.score_action())
    )


def build_queue(
    modeling: DataFrame, model_name: str = C.RULE_MODEL_NAME, threshold: float = C.DEFAULT_THRESHOLD
) -> DataFrame:
    scored = score_candidates(queue_candidates(modeling), model_name, threshold)
    keep = [c for c in schemas.QUEUE_COLUMNS if c != "rank" and c in scored.columns]
    order = [F.col("priority_score").desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in TIE_BREAK]]
    return global_rank(scored.select(*keep), order)


def top_queue(queue: DataFrame, n: int = C.TOP_QUEUE) -> DataFrame:
    return queue.where(F.col("rank") <= n)


def confidence_methodology(queue: DataFrame) -> DataFrame:
    """The published rule list with the number of queue rows each rule set."""
    one = queue.agg(*[
        F.count_if(F.col("rule_confidence_score") == score).alias(f"n{order}")
        for order, _, _, score, _ in C.CONFIDENCE_RULES
    ])
    return one_to_rows(one, [
        {"rule_order": F.lit(order), "min_abs_dollar_gap": F.lit(dollars), "min_severity_pct": F.lit(pct),
         "confidence_score": F.lit(score), "rationale": F.lit(why), "queue_rows": F.col(f"n{order}")}
        for order, dollars, pct, score, why in C.CONFIDENCE_RULES
    ])


def _total(col: str, where=None):
    value = F.col(col) if where is None else F.when(where, F.col(col))
    return S.round_even(F.coalesce(F.sum(value), F.lit(0.0)), 2)


def queue_summary_row(queue: DataFrame, modeling: DataFrame) -> DataFrame:
    """The 14 queue numbers, typed, as one row."""
    rows = F.count(F.lit(1))
    scored = F.count("collection_probability")
    review = F.col("requires_modifier_review")
    n_modeling = modeling.agg(F.count(F.lit(1)).alias("n")).scalar()
    return queue.agg(
        rows.alias("underpaid_queue_rows"),
        F.min("collection_model_name").alias("model_used"),
        scored.alias("model_scored_rows"),
        (rows - scored).alias("rule_fallback_rows"),
        F.min("model_operating_threshold").alias("model_operating_threshold"),
        F.count_if("predicted_high_priority").alias("predicted_high_priority_rows"),
        _total("estimated_recovery").alias("total_estimated_recovery"),
        F.count_if(review).alias("modifier_review_rows"),
        _total("estimated_recovery", review).alias("modifier_review_estimated_recovery"),
        _total("estimated_recovery", ~review).alias("estimated_recovery_excluding_modifier_review"),
        _total("priority_score").alias("total_priority_score"),
        F.count_if(F.col("priority_tier") == "Critical").alias("critical_tier_rows"),
        F.count_if(F.col("priority_tier") == "High").alias("high_tier_rows"),
    ).select(n_modeling.alias("total_modeling_rows"), "*")


def queue_summary(queue: DataFrame, modeling: DataFrame) -> DataFrame:
    return metrics_long(queue_summary_row(queue, modeling))


def queue_filter(
    queue: DataFrame,
    provider_types: Sequence[str] = (),
    states: Sequence[str] = (),
    tiers: Sequence[str] = (),
    payers: Sequence[str] = (),
    code_contains: str = "",
    min_recovery: float = 0.0,
) -> DataFrame:
    """In-list filters, a literal case-insensitive code search and a recovery floor."""
    out = queue
    for column, wanted in (
        ("Rndrng_Prvdr_Type", provider_types), ("Rndrng_Prvdr_State_Abrvtn", states),
        ("priority_tier", tiers), ("payer_type_proxy", payers),
    ):
        if wanted:
            out = out.where(F.col(column).isin(list(wanted)))
    if code_contains:
        out = out.where(F.lower("HCPCS_Cd").contains(code_contains.lower()))
    return out.where(F.col("estimated_recovery") >= float(min_recovery))


SORTABLE = ["estimated_recovery", "confidence_score", "Payment_Gap_Pct"]


def queue_view(
    queue: DataFrame, limit: int = C.TOP_QUEUE, sort_by: str = "estimated_recovery", ascending: bool = False, **filters
) -> DataFrame:
    """Filtered, sorted, limited rows of the queue."""
    if sort_by not in SORTABLE:
        raise ValueError(f"sort_by must be one of {SORTABLE}")
    if limit < 1:
        raise ValueError("limit must be at least 1")
    key = F.col(sort_by).asc_nulls_last() if ascending else F.col(sort_by).desc_nulls_last()
    return top_n(queue_filter(queue, **filters), [key, *[F.col(k) for k in TIE_BREAK]], limit)


def queue_kpis(view: DataFrame) -> DataFrame:
    return view.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(F.sum("estimated_recovery"), F.lit(0.0)).alias("total_estimated_recovery"),
        F.count_if(F.col("priority_tier").isin("Critical", "High")).alias("critical_high_count"),
        F.avg("confidence_score").alias("avg_confidence"),
    )


def filter_options(queue: DataFrame) -> DataFrame:
    """(option, value) pairs: distinct values of each filter column, tiers in rank order.

    One row per distinct value instead of arrays in one row: copies collapse before the shuffle.
    """
    names = {
        "provider_types": "Rndrng_Prvdr_Type", "states": "Rndrng_Prvdr_State_Abrvtn",
        "tiers": "priority_tier", "payer_types": "payer_type_proxy",
    }
    cells = F.array(*[
        F.struct(F.lit(o).alias("option"), F.col(c).alias("value")) for o, c in names.items()
    ])
    tier_pos = F.array_position(F.array(*[F.lit(t) for t in C.TIER_ORDER]), F.col("value"))
    return (
        queue.select(F.inline(cells)).where(F.col("value").isNotNull()).distinct()
        .withColumn("position", F.when(F.col("option") == "tiers", tier_pos).otherwise(F.lit(0)).cast("long"))
        .orderBy("option", "position", "value")
    )


def max_recovery(queue: DataFrame) -> DataFrame:
    return queue.agg(F.coalesce(F.max("estimated_recovery"), F.lit(0.0)).alias("max_recovery"))


def top_view_bars(view: DataFrame, n: int = 10) -> DataFrame:
    """Chart rows: code + state label and recovery of the n largest claims in view."""
    top = top_n(view, [F.col("estimated_recovery").desc(), *[F.col(k) for k in TIE_BREAK]], n)
    return top.select(S.chart_label().alias("label"), "estimated_recovery")
