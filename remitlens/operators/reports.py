"""Roll-ups by code, state, provider type and payer; top claims; the executive summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens import constants as C
from remitlens.functions import scalars as S
from remitlens.operators.ordering import dedupe_first, top_n, top_n_ranked
from remitlens.operators.queue import TIE_BREAK
from remitlens.operators.tables import metrics_long

DIMENSIONS = {
    "hcpcs": "HCPCS_Cd", "state": "Rndrng_Prvdr_State_Abrvtn",
    "provider_type": "Rndrng_Prvdr_Type", "payer": "payer_type_proxy",
}


def attach_payer(queue: DataFrame, features: DataFrame) -> DataFrame:
    """Payer proxy by (provider, code, place) when the queue lacks it; missing -> Unknown."""
    if "payer_type_proxy" not in queue.columns:
        lookup = dedupe_first(
            features.select(*C.CLAIM_KEY, "payer_type_proxy"), C.CLAIM_KEY, ["payer_type_proxy"]
        )
        queue = queue.join(lookup, C.CLAIM_KEY, "left")
    return queue.na.fill(C.PAYER_UNKNOWN, ["payer_type_proxy"])


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("underpaid_rows"),
        F.coalesce(F.sum("estimated_recovery"), F.lit(0.0)).alias("total_estimated_recovery"),
        F.avg("Payment_Gap_Pct").alias("avg_gap_pct"),
        F.avg("confidence_score").alias("avg_confidence"),
        F.count_if(F.col("priority_tier").isin("Critical", "High")).alias("critical_or_high_count"),
    ]


def rollup(queue: DataFrame, key: str, name: str | None = None, with_confidence: bool = False, with_tiers: bool = True, round_pct: bool = True) -> DataFrame:
    """Underpaid rows, recovery, mean gap (and confidence / urgent rows) per key value."""
    name = name or key
    grouped = queue.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(name)).agg(*_measures())
    columns = [
        F.col(name), F.col("underpaid_rows"),
        S.round_even("total_estimated_recovery", 2).alias("total_estimated_recovery"),
        (S.round_mean("avg_gap_pct", 2) if round_pct else F.col("avg_gap_pct")).alias("avg_gap_pct"),
    ]
    if with_confidence:
        columns.append(S.round_mean("avg_confidence", 4).alias("avg_confidence"))
    if with_tiers:
        columns.append(F.col("critical_or_high_count"))
    return grouped.select(*columns).orderBy(F.col("total_estimated_recovery").desc(), name)


def by_hcpcs(queue: DataFrame) -> DataFrame:
    return rollup(queue, "HCPCS_Cd", with_confidence=True)


def by_state(queue: DataFrame) -> DataFrame:
    return rollup(queue, "Rndrng_Prvdr_State_Abrvtn", "provider_state")


def by_provider_type(queue: DataFrame) -> DataFrame:
    return rollup(queue, "Rndrng_Prvdr_Type", "provider_type")


def by_payer(queue: DataFrame) -> DataFrame:
    return rollup(queue, "payer_type_proxy", with_tiers=False, round_pct=False)


def all_rollups(queue: DataFrame) -> DataFrame:
    """The four roll-ups as one long table from a single scan (grouping sets)."""
    keys = list(DIMENSIONS.values())
    cells = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(k).alias("key")) for d, k in DIMENSIONS.items()])
    measured = ["estimated_recovery", "Payment_Gap_Pct", "confidence_score", "priority_tier"]
    long = queue.select(*measured, *keys).select(*measured, F.inline(cells)).where(F.col("key").isNotNull())
    return long.groupBy("dimension", "key").agg(*_measures()).select(
        "dimension", "key", "underpaid_rows",
        S.round_even("total_estimated_recovery", 2).alias("total_estimated_recovery"),
        S.round_mean("avg_gap_pct", 2).alias("avg_gap_pct"),
        S.round_mean("avg_confidence", 4).alias("avg_confidence"),
        "critical_or_high_count",
    )


def top_underpayments(queue: DataFrame, n: int = C.TOP_QUEUE) -> DataFrame:
    order = [F.col("estimated_recovery").desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in TIE_BREAK]]
    return top_n_ranked(queue, order, n)


def executive_summary_row(queue: DataFrame) -> DataFrame:
    """The 15 headline numbers as one typed row: one scan of the queue and one of the roll-ups."""
    review = S.parse_bool("requires_modifier_review")
    amount = F.col("estimated_recovery")

    def dollars(where: Column | None = None) -> Column:
        return S.round_even(F.coalesce(F.sum(amount if where is None else F.when(where, amount)), F.lit(0.0)), 2)

    totals = queue.agg(
        F.count(F.lit(1)).alias("total_underpaid_rows"),
        dollars().alias("total_estimated_recovery"),
        F.count_if(review).alias("modifier_review_rows"),
        dollars(review).alias("modifier_review_estimated_recovery"),
        dollars(~review).alias("estimated_recovery_excluding_modifier_review"),
        F.count_if(F.col("priority_tier") == "Critical").alias("critical_tier_rows"),
        F.count_if(F.col("priority_tier") == "High").alias("high_tier_rows"),
    )

    def best(dimension: str) -> Column:
        # largest total first, smallest key among equals
        rank = F.struct(-F.col("total_estimated_recovery"), F.col("key"))
        return F.min(F.when(F.col("dimension") == dimension, rank))

    tops = all_rollups(queue).agg(
        best("state").alias("s"), best("hcpcs").alias("h"), best("provider_type").alias("p"),
        F.count_if(F.col("dimension") == "hcpcs").alias("unique_hcpcs_codes"),
        F.count_if(F.col("dimension") == "state").alias("unique_states"),
        F.count_if(F.col("dimension") == "provider_type").alias("unique_provider_types"),
    ).select(
        F.col("s.key").alias("top_state_by_recovery"), (-F.col("s.col1")).alias("top_state_recovery_amount"),
        F.col("h.key").alias("top_hcpcs_by_recovery"), (-F.col("h.col1")).alias("top_hcpcs_recovery_amount"),
        F.col("p.key").alias("top_provider_type_by_recovery"),
        "unique_hcpcs_codes", "unique_states", "unique_provider_types",
    )
    # One row on each side.
    return totals.withColumn("_k", F.lit(1)).join(tops.withColumn("_k", F.lit(1)), "_k").drop("_k")


def executive_summary(queue: DataFrame) -> DataFrame:
    return metrics_long(executive_summary_row(queue))


def report_view(report: DataFrame, limit: int = 25) -> DataFrame:
    """The first rows of a roll-up by recovery, with the roll-up's total row count."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    total = report.agg(F.count(F.lit(1)).alias("n")).scalar()
    first = report.columns[0]
    return top_n(report, [F.col("total_estimated_recovery").desc(), F.col(first)], limit).withColumn("total_rows", total)
