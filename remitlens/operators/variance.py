"""Payments joined to the benchmark, gaps, and the audit of what did not match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens import schemas
from remitlens.functions import scalars as S
from remitlens.operators.ordering import top_n

MATCHED = "Expected_Payment_NonFacility_Avg"


def join_benchmark(payments: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Left join on (code, state), N:1. A NULL code has no fee, so it stays unmatched.

    The benchmark is codes x states at most; AQE broadcasts it when its measured size allows
    and otherwise sort-merges, splitting skewed payment partitions.
    """
    on = (F.col("HCPCS_Cd") == F.col("HCPCS")) & (F.col("Rndrng_Prvdr_State_Abrvtn") == F.col("State"))
    return payments.join(benchmark, on, "left").drop("HCPCS", "State")


def split_matched(joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    return joined.where(F.col(MATCHED).isNotNull()), joined.where(F.col(MATCHED).isNull())


def unmatched(payments: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Payments without a usable benchmark row, as an anti join."""
    usable = benchmark.where(F.col(MATCHED).isNotNull()).select("HCPCS", "State")
    on = (F.col("HCPCS_Cd") == F.col("HCPCS")) & (F.col("Rndrng_Prvdr_State_Abrvtn") == F.col("State"))
    return payments.join(usable, on, "left_anti")


def match_rate(joined: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    matched = F.count(MATCHED)
    return joined.agg(
        rows.alias("total_rows"),
        matched.alias("matched_rows"),
        (rows - matched).alias("unmatched_rows"),
        (F.try_divide(matched.cast("double"), rows) * 100.0).alias("match_rate_pct"),
    )


def claims_with_variance(payments: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Matched payments with gap columns: the base table of every later step."""
    matched, _ = split_matched(join_benchmark(payments, benchmark))
    return S.with_variance(matched).select(*schemas.CLAIM_COLUMNS)


def _underpaid_dollars() -> Column:
    return F.coalesce(F.sum(F.when(F.col("Is_Underpaid"), F.col("Total_Dollar_Gap"))), F.lit(0.0))


def variance_summary(claims: DataFrame) -> DataFrame:
    rows, hits = F.count(F.lit(1)), F.count_if("Is_Underpaid")
    return claims.agg(
        rows.alias("rows"),
        hits.alias("underpaid_rows"),
        (F.try_divide(hits.cast("double"), rows) * 100.0).alias("underpaid_pct"),
        _underpaid_dollars().alias("total_underpaid_dollars"),
    )


def join_audit(payments: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The step's audit numbers in one pass over the joined rows."""
    joined = S.with_variance(join_benchmark(payments, benchmark))
    rows, matched = F.count(F.lit(1)), F.count(MATCHED)
    hits = F.count_if("Is_Underpaid")
    return joined.agg(
        rows.alias("total_rows"),
        matched.alias("matched_rows"),
        (rows - matched).alias("unmatched_rows"),
        S.round_even(F.try_divide(matched.cast("double"), rows) * 100.0, 2).alias("match_rate_pct"),
        hits.alias("underpaid_rows"),
        S.round_even(F.try_divide(hits.cast("double"), matched) * 100.0, 2).alias("underpaid_pct"),
        S.round_even(_underpaid_dollars(), 2).alias("total_underpaid_dollars"),
    )


def top_unmatched(unmatched_rows: DataFrame, n: int = 15) -> DataFrame:
    counts = unmatched_rows.where(F.col("HCPCS_Cd").isNotNull()).groupBy("HCPCS_Cd").agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return top_n(counts, [F.col("row_count").desc(), F.col("HCPCS_Cd")], n)


def unmatched_sample(unmatched_rows: DataFrame, n: int = 200) -> DataFrame:
    """A bounded audit sample in key order."""
    order = [F.col(c) for c in ("HCPCS_Cd", "Rndrng_NPI", "Place_Of_Srvc", "Rndrng_Prvdr_State_Abrvtn")]
    return top_n(unmatched_rows, order, n).select(
        "HCPCS_Cd", "Rndrng_Prvdr_State_Abrvtn", "Rndrng_Prvdr_Type", "Avg_Mdcr_Pymt_Amt"
    )
