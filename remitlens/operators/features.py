"""Claim features: categories, bins, logs, ratios and provider / code / state context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.functions import scalars as S
from remitlens.operators.tables import one_to_rows
from remitlens.session import materialize

BASE_LOGS = ["Tot_Srvcs", "Tot_Benes", "Avg_Sbmtd_Chrg", "Avg_Mdcr_Alowd_Amt"]
CONTEXT_LOGS = [
    "provider_row_count", "provider_total_services", "hcpcs_row_count", "hcpcs_total_services",
    "state_row_count", "state_total_services", "avg_charge_per_beneficiary",
]


def add_logs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_log": S.log1p_clip(c) for c in cols})


def row_features(df: DataFrame) -> DataFrame:
    """Everything that needs only the row itself."""
    return add_logs(
        df.withColumns({
            "procedure_category": S.procedure_category(),
            "payer_type_proxy": S.payer_type_proxy(df),
            "claim_severity_proxy": S.severity_bin(),
            "balance_size_bucket": S.balance_bin(),
        }),
        BASE_LOGS,
    ).withColumn("services_per_beneficiary", S.safe_ratio("Tot_Srvcs", "Tot_Benes"))


def context_features(df: DataFrame) -> DataFrame:
    """Row counts, service totals and shares of the provider, the code and the state.

    A window per key would put a whole state, or a hot code, on one task. Instead the claims are
    aggregated once per (state, code) with map-side combine; code and state totals are rolled up
    from that table, and a code carries its row count of every state as an array in the order of
    the states. The claims so meet three lookups, by code, state and provider. These are stored
    first: their sizes are known, and the claims themselves move only where one is large.
    """
    rows, services = F.count(F.lit(1)), F.coalesce(F.sum("Tot_Srvcs"), F.lit(0.0))
    state, code, npi = "Rndrng_Prvdr_State_Abrvtn", "HCPCS_Cd", "Rndrng_NPI"

    cell = df.groupBy(F.col(state).alias("_s"), F.col(code).alias("_c")).agg(
        rows.alias("_cell_rows"), services.alias("_cell_services")
    )
    cell = materialize(cell, "context-cells")
    by_state = cell.where(F.col("_s").isNotNull()).groupBy("_s").agg(
        F.sum("_cell_rows").alias("state_row_count"), F.sum("_cell_services").alias("state_total_services")
    )
    # one row per state
    by_state = materialize(by_state.withColumn("_at", F.row_number().over(Window.orderBy("_s"))), "context-states")
    placed = cell.where(F.col("_c").isNotNull()).join(by_state.select("_s", "_at"), "_s", "left")
    by_code = placed.groupBy("_c").agg(
        F.sum("_cell_rows").alias("hcpcs_row_count"), F.sum("_cell_services").alias("hcpcs_total_services"),
        F.map_from_entries(F.collect_list(F.when(F.col("_at").isNotNull(), F.struct("_at", "_cell_rows")))).alias("_in"),
    )
    states = by_state.count()
    each = F.transform(F.sequence(F.lit(1), F.lit(states)), lambda at: F.element_at("_in", at)) if states else F.array()
    by_code = materialize(by_code.withColumn("_cells", each.cast("array<long>")).drop("_in"), "context-codes")
    provider = df.where(F.col(npi).isNotNull()).groupBy(F.col(npi).alias("_p")).agg(
        rows.alias("provider_row_count"), services.alias("provider_total_services")
    )
    provider = materialize(provider, "context-providers")
    joined = df.join(by_code, F.col(code) == F.col("_c"), "left").join(by_state, F.col(state) == F.col("_s"), "left").join(
        provider, F.col(npi) == F.col("_p"), "left").withColumn("_cell_rows", F.get("_cells", F.col("_at") - 1))
    both_known = F.col(state).isNotNull() & F.col(code).isNotNull()
    return joined.select(
        *[F.col(c) for c in df.columns],
        "provider_row_count", "provider_total_services", "hcpcs_row_count", "hcpcs_total_services",
        "state_row_count", "state_total_services",
        S.safe_ratio(F.when(both_known, F.col("_cell_rows").cast("double")), "state_row_count").alias("hcpcs_state_row_share"),
        S.safe_ratio(F.col("Avg_Sbmtd_Chrg") * F.col("Tot_Srvcs"), "Tot_Benes").alias("avg_charge_per_beneficiary"),
        S.safe_ratio("Tot_Srvcs", "provider_total_services").alias("provider_service_share"),
        S.safe_ratio("Tot_Srvcs", "state_total_services").alias("hcpcs_service_share_in_state"),
    )


def build_features(cleaned: DataFrame) -> DataFrame:
    """Applicable rows with every feature column."""
    applicable = cleaned.where("benchmark_applicable")
    return add_logs(context_features(row_features(applicable)), CONTEXT_LOGS)


def _sample_skew(col: str):
    """Adjusted (sample) skewness from the population form."""
    n = F.count(col).cast("double")
    g1 = F.skewness(col)
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))


def skew_report(features: DataFrame, cols: Sequence[str] = tuple(BASE_LOGS)) -> DataFrame:
    one = features.agg(*[
        a for c in cols for a in (_sample_skew(c).alias(f"{c}__b"), _sample_skew(f"{c}_log").alias(f"{c}__a"))
    ])
    return one_to_rows(one, [
        {"feature": F.lit(c), "skew_before": F.col(f"{c}__b"), "skew_after": F.col(f"{c}__a")} for c in cols
    ])
