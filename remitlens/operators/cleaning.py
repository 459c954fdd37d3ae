"""Exclusions with reasons, duplicate keys, before/after numbers, benchmark applicability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens import constants as C
from remitlens.functions import scalars as S
from remitlens.operators.ordering import exact_quantiles
from remitlens.operators.outliers import with_review_flag
from remitlens.operators.tables import one_to_rows
from remitlens.session import materialize


def with_duplicate_flag(df: DataFrame, keys: Sequence[str] = tuple(C.CLAIM_KEY), name: str = "duplicate_key_flag") -> DataFrame:
    """True on every member of a repeated key (NULL equals NULL).

    Counting combines on the map side and only repeated keys survive, so a key with very many
    copies is one row on the lookup side; a window would bring all its copies to one task. The
    lookup is stored first: its size is known, so the rows themselves move only if it is large.
    """
    repeated = (
        df.groupBy(*[F.col(k).alias(f"_dup_{k}") for k in keys])
        .agg(F.count(F.lit(1)).alias("_copies"))
        .where(F.col("_copies") > 1)
    )
    repeated = materialize(repeated, "repeated-keys")
    same = None
    for k in keys:
        hit = F.col(k).eqNullSafe(F.col(f"_dup_{k}"))
        same = hit if same is None else same & hit
    joined = df.join(repeated, same, "left")
    return joined.select(*[F.col(c) for c in df.columns], F.col("_copies").isNotNull().alias(name))


def flag_claims(claims: DataFrame) -> DataFrame:
    """All matched claims with reason, review, duplicate and applicability columns."""
    reasoned = claims.withColumn("zero_expected_reason", S.zero_expected_reason())
    reviewed = with_review_flag(reasoned)
    marked = with_duplicate_flag(reviewed)
    return marked.withColumn("benchmark_applicable", S.benchmark_applicable())


def excluded_condition():
    return S.zero_benchmark() | S.invalid_allowed()


def split_clean(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded); the two conditions are complements, NULL included."""
    return flagged.where(~excluded_condition()), flagged.where(excluded_condition())


def reason_counts(flagged: DataFrame) -> DataFrame:
    zero = flagged.where(S.zero_benchmark())
    counts = zero.groupBy("zero_expected_reason").agg(F.count(F.lit(1)).alias("row_count"))
    total = zero.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("pct", F.col("row_count").cast("double") / total * 100.0)


def before_after(flagged: DataFrame) -> DataFrame:
    """Rows, mean, median, underpaid rate and invalid rows, before and after exclusion."""
    kept = ~excluded_condition()
    shaped = flagged.select(
        F.col("Payment_Gap_Pct").alias("before"),
        F.when(kept, F.col("Payment_Gap_Pct")).alias("after"),
        F.col("Is_Underpaid").cast("int").alias("low_before"),
        F.when(kept, F.col("Is_Underpaid").cast("int")).alias("low_after"),
        kept.alias("kept"), S.zero_benchmark().alias("zero"),
    )
    one = shaped.agg(
        F.count(F.lit(1)).cast("double").alias("n_before"), F.count_if("kept").cast("double").alias("n_after"),
        F.avg("before").alias("m_before"), F.avg("after").alias("m_after"),
        (F.avg("low_before") * 100.0).alias("u_before"), (F.avg("low_after") * 100.0).alias("u_after"),
        F.count_if("zero").cast("double").alias("zero"),
    )
    medians = exact_quantiles(shaped, ["before", "after"], [0.5], names=["q"])
    pick = medians.agg(
        F.max(F.when(F.col("column") == "before", F.col("q"))).alias("d_before"),
        F.max(F.when(F.col("column") == "after", F.col("q"))).alias("d_after"),
    )
    # Both sides hold exactly one row.
    numbers = one.withColumn("k", F.lit(1)).join(pick.withColumn("k", F.lit(1)), "k")

    def row(metric: str, before, after) -> dict:
        return {"Metric": F.lit(metric), "Before": before, "After": after}

    def two(name: str):
        return S.round_mean(name, 2)

    return one_to_rows(numbers, [
        row("Total rows", F.col("n_before"), F.col("n_after")),
        row("Mean Payment_Gap_Pct", two("m_before"), two("m_after")),
        row("Median Payment_Gap_Pct", two("d_before"), two("d_after")),
        row("Underpaid rate (%)", two("u_before"), two("u_after")),
        row("Rows with infinite/invalid gap", F.col("zero"), F.lit(0.0)),
    ])


def cleaning_summary(flagged: DataFrame) -> DataFrame:
    kept = ~excluded_condition()
    one = flagged.agg(
        F.count(F.lit(1)).alias("m0"), F.count_if(S.zero_benchmark()).alias("m1"),
        F.count_if(S.invalid_allowed()).alias("m2"), F.count_if(kept).alias("m3"),
        F.count_if(kept & F.col("review_flag")).alias("m4"),
        F.count_if(kept & F.col("duplicate_key_flag")).alias("m5"),
    )
    names = [
        "Rows before cleaning", "Rows excluded - zero expected payment",
        "Rows excluded - invalid allowed amount", "Rows in final cleaned dataset",
        "Rows flagged for review (kept)", "Rows flagged as duplicate key",
    ]
    return one_to_rows(one, [{"Metric": F.lit(n), "Value": F.col(f"m{i}")} for i, n in enumerate(names)])


def applicability_audit(cleaned: DataFrame, types: Sequence[str] = tuple(C.NON_APPLICABLE_TYPES)) -> DataFrame:
    """One row per listed provider type, absent ones with a zero count: one conditional scan."""
    kind = F.col("Rndrng_Prvdr_Type")
    one = cleaned.where(kind.isin(list(types))).agg(*[
        a for i, t in enumerate(types) for a in (
            F.count_if(kind == t).alias(f"n{i}"),
            F.avg(F.when(kind == t, F.col("Payment_Gap_Pct"))).alias(f"m{i}"),
        )
    ])
    return one_to_rows(one, [
        {"Provider_Type": F.lit(t), "Row_Count": F.col(f"n{i}"), "Mean_Gap_Pct": S.round_mean(f"m{i}", 2),
         "Reason_Excluded": F.lit(C.NON_APPLICABLE_REASON)}
        for i, t in enumerate(types)
    ])


def headline_stats(cleaned: DataFrame) -> DataFrame:
    """Rows, mean percentage, underpaid rate and dollars, before and after the flag."""
    ok, low = F.col("benchmark_applicable"), F.col("Is_Underpaid")
    dollars = F.col("Total_Dollar_Gap")
    one = cleaned.agg(
        F.count(F.lit(1)).cast("double").alias("b0"), F.count_if(ok).cast("double").alias("a0"),
        F.avg("Payment_Gap_Pct").alias("b1"), F.avg(F.when(ok, F.col("Payment_Gap_Pct"))).alias("a1"),
        (F.avg(low.cast("int")) * 100.0).alias("b2"), (F.avg(F.when(ok, low.cast("int"))) * 100.0).alias("a2"),
        F.coalesce(F.sum(F.when(low, dollars)), F.lit(0.0)).alias("b3"),
        F.coalesce(F.sum(F.when(low & ok, dollars)), F.lit(0.0)).alias("a3"),
    )
    names = ["Total rows", "Mean Payment_Gap_Pct", "Underpaid rate (%)", "Total estimated underpayment ($)"]
    return one_to_rows(one, [
        {"Metric": F.lit(n), "Before_Flag": S.round_mean(f"b{i}", 2), "After_Flag": S.round_mean(f"a{i}", 2)}
        for i, n in enumerate(names)
    ])
