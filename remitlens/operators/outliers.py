"""Outlier bounds (IQR, z-score, percentiles, modified z-score, domain rule) and flags.

Bounds are fitted like a model: two quantile passes give a handful of numbers per column, which
then travel as literals into filters and counters.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens import constants as C
from remitlens.functions import scalars as S
from remitlens.operators.ordering import exact_quantiles, top_n
from remitlens.operators.tables import one_to_rows


@dataclass(frozen=True)
class Bounds:
    """Fitted numbers of one column; None when it had no usable value."""

    n: int
    mean: float | None
    sd: float | None
    q01: float | None
    q25: float | None
    median: float | None
    q75: float | None
    q99: float | None
    mad: float | None

    def iqr(self) -> tuple[float, float]:
        spread = C.IQR_MULTIPLIER * (self.q75 - self.q25)
        return self.q25 - spread, self.q75 + spread

    def z(self) -> tuple[float, float]:
        reach = C.Z_THRESHOLD * (self.sd or 0.0)
        return self.mean - reach, self.mean + reach

    def percentile(self) -> tuple[float, float]:
        return self.q01, self.q99

    def modified_z(self) -> tuple[float, float]:
        reach = C.MODIFIED_Z_THRESHOLD / C.MODIFIED_Z_SCALE * (self.mad or 0.0)
        return self.median - reach, self.median + reach


_PROBS = {"q01": 0.01, "q25": 0.25, "median": 0.5, "q75": 0.75, "q99": 0.99}


def fit_bounds(df: DataFrame, cols: Sequence[str]) -> dict[str, Bounds]:
    """Moments, five quantiles and the MAD of every column, NULLs skipped."""
    moments = df.agg(*[
        a for c in cols for a in (F.avg(c).alias(f"{c}__m"), F.stddev_samp(c).alias(f"{c}__s"))
    ]).first()
    # One row per column (a handful), so reading them to the driver is bounded by len(cols).
    rows = {r["column"]: r for r in exact_quantiles(df, cols, list(_PROBS.values()), names=list(_PROBS)).collect()}
    known = [c for c in cols if c in rows]
    deviations = df.select(*[F.abs(F.col(c) - F.lit(rows[c]["median"])).alias(c) for c in known])
    mads = {r["column"]: r["mad"] for r in exact_quantiles(deviations, known, [0.5], names=["mad"]).collect()} if known else {}
    return {
        c: Bounds(
            n=rows[c]["n"] if c in rows else 0, mean=moments[f"{c}__m"], sd=moments[f"{c}__s"],
            mad=mads.get(c), **{k: (rows[c][k] if c in rows else None) for k in _PROBS},
        )
        for c in cols
    }


def outside(col: str, bounds: tuple[float, float]) -> Column:
    x = F.col(col)
    return F.coalesce((x < F.lit(bounds[0])) | (x > F.lit(bounds[1])), F.lit(False))


def z_outlier(col: str, b: Bounds) -> Column:
    if not b.sd:
        return F.lit(False)
    return F.coalesce(F.abs((F.col(col) - b.mean) / b.sd) > C.Z_THRESHOLD, F.lit(False))


def modified_z_outlier(col: str, b: Bounds) -> Column:
    if not b.mad:
        return F.lit(False)
    score = F.lit(C.MODIFIED_Z_SCALE) * (F.col(col) - F.lit(b.median)) / F.lit(b.mad)
    return F.coalesce(F.abs(score) > C.MODIFIED_Z_THRESHOLD, F.lit(False))


def usable_rows(claims: DataFrame) -> DataFrame:
    """Population of the outlier step: rows whose percentage is not infinite."""
    return claims.where(~S.undefined_pct())


def bounds_table(bounds: dict[str, Bounds], df: DataFrame) -> DataFrame:
    """The fitted numbers as a table (one row per column)."""
    one = df.sparkSession.range(1)
    def num(x: float | None) -> Column:
        return F.lit(x).cast("double")
    return one_to_rows(one, [
        {"Column": F.lit(c), "n": F.lit(b.n).cast("long"), "mean": num(b.mean), "sd": num(b.sd),
         "q01": num(b.q01), "q25": num(b.q25), "median": num(b.median), "q75": num(b.q75),
         "q99": num(b.q99), "mad": num(b.mad)}
        for c, b in bounds.items()
    ])


def outlier_comparison(df: DataFrame, bounds: dict[str, Bounds]) -> DataFrame:
    """Bounds and flagged rows per (column, method), plus the domain rule: one scan."""
    tests: list[tuple[str, str, tuple[float, float], Column, Column]] = []
    for i, (c, b) in enumerate(bounds.items()):
        if not b.n:
            continue
        filled = F.col(f"n{i}")
        z = b.z() if b.sd else (b.mean, b.mean)
        tests += [
            (c, "IQR", b.iqr(), outside(c, b.iqr()), filled),
            (c, "Z-Score", z, z_outlier(c, b), filled),
            (c, "Percentile (1/99)", b.percentile(), outside(c, b.percentile()), filled),
            (c, "Modified Z-Score", b.modified_z(), modified_z_outlier(c, b), filled),
        ]
    tests.append((
        "Payment_Gap_Pct", "Domain Rule (CMS context)", (C.DOMAIN_LOW, C.DOMAIN_HIGH),
        S.domain_outlier(), F.col("rows"),
    ))
    one = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(bounds)],
        *[F.count_if(t[3]).alias(f"hit{j}") for j, t in enumerate(tests)],
    )
    return one_to_rows(one, [
        {
            "Column": F.lit(c), "Method": F.lit(method),
            "Lower_Bound": S.round_even(F.lit(float(lo)), 2), "Upper_Bound": S.round_even(F.lit(float(hi)), 2),
            "Flagged_Count": F.col(f"hit{j}"),
            "Flagged_Pct": S.round_even(F.try_divide(F.col(f"hit{j}").cast("double"), size) * 100.0, 2),
        }
        for j, (c, method, (lo, hi), _, size) in enumerate(tests)
    ])


def outlier_flags(claims: DataFrame, pct: Bounds) -> DataFrame:
    """Domain, modified-z, undefined-percentage and combined flags on every row."""
    undefined = S.undefined_pct()
    return (
        claims.withColumn("zero_expected_payment_flag", undefined)
        .withColumn("outlier_domain_rule", S.domain_outlier() & ~undefined)
        .withColumn("outlier_modified_zscore", modified_z_outlier("Payment_Gap_Pct", pct) & ~undefined)
        .withColumn(
            "outlier_any_flag",
            F.col("outlier_domain_rule") | F.col("outlier_modified_zscore") | F.col("zero_expected_payment_flag"),
        )
    )


def outlier_overlap(flagged: DataFrame) -> DataFrame:
    domain, modz = F.col("outlier_domain_rule"), F.col("outlier_modified_zscore")
    either = F.count_if("outlier_any_flag")
    return flagged.agg(
        F.count_if(domain & ~modz).alias("domain_only"),
        F.count_if(~domain & modz).alias("modified_z_only"),
        F.count_if(domain & modz).alias("both"),
        either.alias("either"),
        (F.try_divide(either.cast("double"), F.count(F.lit(1))) * 100.0).alias("either_pct"),
    )


def outliers_by_code(flagged: DataFrame, min_rows: int = 30) -> DataFrame:
    """Outlier rate per code; the mean percentage skips undefined rows in the same aggregate."""
    rows, hits = F.count(F.lit(1)), F.count_if("outlier_any_flag")
    pct = F.when(~F.col("zero_expected_payment_flag"), F.col("Payment_Gap_Pct"))
    return (
        flagged.where(F.col("HCPCS_Cd").isNotNull())
        .groupBy("HCPCS_Cd")
        .agg(
            rows.alias("Total_Rows"), hits.alias("Outlier_Rows"),
            F.count_if("zero_expected_payment_flag").alias("Zero_Expected_Rows"),
            F.avg(pct).alias("Mean_Gap_Pct"),
            (hits.cast("double") / rows * 100.0).alias("Outlier_Rate_Pct"),
        )
        .where(F.col("Total_Rows") >= min_rows)
        .orderBy(F.col("Outlier_Rate_Pct").desc(), "HCPCS_Cd")
    )


def outlier_sample(flagged: DataFrame, n: int = 500) -> DataFrame:
    keys = [F.col(k) for k in (*C.CLAIM_KEY, "Rndrng_Prvdr_State_Abrvtn")]
    return top_n(flagged.where("outlier_any_flag"), keys, n)


def with_review_flag(claims: DataFrame) -> DataFrame:
    """Domain rule or modified z-score, fitted on and applied to non-zero benchmarks only."""
    valid = ~S.zero_benchmark()
    pct = fit_bounds(claims.where(valid), ["Payment_Gap_Pct"])["Payment_Gap_Pct"]
    hit = S.domain_outlier() | modified_z_outlier("Payment_Gap_Pct", pct)
    return claims.withColumn("review_flag", valid & hit)
