"""Column expressions. Everything here stays inside Catalyst; there are no UDFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens import constants as C


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---- numeric helpers ----------------------------------------------------------------
def round_even(col: str | Column, places: int) -> Column:
    """Half-to-even rounding on the scaled value, the convention of array libraries."""
    scale = float(10**places)
    return F.rint(_c(col) * F.lit(scale)) / F.lit(scale)


def round_mean(col: str | Column, places: int) -> Column:
    """``round_even`` for aggregates: first drops the last-digit noise that depends on the order
    of summation, so a mean that is an exact tie rounds the same way on every run."""
    return round_even(round_even(col, places + 5), places)


def to_double(col: str | Column) -> Column:
    """Tolerant text-to-number: bad text and NaN become NULL."""
    number = _c(col).try_cast("double")
    return F.when(~F.isnan(number), number)


def finite(col: str | Column) -> Column:
    """NaN and +/-infinity become NULL."""
    x = _c(col)
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def clip(col: str | Column, low: float | None = None, high: float | None = None) -> Column:
    """Clamp to [low, high]; NULL stays NULL."""
    x = _c(col)
    out = x
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(x.isNotNull(), out)


def log1p_clip(col: str | Column) -> Column:
    return F.log1p(clip(_c(col).cast("double"), 0.0))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, with 0 where the denominator is 0 or either side is missing."""
    return F.coalesce(F.try_divide(_c(num), _c(den)), F.lit(0.0))


def parse_bool(col: str | Column) -> Column:
    """true / 1 / yes in any letter case are true; everything else, also NULL, is false."""
    return F.coalesce(F.lower(_c(col).cast("string")).isin("true", "1", "yes"), F.lit(False))


def correlation(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation over complete pairs; NULL for a constant side, where the built-in
    ``corr`` divides by zero under ANSI mode."""
    x, y = _c(a).cast("double"), _c(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)


def _bound(edge: float | None) -> bool:
    return edge is not None


def bucketize_right(col: str | Column, edges: Sequence[float | None], labels: Sequence[str]) -> Column:
    """Right-closed bins (e0, e1], (e1, e2], ...; None is an open end; outside -> NULL."""
    x = _c(col)
    out = F.when(x.isNull() | F.isnan(x), F.lit(None).cast("string"))
    if _bound(edges[0]):
        out = out.when(x <= F.lit(edges[0]), F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        out = out.when(x <= F.lit(upper), F.lit(label)) if _bound(upper) else out.otherwise(F.lit(label))
    return out


# ---- pricing and variance -----------------------------------------------------------
def price(work: Column, expense: Column, malpractice: Column, work_index: Column, expense_index: Column, malpractice_index: Column, factor: Column) -> Column:
    """(work x index + expense x index + malpractice x index) x factor; no expense -> 0."""
    return (work * work_index + F.coalesce(expense, F.lit(0.0)) * expense_index + malpractice * malpractice_index) * factor


def expected_amount(practice_expense: str, factor: Column) -> Column:
    names = ["WORK_RVU", practice_expense, "MP_RVU", "WORK_GPCI", "PE_GPCI", "MP_GPCI"]
    return price(*[F.col(n) for n in names], factor)


def benchmark_used() -> Column:
    return F.when(
        F.col("Place_Of_Srvc") == "F", F.col("Expected_Payment_Facility_Avg")
    ).otherwise(F.col("Expected_Payment_NonFacility_Avg"))


def with_variance(df: DataFrame) -> DataFrame:
    """Benchmark by setting, gap, gap percentage, underpaid flag and total dollar gap."""
    gap = F.col("Payment_Gap")
    return (
        df.withColumn("Expected_Payment_Used", benchmark_used())
        .withColumn("Payment_Gap", F.col("Avg_Mdcr_Alowd_Amt") - F.col("Expected_Payment_Used"))
        .withColumn("Payment_Gap_Pct", F.try_divide(gap, F.col("Expected_Payment_Used")) * 100.0)
        .withColumn("Is_Underpaid", F.coalesce(gap < 0, F.lit(False)))
        .withColumn("Total_Dollar_Gap", gap * F.col("Tot_Srvcs"))
    )


# ---- cleaning -----------------------------------------------------------------------
def zero_benchmark() -> Column:
    """The cleaning mask: the non-facility average is 0."""
    return F.coalesce(F.col("Expected_Payment_NonFacility_Avg") == 0, F.lit(False))


def undefined_pct() -> Column:
    """The outlier-step mask: a non-zero gap over a zero benchmark (an infinite percentage)."""
    return F.coalesce(
        (F.col("Expected_Payment_Used") == 0) & (F.col("Payment_Gap") != 0), F.lit(False)
    )


def invalid_allowed() -> Column:
    return F.coalesce(F.col("Avg_Mdcr_Alowd_Amt") < 0, F.lit(False))


def zero_expected_reason(code: str = "HCPCS_Cd", rules=C.ZERO_REASON_RULES) -> Column:
    reason = F.when(~zero_benchmark(), F.lit(C.ZERO_REASON_NONE))
    for pattern, label in rules:
        reason = reason.when(F.col(code).rlike(pattern), F.lit(label))
    return reason.otherwise(F.lit(C.ZERO_REASON_OTHER))


def domain_outlier(col: str | Column = "Payment_Gap_Pct") -> Column:
    x = _c(col)
    return F.coalesce((x < C.DOMAIN_LOW) | (x > C.DOMAIN_HIGH), F.lit(False))


def benchmark_applicable(types: Sequence[str] = C.NON_APPLICABLE_TYPES) -> Column:
    return F.coalesce(~F.col("Rndrng_Prvdr_Type").isin(list(types)), F.lit(True))


# ---- features -----------------------------------------------------------------------
def _digits(code: Column) -> Column:
    return code.rlike(r"^[0-9]+$")


def _code_number(code: Column) -> Column:
    return F.when(_digits(code), code.try_cast("long"))


def procedure_category(code: str | Column = "HCPCS_Cd") -> Column:
    text = _c(code)
    number = _code_number(text)
    out = None
    for low, high, label in C.PROCEDURE_RANGES:
        hit = number.between(low, high)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    for prefix, label in C.PROCEDURE_PREFIXES:
        out = out.when(text.startswith(prefix), F.lit(label))
    return out.otherwise(F.lit(C.PROCEDURE_OTHER))


def payer_type_proxy(df: DataFrame, indicator: str = "Rndrng_Prvdr_Mdcr_Prtcptg_Ind") -> Column:
    if indicator not in df.columns:
        return F.lit(C.PAYER_COLUMN_ABSENT)
    out = None
    for code, label in C.PAYER_BY_PARTICIPATION.items():
        hit = F.col(indicator) == code
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(C.PAYER_UNKNOWN))


def severity_bin() -> Column:
    return bucketize_right("Payment_Gap_Pct", C.SEVERITY_EDGES, C.SEVERITY_LABELS)


def balance_bin() -> Column:
    return bucketize_right(F.abs("Total_Dollar_Gap"), C.BALANCE_EDGES, C.BALANCE_LABELS)


def recovery_target(dollar: float = C.TARGET_DOLLAR, pct: float = C.TARGET_PCT) -> Column:
    hit = (F.col("Total_Dollar_Gap") < -dollar) & (F.col("Payment_Gap_Pct") < pct)
    return F.coalesce(hit, F.lit(False)).cast("int")


# ---- queue --------------------------------------------------------------------------
def estimated_recovery() -> Column:
    """Cents, half to even. The gap inherits the last-digit noise of averaged benchmarks, so an
    exact half cent is settled first; otherwise task order could move a cent between runs."""
    return round_mean(F.abs("Total_Dollar_Gap"), 2)


def is_surgical(code: str | Column = "HCPCS_Cd") -> Column:
    return F.coalesce(_code_number(_c(code)).between(C.SURGICAL_LOW, C.SURGICAL_HIGH), F.lit(False))


def requires_modifier_review() -> Column:
    listed = F.coalesce(F.col("Rndrng_Prvdr_Type").isin(C.MODIFIER_REVIEW_TYPES), F.lit(False))
    fixed_code = F.coalesce(F.col("HCPCS_Cd") == C.MODIFIER_REVIEW_CODE, F.lit(False))
    severe = F.coalesce(F.col("Payment_Gap_Pct") <= C.MODIFIER_REVIEW_PCT, F.lit(False))
    return is_surgical() & severe & (listed | fixed_code)


def modifier_review_reason() -> Column:
    return F.when(requires_modifier_review(), F.lit(C.MODIFIER_REVIEW_REASON)).otherwise(F.lit(""))


def rule_confidence(rules=C.CONFIDENCE_RULES) -> Column:
    dollars, severity = F.abs("Total_Dollar_Gap"), F.abs("Payment_Gap_Pct")
    *ordered, default = sorted(rules)
    out = None
    for _, min_dollars, min_pct, score, _ in ordered:
        hit = (dollars >= min_dollars) & (severity >= min_pct)
        out = F.when(hit, F.lit(score)) if out is None else out.when(hit, F.lit(score))
    return out.otherwise(F.lit(default[3]))


def confidence_score() -> Column:
    return F.coalesce(F.col("collection_probability"), F.col("rule_confidence_score"))


def predicted_high(threshold: str | Column) -> Column:
    return F.coalesce(F.col("collection_probability") >= _c(threshold), F.lit(False))


def priority_score() -> Column:
    return round_even(F.col("estimated_recovery") * F.col("confidence_score"), 2)


def score_tier(col: str | Column = "priority_score") -> Column:
    out = None
    for floor, label in C.SCORE_TIERS:
        hit = _c(col) >= floor
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit("Low"))


def _by_label(col: str | Column, mapping: dict[str, str], default: str) -> Column:
    out = None
    for key, text in mapping.items():
        hit = _c(col) == key
        out = F.when(hit, F.lit(text)) if out is None else out.when(hit, F.lit(text))
    return out.otherwise(F.lit(default))


def score_action(tier: str | Column = "priority_tier") -> Column:
    return _by_label(tier, C.SCORE_ACTIONS, C.SCORE_ACTIONS["Low"])


# ---- probability scale (claim scorer) -----------------------------------------------
def probability_tier(prob: str | Column, threshold: float) -> Column:
    p = _c(prob)
    return (
        F.when(p >= 0.80, "Critical")
        .when(p >= max(0.60, threshold), "High")
        .when(p >= min(0.40, threshold), "Medium")
        .otherwise("Low")
    )


def probability_action(tier: str | Column) -> Column:
    return _by_label(tier, C.PROBABILITY_ACTIONS, "Review manually")


def recovery_signal(prob: str | Column) -> Column:
    out = None
    for floor, text in C.PROBABILITY_SIGNALS:
        hit = _c(prob) >= floor
        out = F.when(hit, F.lit(text)) if out is None else out.when(hit, F.lit(text))
    return out.otherwise(F.lit(C.PROBABILITY_SIGNAL_LOW))


def factor_label(name: str) -> str:
    return C.RISK_FACTOR_LABELS.get(name, name.replace("_", " ").title())


def top_risk_factors(feature_cols: Sequence[str], n: int = 3) -> Column:
    """Labels of the n non-zero features of largest magnitude (ties keep column order)."""
    entries = F.array(*[
        F.struct(
            (-F.abs(F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(0.0)))).alias("size"),
            F.lit(i).alias("pos"),
            F.lit(factor_label(name)).alias("label"),
        )
        for i, name in enumerate(feature_cols)
    ])
    kept = F.slice(F.array_sort(F.filter(entries, lambda e: e["size"] != 0)), 1, n)
    return F.when(F.size(kept) == 0, F.array(F.lit(C.RISK_FACTOR_NONE))).otherwise(
        F.transform(kept, lambda e: e["label"])
    )


def chart_label(code: str = "HCPCS_Cd", state: str = "Rndrng_Prvdr_State_Abrvtn") -> Column:
    return F.concat_ws(" · ", F.col(code), F.col(state))


# ---- hashing: the same text in every engine -----------------------------------------
def row_hash(keys: Sequence[str], seed: int = 42) -> Column:
    """md5 text of the keys and a seed."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def hash_number(hashed: Column) -> Column:
    """First 60 bits of an md5 text as a non-negative long."""
    return F.conv(F.substring(hashed, 1, 15), 16, 10).cast("long")
