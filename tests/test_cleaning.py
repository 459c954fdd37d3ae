"""Missing values, outliers, duplicates and exclusions on small hand-made rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from remitlens.operators import cleaning, outliers, profiling, variance


def test_missing_tokens_blanks_and_signals(spark):
    rows = [("NA", 1.0, 1), (" unknown ", -1.0, 0), (None, float("inf"), 2), ("  ", 0.0, -3), ("\t", None, 5), ("ok", 2.0, 6)]
    got = {(r["Column"], r["Null_Type"]): r for r in profiling.detect_missing(spark.createDataFrame(rows, "s string, x double, n int")).collect()}
    count = {k: r["Count"] for k, r in got.items()}
    assert count == {
        ("s", "Standard NaN/None"): 1, ("s", 'String "nan"'): 1, ("s", 'String "NA"'): 1, ("s", 'String "unknown"'): 1,
        ("s", 'String ""'): 2, ("s", 'String " "'): 2, ("s", 'String "  "'): 2, ("s", "Whitespace Only"): 2,
        ("x", "Standard NaN/None"): 1, ("x", "Zero (0) values - review only"): 1, ("x", "Negative values - review only"): 1, ("x", "Inf / -Inf"): 1,
        ("n", "Zero (0) values - review only"): 1, ("n", "Negative values - review only"): 1,
    }
    assert got[("x", "Zero (0) values - review only")]["Flag_Category"] == "Review Only"
    assert got[("x", "Inf / -Inf")]["Flag_Category"] == "Null / Missing"
    assert got[("s", 'String "NA"')]["Percentage"] == 16.67


def test_profile_exact_and_approximate(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "s string, n long")
    want = {("s", "string", 2, 1, "a"), ("n", "bigint", 3, 3, "1")}
    assert set(map(tuple, profiling.profile_columns(df).collect())) == want
    assert set(map(tuple, profiling.profile_columns(df, approx=True).collect())) == want


def test_coercion_audit(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("2.5",)], "v string")
    assert tuple(profiling.coercion_audit(df, ["v"]).first()) == ("v", 1, 2)


@pytest.mark.parametrize("seed", [0, 1])
def test_bounds_match_numpy(spark, seed):
    x = np.random.default_rng(seed).normal(10, 50, 501)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "Payment_Gap_Pct double")
    b = outliers.fit_bounds(df, ["Payment_Gap_Pct"])["Payment_Gap_Pct"]
    assert b.n == 501 and b.mean == pytest.approx(x.mean()) and b.sd == pytest.approx(x.std(ddof=1))
    assert [b.q01, b.q25, b.median, b.q75, b.q99] == pytest.approx(list(np.quantile(x, [0.01, 0.25, 0.5, 0.75, 0.99])))
    assert b.mad == pytest.approx(np.median(abs(x - np.median(x))))
    flagged = df.where(outliers.modified_z_outlier("Payment_Gap_Pct", b)).count()
    assert flagged == int((abs(0.6745 * (x - np.median(x)) / b.mad) > 3.5).sum())


def test_constant_column_flags_nothing(spark):
    df = spark.createDataFrame([(5.0,)] * 9, "Payment_Gap_Pct double")
    bounds = outliers.fit_bounds(df, ["Payment_Gap_Pct"])
    table = outliers.outlier_comparison(df, bounds).collect()
    assert {r["Method"]: r["Flagged_Count"] for r in table} == {
        "IQR": 0, "Z-Score": 0, "Percentile (1/99)": 0, "Modified Z-Score": 0, "Domain Rule (CMS context)": 0}


def test_duplicates_include_null_keys(spark):
    rows = [(1, "a"), (1, "a"), (2, "a"), (None, "b"), (None, "b"), (3, None)]
    got = cleaning.with_duplicate_flag(spark.createDataFrame(rows, "k long, p string"), ["k", "p"]).collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted(
        [(1, "a", True), (1, "a", True), (2, "a", False), (None, "b", True), (None, "b", True), (3, None, False)], key=str)


def test_null_code_stays_unmatched(spark):
    pay = spark.createDataFrame([(1, None, "S"), (2, "c", "S"), (3, "d", "S")], "Rndrng_NPI long, HCPCS_Cd string, Rndrng_Prvdr_State_Abrvtn string")
    bench = spark.createDataFrame([(None, "S", 1.0), ("c", "S", 2.0), ("d", "S", None)], "HCPCS string, State string, Expected_Payment_NonFacility_Avg double")
    assert sorted(r["Rndrng_NPI"] for r in variance.unmatched(pay, bench).collect()) == [1, 3]
    matched, rest = variance.split_matched(variance.join_benchmark(pay, bench))
    assert [r["Rndrng_NPI"] for r in matched.collect()] == [2] and rest.count() == 2


def test_partitions_of_the_claims(stages):
    n = stages.claims.count()
    assert stages.cleaned.count() + stages.excluded.count() == n == stages.flagged.count()
    matched, rest = variance.split_matched(stages.joined)
    assert matched.count() == n and matched.count() + rest.count() == stages.payments.count()
    assert variance.unmatched(stages.payments, stages.benchmark).count() == rest.count()


def test_negative_allowed_is_excluded(stages):
    odd = stages.flagged.limit(10).withColumn("Avg_Mdcr_Alowd_Amt", F.lit(-1.0))
    kept, out = cleaning.split_clean(odd)
    assert (kept.count(), out.count()) == (0, 10)


def test_benchmark_short_cut_equals_the_long_way(stages):
    from remitlens.operators import pricing

    long = pricing.state_average(stages.expected).drop("Locality_Count")
    short = stages.benchmark
    both = long.alias("a").join(short.alias("b"), ["HCPCS", "State"])
    assert both.count() == long.count() == short.count()
    assert both.where(F.abs(F.col("a.Expected_Payment_NonFacility_Avg") - F.col("b.Expected_Payment_NonFacility_Avg")) > 1e-9).count() == 0


def test_conversion_factor_rule(spark):
    from remitlens.operators.pricing import resolve_conversion_factor

    def factor(values):
        return resolve_conversion_factor(spark.createDataFrame([(v,) for v in values], "CONVERSION_FACTOR_FROM_FILE double")).first()[0]

    assert factor([30.5, 30.5, None]) == 30.5
    assert factor([30.5, 31.0]) == 33.8872
    assert factor([None, None]) == 33.8872
