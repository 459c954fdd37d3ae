"""Edge values of every scalar rule."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from remitlens.functions import scalars as S


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_round_even_matches_array_rounding(spark):
    xs = [0.125, 0.375, 2.5, -2.5, 117.2775, 0.095, 1e9 + 0.005, -0.125, 3.14159]
    got = values(spark, S.round_even("x", 2), [(x,) for x in xs], "x double")
    assert got == [float(v) for v in np.round(np.array(xs), 2)]


def test_to_double_and_finite(spark):
    got = values(spark, S.to_double("s"), [("1.5",), ("abc",), ("",), ("NaN",), (None,), ("-2",)], "s string")
    assert got == [1.5, None, None, None, None, -2.0]
    inf = float("inf")
    assert values(spark, S.finite("x"), [(inf,), (-inf,), (math.nan,), (None,), (1.0,)], "x double") == [None] * 4 + [1.0]


def test_right_closed_bins(spark):
    pct = [-100.0, -50.0, -49.9, -20.0, -5.0, -4.9, 0.0, None]
    got = values(spark, S.severity_bin(), [(p,) for p in pct], "Payment_Gap_Pct double")
    assert got == ["Severe_Underpayment"] * 2 + ["Moderate_Underpayment"] * 2 + ["Minor_Underpayment"] + ["At_or_Above_Expected"] * 2 + [None]
    gaps = [0.0, -100.0, 100.01, 1000.0, 10000.0, -10000.01, None]
    got = values(spark, S.balance_bin(), [(g,) for g in gaps], "Total_Dollar_Gap double")
    assert got == [None, "Small_<$100", "Medium_$100-1k", "Medium_$100-1k", "Large_$1k-10k", "Very_Large_>$10k", None]


def test_procedure_category(spark):
    cases = {
        "99201": "Evaluation_and_Management", "99499": "Evaluation_and_Management", "99200": "Other", "99500": "Other",
        "10000": "Integumentary_Surgery", "69999": "Nervous_System_Surgery", "70000": "Radiology", "00100": "Other",
        "99199": "Medicine_Services", "J1234": "Drugs", "G0008": "HCPCS_G_Codes", "Q1": "HCPCS_Q_Codes_Supplies",
        "A9999": "HCPCS_A_Codes_Supplies", "K0001": "Other", "": "Other", "1234X": "Other", "-": "Other",
    }
    got = values(spark, S.procedure_category("c"), [(c,) for c in cases], "c string")
    assert got == list(cases.values())
    assert values(spark, S.procedure_category("c"), [(None,)], "c string") == ["Other"]


def test_payer_proxy_with_and_without_the_column(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("x",), (None,)], "Rndrng_Prvdr_Mdcr_Prtcptg_Ind string")
    got = [r[0] for r in df.select(S.payer_type_proxy(df)).collect()]
    assert got == ["Medicare_Participating", "Medicare_NonParticipating", "Unknown", "Unknown"]
    other = spark.createDataFrame([(1,)], "a int")
    assert other.select(S.payer_type_proxy(other)).first()[0] == "Medicare_FFS_Only"


def test_variance_and_zero_benchmarks(spark):
    rows = [
        ("O", 100.0, 50.0, 80.0, 2.0), ("F", 100.0, 50.0, 80.0, 2.0), ("O", 0.0, 0.0, 5.0, 1.0), ("O", 0.0, 0.0, 0.0, 1.0),
        ("F", 100.0, 0.0, 5.0, 1.0), ("O", 100.0, 50.0, None, 1.0),
    ]
    schema = "Place_Of_Srvc string, Expected_Payment_NonFacility_Avg double, Expected_Payment_Facility_Avg double, Avg_Mdcr_Alowd_Amt double, Tot_Srvcs double"
    df = S.with_variance(spark.createDataFrame(rows, schema)).withColumns(
        {"zero": S.zero_benchmark(), "undefined": S.undefined_pct()})
    got = [(r.Payment_Gap, r.Payment_Gap_Pct, r.Is_Underpaid, r.Total_Dollar_Gap, r.zero, r.undefined) for r in df.collect()]
    assert got == [
        (-20.0, -20.0, True, -40.0, False, False), (30.0, 60.0, False, 60.0, False, False),
        (5.0, None, False, 5.0, True, True), (0.0, None, False, 0.0, True, False),
        (5.0, None, False, 5.0, False, True), (None, None, False, None, False, False),
    ]


def test_zero_reason_rules_first_match_wins(spark):
    codes = ["80053", "00100", "J1100", "A0428", "Q4100", "G0008", "K0001", "12345", "L1234"]
    df = spark.createDataFrame([(c, 0.0) for c in codes] + [("80053", 5.0)], "HCPCS_Cd string, Expected_Payment_NonFacility_Avg double")
    got = [r[0] for r in df.select(S.zero_expected_reason()).collect()]
    assert got == [
        "Pathology/Laboratory (CPT 80000-89999)", "Anesthesia (CPT 00100-00999, time-based pricing)", "Drugs - ASP pricing (J-codes)",
        "DME/Supplies (HCPCS Level II)", "DME/Supplies (HCPCS Level II)", "Other HCPCS Level II (G/K/etc.)", "Other HCPCS Level II (G/K/etc.)",
        "Other/Unclassified HCPCS code", "Other/Unclassified HCPCS code", "N/A - has valid expected payment",
    ]


def test_domain_and_applicability(spark):
    assert values(spark, S.domain_outlier("x"), [(-100.0,), (-100.1,), (200.0,), (200.1,), (None,)], "x double") == [False, True, False, True, False]
    got = values(spark, S.benchmark_applicable(), [("Nuclear Medicine",), ("Cardiology",), (None,)], "Rndrng_Prvdr_Type string")
    assert got == [False, True, True]


def test_target_thresholds_are_strict(spark):
    rows = [(-50.0, -20.0), (-50.01, -10.0), (-50.01, -10.01), (None, -20.0), (-60.0, None)]
    assert values(spark, S.recovery_target(), rows, "Total_Dollar_Gap double, Payment_Gap_Pct double") == [0, 0, 1, 0, 0]


def test_confidence_tiers_and_actions(spark):
    rows = [(-5000.0, -50.0), (-4999.0, -50.0), (-1000.0, -25.0), (-100.0, -10.0), (-99.0, -90.0), (-9000.0, None)]
    assert values(spark, S.rule_confidence(), rows, "Total_Dollar_Gap double, Payment_Gap_Pct double") == [0.95, 0.85, 0.85, 0.7, 0.5, 0.5]
    df = spark.createDataFrame([(50000.0,), (49999.99,), (10000.0,), (1000.0,), (999.99,)], "priority_score double")
    tiers = [tuple(r) for r in df.select(S.score_tier().alias("t"), S.score_action(S.score_tier())).collect()]
    assert [t for t, _ in tiers] == ["Critical", "High", "High", "Medium", "Low"]
    assert tiers[0][1] == "Immediate contract variance review" and tiers[4][1] == "Monitor or include in batch audit"


@pytest.mark.parametrize("threshold, expected", [(0.40, ["Critical", "High", "Medium", "Low"]), (0.70, ["Critical", "Medium", "Medium", "Low"])])
def test_probability_tier(spark, threshold, expected):
    assert values(spark, S.probability_tier("p", threshold), [(0.8,), (0.6,), (0.4,), (0.39,)], "p double") == expected


def test_modifier_review(spark):
    rows = [
        ("66984", -70.0, "Cardiology"), ("66984", -69.9, "Cardiology"), ("20000", -80.0, "Optometry"), ("20000", -80.0, "Cardiology"),
        ("99213", -80.0, "Optometry"), ("J1234", -80.0, "Optometry"), ("10000", -70.0, None),
    ]
    df = spark.createDataFrame(rows, "HCPCS_Cd string, Payment_Gap_Pct double, Rndrng_Prvdr_Type string")
    assert [r[0] for r in df.select(S.requires_modifier_review()).collect()] == [True, False, True, False, False, False, False]
    assert [r[0] != "" for r in df.select(S.modifier_review_reason()).collect()] == [True, False, True, False, False, False, False]


def test_ratio_log_bool_and_clip(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 2.0), (-3.0, None)], "a double, b double")
    assert [r[0] for r in df.select(S.safe_ratio("a", "b")).collect()] == [0.5, 0.0, 0.0, 0.0]
    assert [r[0] for r in df.select(S.log1p_clip("a")).collect()] == [math.log(2), math.log(2), None, 0.0]
    assert [r[0] for r in df.select(S.clip("a", -1, 0.5)).collect()] == [0.5, 0.5, None, -1.0]
    assert values(spark, S.parse_bool("s"), [("True",), ("1",), ("yes",), ("no",), (None,)], "s string") == [True, True, True, False, False]


def test_top_risk_factors(spark):
    df = spark.createDataFrame([(1.0, -5.0, 0.0, 5.0), (0.0, 0.0, None, 0.0)], "Tot_Srvcs_log double, b_c double, services_per_beneficiary double, d double")
    got = [r[0] for r in df.select(S.top_risk_factors(df.columns, 3)).collect()]
    assert got == [["B C", "D", "High service volume"], ["No strong risk factors detected"]]


def test_hash_text_is_plain_md5(spark):
    import hashlib

    df = spark.createDataFrame([(7, "a", None)], "k long, s string, n string")
    text = df.select(S.row_hash(["k", "s", "n"], 42)).first()[0]
    assert text == hashlib.md5(b"7|a|42").hexdigest()
    assert df.select(S.hash_number(F.lit(text))).first()[0] == int(text[:15], 16)
