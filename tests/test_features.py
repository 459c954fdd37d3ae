"""Context features against pandas group sums, with hot and missing keys; skew; leakage."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from remitlens import constants as C
from remitlens.operators import encoding, features, splits, target


@pytest.fixture(scope="module")
def claims(spark):
    rng = np.random.default_rng(2)
    n = 400
    pdf = pd.DataFrame({
        "Rndrng_NPI": np.where(rng.random(n) < 0.4, 1, rng.integers(2, 40, n)),
        "HCPCS_Cd": np.where(rng.random(n) < 0.4, "99213", rng.integers(10000, 10020, n).astype(str)),
        "Rndrng_Prvdr_State_Abrvtn": rng.choice(["CA", "TX", "NY"], n),
        "Tot_Srvcs": rng.integers(0, 50, n).astype(float), "Tot_Benes": rng.integers(0, 5, n).astype(float),
        "Avg_Sbmtd_Chrg": rng.random(n) * 100, "row": np.arange(n),
    })
    pdf.loc[5, "HCPCS_Cd"] = None
    pdf.loc[6, "Rndrng_Prvdr_State_Abrvtn"] = None
    pdf.loc[7, "Tot_Srvcs"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "Rndrng_NPI long, HCPCS_Cd string, Rndrng_Prvdr_State_Abrvtn string, Tot_Srvcs double, Tot_Benes double, Avg_Sbmtd_Chrg double, row long")
    return df, pdf


def test_context_features(claims):
    df, pdf = claims
    got = features.context_features(df).toPandas().sort_values("row").reset_index(drop=True)
    assert len(got) == len(pdf)
    for name, key in (("provider", "Rndrng_NPI"), ("hcpcs", "HCPCS_Cd"), ("state", "Rndrng_Prvdr_State_Abrvtn")):
        by = pdf.groupby(key)["Tot_Srvcs"]
        np.testing.assert_allclose(got[f"{name}_row_count"].astype(float), by.transform("size").astype(float))
        np.testing.assert_allclose(got[f"{name}_total_services"].astype(float), by.transform("sum"))
    cell = pdf.groupby(["Rndrng_Prvdr_State_Abrvtn", "HCPCS_Cd"])["row"].transform("size")
    share = (cell / pdf.groupby("Rndrng_Prvdr_State_Abrvtn")["row"].transform("size")).fillna(0)
    np.testing.assert_allclose(got["hcpcs_state_row_share"], share)
    charge = (pdf["Avg_Sbmtd_Chrg"] * pdf["Tot_Srvcs"] / pdf["Tot_Benes"].replace(0, np.nan)).fillna(0)
    np.testing.assert_allclose(got["avg_charge_per_beneficiary"], charge)


def test_skew_is_the_sample_form(spark):
    x = pd.Series(np.random.default_rng(0).exponential(10, 300))
    df = spark.createDataFrame([(float(v), float(np.log1p(v))) for v in x], "Tot_Srvcs double, Tot_Srvcs_log double")
    r = features.skew_report(df, ["Tot_Srvcs"]).first()
    assert r["skew_before"] == pytest.approx(x.skew()) and r["skew_after"] == pytest.approx(np.log1p(x).skew())


def test_leakage_audit_orders_and_alarms(spark):
    df = spark.createDataFrame([(float(i), 1.0, int(i > 5), i * 2) for i in range(10)], f"a double, constant double, {C.TARGET} int, b long")
    rows = target.leakage_audit(df).collect()
    assert [r["Feature"] for r in rows] == ["a", "b", "constant"]
    assert rows[0]["needs_review"] and rows[2]["Correlation_with_Target"] is None


def test_onehot_does_not_depend_on_the_batch(spark):
    df = spark.createDataFrame([("a", "O"), ("b", "F"), ("c", "O"), (None, "F")], "k string, p string")
    vocab = encoding.fit_onehot(df, ["k", "p"])
    assert vocab == {"k": ["b", "c"], "p": ["O"]}
    one = encoding.apply_onehot(spark.createDataFrame([("c", "new")], "k string, p string"), vocab).first()
    assert (one["k_b"], one["k_c"], one["p_O"]) == (0.0, 1.0, 0.0)


def test_model_features_exclude_leakage_ids_and_booleans(stages):
    names = encoding.model_features(stages.modeling)
    assert len(names) == 24 or len(names) == 25
    assert not set(names) & {*C.LEAKAGE_COLUMNS, *C.MODEL_ID_COLUMNS, C.TARGET, "review_flag", "duplicate_key_flag"}


def test_target_encoding_unseen_level(spark):
    train = spark.createDataFrame([("a", 10.0)] * 5 + [("b", 20.0)] * 5, "k string, y double")
    table = encoding.fit_target_encoding(train, "k", "y")
    got = {r["level"]: r["encoding"] for r in table.collect()}
    assert got == {"a": pytest.approx((50 + 15 * 25) / 30), "b": pytest.approx((100 + 15 * 25) / 30)}
    test = encoding.apply_encoding(spark.createDataFrame([("a",), ("z",), (None,)], "k string"), table, "k", 15.0)
    assert {r["k"]: r["k_target_enc"] for r in test.collect()} == {"a": got["a"], "z": 15.0, None: 15.0}


def test_split_and_folds_partition_the_rows(stages):
    train, held = splits.split(stages.modeling)
    n = stages.modeling.count()
    assert train.count() + held.count() == n and 0.1 < held.count() / n < 0.3
    assert splits.fold_col(stages.modeling, 5).where(~F.col("fold").between(0, 4)).count() == 0
