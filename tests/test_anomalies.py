"""Isolation forest: planted outliers surface, sampling is bounded, runs repeat."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from remitlens import constants as C
from remitlens.operators import anomalies as A


@pytest.fixture(scope="module")
def groups(spark):
    rng = np.random.default_rng(4)
    rows = [(str(i), *[float(v) for v in rng.normal(0, 1, 6)], 1.0) for i in range(1500)]
    rows += [(f"odd{i}", *[9.0 + i] * 6, 1.0) for i in range(5)]
    names = ", ".join(f"`{c}` double" for c in C.PATTERN_FEATURES)
    return spark.createDataFrame(rows, f"k string, {names}, extra double")


def test_each_tree_sees_a_full_small_sample(groups):
    for psi in (64, 5000):
        sizes = A.sample_per_tree(groups.select("k", *C.PATTERN_FEATURES), ["k"], 20, psi, 1505, 1).groupBy("tree").agg(
            F.count("*").alias("n"), F.count_distinct("k").alias("d")).collect()
        assert len(sizes) == 20 and all(r["n"] == r["d"] == min(psi, 1505) for r in sizes)


def test_planted_outliers_score_highest_and_repeatably(groups):
    first = A.detect_anomalies(groups, ["k"], trees=60, psi=128)
    again = A.detect_anomalies(groups.repartition(5), ["k"], trees=60, psi=128)
    a = {r["k"]: r["anomaly_score"] for r in first.collect()}
    assert a == {r["k"]: r["anomaly_score"] for r in again.collect()}
    top = sorted(a, key=a.get, reverse=True)[:5]
    assert set(top) == {f"odd{i}" for i in range(5)}
    flagged = first.where("anomaly_flag").count()
    assert abs(flagged - 150) <= 2


def test_average_path_length():
    assert A.average_path(1) == 0.0 and A.average_path(2) == 1.0
    assert A.average_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_patterns_keep_null_groups(spark):
    rows = [(None, "t", "c", "O", True, -10.0, -5.0, 1.0)] * 3 + [("S", "t", "c", "O", False, 4.0, 2.0, None)] * 2
    df = spark.createDataFrame(rows, "Rndrng_Prvdr_State_Abrvtn string, Rndrng_Prvdr_Type string, HCPCS_Cd string, Place_Of_Srvc string, Is_Underpaid boolean, Total_Dollar_Gap double, Payment_Gap_Pct double, Tot_Srvcs double")
    got = {r["Rndrng_Prvdr_State_Abrvtn"]: r for r in A.underpayment_patterns(df, min_rows=2).collect()}
    assert got[None]["total_estimated_recovery"] == 30.0 and got[None]["avg_gap_pct"] == 5.0
    assert got["S"]["avg_gap_pct"] == 0.0 and got["S"]["avg_total_services"] is None
