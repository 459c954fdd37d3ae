"""Stage tables move narrow rows: wide claims are written once and not shuffled for lookups."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from remitlens.operators import cleaning, eda, features, ordering, splits
from remitlens.plans.stages import Stages
from remitlens.schemas import CLAIM_COLUMNS, GPCI, PAYMENTS, RVU


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def few(spark):
    rows = [(p, s, c, 10.0 * i, float(i), 5.0) for i, (p, s, c) in enumerate(
        [(1, "A", "x"), (1, "A", "x"), (1, "B", "x"), (2, "B", "y"), (2, None, "x"), (None, "A", None), (None, None, None)])]
    return spark.createDataFrame(rows, "Rndrng_NPI long, Rndrng_Prvdr_State_Abrvtn string, HCPCS_Cd string, Tot_Srvcs double, Tot_Benes double, Avg_Sbmtd_Chrg double")


def test_context_needs_no_shuffle_of_claims(few):
    got = features.context_features(few)
    assert "Exchange hashpartitioning" not in plan(got)
    rows = {(r["Tot_Srvcs"]): r for r in got.collect()}
    assert [rows[10.0 * i]["hcpcs_row_count"] for i in range(7)] == [4, 4, 4, 1, 4, None, None]
    assert [rows[10.0 * i]["state_row_count"] for i in range(7)] == [3, 3, 2, 2, None, 3, None]
    assert [rows[10.0 * i]["provider_row_count"] for i in range(7)] == [3, 3, 3, 2, 2, None, None]
    shares = [rows[10.0 * i]["hcpcs_state_row_share"] for i in range(7)]
    assert shares[:4] == pytest.approx([2 / 3, 2 / 3, 0.5, 0.5]) and shares[4:] == [0.0, 0.0, 0.0]


def test_context_of_no_rows_and_no_states(few):
    assert features.context_features(few.where("false")).count() == 0
    bare = features.context_features(few.withColumn("Rndrng_Prvdr_State_Abrvtn", F.lit(None).cast("string")))
    assert {r["hcpcs_state_row_share"] for r in bare.collect()} == {0.0} and bare.count() == 7


def test_duplicate_flag_moves_keys_only(few):
    got = cleaning.with_duplicate_flag(few, ["Rndrng_NPI", "HCPCS_Cd"])
    assert "Exchange hashpartitioning" not in plan(got)
    assert sorted(r["Tot_Srvcs"] for r in got.where("duplicate_key_flag").collect()) == [0.0, 10.0, 20.0, 50.0, 60.0]


def test_flags_and_features_are_not_written(spark, monkeypatch):
    rvu = spark.createDataFrame([("99213", "visit", "A", 1.0, 1.0, 0.5, 0.1, 33.0)], RVU)
    gpci = spark.createDataFrame([("M", "OHIO", "1", "all", 1.0, 1.0, 1.0)], GPCI)
    payments = spark.createDataFrame([(n, "OHIO", "Cardiology", "99213", "O", 5.0, 9.0, 200.0, 20.0 + n, 40.0, "Y", "I") for n in range(40)], PAYMENTS)
    st, written = Stages(rvu, gpci, payments), []
    import remitlens.plans.stages as module
    real = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: written.append((name, df.columns)) or real(df, name))
    assert st.claims.columns == CLAIM_COLUMNS and st.modeling.count() == 40
    assert [name for name, _ in written] == ["claims"] and "Payment_Gap" not in written[0][1]


def test_box_stats_join_quartiles_without_shuffle(spark):
    df = spark.range(200).select((F.col("id") % 2).cast("string").alias("k"), F.col("id").cast("double").alias("v"))
    got = eda.box_stats(df, "k", "v", -1000, 1000)
    assert "SortMergeJoin" not in plan(got)
    assert sorted((r["k"], r["n"], r["median"]) for r in got.collect()) == [("0", 100, 99.0), ("1", 100, 100.0)]


def test_order_columns_are_not_stored(spark):
    df = spark.range(50).select("id", F.md5(F.col("id").cast("string")).alias("h"))
    got = ordering.global_rank(df, [F.col("h")], "r", ["h"])
    assert got.columns == ["r", "id"]
    want = [r["id"] for r in df.orderBy("h").collect()]
    assert [r["id"] for r in got.orderBy("r").collect()] == want
    assert splits.stratified_folds(df.withColumn("label", F.lit(1)), "label", 5, ["id"]).groupBy("fold").count().where("count = 10").count() == 5


def test_newest_payments_may_be_a_folder_of_parts(spark, tmp_path):
    from remitlens.sources import files

    rows = [(n, "OHIO", "Cardiology", "99213", "O", 5.0, 9.0, 200.0, 20.0 + n, 40.0, "Y", "I") for n in range(40)]
    df = spark.createDataFrame(rows, PAYMENTS)
    df.limit(3).repartition(1).write.option("header", True).csv(f"{tmp_path}/2022")
    df.repartition(4).write.option("header", True).csv(f"{tmp_path}/2023")
    got = files.read_payments(spark, str(tmp_path), "part-*.csv")
    assert sorted(r["Rndrng_NPI"] for r in got.collect()) == list(range(40))


def test_folds_are_stored_once(spark, monkeypatch):
    from remitlens.operators import models

    stored = []
    for module in (ordering, splits, models):
        real = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, name, real=real: stored.append((name, "features" in df.columns)) or real(df, name))
    table = spark.range(60).select("id", (F.col("id") % 2).cast("double").alias("label"), F.array(F.lit(1.0)).alias("features"))
    monkeypatch.setattr(models, "KEYS", ["id"])
    monkeypatch.setattr(models.boosting, "fit_many", lambda folded, fits, label: (None, folded.select(F.lit("m").alias("Model"), "fold", "label", F.lit(0.5).alias("score"))))
    got = models.cross_validate(table, {"m": models.Boost()})
    assert got.groupBy("fold").count().where("count = 12").count() == 5
    assert [name for name, wide in stored if wide] == ["rank"]


def _placed(rows, test):
    """Keys held by the ranks that the split stands for."""
    import hashlib

    out = []
    for c in (0, 1):
        mine = sorted((hashlib.md5(f"{k}|42".encode()).hexdigest(), k) for k, y in rows if y == c)
        out += [k for _, k in mine[:int(len(mine) * test + 0.5)]]
    return sorted(out)


@pytest.mark.parametrize("test", [0.0, 0.2, 0.5, 1.0])
def test_split_moves_and_writes_no_rows(spark, monkeypatch, test):
    rows = [(k, int(k % 7 == 0)) for k in range(5000)]
    df = spark.createDataFrame([(k, y, "wide" * 20) for k, y in rows] + [(-1, None, "no label")], "k long, y int, wide string")
    monkeypatch.setattr(splits, "_place_in_class", lambda *a: pytest.fail("rows were ranked"))
    train, held = splits.stratified_split(df, "y", test, ["k"])
    assert sorted(r["k"] for r in held.collect()) == _placed(rows, test)
    assert train.count() == 5000 - held.count() and train.columns == df.columns
    assert "Exchange" not in plan(train) and "Exchange" not in plan(held)


def test_split_counts_hold_where_keys_repeat(spark):
    df = spark.createDataFrame([(1, 0)] * 10 + [(2, 1)] * 5 + [(None, 1)] * 5, "k long, y int")
    train, held = splits.stratified_split(df, "y", 0.25, ["k"])
    assert {r["y"]: r["count"] for r in held.groupBy("y").count().collect()} == {0: 3, 1: 3}
    assert train.count() == 14 and splits.stratified_split(df.where("k > 5"), "y", 0.2, ["k"])[0].count() == 0
