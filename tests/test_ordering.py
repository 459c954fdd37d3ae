"""Global ranks, prefix sums, quantiles and samples against brute force, hot keys included."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from remitlens.operators import ordering as O
from remitlens.operators.pricing import pair_all


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    n = 3000
    value = np.where(rng.random(n) < 0.4, 7.0, np.round(rng.normal(0, 100, n), 2))  # 40 % share one value
    group = np.where(rng.random(n) < 0.35, "hot", rng.integers(0, 9, n).astype(str))
    rows = [(i, str(g), float(v) if i % 50 else None) for i, (g, v) in enumerate(zip(group, value))]
    return spark.createDataFrame(rows, "id long, g string, x double").repartition(7), rows


def test_global_rank_equals_row_number(frame):
    df, _ = frame
    order = [F.col("x").desc_nulls_last(), F.col("id")]
    got = O.global_rank(df, order).join(df.select("id", F.row_number().over(Window.orderBy(*order)).alias("want")), "id")
    assert got.where("rank <> want").count() == 0 and got.count() == df.count()


def test_rank_of_an_empty_table(frame):
    assert O.global_rank(frame[0].where("id < 0"), [F.col("id")]).count() == 0


def test_running_sums(frame):
    df, rows = frame
    got = {r["id"]: r["c"] for r in O.running_sums(df, [F.col("id").desc()], {"c": "id"}).collect()}
    total, want = 0, {}
    for i in sorted((r[0] for r in rows), reverse=True):
        total += i
        want[i] = total
    assert got == want


def test_quantiles_overall_and_grouped(frame):
    df, rows = frame
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = O.exact_quantiles(df, ["x"], probs).first()
    xs = [r[2] for r in rows if r[2] is not None]
    assert got["n"] == len(xs)
    assert np.allclose([got[f"q{i}"] for i in range(6)], np.quantile(xs, probs))
    for r in O.exact_quantiles(df, ["x"], probs, ["g"]).collect():
        xs = [v for _, g, v in rows if g == r["g"] and v is not None]
        assert r["n"] == len(xs) and np.allclose([r[f"q{i}"] for i in range(6)], np.quantile(xs, probs))


def test_quantiles_of_null_groups_and_single_rows(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("b", None)], "g string, x double")
    got = {r["g"]: r["m"] for r in O.exact_quantiles(df, ["x"], [0.5], ["g"], ["m"]).collect()}
    assert got == {None: 2.0, "a": 5.0}


@pytest.mark.parametrize("n", [1, 100, 2999, 5000])
def test_sample_paths_agree(frame, n):
    df, _ = frame
    small = {r["id"] for r in O.sample_n(df, n, ["id"], small=10**6).collect()}
    large = {r["id"] for r in O.sample_n(df, n, ["id"], small=0).collect()}
    assert small == large and len(small) == min(n, 3000)


def test_sample_of_copies_is_still_exact(spark):
    df = spark.createDataFrame([(1,)] * 500 + [(i,) for i in range(2, 300)], "k long")
    assert O.sample_n(df, 400, ["k"], small=0).count() == 400


def test_stratified_sample_keeps_the_rate(spark):
    df = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(2000)], "id long, y int")
    got = O.stratified_sample(df, "y", 401, ["id"]).groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in got} == {1: 100, 0: 301}
    assert O.stratified_sample(df, "y", 5000, ["id"]).count() == 2000


def test_dedupe_keeps_the_first(spark):
    df = spark.createDataFrame([(1, "b", None), (1, "a", "z"), (2, "c", "c"), (None, "q", "q"), (None, "p", "p")], "k long, v string, w string")
    got = sorted(map(tuple, O.dedupe_first(df, ["k"], ["v"]).collect()), key=str)
    assert got == sorted([(1, "a", "z"), (2, "c", "c"), (None, "p", "p")], key=str)


def test_every_pair_meets_once(spark):
    a = spark.createDataFrame([(i % 3, "x") for i in range(30)], "i int, s string")  # copies on purpose
    b = spark.createDataFrame([(j, None) for j in range(11)], "j int, t string")
    got = pair_all(a, b)
    assert got.count() == 330
    assert got.groupBy("i", "j").count().where("count <> 10").count() == 0


def test_top_n_ranked(frame):
    df, _ = frame
    got = O.top_n_ranked(df, [F.col("x").desc_nulls_last(), F.col("id")], 5).collect()
    assert [r["report_rank"] for r in got] == [1, 2, 3, 4, 5] and got[0]["x"] >= got[4]["x"]


def test_quantiles_of_large_groups_use_brackets(spark):
    """Above the exact limit only bracketed values survive the map side; results stay exact."""
    n = 90_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.when(F.col("id") % 3 == 1, "wide").otherwise(None)).alias("g"),
        F.when(F.col("id") % 5 == 0, 1.5).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7.0).alias("x"),
    )
    pdf = df.toPandas()
    probs = [0.01, 0.25, 0.5, 0.99]
    got = O.exact_quantiles(df, ["x"], probs).first()
    assert np.allclose([got[f"q{i}"] for i in range(4)], np.quantile(pdf["x"], probs), rtol=1e-12)
    big = df.withColumn("g", F.coalesce("g", F.lit("hot")))
    rows = {r["g"]: r for r in O.exact_quantiles(big, ["x"], probs, ["g"]).collect()}
    pdf["g"] = pdf["g"].fillna("hot")
    assert rows["hot"]["n"] > O._EXACT_BELOW > rows["wide"]["n"]
    for g, part in pdf.groupby("g"):
        assert np.allclose([rows[g][f"q{i}"] for i in range(4)], np.quantile(part["x"], probs), rtol=1e-12)
