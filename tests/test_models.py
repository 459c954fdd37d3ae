"""Small, seeded model runs: quality floor, persistence, scoring without a model, importances."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from remitlens.operators import boosting, claims_api, evaluation, models, regression


@pytest.fixture(scope="module")
def trained(stages):
    est = replace(models.candidates()["Gradient_Boosting"], rounds=3)
    return models.fit_final(stages.modeling, "Gradient_Boosting", est)


def test_holdout_beats_chance(trained):
    _, held = trained
    curve = evaluation.pr_curve(held)
    assert evaluation.roc_auc(curve).first()[0] > 0.7


def test_save_load_and_retune(spark, stages, trained, tmp_path):
    model, _ = trained
    models.save_model(model, str(tmp_path / "m"))
    back = models.load_model(spark, str(tmp_path / "m"))
    assert back.spec == model.spec and back.name == model.name
    a = {r["Rndrng_NPI"], } if (r := models.score_rows(stages.modeling.limit(1), model).first()) else set()
    assert a
    one = stages.modeling.orderBy("Rndrng_NPI", "HCPCS_Cd", "Place_Of_Srvc").limit(5)
    assert [r["probability_1"] for r in models.score_rows(one, model).collect()] == [r["probability_1"] for r in models.score_rows(one, back).collect()]
    assert models.retune(spark, str(tmp_path / "m"), stages.modeling).count() >= 22


def test_score_without_a_model_is_null(stages):
    assert models.score(stages.modeling, None).where(F.col("collection_probability").isNotNull()).count() == 0


def test_logistic_and_coefficients(stages):
    est = models.candidates()["Logistic_Regression"]
    fitted, _ = models.fit_final(stages.modeling, "Logistic_Regression", est)
    rows = models.coefficients(fitted).collect()
    sizes = [abs(r["Coefficient"]) for r in rows]
    assert len(rows) == len(fitted.spec.names) and sizes == sorted(sizes, reverse=True)


def test_tuning_picks_from_the_grid(stages):
    table = models.training_table(stages.modeling, models.fit_features(stages.modeling))
    est = models.candidates()["Logistic_Regression"]
    grid = models.grids("Logistic_Regression", est)
    best = models.tune(table, est, grid)
    assert len(grid) == len(best.scores) == 4
    fitted = best.best.fit(table).stages[-1]
    assert 1.0 / fitted.getRegParam() > 0 and best.table(table.sparkSession).where("best").count() >= 1


def test_boosted_search_equals_separate_validation(stages):
    table = models.training_table(stages.modeling, models.fit_features(stages.modeling))
    est = replace(models.candidates()["Hist_Gradient_Boosting"], rounds=3)
    grid = boosting.grid(est, rounds=[1, 3], l2=[0.0, 5.0])
    found = models.tune(table, est, grid)
    assert len(found.scores) == 4 and found.best in grid and max(found.scores) > 0.5
    alone = models.tune(table, est, [grid[2]])
    assert alone.scores[0] == pytest.approx(found.scores[2])


def test_importances_sum_to_one(trained):
    model, _ = trained
    assert models.importances(model).agg(F.sum("Importance")).first()[0] == pytest.approx(1.0)


def test_permutation_importance_finds_the_used_feature(stages, trained):
    model, _ = trained
    table = models.permutation_importance(model, stages.modeling).collect()
    assert len(table) == len(model.spec.names)
    best = max(table, key=lambda r: r["Importance"])
    builtin = {r["Feature"]: r["Importance"] for r in models.importances(model).collect()}
    assert best["Importance"] > 0 and builtin[best["Feature"]] > 0
    assert all(abs(r["Importance"]) < 1e-12 for r in table if builtin[r["Feature"]] == 0.0)


def test_claim_scoring_is_batch_independent(spark, trained):
    model, _ = trained
    rows = [(1, "Radiology", "F", 0.0, 0.0), (2, "Drugs", None, 80.0, None), (3, None, "O", None, 12.0)]
    df = spark.createDataFrame(rows, "id int, procedure_category string, place_of_service string, tot_srvcs double, tot_benes double")
    batch = {r["id"]: r for r in models.score_claims(df, model, keep=["id"]).collect()}
    for i in (1, 2, 3):
        alone = models.score_claims(df.where(F.col("id") == i), model, keep=["id"]).first()
        assert alone == batch[i]
    assert 0 < len(batch[1]["top_risk_factors"]) <= 3
    summary = claims_api.batch_summary(models.score_claims(df, model)).first()
    assert summary["total_claims"] == 3


def test_supplied_zero_is_kept(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0), (None, None, None)], "locality_count double, tot_srvcs_log double, tot_srvcs double")
    a, b = claims_api.complete_claims(df).select("Locality_Count", "Tot_Srvcs_log", "Tot_Srvcs", "services_per_beneficiary").collect()
    assert tuple(a) == (0.0, 0.0, 0.0, 0.0)
    assert (b["Locality_Count"], b["Tot_Srvcs"]) == (1.0, 50.0) and b["services_per_beneficiary"] == pytest.approx(50 / 30)


def test_regressors_against_the_formula(stages):
    regressors = regression.regressors()
    regressors["Gradient_Boosting_Regressor"].setMaxIter(3)
    table = regression.compare_regressors(stages.modeling, regressors)
    assert table.count() == 3
    assert regression.best_regressor(table).first()["best_r2"] > 0


def test_registered_comparison_fits_on_all_rows_of_the_other_folds(spark, monkeypatch):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    from remitlens.plans.stages import Stages

    seen = []

    class Counting(LogisticRegression):
        def _fit(self, dataset):
            seen.append(dataset.count())
            return super()._fit(dataset)

    table = spark.range(6000).select(
        F.col("id").alias("Rndrng_NPI"), F.lit("A").alias("HCPCS_Cd"), F.lit("O").alias("Place_Of_Srvc"), F.lit("OHIO").alias("Rndrng_Prvdr_State_Abrvtn"),
        (F.col("id") % 3 == 0).cast("double").alias("label"), F.lit(1.0).alias("w_balanced"), F.lit(1.0).alias("w_positive"),
        array_to_vector(F.array((F.col("id") % 7).cast("double"), (F.col("id") % 3).cast("double"))).alias("features"))
    monkeypatch.setattr(models, "candidates", lambda: {"Logistic_Regression": Counting(labelCol="label", maxIter=2)})
    st = Stages(None, None, None)
    st.__dict__["training"] = table
    held = st.cross_validated("Logistic_Regression")
    assert seen == [4800] * 5  # 4,000 of them were taken before
    assert held.count() == 6000 and held.select("fold").distinct().count() == 5
