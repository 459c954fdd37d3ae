"""Evaluation maths against quadratic brute force."""

import numpy as np
import pytest

from remitlens.operators import evaluation as E


def brute(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    auc = wins / (len(pos) * len(neg)) if pos and neg else None
    ap, seen = 0.0, 0.0
    for t in sorted(set(scores), reverse=True):
        tp = sum(s >= t for s in pos)
        fp = sum(s >= t for s in neg)
        recall = tp / len(pos) if pos else 0.0
        ap += (recall - seen) * tp / (tp + fp)
        seen = recall
    return ap, auc


@pytest.mark.parametrize("seed, levels", [(0, 5), (1, 40), (2, 1000)])
def test_ap_and_auc(spark, seed, levels):
    rng = np.random.default_rng(seed)
    labels = (rng.random(300) < 0.3).astype(int)
    scores = np.round(np.clip(labels * 0.2 + rng.random(300), 0, 1) * levels) / levels
    df = spark.createDataFrame([(int(y), float(s)) for y, s in zip(labels, scores)], "label int, score double")
    curve = E.pr_curve(df)
    ap, auc = brute(scores, labels)
    assert E.average_precision(curve).first()[0] == pytest.approx(ap, abs=1e-12)
    assert E.roc_auc(curve).first()[0] == pytest.approx(auc, abs=1e-12)


def test_groups_are_independent(spark):
    rng = np.random.default_rng(3)
    rows = [(g, int(rng.random() < 0.4), round(float(rng.random()), 1)) for g in ("a", "b", "c") for _ in range(80)]
    curve = E.pr_curve(spark.createDataFrame(rows, "g string, label int, score double"), group_cols=["g"])
    ap = {r["g"]: r["average_precision"] for r in E.average_precision(curve, ["g"]).collect()}
    auc = {r["g"]: r["roc_auc"] for r in E.roc_auc(curve, ["g"]).collect()}
    for g in ap:
        want = brute([s for k, _, s in rows if k == g], [y for k, y, _ in rows if k == g])
        assert (ap[g], auc[g]) == pytest.approx(want)


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_only(spark, label):
    curve = E.pr_curve(spark.createDataFrame([(label, 0.1), (label, 0.9)], "label int, score double"))
    assert E.roc_auc(curve).first()[0] is None
    assert E.average_precision(curve).first()[0] == float(label)


def test_threshold_choice(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.7), (1, 0.6), (0, 0.5), (0, 0.4), (1, 0.3), (0, 0.2)]
    df = spark.createDataFrame(rows, "label int, score double")
    curve = E.pr_curve(df)
    assert E.best_f1(curve).first()["threshold"] == 0.6
    assert E.recall_threshold(curve, 0.70).first()["threshold"] == 0.6
    table = {r["label"]: r for r in E.threshold_table(df, curve).collect()}
    assert len(table) == 23 and table["recall_0.70"]["recall"] == 0.75 and table["grid_0.95"]["precision"] == 0.0
    cells = {(r["actual"], r["predicted"]): r["row_count"] for r in E.confusion(df, 0.5).collect()}
    assert cells == {(1, 1): 3, (1, 0): 1, (0, 1): 2, (0, 0): 2}
    report = {r["class"]: r for r in E.class_report(df, 0.5).collect()}
    assert report[1]["precision"] == pytest.approx(0.6) and report[0]["support"] == 4


def test_regression_metrics(spark):
    rng = np.random.default_rng(1)
    y, p = rng.random(200) * 100, rng.random(200) * 100
    m = E.regression_metrics(spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double"), "y", "p").first()
    assert m["MAE"] == pytest.approx(np.mean(abs(y - p)), abs=1e-4)
    assert m["RMSE"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2)), abs=1e-4)
    assert m["R2"] == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2), abs=1e-4)
    assert m["Median_AE"] == pytest.approx(np.median(abs(y - p)), abs=1e-4)
