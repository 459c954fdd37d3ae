"""Classifier and regressor evaluation on scored rows, exact and fully distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens import constants as C
from remitlens.functions import scalars as S
from remitlens.operators.ordering import exact_quantiles, running_sums
from remitlens.operators.tables import one_to_rows

F1_GUARD = 1e-9


def pr_curve(scored: DataFrame, label: str = "label", score: str = "score", group_cols: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 at every distinct score used as a threshold, per group.

    Equal scores collapse to counts first; running totals over the descending scores come from
    range-partitioned prefix sums, so the curve never passes through one task. Groups (say, model
    and fold) share one pass: each group's totals are the running totals minus its start.
    """
    groups = list(group_cols)
    counts = scored.where(F.col(score).isNotNull()).groupBy(*groups, F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return curve_of_counts(counts, groups)


def curve_of_counts(counts: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """The curve from positives and negatives per distinct score (threshold, pos, neg)."""
    groups = list(group_cols)
    order = [*[F.col(g).asc() for g in groups], F.col("threshold").desc()]
    cum = running_sums(counts, order, {"tp": "pos", "fp": "neg"})
    if groups:
        base = cum.groupBy(*groups).agg(
            F.min(F.col("tp") - F.col("pos")).alias("_tp0"), F.min(F.col("fp") - F.col("neg")).alias("_fp0"),
            F.sum("pos").alias("_p"),
        )
        cum = cum.join(base, groups).withColumn("tp", F.col("tp") - F.col("_tp0")).withColumn("fp", F.col("fp") - F.col("_fp0"))
        positives = F.col("_p")
    else:
        positives = cum.agg(F.sum("pos").alias("p")).scalar()
    precision = F.col("tp").cast("double") / (F.col("tp") + F.col("fp"))
    recall = F.coalesce(F.try_divide(F.col("tp").cast("double"), positives), F.lit(0.0))
    return cum.drop("_tp0", "_fp0").withColumn("precision", precision).withColumn("recall", recall).withColumn(
        "f1", 2.0 * (F.col("precision") * F.col("recall")) / (F.col("precision") + F.col("recall") + F1_GUARD)
    ).drop("_p")


def average_precision(curve: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Step-wise: sum of recall increments x precision (no interpolation)."""
    weighted = F.sum(F.col("pos") * F.col("precision"))
    return curve.groupBy(*group_cols).agg(F.coalesce(F.try_divide(weighted, F.sum("pos")), F.lit(0.0)).alias("average_precision"))


def roc_auc(curve: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Rank-sum form with half credit for ties; NULL when one class is absent."""
    p, n = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    beaten = F.sum(F.col("fp").cast("double") * F.col("pos") - F.col("neg").cast("double") * F.col("pos") * 0.5)
    return curve.groupBy(*group_cols).agg((1.0 - F.try_divide(beaten, p * n)).alias("roc_auc"))


def _at(label: str, score: str, threshold: float) -> tuple[Column, Column]:
    hit = F.col(score) >= F.lit(float(threshold))
    return F.count_if(hit & (F.col(label) == 1)), F.count_if(hit)


def _metric_columns(tp: Column, predicted: Column, positives: Column, rows: Column, places: int | None) -> dict[str, Column]:
    tp = tp.cast("double")
    out = {
        "precision": F.coalesce(F.try_divide(tp, predicted), F.lit(0.0)),
        "recall": F.coalesce(F.try_divide(tp, positives), F.lit(0.0)),
        "f1": F.coalesce(F.try_divide(2.0 * tp, predicted + positives), F.lit(0.0)),
        "predicted_positive_rate": F.coalesce(F.try_divide(predicted.cast("double"), rows), F.lit(0.0)),
    }
    return out if places is None else {k: S.round_even(v, places) for k, v in out.items()}


def metrics_at(scored: DataFrame, thresholds: Sequence[tuple[str, float]], label: str = "label", score: str = "score", places: int | None = 4) -> DataFrame:
    """Precision, recall, F1 and predicted rate at each named threshold: one scan for all."""
    counters = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("positives")]
    for i, (_, t) in enumerate(thresholds):
        tp, predicted = _at(label, score, t)
        counters += [tp.alias(f"tp{i}"), predicted.alias(f"pp{i}")]
    return one_to_rows(scored.agg(*counters), [
        {"label": F.lit(name), "threshold": S.round_even(F.lit(float(t)), 6),
         **_metric_columns(F.col(f"tp{i}"), F.col(f"pp{i}"), F.col("positives"), F.col("rows"), places)}
        for i, (name, t) in enumerate(thresholds)
    ])


def best_f1(curve: DataFrame) -> DataFrame:
    """Threshold of the largest F1, the smallest threshold among equals."""
    return curve.agg(F.max_by("threshold", F.struct("f1", -F.col("threshold"))).alias("threshold"), F.max("f1").alias("f1"))


def recall_threshold(curve: DataFrame, target: float = C.RECALL_TARGET) -> DataFrame:
    """Best precision (then F1) among thresholds that reach the recall; max-F1 if none does."""
    rank = F.struct("precision", "f1", -F.col("threshold"))
    reached = F.when(F.col("recall") >= target, rank)
    best = F.max_by("threshold", F.struct("f1", -F.col("threshold")))
    return curve.agg(F.coalesce(-F.max(reached)["col3"], best).alias("threshold"))


def threshold_table(scored: DataFrame, curve: DataFrame, business: bool = True, recall_target: float = C.RECALL_TARGET, label: str = "label", score: str = "score") -> DataFrame:
    """Default, max-F1, business, recall-target and grid thresholds, best F1 first."""
    picks = curve.agg(
        F.max_by("threshold", F.struct("f1", -F.col("threshold"))).alias("f1"),
        (-F.max(F.when(F.col("recall") >= recall_target, F.struct("precision", "f1", -F.col("threshold"))))["col3"]).alias("recall"),
    ).first()
    points = [("default_0_50", 0.5), ("max_f1", picks["f1"])]
    if business:
        points.append(("business_operating_0_40", C.BUSINESS_THRESHOLD))
    if picks["recall"] is not None:
        points.append((f"recall_{recall_target:.2f}", picks["recall"]))
    elif business:
        points.append((f"recall_{recall_target:.2f}", picks["f1"]))
    points += [(f"grid_{k / 20:.2f}", round(k * 0.05, 2)) for k in range(1, 20)]
    table = metrics_at(scored, [(n, t) for n, t in points if t is not None], label, score)
    return table.orderBy(F.col("f1").desc(), F.col("recall").desc(), "label")


def confusion(scored: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    predicted = F.coalesce(F.col(score) >= float(threshold), F.lit(False)).cast("int").alias("predicted")
    return scored.groupBy(F.col(label).cast("int").alias("actual"), predicted).agg(F.count(F.lit(1)).alias("row_count"))


def class_report(scored: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """Precision, recall, F1 and support per class, from the (at most four) confusion counts."""
    cells = confusion(scored, threshold, label, score)

    def total(**wanted: int) -> Column:
        hit = None
        for k, v in wanted.items():
            hit = (F.col(k) == v) if hit is None else hit & (F.col(k) == v)
        return F.coalesce(F.sum(F.when(hit, F.col("row_count"))), F.lit(0))

    one = cells.agg(*[
        c for k in (0, 1) for c in (
            total(actual=k, predicted=k).alias(f"hit{k}"), total(predicted=k).alias(f"pred{k}"), total(actual=k).alias(f"act{k}"),
        )
    ])
    return one_to_rows(one, [
        {
            "class": F.lit(k),
            "precision": F.coalesce(F.try_divide(F.col(f"hit{k}").cast("double"), F.col(f"pred{k}")), F.lit(0.0)),
            "recall": F.coalesce(F.try_divide(F.col(f"hit{k}").cast("double"), F.col(f"act{k}")), F.lit(0.0)),
            "f1": F.coalesce(F.try_divide(2.0 * F.col(f"hit{k}"), F.col(f"pred{k}") + F.col(f"act{k}")), F.lit(0.0)),
            "support": F.col(f"act{k}"),
        }
        for k in (0, 1)
    ])


def class_weights(df: DataFrame, label: str = C.TARGET) -> DataFrame:
    """Balanced weights n / (2 n_class) and the negative / positive ratio, as one row."""
    n = F.count(F.lit(1)).cast("double")
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(
        F.try_divide(n, 2.0 * neg).alias("weight_negative"),
        F.try_divide(n, 2.0 * pos).alias("weight_positive"),
        F.coalesce(F.try_divide(neg.cast("double"), pos), F.lit(1.0)).alias("scale_pos_weight"),
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R2, median error and their shares of the mean actual, rounded for reports."""
    groups = list(group_cols)
    shaped = df.select(
        *groups, F.col(actual).cast("double").alias("y"), F.col(predicted).cast("double").alias("p")
    ).withColumn("ae", F.abs(F.col("y") - F.col("p")))
    one = shaped.groupBy(*groups).agg(
        F.avg("ae").alias("mae"), F.avg(F.col("ae") * F.col("ae")).alias("mse"), F.var_pop("y").alias("var"),
        F.avg("y").alias("mean"),
    )
    medians = exact_quantiles(shaped, ["ae", "y"], [0.5], groups, ["q"]).groupBy(*groups).agg(
        F.max(F.when(F.col("column") == "ae", F.col("q"))).alias("med_ae"),
        F.max(F.when(F.col("column") == "y", F.col("q"))).alias("med_y"),
    )
    # one row per group on each side
    both = one.withColumn("_k", F.lit(1)).join(medians.withColumn("_k", F.lit(1)), [*groups, "_k"])
    rmse = F.sqrt("mse")
    return both.select(
        *groups,
        S.round_even("mae", 4).alias("MAE"),
        S.round_even(rmse, 4).alias("RMSE"),
        S.round_even(1.0 - F.try_divide(F.col("mse"), F.col("var")), 4).alias("R2"),
        S.round_even("med_ae", 4).alias("Median_AE"),
        S.round_even(F.try_divide(F.col("mae"), F.col("mean")) * 100.0, 2).alias("MAE_Pct_Mean_Actual"),
        S.round_even(F.try_divide(rmse, F.col("mean")) * 100.0, 2).alias("RMSE_Pct_Mean_Actual"),
        S.round_even("mean", 4).alias("Mean_Actual"),
        S.round_even("med_y", 4).alias("Median_Actual"),
    )
