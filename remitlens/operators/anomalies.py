"""Group-level underpayment patterns and an isolation forest over them.

The forest follows Liu, Ting and Zhou (2008). Each tree sees at most ``psi`` sampled rows, so
trees are built one per group in parallel; scoring reads the node table, whose size is bounded
by trees x (2 psi - 1) rows whatever the data size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens import constants as C
from remitlens.functions import scalars as S
from remitlens.operators.ordering import exact_quantiles, top_n
from remitlens.operators.tables import metrics_long
from remitlens.session import materialize


def underpayment_patterns(df: DataFrame, group_cols: Sequence[str] = tuple(C.PATTERN_KEYS), min_rows: int = C.PATTERN_MIN_ROWS) -> DataFrame:
    """Counts, recoveries and guarded averages per group; NULL keys form groups of their own."""
    rows, low = F.count(F.lit(1)), F.count_if("Is_Underpaid")
    dollars, pct = F.col("Total_Dollar_Gap"), F.col("Payment_Gap_Pct")
    grouped = df.groupBy(*group_cols).agg(
        rows.alias("row_count"), low.alias("underpaid_rows"),
        F.coalesce(F.sum(F.when(dollars < 0, -dollars)), F.lit(0.0)).alias("total_estimated_recovery"),
        F.coalesce(F.sum(F.when(pct < 0, -pct)), F.lit(0.0)).alias("_pct"),
        F.avg("Tot_Srvcs").alias("avg_total_services"),
    ).where(F.col("row_count") >= min_rows)
    return grouped.select(
        *group_cols, "row_count", "underpaid_rows", "total_estimated_recovery", "avg_total_services",
        (F.col("underpaid_rows").cast("double") / F.col("row_count")).alias("underpaid_rate"),
        F.coalesce(F.try_divide(F.col("_pct"), F.col("underpaid_rows")), F.lit(0.0)).alias("avg_gap_pct"),
        (F.col("total_estimated_recovery") / F.col("row_count")).alias("avg_recovery_per_row"),
    )


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


_NODES = "tree int, node int, feature int, cut double, left int, right int, path double"


def _grow(points: np.ndarray, limit: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes of one tree over a small sample; a leaf stores its depth plus the unresolved part."""
    nodes: list[list] = [[-1, 0.0, -1, -1, 0.0]]
    todo = [(0, points, 0)]
    while todo:
        at, rows, depth = todo.pop()
        spans = np.ptp(rows, axis=0) if len(rows) else np.zeros(points.shape[1])
        usable = np.flatnonzero(spans > 0)
        if depth >= limit or len(rows) <= 1 or not len(usable):
            nodes[at][4] = depth + average_path(len(rows))
            continue
        f = int(rng.choice(usable))
        cut = float(rng.uniform(rows[:, f].min(), rows[:, f].max()))
        below = rows[:, f] <= cut
        left, right = len(nodes), len(nodes) + 1
        nodes += [[-1, 0.0, -1, -1, 0.0], [-1, 0.0, -1, -1, 0.0]]
        nodes[at][:4] = [f, cut, left, right]
        todo += [(left, rows[below], depth + 1), (right, rows[~below], depth + 1)]
    return [(i, *n) for i, n in enumerate(nodes)]


def sample_per_tree(df: DataFrame, keys: Sequence[str], trees: int, psi: int, rows: int, seed: int) -> DataFrame:
    """``tree`` + columns: min(psi, rows) distinct rows per tree.

    A row's hash places it on a circle; tree t takes the first psi rows of an arc starting at
    t / trees. Arcs are about twice as long as needed, so only a few hundred candidates per tree
    are ever ordered together. Keys are unique, so no arc can be crowded by copies.
    """
    u = S.hash_number(S.row_hash(keys, seed)).cast("double") / float(1 << 60)
    arc = min(1.0, (2.0 * psi + 64.0) / max(rows, 1))
    placed = df.withColumn("_u", u)
    if arc >= 1.0:
        candidates = placed.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    else:
        last = F.floor(F.col("_u") * trees).cast("int")
        first = (F.floor((F.col("_u") - arc) * trees) + 1).cast("int")
        covering = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        candidates = placed.withColumn("tree", F.explode(covering)).withColumn(
            "tree", F.pmod(F.col("tree"), F.lit(trees)).cast("int")
        )
    order = Window.partitionBy("tree").orderBy(S.row_hash([*keys, "tree"], seed + 1))
    return candidates.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= psi).drop("_n", "_u")


def isolation_forest_fit(df: DataFrame, cols: Sequence[str], keys: Sequence[str], trees: int = 200, psi: int = 256, seed: int = 42) -> DataFrame:
    """Node table of the forest (at most trees x (2 psi - 1) rows).

    Trees split at uniform points between a sample's extremes, so standard scaling of the inputs
    would not change any split order; values are used as they are.
    """
    rows = df.count()
    limit = max(1, math.ceil(math.log2(max(2, min(psi, rows)))))
    numbers = list(cols)
    table = df.select(*keys, *[F.coalesce(S.finite(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in numbers])
    samples = sample_per_tree(table, keys, trees, psi, rows, seed)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        points = pdf[numbers].to_numpy(dtype=float)
        points = points[np.lexsort(points.T)]  # arrival order must not matter
        nodes = _grow(points, limit, np.random.default_rng([seed, tree]))
        return pd.DataFrame([(tree, *n) for n in nodes], columns=["tree", "node", "feature", "cut", "left", "right", "path"])

    return samples.select("tree", *numbers).groupBy("tree").applyInPandas(grow, _NODES)


def isolation_forest_score(df: DataFrame, forest: DataFrame, cols: Sequence[str], trees: int = 200, psi: int = 256) -> DataFrame:
    """Adds ``raw_score`` = 2 ^ (-mean path / c(sample size)); near 1 is easy to isolate."""
    bound = trees * (2 * psi - 1)
    nodes = forest.limit(bound + 1).toPandas()
    if len(nodes) > bound:
        raise ValueError("forest is larger than its bound")
    parts = [g.sort_values("node") for _, g in nodes.groupby("tree")]
    packed = df.sparkSession.sparkContext.broadcast([
        (g["feature"].to_numpy(), g["cut"].to_numpy(), g["left"].to_numpy(), g["right"].to_numpy(), g["path"].to_numpy())
        for g in parts
    ])
    norm = average_path(min(psi, df.count())) or 1.0
    numbers = list(cols)
    schema = T.StructType([*df.schema.fields, T.StructField("raw_score", T.DoubleType())])

    def score(batches):
        for pdf in batches:
            x = np.nan_to_num(pdf[numbers].to_numpy(dtype=float), nan=0.0, posinf=0.0, neginf=0.0)
            total = np.zeros(len(pdf))
            row = np.arange(len(pdf))
            for feature, cut, left, right, path in packed.value:
                at = np.zeros(len(pdf), dtype=int)
                while True:
                    f = feature[at]
                    live = f >= 0
                    if not live.any():
                        break
                    below = x[row, np.maximum(f, 0)] <= cut[at]
                    at = np.where(live, np.where(below, left[at], right[at]), at)
                total += path[at]
            yield pdf.assign(raw_score=np.power(2.0, -total / len(packed.value) / norm))

    return df.mapInPandas(score, schema)


def flag_contamination(scored: DataFrame, contamination: float = C.CONTAMINATION) -> DataFrame:
    """Flag scores above the (1 - contamination) quantile; the reported score is the excess."""
    row = exact_quantiles(scored, ["raw_score"], [1.0 - contamination], names=["q"]).first()
    cut = row["q"] if row else 0.0
    excess = F.col("raw_score") - F.lit(cut)
    return scored.withColumn("anomaly_flag", excess > 0).withColumn("anomaly_score", S.round_even(excess, 6)).drop("raw_score")


def detect_anomalies(patterns: DataFrame, keys: Sequence[str] = tuple(C.PATTERN_KEYS), trees: int = 200, psi: int = 256, contamination: float = C.CONTAMINATION, seed: int = 42) -> DataFrame:
    patterns = materialize(patterns, "patterns")
    forest = isolation_forest_fit(patterns, C.PATTERN_FEATURES, keys, trees, psi, seed)
    scored = isolation_forest_score(patterns, forest, C.PATTERN_FEATURES, trees, psi)
    return flag_contamination(materialize(scored, "scores"), contamination)


def rank_anomalies(flagged: DataFrame, keys: Sequence[str] = tuple(C.PATTERN_KEYS)) -> DataFrame:
    return flagged.orderBy(
        F.col("anomaly_flag").desc(), F.col("anomaly_score").desc(), F.col("total_estimated_recovery").desc(), *keys
    )


def anomaly_concentration(flagged: DataFrame, key: str, n: int = 10) -> DataFrame:
    counts = flagged.where(F.col("anomaly_flag") & F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("anomaly_patterns"))
    return top_n(counts, [F.col("anomaly_patterns").desc(), F.col(key)], n)


def anomaly_summary(df: DataFrame, flagged: DataFrame, group_cols: Sequence[str] = tuple(C.PATTERN_KEYS), min_rows: int = C.PATTERN_MIN_ROWS, contamination: float = C.CONTAMINATION) -> DataFrame:
    n_input = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    formed = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("r")).agg(F.count(F.lit(1)).alias("n")).scalar()
    scored, hits = F.count(F.lit(1)), F.count_if("anomaly_flag")
    one = flagged.agg(
        scored.alias("groups_scored"), hits.alias("anomaly_patterns"),
        S.round_even(F.try_divide(hits.cast("double"), scored) * 100.0, 4).alias("anomaly_rate_pct"),
    ).select(
        n_input.alias("input_rows"), formed.alias("total_groups_formed"), F.lit(min_rows).alias("groups_scored_min_rows"),
        "groups_scored", "anomaly_patterns", "anomaly_rate_pct",
        F.lit(str(contamination)).alias("contamination_setting"), F.lit(", ".join(group_cols)).alias("grouping_columns"),
    )
    return metrics_long(one)
