"""Chart-ready tables: histograms, box statistics, group means, rates, sums and correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens import constants as C
from remitlens.functions import scalars as S
from remitlens.operators.correlation import correlation_row
from remitlens.operators.ordering import exact_quantiles, sample_n, top_n
from remitlens.operators.tables import one_to_rows
from remitlens.session import materialize

CORRELATION_COLUMNS = [
    "Tot_Benes", "Tot_Srvcs", "Avg_Sbmtd_Chrg", "Avg_Mdcr_Alowd_Amt",
    "Expected_Payment_NonFacility_Avg", "Payment_Gap", "Payment_Gap_Pct",
]


def histogram(df: DataFrame, col: str, low: float, high: float, bins: int) -> DataFrame:
    """Equal-width counts of the clipped column over its own range; empty bins included.

    The right edge belongs to the last bin.
    """
    shown = df.select(S.clip(col, low, high).alias("x")).where(F.col("x").isNotNull())
    ends = shown.agg(F.min("x").alias("a"), F.max("x").alias("b")).first()
    start, stop = ends["a"], ends["b"]
    if start is None:
        return df.sparkSession.createDataFrame([], "bin long, bin_low double, bin_high double, row_count long")
    if start == stop:
        start, stop = start - 0.5, stop + 0.5
    width = stop - start
    slot = F.least(F.floor((F.col("x") - F.lit(start)) / F.lit(width) * float(bins)), F.lit(bins - 1)).cast("long")
    counts = shown.groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edge = F.lit(width) / float(bins)
    return (
        df.sparkSession.range(bins).withColumnRenamed("id", "bin").join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(start) + edge * F.col("bin")).alias("bin_low"),
            (F.lit(start) + edge * (F.col("bin") + 1)).alias("bin_high"),
            F.coalesce("n", F.lit(0)).alias("row_count"),
        )
    )


def share(df: DataFrame, flag: str) -> DataFrame:
    """Rows and percentage per value of a flag, labelled by the value itself."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = df.groupBy(flag).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.withColumn("pct", F.col("row_count").cast("double") / total * 100.0)


def group_mean(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias(name))


def group_rate(df: DataFrame, key: str, flag: str, name: str) -> DataFrame:
    """Share of true rows per key, in percent."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg((F.avg(F.col(flag).cast("int")) * 100.0).alias(name))


def group_sum(df: DataFrame, key: str, value: str, name: str, where: Column | None = None) -> DataFrame:
    rows = df.where(F.col(key).isNotNull())
    rows = rows if where is None else rows.where(where)
    return rows.groupBy(key).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(name))


def group_count(df: DataFrame, key: str, name: str = "row_count") -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def group_median(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    rows = df.where(F.col(key).isNotNull())
    return exact_quantiles(rows, [value], [0.5], [key], [name]).select(key, name)


def extremes(grouped: DataFrame, value: str, n: int = 15, largest: bool = True) -> DataFrame:
    """The n largest or smallest groups, ties in key order."""
    key = grouped.columns[0]
    order = F.col(value).desc_nulls_last() if largest else F.col(value).asc_nulls_last()
    return top_n(grouped, [order, F.col(key)], n)


def code_stats(df: DataFrame, min_rows: int = 100) -> DataFrame:
    return (
        df.where(F.col("HCPCS_Cd").isNotNull()).groupBy("HCPCS_Cd")
        .agg(F.avg("Payment_Gap_Pct").alias("Mean_Gap_Pct"), F.count(F.lit(1)).alias("Count"))
        .where(F.col("Count") >= min_rows)
    )


def box_stats(df: DataFrame, key: str, col: str, low: float, high: float) -> DataFrame:
    """Quartiles, whiskers (furthest points within 1.5 IQR) and points beyond, per key value."""
    rows = df.select(F.col(key), S.clip(col, low, high).alias("x")).where(
        F.col(key).isNotNull() & F.col("x").isNotNull()
    )
    quartiles = materialize(exact_quantiles(rows, ["x"], [0.25, 0.5, 0.75], [key], ["q1", "median", "q3"]).drop("column"), "quartiles")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (F.col("x") >= F.col("q1") - reach) & (F.col("x") <= F.col("q3") + reach)
    return rows.join(quartiles, key).groupBy(key, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.count_if(~inside).alias("fliers"),
    )


def scatter_sample(df: DataFrame, x: tuple[str, float | None, float | None], y: tuple[str, float | None, float | None], n: int = 20_000, keys: Sequence[str] = tuple(C.CLAIM_KEY)) -> DataFrame:
    """A repeatable sample of two clipped columns with the row key."""
    picked = sample_n(df.select(*dict.fromkeys([*keys, x[0], y[0]])), n, keys)
    return picked.select(*keys, S.clip(*x).alias("x"), S.clip(*y).alias("y"))


def pair_correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(S.correlation(a, b).alias("correlation"))


def corr_matrix(df: DataFrame, cols: Sequence[str] = tuple(CORRELATION_COLUMNS)) -> DataFrame:
    """Pairwise-complete correlations as (row, column, value): one scan, upper half computed."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    place = {p: f"c{k}" for k, p in enumerate(pairs)}
    return one_to_rows(correlation_row(df, pairs), [
        {"row_name": F.lit(a), "column_name": F.lit(b), "correlation": F.col(place.get((a, b)) or place[(b, a)])}
        for a in cols for b in cols
    ])
