"""Many pairwise correlations in two light scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions import scalars as S


def correlation_row(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """One row ``c0, c1, ...`` with the complete-pair correlation of every pair.

    Means and deviations come from a first scan. Pairs without a NULL then need just the average
    of a centred product, a far smaller aggregate than one ``corr`` each; pairs with NULLs use
    the guarded formula; a constant column has no correlation (``corr`` would fail under ANSI).
    """
    cols = sorted({c for pair in pairs for c in pair})
    number = {c: F.col(f"`{c}`").cast("double") for c in cols}
    stats = df.agg(F.count(F.lit(1)).alias("rows"), *[
        a for i, c in enumerate(cols) for a in (
            F.count(number[c]).alias(f"n{i}"), F.avg(number[c]).alias(f"m{i}"), F.stddev_pop(number[c]).alias(f"s{i}"),
        )
    ]).first()
    full = {c: stats[f"n{i}"] == stats["rows"] for i, c in enumerate(cols)}
    mean = {c: stats[f"m{i}"] for i, c in enumerate(cols)}
    spread = {c: stats[f"s{i}"] for i, c in enumerate(cols)}

    def one(a: str, b: str) -> Column:
        if not spread[a] or not spread[b]:
            return F.max(F.lit(None).cast("double"))
        if full[a] and full[b]:
            product = (number[a] - F.lit(mean[a])) * (number[b] - F.lit(mean[b]))
            return S.finite(F.avg(product) / F.lit(spread[a] * spread[b]))
        return S.correlation(a, b)

    return df.agg(*[one(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
