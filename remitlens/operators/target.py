"""Proxy target, class balance and the correlation audit against leakage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens import constants as C
from remitlens.functions import scalars as S
from remitlens.operators.correlation import correlation_row
from remitlens.operators.tables import one_to_rows


def with_target(features: DataFrame) -> DataFrame:
    return features.withColumn(C.TARGET, S.recovery_target())


def class_balance(df: DataFrame, target: str = C.TARGET) -> DataFrame:
    """Counts, positive rate and a warning outside 10..90 %."""
    n, pos = F.count(F.lit(1)), F.count_if(F.col(target) == 1)
    rate = F.try_divide(pos.cast("double"), n) * 100.0
    return df.agg(
        n.alias("rows"), pos.alias("positive"), (n - pos).alias("negative"), rate.alias("positive_pct"),
        ((rate < 10.0) | (rate > 90.0)).alias("imbalanced"),
    )


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns in order; booleans are not numbers here."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def leakage_audit(
    df: DataFrame, exclude: Sequence[str] = tuple(C.LEAKAGE_COLUMNS), target: str = C.TARGET, alarm: float = 0.5
) -> DataFrame:
    """Correlation of every remaining numeric column with the target, largest first: one scan."""
    cols = [c for c in numeric_columns(df) if c not in exclude and c != target]
    one = correlation_row(df, [(c, target) for c in cols])
    rows = one_to_rows(one, [
        {"Feature": F.lit(c), "Correlation_with_Target": S.round_even(f"c{i}", 4)} for i, c in enumerate(cols)
    ]).withColumn("needs_review", F.coalesce(F.abs("Correlation_with_Target") > alarm, F.lit(False)))
    return rows.orderBy(F.abs("Correlation_with_Target").desc_nulls_last(), "Feature")
