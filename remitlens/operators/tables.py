"""Small helpers that turn one aggregated row into a long table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_to_rows(one_row: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """Unfold a one-row table into len(rows) rows with the given named columns."""
    return one_row.select(F.inline(F.array(*[
        F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows
    ])))


def metrics_long(one_row: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """(metric, value) text pairs, one per column of a one-row table."""
    return one_to_rows(one_row, [
        {"metric": F.lit(n), "value": F.col(f"`{n}`").cast("string")} for n in (names or one_row.columns)
    ])
