"""Stage tables as Parquet, small reports as one CSV file, bounded audit samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.operators.ordering import top_n


def write_stage(df: DataFrame, root: str, name: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Overwrite a stage table and return it as a Parquet scan."""
    path = f"{root.rstrip('/')}/{name}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """One CSV file; for reports whose rows are groups or metrics, never for claim tables.

    The shuffle keeps the last aggregate parallel; only the finished rows meet in one task."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def audit_sample(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    return top_n(df, [F.col(k) for k in keys], n)
