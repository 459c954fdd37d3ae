"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space characters.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_words(text: Column) -> Column:
    """Array of words; no word gives an empty array, and so does a null text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP))


def count_words(text: Column) -> Column:
    return F.size(as_words(text)).cast("long")


def text_key(text: Column) -> Column:
    """Digest by which equal texts meet; a null text has a key of its own."""
    return F.when(text.isNull(), F.lit("null")).otherwise(F.md5(text))


def row_key(*columns: Column) -> Column:
    """Digest of several columns; nulls count, and no two different rows run together."""
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Join condition on equal keys where null meets null."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond
