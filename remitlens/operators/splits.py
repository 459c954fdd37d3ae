"""Repeatable splits and folds from a hash of the row key, in a single projection."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens import constants as C
from remitlens.functions import scalars as S
from remitlens.operators.ordering import global_rank
from remitlens.session import materialize

SPLIT_KEYS = [*C.CLAIM_KEY, "Rndrng_Prvdr_State_Abrvtn"]


def hash_bucket(keys: Sequence[str], buckets: int, seed: int = 42) -> Column:
    return (S.hash_number(S.row_hash(keys, seed)) % buckets).cast("int")


def split(df: DataFrame, test: float = 0.2, keys: Sequence[str] = tuple(SPLIT_KEYS), seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test). The hash is independent of the label, so every stratum keeps its share."""
    cut = int(round(test * 1000))
    bucket = hash_bucket(keys, 1000, seed)
    return df.where(bucket >= cut), df.where(bucket < cut)


def _place_in_class(df: DataFrame, label: str, keys: Sequence[str], seed: int) -> DataFrame:
    """``_place`` 0.. of each row in hash order among the rows of its label, and the label's row count ``_size``."""
    hashed = df.withColumn("_hash", F.unhex(S.row_hash(keys, seed)))  # bytes order as their digits do
    ranked = global_rank(hashed, [F.col(label), F.col("_hash"), *[F.col(k) for k in keys]], "_rank", ["_hash"])
    starts = ranked.groupBy(label).agg(F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("_size"))
    starts = materialize(starts, "starts")
    return ranked.join(F.broadcast(starts), label).withColumn("_place", F.col("_rank") - F.col("_first"))  # one row per class


def _cuts(df: DataFrame, label: str, test: float, hashed: Column) -> list[tuple[object, str | None]] | None:
    """(class, hash of its first row in hash order that is not held); no hash if all rows are. None if rows on both sides of a cut have one hash."""
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).alias("c"), hashed.alias("h")).withColumn("b", F.substring("h", 1, 4))
    counts = materialize(rows.groupBy("c", "b").agg(F.count(F.lit(1)).alias("n")), "split-counts")  # 65,536 rows a class at most
    whole = {r["c"]: r["n"] for r in counts.groupBy("c").agg(F.sum("n").alias("n")).collect()}
    held = {c: math.floor(n * test + 0.5) for c, n in whole.items()}
    upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)))
    hit = F.lit(False)
    for c, m in held.items():
        hit = hit | ((F.col("c") == F.lit(c)) & (F.col("upto") > m) & (F.col("upto") - F.col("n") <= m))
    at = {r["c"]: (r["b"], held[r["c"]] - (r["upto"] - r["n"])) for r in upto.where(hit).collect()}  # one row a class
    near = F.lit(False)
    for c, (b, _) in at.items():
        near = near | ((F.col("c") == F.lit(c)) & (F.col("b") == b))
    found: dict[object, list[str]] = {c: [] for c in at}
    for r in rows.where(near).select("c", "h").collect():  # one bucket a class: 1 in 65,536 of the rows
        found[r["c"]].append(r["h"])
    out = []
    for c in held:
        if c not in at:
            out.append((c, None))
            continue
        hashes, k = sorted(found[c]), at[c][1]
        if k and hashes[k] == hashes[k - 1]:
            return None
        out.append((c, hashes[k]))
    return out


def stratified_split(df: DataFrame, label: str, test: float = 0.2, keys: Sequence[str] = tuple(SPLIT_KEYS), seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) with each class's share exact to one row. Both are filters over ``df``, by the hash at which a class is cut, so no row is
    moved or written; only where repeated keys lie across a cut, rows are ranked."""
    hashed = S.row_hash(keys, seed)
    cuts = _cuts(df, label, test, hashed)
    if cuts is None:
        placed = _place_in_class(df, label, keys, seed)
        held = F.col("_place") < F.floor(F.col("_size") * F.lit(test) + 0.5)
        return placed.where(~held).select(*df.columns), placed.where(held).select(*df.columns)
    held = F.lit(None).cast("boolean")
    for c, cut in cuts:
        held = F.when(F.col(label) == F.lit(c), F.lit(True) if cut is None else hashed < cut).otherwise(held)
    return df.where(~held), df.where(held)


def stratified_folds(df: DataFrame, label: str, k: int = 5, keys: Sequence[str] = tuple(SPLIT_KEYS), seed: int = 7, name: str = "fold") -> DataFrame:
    """Fold 0..k-1 of each row; the folds of a class differ by one row at most."""
    return _place_in_class(df, label, keys, seed).withColumn(name, (F.col("_place") % k).cast("int")).select(*df.columns, name)


def fold_col(df: DataFrame, k: int = 5, keys: Sequence[str] = tuple(SPLIT_KEYS), seed: int = 7, name: str = "fold") -> DataFrame:
    return df.withColumn(name, hash_bucket(keys, k, seed))
