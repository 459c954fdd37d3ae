"""Vector bin packing: groups of rows go to shards so that several loads come out even together.

Every group is a vector (bytes, tokens, rows). Groups are taken by falling load; each goes to the shard
where the dot product of its vector with the shard's residual capacity is highest among those where it
fits. The few large groups, at most ``dims * shards / HEAD`` of them, are placed first in one list; all
others are dealt by hash into slices of about ``SLICE`` groups, and each slice is placed by a task of its
own against its share of the remaining capacity. So no task sees more than a slice.

A group that would fill more than ``WHOLE`` of a shard in any dimension is cut into ``8 * shards`` pieces
by document id, so a group with a third of all rows is spread instead of filling a shard.

Defined results: a null text counts as no bytes and is a group of its own; documents of equal text share
a shard unless their group is cut; repeated rows are all kept and get slots of their own; an empty table
gives an empty result; columns besides those named are ignored by ``assign``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from remitlens.llm.common import count_words, table, text_key
from remitlens.session import materialize

WHOLE = 1 / 8  # of a shard's capacity: larger groups are cut
HEAD = 1 / 64  # of a shard's capacity: larger groups are placed first, in one list
SLICE = 20_000  # groups that one task places
SLOTS = 50_000  # rows that one task numbers


def place(items: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Shard of each item (rows of ``items``, in the order to place them); ``residual`` is used up."""
    scale = np.maximum(residual.mean(axis=0), 1e-9)
    items, left = items / scale, residual / scale
    out = np.empty(len(items), dtype=np.int32)
    for k, item in enumerate(items):
        score = left @ item
        fits = (left >= item).all(axis=1)
        if fits.any():
            score = np.where(fits, score, -np.inf)
        best = int(score.argmax())
        left[best] -= item
        out[k] = best
    residual[:] = left * scale
    return out


def assign(rows: DataFrame, group: str, spread: Column, dims: list[str], n_shards: int) -> DataFrame:
    """``rows`` with an int column ``shard``. ``spread`` splits a large group; rows should be small and stored."""
    salts = 8 * n_shards
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(spread, F.col(group)), F.lit(salts)).cast("int"))
    sums = [F.sum(d).cast("double").alias(d) for d in dims]
    pieces = materialize(rows.groupBy(group, "_salt").agg(*sums), "op1-pieces")
    groups = pieces.groupBy(group).agg(*[F.sum(d).alias(d) for d in dims])
    total = groups.agg(*[F.sum(d).alias(d) for d in dims], F.count(F.lit(1)).alias("n")).first()
    capacity = np.array([max(float(total[d] or 0), 1e-9) / n_shards for d in dims])
    load = F.greatest(*[F.col(d) / F.lit(float(c)) for d, c in zip(dims, capacity)]) if len(dims) > 1 else F.col(dims[0]) / F.lit(float(capacity[0]))
    # loads of all groups sum to n_shards in each dimension, so at most dims * n_shards / WHOLE groups are cut
    cut = groups.where(load > WHOLE).select(group)
    whole = groups.where(load <= WHOLE).withColumn("_salt", F.lit(-1))
    items = materialize(
        whole.unionByName(pieces.join(F.broadcast(cut), group)).withColumn("_load", load), "op1-items")
    # bounded in the same way: at most dims * n_shards / HEAD of them
    head = items.where(F.col("_load") > HEAD).orderBy(F.desc("_load"), group, "_salt").toPandas()
    residual = np.tile(capacity, (n_shards, 1))
    head["shard"] = place(head[dims].to_numpy(dtype=float), residual)
    rest_total = np.maximum(residual.sum(axis=0), 1e-9)
    slices = max(1, math.ceil(int(total["n"]) / SLICE))
    schema = f"{group} string, _salt int, shard int"

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_load", group, "_salt"], ascending=[False, True, True], kind="stable")
        vectors = pdf[dims].to_numpy(dtype=float)
        own = residual * (vectors.sum(axis=0) / rest_total)
        return pd.DataFrame({group: pdf[group], "_salt": pdf["_salt"], "shard": place(vectors, own)})

    tail = (items.where(F.col("_load") <= HEAD)
            .withColumn("_slice", F.pmod(F.xxhash64(group, "_salt"), F.lit(slices)))
            .groupBy("_slice").applyInPandas(fill, schema))
    spark = rows.sparkSession
    placed = tail.unionByName(spark.createDataFrame(head[[group, "_salt", "shard"]], schema)) if len(head) else tail
    marked = rows.join(F.broadcast(cut.withColumn("_cut", F.lit(True))), group, "left")
    marked = marked.withColumn("_salt", F.when(F.col("_cut"), F.col("_salt")).otherwise(F.lit(-1))).drop("_cut")
    return marked.join(placed, [group, "_salt"]).drop("_salt")


def number(rows: DataFrame, shard: str, order: list[str], n_rows: int, n_shards: int) -> DataFrame:
    """``rows`` with a gapless long ``slot`` from 0 in each shard, counted in buckets side by side."""
    buckets = max(1, math.ceil(n_rows / (n_shards * SLOTS)))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = rows.groupBy(shard, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(shard).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(shard, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rank = F.row_number().over(W.partitionBy(shard, "_bucket").orderBy(*order))
    return (rows.withColumn("_rank", rank).join(starts, [shard, "_bucket"])
            .withColumn("slot", (F.col("_start") + F.col("_rank") - 1).cast("long")).drop("_bucket", "_rank", "_start"))


def shard_documents(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """One row per document (doc_id, size, text_crc32, law, shard, slot, grown_shard, tokens), bytes, tokens and rows even."""
    text = F.col("text")
    rows = materialize(docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        count_words(text).alias("tokens"),
        text_key(text).alias("group"), F.lit(1).cast("long").alias("rows")), "op1-rows")
    placed = materialize(assign(rows, "group", F.col("doc_id"), ["size", "tokens", "rows"], n_shards), "op1-placed")
    numbered = number(placed, "shard", ["doc_id", "text_crc32", "size"], rows.count(), n_shards)
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                           F.lit(None).cast("int").alias("grown_shard"), "tokens", "group")


def shard_rows(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """The documents themselves with ``shard`` and ``slot``; columns of these names are replaced."""
    where = shard_documents(docs, n_shards).withColumn(
        "_i", F.row_number().over(W.partitionBy("doc_id", "group").orderBy("shard", "slot")))
    names = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").alias("_id"), text_key(F.col("text")).alias("_group"))
    rows = rows.withColumn("_i", F.row_number().over(W.partitionBy("_id", "_group").orderBy(F.lit(1))))
    met = rows["_id"].eqNullSafe(where["doc_id"]) & (rows["_group"] == where["group"]) & (rows["_i"] == where["_i"])
    return rows.join(where, met).select("_row.*", where["shard"], where["slot"])


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).drop("group")
