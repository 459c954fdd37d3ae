"""Token counts: an exact histogram of encoded lengths answers every context limit.

Documents are encoded once, in Arrow batches; after that only (length, documents) pairs move, counted on the
map side. Suffix sums over the histogram give, for every length L that occurs, the documents and tokens at or above L,
the share of documents up to L, and how many tokens remain if all documents are cut to L. The suffix sums run in
bands of ``BAND`` lengths with one offset per band, so no task sees more than a band.

The tokenizer is a byte-pair vocabulary of ranks (50 k entries, a fixed size) whose path is a parameter; it is read on
the driver and sent to the tasks.

Defined results: a null or empty text has length 0 and is counted; repeated rows count each; an empty table gives an empty histogram.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from remitlens.llm.common import table
from remitlens.session import materialize

BAND = 1024


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def load_ranks(path: str) -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return ranks, public_tokenizers.PATTERN


def encoded_lengths(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(tokens long), one row per document."""
    sent = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary or default_vocabulary()))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks, pattern = sent.value
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = np.array([len(enc.encode_ordinary(t)) if t else 0 for t in b.column("text").to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(n)], names=["tokens"])

    return docs.select("text").mapInArrow(each, "tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """From (tokens): per length its documents, suffix sums, the quantile it stands for and the truncated total."""
    per = materialize(lengths.groupBy("tokens").agg(F.count(F.lit(1)).alias("docs")).withColumn("_band", F.floor(F.col("tokens") / BAND)), "op6-lengths")
    bands = per.groupBy("_band").agg(F.sum("docs").alias("_d"), F.sum(F.col("docs") * F.col("tokens")).alias("_t"))
    above = W.orderBy(F.desc("_band")).rowsBetween(W.unboundedPreceding, -1)  # one row per BAND lengths
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    bands = bands.select("_band", F.coalesce(F.sum("_d").over(above), F.lit(0)).alias("_d"), F.coalesce(F.sum("_t").over(above), F.lit(0)).alias("_t"),
                         F.sum("_d").over(everything).alias("_docs"), F.sum("_t").over(everything).alias("_tokens"))
    inside = W.partitionBy("_band").orderBy(F.desc("tokens")).rowsBetween(W.unboundedPreceding, 0)
    rows = per.withColumn("_di", F.sum("docs").over(inside)).withColumn("_ti", F.sum(F.col("docs") * F.col("tokens")).over(inside)).join(bands, "_band")
    docs_from, tokens_from = F.col("_di") + F.col("_d"), F.col("_ti") + F.col("_t")
    return rows.select(
        "tokens", "docs", (F.col("docs") * F.col("tokens")).alias("total"), docs_from.alias("docs_from"), tokens_from.alias("tokens_from"),
        ((F.col("_docs") - docs_from + F.col("docs")) / F.col("_docs")).alias("quantile"),
        (F.col("_tokens") - tokens_from + docs_from * F.col("tokens")).alias("truncated_total"),
        (tokens_from - docs_from * F.col("tokens")).alias("lost_tokens"))


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """(context, docs_cut, truncated_total) for any limits, also those that no document has as its length."""
    contexts = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in sorted(set(limits))]))
    kept = F.sum(F.col("docs") * F.least("tokens", "context"))
    cut = F.sum(F.when(F.col("tokens") > F.col("context"), F.col("docs")).otherwise(0))
    return hist.select("tokens", "docs", contexts.alias("context")).groupBy("context").agg(cut.alias("docs_cut"), kept.alias("truncated_total"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(encoded_lengths(table(spark, sf_dir, "documents")))
