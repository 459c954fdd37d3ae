"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Every document has a wished number of copies, its source's target over its source's size. The whole part is
taken; the fractional parts are settled by pivoting: two documents meet, word mass moves from one to the
other until one of them is taken in full or not at all, and the direction is drawn so that each document's
expected mass stays as it was. The words that a pair takes never change, so a source misses its target by
less than one document. Documents meet in blocks of about ``BLOCK``; what a block leaves open, one document
at most, meets the rest of other blocks one level higher: a reduction tree of depth log(n).

Draws come from hashes of the document ids, so reruns agree. Rows that agree in source, id and size
are counted before they are dealt, so that repeats of one row cannot fill a block.

Defined results: null or wordless texts have size 0 and take 0 words; a null source is a source of its own,
last in order; repeated rows are settled together and all returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from remitlens.llm.common import count_words, table
from remitlens.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
BLOCK = 48
SEED = 20240611


def source_targets(sized: DataFrame) -> DataFrame:
    """Per source: source_size (long) and target (double). One row per source enters the window.

    Filling by weight with a ceiling: in order of ceiling over weight, sources are full as long as the level
    that the others would get lies above theirs.
    """
    per = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    per = per.withColumn("_weight", F.element_at(weights, (place % len(WEIGHTS) + 1).cast("int")))
    per = per.withColumn("_cap", F.col("source_size") * F.lit(MOST)).withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    order = W.orderBy("_ratio", F.asc_nulls_last("source"))
    full = F.coalesce(F.sum("_cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("_weight").over(order.rowsBetween(0, W.unboundedFollowing))
    everything = F.sum("source_size").over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    per = per.withColumn("_level", (everything * F.lit(SHARE) - full) / open_weight)
    first = F.min(F.when(F.col("_ratio") >= F.col("_level"), F.struct("_ratio", "_level"))).over(
        W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    level = F.coalesce(first["_level"], F.lit(float("inf")))
    return per.select("source", "source_size", F.least(F.col("_cap"), F.col("_weight") * level).alias("target"))


def _settle() -> Column:
    """Fold a sorted array ``items`` into the document left open (or null) and the settled ones."""
    item = "struct<h:bigint,doc_id:bigint,size:bigint,n:bigint,base:bigint,mass:double>"
    done = f"array<struct<it:{item},extra:int>>"

    def closed(it: Column, extra: int) -> Column:
        return F.array(F.struct(it.alias("it"), F.lit(extra).alias("extra")))

    def moved(it: Column, mass: Column) -> Column:
        return F.struct(it["h"].alias("h"), it["doc_id"].alias("doc_id"), it["size"].alias("size"), it["n"].alias("n"), it["base"].alias("base"), mass.alias("mass"))

    def state(open_: Column, closed_: Column) -> Column:
        return F.struct(open_.cast(item).alias("open"), closed_.cast(done).alias("done"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["open"]
        into, out = F.least(a["size"] - a["mass"], x["mass"]), F.least(a["mass"], x["size"] - x["mass"])
        draw = F.pmod(F.xxhash64(F.lit(SEED), a["h"], x["h"]), F.lit(1 << 40)) / F.lit(float(1 << 40))
        none = F.lit(None).cast(item)
        keep = acc["done"]
        gain = (F.when((into == a["size"] - a["mass"]) & (into == x["mass"]), state(none, F.concat(keep, closed(a, 1), closed(x, 0))))
                .when(into == a["size"] - a["mass"], state(moved(x, x["mass"] - into), F.concat(keep, closed(a, 1))))
                .otherwise(state(moved(a, a["mass"] + into), F.concat(keep, closed(x, 0)))))
        lose = (F.when((out == a["mass"]) & (out == x["size"] - x["mass"]), state(none, F.concat(keep, closed(a, 0), closed(x, 1))))
                .when(out == a["mass"], state(moved(x, x["mass"] + out), F.concat(keep, closed(a, 0))))
                .otherwise(state(moved(a, a["mass"] - out), F.concat(keep, closed(x, 1)))))
        return F.when(a.isNull(), state(x, keep)).when(draw * (into + out) < out, gain).otherwise(lose)

    return F.aggregate("items", state(F.lit(None), F.array()), step)


def plan_copies(sized: DataFrame) -> DataFrame:
    """For rows (doc_id, source, size): one row per distinct row with ``n`` (how often it occurs), ``base``
    copies for each, ``more`` (so many of the n get one copy more), source_size and target."""
    targets = materialize(source_targets(sized), "op3-targets")
    units = sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n"))
    u, t = units.alias("u"), targets.alias("t")
    wish = F.when(F.col("t.source_size") > 0, F.col("t.target") / F.col("t.source_size")).otherwise(F.lit(0.0))
    units = u.join(t, F.col("u.source").eqNullSafe(F.col("t.source"))).select("u.*", "t.source_size", "t.target", wish.alias("_wish"))
    units = units.withColumn("base", F.floor("_wish")).withColumn("_part", (F.col("_wish") - F.col("base")) * F.col("n"))
    units = units.withColumn("_sure", F.floor("_part"))
    units = materialize(units.withColumn("_mass", (F.col("_part") - F.col("_sure")) * F.col("size")), "op3-units")
    is_open = (F.col("_mass") > 0) & (F.col("_mass") < F.col("size"))
    sure = units.where(~is_open).select("source", "doc_id", "size", F.lit(0).alias("extra"))
    h = F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("size"))
    live = units.where(is_open)
    per = live.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
    most = per.agg(F.max("blocks")).first()[0] or 0
    v, p = live.alias("v"), per.alias("p")
    live = v.join(p, F.col("v.source").eqNullSafe(F.col("p.source"))).select(
        "v.source", "p.blocks", F.struct(h.alias("h"), F.col("v.doc_id").alias("doc_id"), F.col("v.size").alias("size"),
                                         F.col("v.n").alias("n"), F.col("v.base").alias("base"), F.col("v._mass").alias("mass")).alias("it"))
    settled, level = [], 0
    while most:
        block = F.pmod(F.xxhash64(F.lit(level), F.col("it.h"), F.col("it.doc_id")), F.col("blocks"))
        folded = (live.groupBy("source", "blocks", block.alias("_block")).agg(F.sort_array(F.collect_list("it")).alias("items"))
                  .select("source", "blocks", _settle().alias("s")))
        folded = materialize(folded, f"op3-level{level}")
        settled.append(folded.select("source", F.explode("s.done").alias("d")).select(
            "source", "d.it.doc_id", "d.it.size", "d.extra"))
        live = folded.where(F.col("s.open").isNotNull()).select(
            "source", F.ceil(F.col("blocks") / BLOCK).cast("long").alias("blocks"), F.col("s.open").alias("it"))
        if most == 1:
            last = F.pmod(F.xxhash64(F.lit(SEED + 1), F.col("it.h")), F.lit(1 << 40)) / F.lit(float(1 << 40))
            settled.append(live.select("source", "it.doc_id", "it.size",
                                       F.when(last * F.col("it.size") < F.col("it.mass"), 1).otherwise(0).alias("extra")))
        most, level = (0 if most == 1 else math.ceil(most / BLOCK)), level + 1
    for part in settled:
        sure = sure.unionByName(part)
    u, s = units.alias("u"), sure.alias("s")
    met = F.col("u.doc_id").eqNullSafe(F.col("s.doc_id")) & F.col("u.source").eqNullSafe(F.col("s.source")) & (F.col("u.size") == F.col("s.size"))
    more = (F.col("u._sure") + F.col("s.extra")).alias("more")
    return u.join(s, met).select("u.doc_id", "u.source", "u.size", "u.n", "u.base", more, "u.source_size", "u.target")


def size_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", count_words(F.col("text")).alias("size"))


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    plan = plan_copies(materialize(size_rows(docs), "op3-sized"))
    each = plan.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    copies = (F.col("base") + F.when(F.col("_i") <= F.col("more"), 1).otherwise(0)).cast("long")
    return each.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    plan = plan_copies(materialize(size_rows(docs), "op3-sized"))
    plan = plan.select(F.col("doc_id").alias("_id"), F.col("source").alias("_src"), F.col("size").alias("_size"), "base", "more")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.md5(F.coalesce("text", F.lit(""))).alias("_key"),
                       F.col("doc_id").alias("_did"), F.col("source").alias("_dsrc"), count_words(F.col("text")).alias("_dsize"))
    rows = rows.withColumn("_i", F.row_number().over(W.partitionBy("_did", "_dsrc", "_dsize").orderBy("_key")))
    met = F.col("_id").eqNullSafe(F.col("_did")) & F.col("_src").eqNullSafe(F.col("_dsrc")) & (F.col("_size") == F.col("_dsize"))
    copies = (F.col("base") + F.when(F.col("_i") <= F.col("more"), 1).otherwise(0)).cast("int")
    joined = rows.join(plan, met).withColumn("_copies", copies).where("_copies >= 1")
    return joined.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_c")).select("_row.*")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))
