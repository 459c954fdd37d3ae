"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base rules look at one document. The method's own rule looks across documents: normalised lines are hashed,
distinct documents are counted per host (``source``) and line, lines in more documents than the limit are
removed, and a document that keeps less than ``KEEP_SHARE`` of its words is depleted and rejected.

Documents are counted by distinct text, and texts that are near copies of each other count once, both for a line and for the host: else
a group of near copies would lift all its lines above the limit, and go before the deduplication sees it. Near copies share
``SAME_SHARE`` of their words in lines (Jaccard similarity). All lines above the limit are removed, also those of pages that hold little else.

Lines are counted with map-side sums on (host, line), so a line in a third of all documents is no hot key.

Defined results: a null text has no words and fails the base rules; a null host is a host of its own; repeated
rows are all returned; ties need no order; an empty table gives an empty result; further columns are kept aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm.common import GAP, as_words, row_key, table
from remitlens.session import materialize

MIN_WORDS = 20
REPEAT_PCT = 30
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
LINE_DOCS = 10  # a line in so many documents of a host, or fewer, stays
LINE_SHARE = 0.01  # and so does one in this share of the host's documents
SAME_SHARE = 0.8  # near copies share so much of their words in lines
ORDERS = 4
KEEP_SHARE = 0.3  # a document that keeps a smaller share of its words is depleted


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more; ``hashes`` holds one hash for each window start."""
    def covered(starts: Column) -> Column:
        nexts = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.lit(1 << 30)))
        return F.aggregate(F.zip_with(starts, nexts, lambda a, b: F.least(b - a, F.lit(WINDOW))), F.lit(0), lambda s, x: s + x)

    def marked(s: Column) -> Column:
        twin = lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["p"]))

    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    return _bind(F.sort_array(pairs), lambda s: _bind(marked(s), covered))


def line_hash(line: Column) -> Column:
    """Hash of a line without regard to case, digits and white space."""
    return F.xxhash64(F.translate(F.lower(F.btrim(line)), "0123456789", "0000000000"))


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, source, key, doc, lines (those with a word) and the base counts; one row per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", "source", text.alias("text"), row_key(F.col("doc_id"), F.col("source"), F.col("text")).alias("key"), F.md5(text).alias("doc"), as_words(F.col("text")).alias("words"))
    d = d.withColumn("n_words", F.size("words").cast("long")).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit("\x20\x09\x0a\x0b\x0c\x0d")) != ""))
    windows = F.transform(F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW)))
    d = d.withColumn("_h", F.when(F.col("n_words") > WINDOW, windows))
    d = d.withColumn("_again", F.coalesce(F.size(F.array_distinct("_h")) < F.size("_h"), F.lit(False)))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PCT)
    return d.select(
        "doc_id", "source", "key", "doc", "lines", "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("_again"), repeated_words(F.col("_h"))).otherwise(0).cast("long").alias("n_repeat_words"),
    ).withColumn("base_failed", failed)


def near_copies(hit: DataFrame) -> DataFrame:
    """(source, doc) of texts that share at least ``SAME_SHARE`` of their words in lines with a text that stands for them. ``hit``
    holds the shared lines (source, doc, total, h, w) of every text. A text is compared with the first of those that agree with it in the lowest hash
    of their lines, under several orders of the hashes."""
    lines = hit.groupBy("source", "doc", "total").agg(F.collect_list(F.struct("h", "w")).alias("lines"), F.sum("w").alias("shared"))
    lines = materialize(lines.where(F.col("shared") >= F.col("total") * SAME_SHARE), "op4-shared")
    orders = F.array(*[F.array_min(F.transform("lines", lambda x: F.xxhash64(x["h"], F.lit(k)))) for k in range(ORDERS)])  # noqa: B023
    keys = lines.select(F.coalesce("source", F.lit("")).alias("host"), F.col("source").isNull().alias("none"), "doc", F.posexplode(orders).alias("k", "key"))
    on = ["host", "none", "k", "key"]
    leads = keys.groupBy(*on).agg(F.min("doc").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    pairs = keys.join(leads, on).where("doc > lead").select("host", "none", "doc", "lead").distinct()
    full = lines.select(F.coalesce("source", F.lit("")).alias("host"), F.col("source").isNull().alias("none"), "source", "doc", "total", "lines")
    first = full.select("host", "none", F.col("doc").alias("lead"), F.col("total").alias("lead_total"), F.transform("lines", lambda x: x["h"]).alias("lead_lines"))
    both = pairs.join(full, ["host", "none", "doc"]).join(first, ["host", "none", "lead"])
    common = F.array_intersect(F.transform("lines", lambda x: x["h"]), F.col("lead_lines"))
    words = _bind(common, lambda c: F.aggregate(F.filter("lines", lambda x: F.array_contains(c, x["h"])), F.lit(0).cast("long"), lambda n, x: n + x["w"]))
    both = both.withColumn("words", words).where(F.col("words") >= SAME_SHARE * (F.col("total") + F.col("lead_total") - F.col("words")))
    return both.select("source", "doc").distinct()


def frequent_lines(base: DataFrame) -> DataFrame:
    """(source, h): hashes of lines in more documents of the host than the limit. ``base`` has source, doc (digest of the
    text) and lines (hash h, words w)."""
    texts = base.select("source", "doc", F.array_distinct("lines").alias("lines")).groupBy("source", "doc").agg(F.first("lines").alias("lines"))
    texts = materialize(texts.withColumn("total", F.aggregate("lines", F.lit(0).cast("long"), lambda s, x: s + x["w"])), "op4-texts")
    held = texts.select("source", "doc", "total", F.explode("lines").alias("l")).select("source", "doc", "total", "l.h", "l.w")
    often = materialize(held.groupBy("source", "h").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") > LINE_DOCS), "op4-often")
    e, o = held.alias("e"), often.alias("o")
    hit = materialize(e.join(o, F.col("e.source").eqNullSafe(F.col("o.source")) & (F.col("e.h") == F.col("o.h"))).select("e.source", "e.doc", "e.total", "e.h", "e.w"), "op4-hit")
    copies = materialize(near_copies(hit), "op4-copies")
    m, c = hit.alias("m"), copies.alias("c")
    again = m.join(c, F.col("m.source").eqNullSafe(F.col("c.source")) & (F.col("m.doc") == F.col("c.doc"))).select("m.source", "m.h", F.lit(-1).alias("docs"))
    lines = often.select("source", "h", "docs").unionByName(again).groupBy("source", "h").agg(F.sum("docs").alias("docs")).where(F.col("docs") > LINE_DOCS).alias("l")
    hosts = texts.select("source", F.lit(1).alias("n")).unionByName(copies.select("source", F.lit(-1).alias("n"))).groupBy("source").agg(F.sum("n").alias("host_docs")).alias("s")
    return lines.join(hosts, F.col("l.source").eqNullSafe(F.col("s.source"))).where(F.col("docs") > F.col("host_docs") * LINE_SHARE).select("l.source", "l.h")


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: key, base counts, removed (hashes of its removed lines), removed_words, kept."""
    base = materialize(base_rules(docs).withColumn("lines", F.transform("lines", lambda x: F.struct(line_hash(x).alias("h"), F.size(as_words(x)).alias("w")))), "op4-base")
    hot = materialize(frequent_lines(base), "op4-lines")
    mine = base.select("key", "source", F.explode("lines").alias("l")).groupBy("key", "source", "l.h").agg(F.sum("l.w").alias("w"), F.count(F.lit(1)).alias("_n"))
    m, t = mine.alias("m"), hot.alias("t")
    gone = (m.join(t, F.col("m.source").eqNullSafe(F.col("t.source")) & (F.col("m.h") == F.col("t.h")))
            .groupBy("m.key").agg(F.sum("m.w").alias("_w"), F.collect_set("m.h").alias("removed")))
    times = base.groupBy("key").agg(F.count(F.lit(1)).alias("_times"))  # repeated rows were summed together
    gone = gone.join(times, "key").select("key", (F.col("_w") / F.col("_times")).cast("long").alias("removed_words"), "removed")
    out = base.drop("lines", "doc").join(gone, "key", "left")
    left = F.col("n_words") - F.coalesce("removed_words", F.lit(0))
    return out.withColumn("kept", ~F.col("base_failed") & (left >= F.col("n_words") * KEEP_SHARE))


def clean_documents(docs: DataFrame) -> DataFrame:
    """Documents that pass, without the lines above the limits; the columns of ``docs``, n_chars brought up to date."""
    names = docs.columns
    verdict = judge(docs).where("kept").select("key", "removed").groupBy("key").agg(F.first("removed").alias("removed"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), row_key(F.col("doc_id"), F.col("source"), F.col("text")).alias("key"))
    rows = rows.join(verdict, "key")
    text = F.col("_row.text")
    rest = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(F.col("removed"), line_hash(x))), "\n")
    rows = rows.withColumn("_text", F.when(F.col("removed").isNull(), text).otherwise(rest))
    fresh = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return rows.select(*[fresh[c].alias(c) if c in fresh else F.col(f"_row.`{c}`") for c in names])


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.coalesce("removed_words", F.lit(0)).cast("long").alias("removed_words"))
