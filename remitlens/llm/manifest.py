"""Merkle manifest of a dataset by concatenated-level strings.

Each row is a leaf: the sha256 of its fields, written with their lengths. The leaves of a source, in the order of doc_id, are hashed in runs of
``ARITY`` until one node remains, the subroot; the subroots in the order of their source give the root in the same way.

Leaves are dealt to aligned blocks of ``ARITY ** LEVELS``. A block keeps each of its levels as one hex string: fixed-width substrings
hash to the parents, and the substrings that flank a node in its run are its siblings. The roots of the blocks are the leaves of the next round,
so a source of any size takes a few rounds of bounded blocks, and no task holds more than one block of a group at a time. Upper paths are joined
to blocks, not to rows.

``manifest`` returns the full proof of each row as (left, right) sibling strings; ``fold`` recomputes the root from a leaf and its proof.

Defined results: a null field is written ``-``; an empty text is ``0:``; rows equal in all fields are leaves of their own with equal
digests; rows of equal doc_id and different content are ordered by their digests; null doc_ids come first, as does the null source; very long texts are
hashed whole where they are read and never move; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm.common import same, table
from remitlens.operators.ordering import global_rank
from remitlens.session import materialize

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
ARITY = 3
LEVELS = 5
BLOCK = ARITY ** LEVELS
HEX = 64  # width of a digest


def leaf(text: Column | None = None) -> Column:
    """Digest of the row's fields; ``text`` stands in for the text."""
    parts = []
    for name in FIELDS:
        c = (text if name == "text" and text is not None else F.col(name)).cast("string")
        parts.append(F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)))
    return F.sha2(F.concat(*parts), 256)


def parents(level: Column) -> Column:
    """The level above a level, both as strings of digests."""
    runs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / (ARITY * HEX)).cast("int"))
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * ARITY * HEX + 1, ARITY * HEX), 256)), "")


def _block_levels(first: Column, whole: Column) -> Column:
    """All levels of a block. A block of a larger tree goes up ``LEVELS`` times, a lone block until one node is left."""
    last = lambda a: F.element_at(a, -1)
    return F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), F.array(first), lambda acc, _: F.when(
        ~whole | (F.length(last(acc)) > HEX), F.concat(acc, F.array(parents(last(acc))))).otherwise(acc))


def _steps(levels: Column, at: Column) -> Column:
    """Siblings of the node at ``at`` on each level of its block, as the digests left and right of it in its run."""
    width = F.array(*[F.lit(ARITY ** k) for k in range(LEVELS + 1)])

    def step(k: Column) -> Column:
        node = F.floor(at / F.element_at(width, k)).cast("int")
        own = F.pmod(node, F.lit(ARITY))
        run = F.substring(F.element_at(levels, k), (node - own) * HEX + 1, F.lit(ARITY * HEX))
        return F.struct(F.substring(run, F.lit(1), own * HEX).alias("left"), F.substring(run, (own + 1) * HEX + 1, F.lit(ARITY * HEX)).alias("right"))

    empty = F.array().cast("array<struct<left:string,right:string>>")
    return F.when(F.size(levels) > 1, F.transform(F.sequence(F.lit(1), F.size(levels) - 1), step)).otherwise(empty)


def _blocks(nodes: DataFrame) -> DataFrame:
    """(tree, n, block, root, rows) of nodes (tree, n, pos, h, data): each row of a block with its siblings inside the block."""
    dealt = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))
    held = dealt.groupBy("tree", "n", "block").agg(F.sort_array(F.collect_list(F.struct("pos", "h", "data"))).alias("rows"))  # BLOCK rows at most
    first = F.array_join(F.transform("rows", lambda x: x["h"]), "")
    held = held.withColumn("levels", _block_levels(first, F.col("n") <= BLOCK))
    rows = F.transform("rows", lambda x: F.struct(x["pos"].alias("pos"), x["h"].alias("h"), x["data"].alias("data"), _steps(F.col("levels"), F.pmod(x["pos"], F.lit(BLOCK))).alias("steps")))
    return materialize(held.select("tree", "n", "block", F.element_at("levels", -1).alias("root"), rows.alias("rows")), "op11-blocks")


def _joined(blocks: DataFrame, upper: DataFrame, on: list[str]) -> DataFrame:
    """Blocks with the siblings above them appended to those of their rows; trees of one block are as they are."""
    got = blocks.join(upper, on, "left")
    above = F.coalesce("above", F.array().cast("array<struct<left:string,right:string>>"))
    return got.select("tree", "n", "block", F.coalesce("top", "root").alias("root"), "rows", above.alias("above"))


def _trees(nodes: DataFrame) -> DataFrame:
    """(tree, n, block, root, rows, above) of every tree: its root, its rows with the siblings in their block, the siblings above."""
    blocks = _blocks(nodes)
    large = blocks.where(F.col("n") > BLOCK)
    if large.isEmpty():
        return blocks.withColumn("above", F.array().cast("array<struct<left:string,right:string>>"))
    up = _trees(large.select("tree", F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("block").alias("pos"), F.col("root").alias("h"), F.lit(None).cast("string").alias("data")))
    paths = up.select("tree", "above", F.col("root").alias("top"), F.explode("rows").alias("x"))
    paths = materialize(paths.select("tree", F.col("x.pos").alias("block"), F.concat("x.steps", "above").alias("above"), "top"), "op11-upper")
    return _joined(blocks, paths, ["tree", "block"])


def fold(start: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, start, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def manifest(docs: DataFrame, other: Column | None = None) -> DataFrame:
    """(doc_id, leaf, other, subroot, root, steps) of every row; ``other`` is a column of ``docs`` carried along."""
    rows = docs.select("doc_id", "source", leaf().alias("leaf"), (F.lit(None).cast("string") if other is None else other).alias("other"))
    ranked = global_rank(rows, [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.col("leaf")], "rank")
    trees = materialize(ranked.groupBy("source").agg((F.min("rank") - 1).alias("tree"), F.count(F.lit(1)).alias("n")), "op11-sources")
    nodes = ranked.join(trees, same(ranked, trees, ["source"])).select(
        "tree", "n", (F.col("rank") - 1 - F.col("tree")).alias("pos"), F.col("leaf").alias("h"), F.struct("doc_id", "other").alias("data"))
    found = materialize(_trees(nodes), "op11-trees")
    # the subroots: trees are numbered in the order of their sources
    subroots = found.where("block = 0").select("tree", F.col("root").alias("subroot"))
    order = global_rank(subroots, [F.col("tree")], "rank").withColumn("n", subroots.agg(F.count(F.lit(1)).alias("n")).scalar())
    top = _trees(order.select(F.lit(0).cast("long").alias("tree"), "n", (F.col("rank") - 1).alias("pos"), F.col("subroot").alias("h"), F.col("tree").alias("data")))
    top = top.select(F.col("root").alias("all_root"), F.col("above").alias("high"), F.explode("rows").alias("x"))
    top = materialize(top.select(F.col("x.data").alias("tree"), F.col("x.h").alias("subroot"), F.concat("x.steps", "high").alias("high"), "all_root"), "op11-top")
    whole = found.join(top, "tree").select("subroot", "all_root", F.concat("above", "high").alias("above"), F.explode("rows").alias("x"))
    return whole.select(F.col("x.data.doc_id").alias("doc_id"), F.col("x.h").alias("leaf"), F.col("x.data.other").alias("other"), "subroot", F.col("all_root").alias("root"),
                        F.concat("x.steps", "above").alias("steps"))


def tampered() -> Column:
    """Leaf of the row as it reads after a tampering: where the checksum of doc_id is even its text has lost its line feeds; else null."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even & F.contains("text", F.lit("\n")), leaf(F.translate("text", "\n", "")))


def check_manifest(docs: DataFrame, other: Column) -> DataFrame:
    """Each row's proof as a digest, and whether the leaf ``other`` (null: the row's own) still folds to the root."""
    full = manifest(docs, other)
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    out = full.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), fold(F.coalesce("other", "leaf"), F.col("steps")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_manifest(table(spark, sf_dir, "documents"), tampered())


SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos, *, replace(text, chr(10), '') AS cut FROM documents),
crc AS (SELECT DISTINCT doc_id, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))) AS c FROM documents),
f AS (SELECT doc_id, source, pos, concat(coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-'), coalesce(octet_length(encode(source)) || ':' || source, '-'),
        coalesce(octet_length(encode(lang)) || ':' || lang, '-'), coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-')) AS head,
        coalesce(octet_length(encode(text)) || ':' || text, '-') AS body, coalesce(octet_length(encode(cut)) || ':' || cut, '-') AS short FROM d),
leaves AS (SELECT f.doc_id, source, pos, sha256(head || body) AS leaf, CASE WHEN xor(c, 4294967295) % 2 = 0 THEN sha256(head || short) ELSE sha256(head || body) END AS other
    FROM f LEFT JOIN crc ON f.doc_id = crc.doc_id),
up(source, lvl, pos, h, n) AS (SELECT source, 0, pos, leaf, count(*) OVER (PARTITION BY source) FROM leaves
    UNION ALL SELECT source, lvl, pos, h, count(*) OVER (PARTITION BY source) FROM (
        SELECT source, any_value(lvl) + 1 AS lvl, pos // 3 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h FROM up WHERE n > 1 GROUP BY source, pos // 3)),
sub AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM up WHERE n = 1),
top(lvl, pos, h, n) AS (SELECT 0, pos, subroot, count(*) OVER () FROM sub
    UNION ALL SELECT lvl, pos, h, count(*) OVER () FROM (SELECT any_value(lvl) + 1 AS lvl, pos // 3 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h FROM top WHERE n > 1 GROUP BY pos // 3)),
low AS (SELECT a.source, a.lvl, a.pos, string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos) AS l, string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos) AS r
    FROM up a JOIN up b ON a.source IS NOT DISTINCT FROM b.source AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL),
high AS (SELECT a.lvl, a.pos, string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos) AS l, string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos) AS r
    FROM top a JOIN top b ON a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL),
steps AS (SELECT s.source, s.pos, low.lvl, coalesce(l, '') AS l, coalesce(r, '') AS r FROM leaves s JOIN low ON s.source IS NOT DISTINCT FROM low.source AND low.pos = s.pos // CAST(3 ** low.lvl AS BIGINT)
    UNION ALL SELECT s.source, s.pos, 1000 + high.lvl, coalesce(l, ''), coalesce(r, '') FROM leaves s JOIN sub ON s.source IS NOT DISTINCT FROM sub.source JOIN high ON high.pos = sub.pos // CAST(3 ** high.lvl AS BIGINT)),
path AS (SELECT source, pos, list({'l': l, 'r': r} ORDER BY lvl) AS p FROM steps GROUP BY source, pos),
walk(source, pos, k, acc, p) AS (SELECT s.source, s.pos, 1, other, coalesce(p, []) FROM leaves s LEFT JOIN path ON s.source IS NOT DISTINCT FROM path.source AND s.pos = path.pos
    UNION ALL SELECT source, pos, k + 1, sha256(p[k].l || acc || p[k].r), p FROM walk WHERE k <= len(p))
SELECT s.doc_id, s.leaf, subroot, root, sha256(array_to_string(list_transform(p, lambda x: x.l || x.r), '')) AS proof_sha256, acc AS folded_root, acc = root AS verified
FROM leaves s JOIN sub ON s.source IS NOT DISTINCT FROM sub.source JOIN walk w ON s.source IS NOT DISTINCT FROM w.source AND s.pos = w.pos AND w.k = len(w.p) + 1
    CROSS JOIN (SELECT h AS root FROM top WHERE n = 1)
"""
