"""SimHash near-duplicates through vantage-point trees.

Fingerprints: words of the text (A-Z lower-cased), shingles of three words with repeats, each hashed by XXH64
(seed 42); a bit is set when more than half of the hashes have it. The hashing runs in Arrow batches.

Search: fingerprints within ``LIMIT`` bits differ by at most ``LIMIT // QUARTERS`` bits in one of their quarters. Every quarter
has a vantage-point tree over the Hamming distance in that quarter, grown on a bounded sample, which deals the distinct
fingerprints into shards. Inner nodes hold a vantage point and a radius; a fingerprint lives on one side, and is sent as
a query to the other side as well when the triangle bound allows a partner there. With four quarters and three bits one quarter
agrees entirely, so the bound is tight and no boundary is crossed: each fingerprint goes to four shards however many there are.
(One tree over the whole distance sends each to 1.6 times as many shards per level; that was measured and left.)
Every shard grows a vantage-point tree of its own over the whole Hamming distance and runs all its queries down this tree
together; inner nodes prune by the triangle bound and leaves compare exactly. A shard emits a spanning forest of the
links it found, never all pairs.

Components: links of the shards are contracted by alternating large-star and small-star rounds.

Defined results: a null or wordless text has fingerprint zero; equal fingerprints are linked; a null doc_id
takes part but is never the id of a component unless its component has no other; repeated rows are all returned;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from remitlens.llm.common import row_key, table
from remitlens.session import materialize

LIMIT = 3
SHINGLE = 3
SEED = 42
QUARTERS = 4
SAMPLE = 20_000  # fingerprints that the upper trees are grown on
SHARD = 10_000  # fingerprints that live in one shard, about
LEAF = 128
_LOWER = bytes(range(256)).lower()


def fingerprint(text: str | None) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    h, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= SHINGLE:
        return h(join(words), SEED)
    got = np.array([h(b"%b %b %b" % x, SEED) for x in zip(words, words[1:], words[2:])], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(got), 1 << 16):
        ones += np.unpackbits(got[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(got), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, key, fp): fp is the fingerprint's 64 bits as a signed long."""
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t) for t in b.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(fps)], names=["doc_id", "key", "fp"])

    return rows.mapInArrow(each, "doc_id long, key string, fp long")


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def grow(points: np.ndarray, leaf: int) -> tuple:
    """Vantage-point tree: inner nodes (vantage, radius, inside, outside), leaves (points,)."""
    if len(points) <= leaf:
        return (points,)
    # of a few points spread over the node, the one whose distances vary most tells the others apart best
    tried = points[np.linspace(0, len(points) - 1, 5).astype(int)]
    some = points[:: max(1, len(points) // 500)]
    vantage = max(tried, key=lambda v: (distance(some, v).astype(float).std(), -int(v)))
    d = distance(points, vantage)
    radius = int(np.median(d))
    if (d <= radius).all():
        radius = int(d.max()) - 1
    near = d <= radius
    if near.all() or not near.any():
        return (points,)
    return (vantage, radius, grow(points[near], leaf), grow(points[~near], leaf))


def quarter(fps: np.ndarray, q: int, width: int) -> np.ndarray:
    return (fps >> np.uint64(q * width)) & np.uint64((1 << width) - 1)


def number_leaves(tree: tuple, start: int = 0) -> tuple[tuple, int]:
    """The tree with leaves replaced by numbers from ``start``."""
    if len(tree) == 1:
        return (start,), start + 1
    inside, k = number_leaves(tree[2], start)
    outside, k = number_leaves(tree[3], k)
    return (tree[0], tree[1], inside, outside), k


def route(tree: tuple, fps: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions in ``fps``, leaf numbers) of all leaves that may hold a point within ``reach``."""
    out_pos, out_leaf, todo = [], [], [(tree, np.arange(len(fps)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if len(node) == 1:
            out_pos.append(at)
            out_leaf.append(np.full(len(at), node[0], dtype=np.int32))
            continue
        d = distance(fps[at], node[0]).astype(int)
        todo.append((node[2], at[d <= node[1] + reach]))
        todo.append((node[3], at[d > node[1] - reach]))
    if not out_pos:
        return np.array([], dtype=int), np.array([], dtype=np.int32)
    return np.concatenate(out_pos), np.concatenate(out_leaf)


class Forest:
    """Union-find over the fingerprints of one shard; keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        x, y = self.find(a), self.find(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.links.append((a, b))


def shard_links(homes: np.ndarray, queries: np.ndarray, limit: int = LIMIT) -> list[tuple[int, int]]:
    """Spanning links (pairs of fingerprints) of all query-home pairs within ``limit``."""
    everything = np.unique(np.concatenate([homes, queries]))
    forest, todo = Forest(len(everything)), [(grow(homes, LEAF), queries)]
    while todo:
        node, asked = todo.pop()
        if not len(asked):
            continue
        if len(node) == 1:
            for k in range(0, len(asked), 4096):
                part = asked[k:k + 4096]
                q, x = np.nonzero(distance(part[:, None], node[0][None, :]) <= limit)
                other = part[q] != node[0][x]
                a, b = np.searchsorted(everything, part[q[other]]), np.searchsorted(everything, node[0][x[other]])
                for i, j in zip(a.tolist(), b.tolist()):
                    forest.join(i, j)
            continue
        d = distance(asked, node[0]).astype(int)
        todo.append((node[2], asked[d <= node[1] + limit]))
        todo.append((node[3], asked[d > node[1] - limit]))
    return [(int(everything[a]), int(everything[b])) for a, b in forest.links]


def near_links(fps: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints in column ``fp`` that connect all pairs within ``limit``."""
    n = fps.count()
    schema = "a long, b long"
    if n == 0:
        return fps.sparkSession.createDataFrame([], schema)
    shards = max(1, -(-n // SHARD))
    # the sample only shapes the upper trees; by hash order, so that reruns grow the same trees
    share = min(1.0, 2.0 * SAMPLE / n)
    taken = fps.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE)
    sample = np.array([r[0] for r in taken.collect()] or [0], dtype=np.int64).view(np.uint64)
    width, reach, trees, first = 64 // QUARTERS, limit // QUARTERS, [], 0
    for q in range(QUARTERS):
        tree, first = number_leaves(grow(quarter(sample, q, width), max(1, -(-len(sample) // shards))), first)
        trees.append(tree)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            f = pdf["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            for q, tree in enumerate(trees):
                part = quarter(f, q, width)
                at, home = route(tree, part, 0)
                own = np.empty(len(f), dtype=np.int32)
                own[at] = home
                pos, leaf = route(tree, part, reach)
                yield pd.DataFrame({"shard": leaf, "fp": f[pos].view(np.int64), "lives": own[pos] == leaf})

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        f = pdf["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        return pd.DataFrame([(np.uint64(a).astype(np.int64), np.uint64(b).astype(np.int64)) for a, b in shard_links(f[pdf["lives"].to_numpy(dtype=bool)], f, limit)], columns=["a", "b"]).astype("int64")

    return fps.mapInPandas(deal, "shard int, fp long, lives boolean").groupBy("shard").applyInPandas(search, schema)


def components(links: DataFrame) -> DataFrame:
    """(node, root): root is the same for all nodes that links (a, b) connect. Nodes without links do not appear."""
    star = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "op7-star")
    before = None
    while True:
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        star = materialize(small, "op7-star")
        mark = tuple(star.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before:
            return star.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(star.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = mark


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, key, fp, fingerprint, component_id), one row per document."""
    rows = materialize(fingerprints(docs), "op7-fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "op7-classes")
    roots = components(near_links(classes.select("fp")))
    named = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    member = named.join(lowest, "root").select("fp", "root", "component_id")
    out = rows.join(member, "fp")
    return out.select("doc_id", "key", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "root", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest (doc_id, key); the columns of ``docs``."""
    found = near_duplicates(docs)
    chosen = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("best")).select(F.col("best.key").alias("_key"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), row_key(F.col("doc_id"), F.col("text")).alias("_key"))
    kept = rows.join(chosen.distinct(), "_key", "left_semi")
    first = F.row_number().over(W.partitionBy("_key").orderBy(F.lit(1)))  # rows of one key agree in id and text
    return kept.withColumn("_n", first).where("_n = 1").select("_row.*")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
