"""Removal of repeated byte strings by suffix sorting (deep-shallow).

Every byte covered by a string of ``LENGTH`` bytes that starts anywhere else as well, in the same text or another, is
removed. Sorting all suffixes is not needed: each window of ``LENGTH`` bytes has an anchor, the leftmost smallest
hash of its ``GRAM``-byte strings, which lies at the same place in every occurrence of the window. One record per anchor
stands for the run of windows that share it, about one record per 190 bytes. Records meet under the hash of a core
of ``CORE`` bytes on one side of the anchor that all their windows contain; cores that occur once drop out by
a count before any text moves.

Within the records of one core the suffixes to the right of the anchor and the reversed prefixes to its left are sorted:
multikey quicksort down to ``SHALLOW`` bytes, blind tries for groups that still agree there. From the two
orders and their longest common prefixes follows, for each offset, which windows are equal, exactly and without comparing pairs.

A core with more than ``HOT`` records is not sorted in one task: its records are first counted by content, and the windows of
the different ones are dealt by their own 128-bit hashes and counted with map-side sums.

Texts that occur more than once are removed as a whole if they are long enough, and only one of them takes part.

Defined results: a null text is empty; texts under ``LENGTH`` bytes stay whole; repeated rows are copies of one another; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm.common import table
from remitlens.session import materialize

LENGTH, GRAM, CORE = 400, 16, 208
REACH = LENGTH - CORE  # a window reaching further left than this is met by its left core
SHALLOW = 32
HOT = 20_000
BUCKET = 4_000  # records sorted together in one call
CHUNK = 1 << 20
SEND = 1_000_000  # keys of texts that are sent to the scan, 16 bytes each; above it the texts are joined by a shuffle
_RECORD = np.dtype([("core", "<u8"), ("a", "<i8"), ("lo", "<i2"), ("hi", "<i2"), ("left", "?")])
_SPAN = np.dtype([("start", "<i8"), ("end", "<i8")])


def anchors(data: bytes) -> list[tuple[int, int, int]]:
    """(anchor, first window, last window) for the window starts of ``data``; each window has its leftmost least gram."""
    out: list[tuple[int, int, int]] = []
    width = LENGTH - GRAM + 1
    for at in range(0, len(data) - LENGTH + 1, CHUNK):
        h = np.frombuffer(data, np.uint8, min(CHUNK + LENGTH - 1, len(data) - at), at).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
        step = 1
        while step < GRAM:
            h = (h[:-step] * np.uint64(0xBF58476D1CE4E5B9)) ^ (h[step:] * np.uint64(0x94D049BB133111EB))
            h ^= h >> np.uint64(31)
            step *= 2
        blocks = np.concatenate([h, np.full(-len(h) % width, np.iinfo(np.uint64).max)]).reshape(-1, width)
        n = len(h) - width + 1
        after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        before = np.minimum.accumulate(blocks, axis=1).ravel()
        least = np.minimum(after[:n], before[width - 1:width - 1 + n])
        edges = (np.flatnonzero(least[1:] != least[:-1]) + 1).tolist()
        for s, e in zip([0, *edges], [*edges, n]):  # windows s..e-1 have one least value
            for p in (np.flatnonzero(h[s:e - 1 + width] == least[s]) + s).tolist():
                if p >= s:
                    last = min(p, e - 1)
                    out.append((at + p, at + s, at + last))
                    s = last + 1
                    if s >= e:
                        break
    return out


def records(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Records of a text and spans that repeat inside it: windows reach ``lo``..``hi`` bytes to the left of ``a``."""
    got, spans, seen = [], [], {}
    for a, first, last in anchors(data):
        lo, hi = a - last, a - first
        parts = ([(lo, min(hi, REACH), False)] if lo <= REACH else []) + ([(max(lo, REACH + 1), hi, True)] if hi > REACH else [])
        for lo_, hi_, left in parts:
            core = data[a + GRAM - CORE:a + GRAM] if left else data[a:a + CORE]
            span = (a - hi_, a - lo_ + LENGTH)
            same = seen.setdefault(xxhash.xxh3_128_digest(data[span[0]:span[1]]) + bytes([left]), span)
            if same != span and data[same[0]:same[1]] == data[span[0]:span[1]]:
                spans += [same, span]  # a stretch that repeats within the text, such as a run of one word
                continue
            got.append((xxhash.xxh64_intdigest(core, left), a, lo_, hi_, left))
    return np.array(got, dtype=_RECORD), merged(np.array(spans, dtype=np.int64).reshape(-1, 2))


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of (start, end) rows."""
    if not len(spans):
        return np.zeros((0, 2), dtype=np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > ends[:-1]])
    return np.stack([spans[new, 0], ends[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(spans) - 1]])]], axis=1)


def lcp(a: bytes, b: bytes) -> int:
    n, k = min(len(a), len(b)), 0
    while k < n and a[k:k + 32] == b[k:k + 32]:
        k += 32
    k = min(k, n)
    while k < n and a[k] == b[k]:
        k += 1
    return k


def blind_order(strings: list[bytes], group: list[int]) -> list[int]:
    """``group`` (positions) in the order of their strings, through a blind trie: descend by single bytes without comparing,
    compare with the leaf reached, and hang the new leaf in at the depth where they part."""
    at = lambda s, d: s[d] if d < len(s) else -1
    root: list = [group[0]]  # a leaf is the list of its positions, an inner node is (depth, children)
    for x in group[1:]:
        s, node = strings[x], root
        while isinstance(node, tuple):
            node = node[1].get(at(s, node[0])) or next(iter(node[1].values()))
        other = strings[node[0]]
        d = lcp(s, other)
        if d == len(s) == len(other):
            node.append(x)
            continue
        parent, node, byte = None, root, -2
        while isinstance(node, tuple) and node[0] < d:
            parent, byte = node, at(s, node[0])
            node = node[1][byte]
        if isinstance(node, tuple) and node[0] == d:
            node[1][at(s, d)] = [x]
            continue
        fresh = (d, {at(other, d): node, at(s, d): [x]})
        if parent is None:
            root = fresh
        else:
            parent[1][byte] = fresh
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if isinstance(node, tuple):
            todo += [node[1][k] for k in sorted(node[1], reverse=True)]
        else:
            out += node
    return out


def deep_shallow(strings: list[bytes]) -> list[int]:
    """Positions of ``strings`` in lexicographic order."""
    out, todo = [], [(list(range(len(strings))), 0)]
    while todo:
        group, depth = todo.pop()
        if len(group) < 2:
            out += group
            continue
        if depth >= SHALLOW:
            out += blind_order(strings, group)
            continue
        keys = [strings[x][depth:depth + 8] for x in group]  # eight bytes at a time
        pivot = keys[len(keys) // 2]
        below, equal, above = [], [], []
        for x, k in zip(group, keys):
            (below if k < pivot else equal if k == pivot else above).append(x)
        todo.append((above, depth))
        todo.append((equal, depth + 8) if len(pivot) == 8 else (equal, SHALLOW))
        todo.append((below, depth))
    return out


def equal_windows(lefts: list[bytes], rights: list[bytes], lo: np.ndarray, hi: np.ndarray, times: np.ndarray) -> list[list[tuple[int, int]]]:
    """For records of one core (reversed text left of the anchor, text from it on): runs of offsets whose window has an equal."""
    m = len(lefts)
    if m == 1:
        return [[(int(lo[0]), int(hi[0]))] if times[0] > 1 else []]
    if m == 2 and times.max() == 1:
        a, b = max(int(lo.max()), LENGTH - lcp(rights[0], rights[1])), min(int(hi.min()), lcp(lefts[0], lefts[1]))
        return [[(a, b)] if a <= b else []] * 2
    classes = []
    offsets = np.arange(int(lo.min()), int(hi.max()) + 1)
    for strings, need in ((lefts, offsets), (rights, LENGTH - offsets)):
        order = deep_shallow(strings)
        common = np.array([lcp(strings[x], strings[y]) for x, y in zip(order, order[1:])], dtype=np.int32)
        cls = np.zeros((len(offsets), m), dtype=np.int64)
        cls[:, order[1:]] = np.cumsum(common[None, :] < need[:, None], axis=1)
        classes.append(cls)
    pair = classes[0] * m + classes[1]
    open_ = (lo[None, :] <= offsets[:, None]) & (offsets[:, None] <= hi[None, :])
    pair = np.where(open_, pair, -1 - np.arange(m)[None, :])
    order = np.argsort(pair, axis=1, kind="stable")
    ranked = np.take_along_axis(pair, order, axis=1)
    twin = np.zeros_like(open_)
    twin[:, 1:] = ranked[:, 1:] == ranked[:, :-1]
    twin[:, :-1] |= twin[:, 1:].copy()
    found = np.zeros_like(open_)
    np.put_along_axis(found, order, twin, axis=1)
    found |= open_ & (times > 1)[None, :]
    edge = np.diff(found.astype(np.int8), axis=0, prepend=0, append=0)
    out: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    starts, ends = np.argwhere(edge.T == 1), np.argwhere(edge.T == -1)
    for (k, s), (_, e) in zip(starts.tolist(), ends.tolist()):
        out[k].append((int(offsets[s]), int(offsets[e - 1])))
    return out


def sort_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """Removed spans of all records in a bucket of cores: (tkey, start, end)."""
    groups: dict[tuple, list[int]] = {}
    text, lo, hi, left, core = (pdf[c].tolist() for c in ("text", "lo", "hi", "left", "core"))
    for k, t in enumerate(text):
        mid = t[hi[k] + GRAM - CORE:hi[k] + GRAM] if left[k] else t[hi[k]:hi[k] + CORE]
        groups.setdefault((core[k], left[k], mid), []).append(k)
    tkey, at, out = pdf["tkey"].tolist(), pdf["a"].tolist(), []
    for rows in groups.values():
        if len(rows) < 2:
            continue
        kinds: dict[tuple, list[int]] = {}
        for k in rows:
            kinds.setdefault((text[k], lo[k], hi[k]), []).append(k)
        heads = list(kinds)
        runs = equal_windows([t[:h][::-1] for t, _, h in heads], [t[h:] for t, _, h in heads], np.array([x[1] for x in heads]),
                             np.array([x[2] for x in heads]), np.array([len(v) for v in kinds.values()]))
        for members, found in zip(kinds.values(), runs):
            out += [(tkey[k], at[k] - b, at[k] - a + LENGTH) for k in members for a, b in found]
    return pd.DataFrame(out, columns=["tkey", "start", "end"]).astype({"start": "int64", "end": "int64"})


def _texts(docs: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """Rows of ``wanted`` (tkey, doc, alone, ...) with the bytes of their text. ``doc`` names one document with this text;
    where that id repeats (``alone`` > 1) the rows are counted into one."""
    keys = wanted.select("tkey", "doc")
    rows = docs.select("tkey", "doc", "text")
    if wanted.count() <= SEND:
        rows = rows.join(F.broadcast(keys), ["tkey", "doc"], "left_semi")
    joined = rows.join(wanted, ["tkey", "doc"])
    others = [c for c in wanted.columns if c not in ("tkey", "doc", "alone")]
    once = joined.where("alone = 1").select("tkey", "text", *others)
    more = joined.where("alone > 1").groupBy("tkey").agg(F.first("text").alias("text"), *[F.first(c).alias(c) for c in others])
    return once.unionByName(more)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(tkey, doc, alone, copies, n_bytes, spans) of the texts with something to remove; spans is packed (start, end) pairs.
    ``docs`` has doc (long), tkey (binary) and text (string)."""
    long_ = docs.where(F.octet_length("text") >= LENGTH)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                found = [records(t.encode()) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("tkey"), part.column("doc"), pa.array([r.tobytes() for r, _ in found], pa.binary()),
                                                  pa.array([s.tobytes() for _, s in found], pa.binary())], names=["tkey", "doc", "recs", "own"])

    per = long_.select("tkey", "doc", "text").mapInArrow(scan, "tkey binary, doc long, recs binary, own binary")
    sizes = per.groupBy("tkey", "doc").agg(F.first("recs").alias("recs"), F.first("own").alias("own"), F.count(F.lit(1)).alias("n"))
    texts = sizes.groupBy("tkey").agg(F.first("recs").alias("recs"), F.first("own").alias("own"), F.min(F.struct("doc", "n")).alias("m"), F.sum("n").alias("copies"))
    texts = materialize(texts.select("tkey", "recs", "own", F.col("m.doc").alias("doc"), F.col("m.n").alias("alone"), "copies"), "op2-texts")

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = np.concatenate([np.frombuffer(x, _RECORD)["core"] for x in b.column("recs").to_pylist()] or [np.array([], np.uint64)])
            k, n = np.unique(k, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n.astype(np.int64))], names=["core", "n"])

    shared = materialize(texts.select("recs").mapInArrow(cores, "core long, n long").groupBy("core").agg(F.sum("n").alias("n")).where("n > 1"), "op2-cores")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tkey, x in zip(b.column("tkey"), b.column("recs").to_pylist()):
                r = np.frombuffer(x, _RECORD)
                if len(r):
                    yield pa.RecordBatch.from_arrays([pa.array([tkey.as_py()] * len(r), pa.binary()), pa.array(r["core"].view(np.int64)), pa.array(r["a"]), pa.array(r["lo"]), pa.array(r["hi"]), pa.array(r["left"])],
                                                     names=["tkey", "core", "a", "lo", "hi", "left"])

    fields = "core long, a long, lo short, hi short, left boolean"
    asked = texts.select("tkey", "recs").mapInArrow(unpack, f"tkey binary, {fields}").join(shared, "core")
    asked = asked.groupBy("tkey").agg(F.collect_list(F.struct("core", "a", "lo", "hi", "left", (F.col("n") > HOT).alias("hot"))).alias("asked"))  # of one text
    asked = materialize(asked.join(texts.select("tkey", "doc", "alone"), "tkey"), "op2-asked")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tkey, text, rows in zip(*[b.column(c).to_pylist() for c in ("tkey", "text", "asked")]):
                data = text.encode()
                for k in range(0, len(rows), 2000):
                    part = rows[k:k + 2000]
                    cols = {c: [x[c] for x in part] for c in ("core", "a", "lo", "hi", "left", "hot")}
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tkey] * len(part), pa.binary()), pa.array(cols["core"], pa.int64()), pa.array(cols["a"], pa.int64()), pa.array(cols["lo"], pa.int16()), pa.array(cols["hi"], pa.int16()),
                         pa.array(cols["left"], pa.bool_()), pa.array(cols["hot"], pa.bool_()), pa.array([data[x["a"] - x["hi"]:x["a"] - x["lo"] + LENGTH] for x in part], pa.binary())],
                        names=["tkey", "core", "a", "lo", "hi", "left", "hot", "text"])

    pieces = materialize(_texts(docs, asked, "asked").mapInArrow(cut, f"tkey binary, {fields}, hot boolean, text binary"), "op2-pieces")
    counts = pieces.groupBy("hot").agg(F.count(F.lit(1)).alias("n")).collect()  # two rows at most
    counts = {r["hot"]: r["n"] for r in counts}
    buckets = max(1, counts.get(False, 0) // BUCKET)
    spans = (pieces.where("not hot").withColumn("bucket", F.pmod(F.xxhash64("core"), F.lit(buckets)))
             .groupBy("bucket").applyInPandas(sort_bucket, "tkey binary, start long, end long"))
    if counts.get(True):
        spans = spans.unionByName(hot_spans(pieces.where("hot")))
    own = texts.where(F.octet_length("own") > 0).select("tkey", "own")

    def loose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tkey, x in zip(b.column("tkey").to_pylist(), b.column("own").to_pylist()):
                s = np.frombuffer(x, _SPAN)
                yield pa.RecordBatch.from_arrays([pa.array([tkey] * len(s), pa.binary()), pa.array(s["start"]), pa.array(s["end"])], names=["tkey", "start", "end"])

    spans = spans.unionByName(own.mapInArrow(loose, "tkey binary, start long, end long"))
    per_text = spans.groupBy("tkey").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
    return texts.select("tkey", "doc", "alone", "copies").join(per_text, "tkey", "left").where("copies > 1 or spans is not null")


def hot_spans(pieces: DataFrame) -> DataFrame:
    """Removed spans of the records of very frequent cores, from counts of their windows: nothing of a core meets in one task."""
    named = pieces.withColumn("rid", F.unhex(F.md5(F.concat(F.col("text"), F.concat_ws(",", "lo", "hi", "left").cast("binary")))))
    kinds = materialize(named.groupBy("rid", "text", "lo", "hi").agg(F.count(F.lit(1)).alias("n")), "op2-kinds")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rid, text, lo, hi, n in zip(*[b.column(c).to_pylist() for c in ("rid", "text", "lo", "hi", "n")]):
                off = list(range(lo, hi + 1))
                h = [xxhash.xxh3_128_digest(text[hi - k:hi - k + LENGTH]) for k in off]
                yield pa.RecordBatch.from_arrays([pa.array([rid] * len(off), pa.binary()), pa.array(off, pa.int32()), pa.array(h, pa.binary()), pa.array([n] * len(off), pa.int64())], names=["rid", "off", "h", "n"])

    rows = kinds.mapInArrow(explode, "rid binary, off int, h binary, n long")
    twice = rows.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    found = rows.join(twice, "h", "left_semi").select("rid", "off")
    return named.join(found, "rid").select("tkey", (F.col("a") - F.col("off")).alias("start"), (F.col("a") - F.col("off") + LENGTH).alias("end"))


def remove_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept, changed and, if ``keep_text``, kept (the remaining bytes); one row per document."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), F.unhex(F.md5(body)).alias("tkey"), body.alias("text"))
    found = materialize(repeated_spans(rows), "op2-found")
    # texts that occur once and lose something: their remaining bytes have to be hashed
    part = found.where("copies = 1").select("tkey", "doc", "alone", "spans")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for tkey, text, spans in zip(*[b.column(c).to_pylist() for c in ("tkey", "text", "spans")]):
                data, runs = text.encode(), merged(np.array([(s["start"], s["end"]) for s in spans], dtype=np.int64)).tolist()
                edges = [0, *[x for r in runs for x in r], len(data)]
                rest = b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2]))
                out.append((tkey, len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest if keep_text else None))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                                             names=["tkey", "n_removed", "n_spans", "kept_sha256", "kept"])

    schema = "tkey binary, n_removed long, n_spans long, kept_sha256 string, kept binary"
    kept = _texts(rows, part, "part").mapInArrow(keep, schema)
    gone = found.where("copies > 1").select("tkey", F.lit(-1).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                                            F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"), F.lit(b"").alias("kept"))
    changes = materialize(kept.unionByName(gone), "op2-changes")
    light = rows.select("doc_id", "tkey", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("_whole"), *([F.col("text").cast("binary").alias("_text")] if keep_text else []))
    joined = light.join(changes, "tkey", "left")
    removed = F.when(F.col("n_removed") < 0, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long")
    out = joined.select("doc_id", "n_bytes", removed.alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
                        F.coalesce("kept_sha256", "_whole").alias("kept_sha256"),
                        (F.col("n_bytes") - removed).alias("n_kept"), (removed > 0).alias("changed"), *([F.when(F.col("kept_sha256").isNull(), F.col("_text")).otherwise(F.col("kept")).alias("kept")] if keep_text else []))
    return out


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)
