"""Removal of repeated passages of words by suffix automata of reference shards and matching statistics.

Every word covered by a window of ``WINDOW`` words whose sequence also starts anywhere else, in the same document or another, is removed.

Reference shards: each window has an anchor, the leftmost of its ``GRAM``-word strings with the least hash, which lies at the same place in every
occurrence. Stretches of windows around anchors that occur once are unique and drop out by a count of anchors before any text moves. The
other stretches, equal ones counted into one, are the reference. They are dealt to shards of about ``SHARD`` stretches by their anchor, so all
occurrences of a window are in one shard, and a shard's suffix automaton with occurrence counts (``build``) has a bounded size.

Matching statistics: documents are streamed through the automaton of a shard (``matching``): the longest suffix of the words read that occurs in the
shard, cut to ``WINDOW`` words, and its number of occurrences. Where it reaches ``WINDOW`` and occurs twice, the window is marked; maximal
runs of marked windows are the removed spans. An automaton is sent to the tasks that stream stretches of its shard (``FAN`` of them), not
to every executor: all automata together grow with the data, so a broadcast of them has no bound, while one shard's has.

An anchor with more than ``HOT`` different stretches would break the bound of its shard. Its stretches are halved: the windows of a half have more words
in common, and these are its anchor. Equal halves are counted into one, again before they move, and halves without an equal anchor drop out, so
after five rounds at most no anchor is too frequent. Texts that occur more than once are removed as a whole if they have a window, and one of them takes part.

Defined results: a null or wordless text has no words and keeps the empty string; texts under ``WINDOW`` words stay whole; repeated rows are
copies of one another; very long texts are read whole, in pieces that overlap by a window; ties between equal hashes go to the left; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm.common import table
from remitlens.llm.repeats import merged
from remitlens.session import materialize

WINDOW, GRAM = 35, 8
WIDTH = WINDOW - GRAM + 1  # grams in a window
SHARD = 2_000
HOT = 2_000
FAN = 2
CHUNK = 1 << 19  # words looked at together; positions in a chunk take 20 bits
_RECORD = np.dtype([("core", "<i8"), ("first", "<i8"), ("n", "<i2"), ("off", "<i2")])
_LOW = np.uint64((1 << 20) - 1)


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_DRAW = np.random.default_rng(13).integers(1, 1 << 63, size=4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def coded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word codes, first byte of each word) of UTF-8 bytes. Equal words have equal codes; texts are compared by their words later."""
    gap = _SPACE[data]
    first = ~gap
    first[1:] &= gap[:-1]
    starts = np.flatnonzero(first)
    value = data.astype(np.uint64) + np.uint64(1)
    value[gap] = 0
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    begin = np.zeros(len(data), dtype=np.int64)
    begin[starts] = starts
    offset = np.arange(len(data), dtype=np.int64) - np.maximum.accumulate(begin)
    value *= _DRAW[offset & 4095]
    codes = np.add.reduceat(value, starts)
    codes ^= codes >> np.uint64(29)
    return codes * np.uint64(0xFF51AFD7ED558CCD), starts


def anchors(codes: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the anchor, first window, number of windows, place of the anchor from the first window on) of the runs of windows with one anchor. ``codes`` are the words of several texts
    behind one another, at most 2 * CHUNK of them; ``text_of`` numbers the text of each word, and no window crosses texts."""
    n = len(codes) - WINDOW + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 4
    h = codes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
    step = 1
    while step < GRAM:
        h = (h[:-step] * np.uint64(0xBF58476D1CE4E5B9)) ^ (h[step:] * np.uint64(0x94D049BB133111EB))
        h ^= h >> np.uint64(31)
        step *= 2
    key = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)  # equal hashes: the leftmost
    blocks = np.concatenate([key, np.full(-len(key) % WIDTH, np.iinfo(np.uint64).max)]).reshape(-1, WIDTH)
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    at = (np.minimum(after[:n], before[WIDTH - 1:WIDTH - 1 + n]) & _LOW).astype(np.int64)
    at[text_of[:n] != text_of[WINDOW - 1:]] = -1
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    sizes = np.diff(np.append(starts, n))
    good = at[starts] >= 0
    starts, sizes = starts[good], sizes[good]
    return h[at[starts]].view(np.int64), starts, sizes, at[starts] - starts


def records(texts: list[bytes]) -> list[tuple[int, np.ndarray, bytes]]:
    """(number of words, records, words joined by one space) of each text. Short texts are looked at together, long ones in pieces."""
    out: list[tuple[int, np.ndarray, bytes]] = []
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) < CHUNK // 2):
            size += len(texts[end]) + 1
            end += 1
        group = texts[at:end]
        codes, starts = coded(np.frombuffer(b"\n".join(group), np.uint8))
        bounds = np.cumsum([0, *[len(t) + 1 for t in group]])
        text_of = np.searchsorted(bounds, starts, side="right") - 1
        words = np.searchsorted(text_of, np.arange(len(group) + 1))
        found = []
        for k in range(0, max(len(codes) - WINDOW + 1, 0), CHUNK):  # windows k .. k + CHUNK - 1
            piece = slice(k, k + CHUNK + WINDOW - 1)
            core, first, n, off = anchors(codes[piece], text_of[piece])
            got = np.zeros(len(core), dtype=_RECORD)
            got["core"], got["first"], got["n"], got["off"] = core, first + k, n, off
            found.append(got)
        recs = np.concatenate(found) if found else np.zeros(0, _RECORD)
        part = np.searchsorted(recs["first"], words)
        for k, t in enumerate(group):
            own = recs[part[k]:part[k + 1]].copy()
            own["first"] -= words[k]
            out.append((int(words[k + 1] - words[k]), own, b" ".join(t.split())))
        at = end
    return out


def shared_parts(texts: list[list[bytes]], core: np.ndarray, off: np.ndarray, times: np.ndarray) -> dict[tuple[bytes, ...], int]:
    """The part of each stretch around its anchor whose words another stretch of the anchor has at the same places, equal parts counted into
    one; a window that occurs twice lies in such a part. Parts shorter than a window drop out."""
    _, back, n = np.unique(core, return_inverse=True, return_counts=True)
    some = np.flatnonzero(n[back] > 1)  # an anchor with one stretch has nothing to compare
    texts, core, off, times = [texts[k] for k in some.tolist()], core[some], off[some], times[some]
    ids: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    base = np.cumsum(sizes) - sizes
    word = np.fromiter((ids.setdefault(w, len(ids)) for t in texts for w in t), dtype=np.int64, count=int(sizes.sum()))
    place = np.arange(len(word)) - np.repeat(base + off, sizes) + WIDTH  # from the anchor on
    group = np.repeat(np.unique(core, return_inverse=True)[1], sizes)
    _, back, n = np.unique((group * (4 * WINDOW) + place) * len(ids) + word, return_inverse=True, return_counts=True)
    bad = (n[back] < 2) & np.repeat(times < 2, sizes)
    at, mid = np.arange(len(word)), base + off
    before = np.maximum.accumulate(np.where(bad, at, -1))[mid]
    after = np.minimum.accumulate(np.where(bad, at, len(word))[::-1])[::-1][mid]
    lo, hi = np.maximum(before + 1, base) - base, np.minimum(after, base + sizes) - base
    parts: dict[tuple[bytes, ...], int] = {}
    for k in np.flatnonzero(hi - lo >= WINDOW).tolist():
        t = tuple(texts[k][lo[k]:hi[k]])
        parts[t] = parts.get(t, 0) + int(times[k])
    return parts


class Automaton:
    """Suffix automaton of the strings of a shard: transitions as sorted keys, suffix links, lengths and occurrence counts."""

    def __init__(self, words: dict[bytes, int], keys: np.ndarray, target: np.ndarray, link: np.ndarray, length: np.ndarray, count: np.ndarray) -> None:
        self.words, self.keys, self.target, self.link, self.length, self.count = words, keys, target, link, length, count
        self.base = len(words) + 1  # words that the shard does not know share the last number

    def dump(self) -> bytes:
        head = b"\n".join(self.words)
        arrays = [self.keys, self.target, self.link, self.length, self.count]
        sizes = np.array([len(head), *[len(a) for a in arrays]], dtype="<i8")
        return sizes.tobytes() + head + b"".join(a.astype("<i8").tobytes() for a in arrays)

    @classmethod
    def load(cls, blob: bytes) -> Automaton:
        sizes = np.frombuffer(blob, "<i8", 6)
        head, at, arrays = bytes(blob[48:48 + sizes[0]]), 48 + int(sizes[0]), []
        for n in sizes[1:].tolist():
            arrays.append(np.frombuffer(blob, "<i8", n, at))
            at += 8 * n
        return cls({w: k for k, w in enumerate(head.split(b"\n"))} if head else {}, *arrays)


def build(texts: Sequence[Sequence[bytes]], times: list[int]) -> Automaton:
    """The automaton of ``texts``; a string occurs as often as the texts that hold it, each ``times`` over."""
    words: dict[bytes, int] = {}
    step: list[dict[int, int]] = [{}]
    link, length, count = [-1], [0], [0]

    def split(p: int, c: int, q: int) -> int:
        clone = len(step)
        step.append(dict(step[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        count.append(0)
        link[q] = clone
        while p >= 0 and step[p].get(c) == q:
            step[p][c] = clone
            p = link[p]
        return clone

    for text, n in zip(texts, times):
        last = 0
        for w in text:
            c = words.setdefault(w, len(words))
            q = step[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else split(last, c, q)
            else:
                new = len(step)
                step.append({})
                link.append(0)
                length.append(length[last] + 1)
                count.append(0)
                p = last
                while p >= 0 and c not in step[p]:
                    step[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = step[p][c]
                    link[new] = q if length[q] == length[p] + 1 else split(p, c, q)
                last = new
            count[last] += n
    lens, links, counts = (np.array(x, dtype=np.int64) for x in (length, link, count))
    order = np.argsort(-lens, kind="stable")
    for v in order[:-1].tolist():  # longest first; the last one is the empty string
        counts[links[v]] += counts[v]
    base = len(words) + 1
    keys = np.fromiter((s * base + c for s, d in enumerate(step) for c in d), dtype=np.int64)
    target = np.fromiter((t for d in step for t in d.values()), dtype=np.int64)
    order = np.argsort(keys)
    return Automaton(words, keys[order], target[order], links, lens, counts)


def matching(auto: Automaton, texts: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Matching statistics of each text, cut at WINDOW words: after each word the length of the longest suffix that occurs in the shard and
    how often it occurs. All texts move word by word side by side."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    widest = int(sizes.max(initial=0))
    code = np.full((len(texts), widest), auto.base - 1, dtype=np.int64)
    for row, t in enumerate(order.tolist()):
        code[row, :sizes[t]] = [auto.words.get(w, auto.base - 1) for w in texts[t]]
    live = np.searchsorted(-sizes[order], -np.arange(widest), side="left")  # texts longer than k
    state, held = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    long_, often = np.zeros((len(texts), widest), np.int64), np.zeros((len(texts), widest), np.int64)
    if not len(auto.keys):
        live[:] = 0
    for k in range(widest):
        n = int(live[k])
        want = state[:n] * auto.base + code[:n, k]
        at = np.minimum(np.searchsorted(auto.keys, want), len(auto.keys) - 1)
        hit = auto.keys[at] == want
        state[:n] = np.where(hit, auto.target[at], state[:n])
        held[:n] += hit
        todo = np.flatnonzero(~hit)
        while len(todo):  # no such word behind this suffix: try a shorter one
            root = state[todo] == 0
            held[todo[root]] = 0
            todo = todo[~root]
            state[todo] = auto.link[state[todo]]
            held[todo] = auto.length[state[todo]]
            want = state[todo] * auto.base + code[todo, k]
            at = np.minimum(np.searchsorted(auto.keys, want), len(auto.keys) - 1)
            hit = auto.keys[at] == want
            state[todo[hit]] = auto.target[at[hit]]
            held[todo[hit]] += 1
            todo = todo[~hit]
        if k >= WINDOW - 1:
            todo = np.flatnonzero(held[:n] > WINDOW - 1)
            while len(todo):  # no longer context than a window
                up = auto.link[state[todo]]
                todo = todo[(up >= 0) & (auto.length[up] >= WINDOW)]
                state[todo] = auto.link[state[todo]]
            held[:n] = np.minimum(held[:n], WINDOW)
        long_[:n, k], often[:n, k] = held[:n], np.where(held[:n] > 0, auto.count[state[:n]], 0)
    out: list[tuple[np.ndarray, np.ndarray]] = [(long_[0, :0], often[0, :0])] * len(texts) if len(texts) else []
    for row, t in enumerate(order.tolist()):
        out[t] = (long_[row, :sizes[t]], often[row, :sizes[t]])
    return out


def repeated_windows(auto: Automaton, texts: list[list[bytes]]) -> list[list[tuple[int, int]]]:
    """Maximal runs (first, last) of windows of each text that occur at least twice in the shard."""
    out = []
    for size, n in matching(auto, texts):
        ok = (size[WINDOW - 1:] >= WINDOW) & (n[WINDOW - 1:] > 1)
        edge = np.diff(ok.astype(np.int8), prepend=0, append=0)
        out.append(list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist())))
    return out


_RUNS = "kid binary, runs array<struct<first:long,last:long>>"


def _runs(kids: list[bytes], runs: list[list[tuple[int, int]]]) -> pd.DataFrame:
    found = [(k, [{"first": a, "last": b} for a, b in r]) for k, r in zip(kids, runs) if r]
    return pd.DataFrame(found, columns=["kid", "runs"])


def _by_automata(kinds: DataFrame, shards: int) -> DataFrame:
    """(kid, runs) of the reference stretches (core, off, kid, text, n): one automaton per shard, streamed through in FAN tasks each."""
    dealt = kinds.withColumn("shard", F.pmod(F.xxhash64("core"), F.lit(shards)).cast("int"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = shared_parts([t.split(b" ") for t in pdf["text"]], pdf["core"].to_numpy(), pdf["off"].to_numpy(), pdf["n"].to_numpy())
        auto = build(list(parts), list(parts.values()))
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "automaton": [auto.dump()]})

    fitted = materialize(dealt.groupBy("shard").applyInPandas(fit, "shard int, automaton binary"), "op13-automata")
    sent = fitted.withColumn("fan", F.explode(F.sequence(F.lit(0), F.lit(FAN - 1))))
    asked = dealt.select("shard", F.pmod(F.crc32("kid"), F.lit(FAN)).cast("int").alias("fan"), "kid", "text")

    def stream(key: tuple, auto: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        if not len(auto) or not len(docs):
            return _runs([], [])
        return _runs(docs["kid"].tolist(), repeated_windows(Automaton.load(auto["automaton"].iloc[0]), [t.split(b" ") for t in docs["text"]]))

    return sent.groupBy("shard", "fan").cogroup(asked.groupBy("shard", "fan")).applyInPandas(stream, _RUNS)


_KIND = ["core", "low", "high", "off", "m", "kid", "text"]
_KIND_TYPES = "core long, low short, high short, off short, m short, kid binary, text binary, n long"
_KIND_ARROW = [pa.int64(), pa.int16(), pa.int16(), pa.int16(), pa.int16(), pa.binary(), pa.binary(), pa.int64()]


def _kid(text: bytes, off: int) -> bytes:
    return xxhash.xxh3_128_digest(text + b" %d" % off)


def _halves(kinds: DataFrame) -> DataFrame:
    """(whole, shift) and the columns of a stretch: each stretch as two, by how many words (``low`` .. ``high``) before the anchor a window starts.
    The windows of a half have more words in common than those of the whole; these words are its anchor from now on."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for kid, low, high, off, m, text, n in zip(*[b.column(c).to_pylist() for c in ("kid", "low", "high", "off", "m", "text", "n")]):
                words, mid = text.split(b" "), (low + high) // 2
                for a, z in ((low, mid), (mid + 1, high)):
                    first, last = max(0, off - z), min(m - 1, off - a)
                    if first <= last:
                        own, common = b" ".join(words[first:last + WINDOW]), b" ".join(words[off - a:off - z + WINDOW])
                        core = xxhash.xxh64_intdigest(common, 1 + a) - (1 << 63)
                        out.append((kid, first, core, a, z, off - first, last - first + 1, _kid(own, off - first), own, n))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate([pa.binary(), pa.int64(), *_KIND_ARROW])], names=["whole", "shift", *_KIND, "n"])

    return kinds.select(*_KIND, "n").mapInArrow(cut, f"whole binary, shift long, {_KIND_TYPES}")


def _runs_of(rows: DataFrame) -> DataFrame:
    """(kid, runs) of the stretches in ``rows`` (core, low, high, off, m, kid, text, n). Stretches of anchors too frequent for a shard are halved until
    they are rare or equal; a window is the last, so this takes five rounds at most."""
    kinds = materialize(rows.groupBy(*_KIND).agg(F.sum("n").alias("n")), "op13-kinds")
    per = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.min("kid").alias("kid"), F.max("m").alias("m"), F.max(F.col("low") < F.col("high")).alias("wide"))
    per = materialize(per.where("k > 1 or n > 1").withColumn("hot", (F.col("k") > HOT) & F.col("wide")), "op13-anchors")
    # a stretch whose anchor has no other stretch repeats as a whole or not at all
    whole = F.array(F.struct(F.lit(0).cast("long").alias("first"), (F.col("m") - 1).cast("long").alias("last")))
    runs = per.where("k = 1").select("kid", whole.alias("runs"))
    size = per.agg(F.sum(F.when((F.col("k") > 1) & ~F.col("hot"), F.col("k"))).alias("n"), F.count_if("hot").alias("hot")).first()
    cold = kinds
    if size["hot"]:
        hot = materialize(per.where("hot").select("core"), "op13-hot")
        cold = kinds.join(hot, "core", "left_anti")
        halves = _halves(kinds.join(hot, "core", "left_semi"))
        below = materialize(_runs_of(halves.drop("whole", "shift")), "op13-halves")
        part = halves.select("whole", "shift", "kid").join(below, "kid").select("whole", F.transform("runs", lambda r: F.struct(
            (r["first"] + F.col("shift")).alias("first"), (r["last"] + F.col("shift")).alias("last"))).alias("runs"))
        runs = runs.unionByName(part.groupBy(F.col("whole").alias("kid")).agg(F.flatten(F.collect_list("runs")).alias("runs")))  # two halves
    if size["n"]:
        runs = runs.unionByName(_by_automata(cold, 1 + size["n"] // SHARD))
    return runs


def _stretches(text: str, asked: list[dict]) -> Iterator[tuple[bytes, dict, bytes]]:
    """(kid, record, words) of the asked records of a text."""
    words = text.encode().split()
    for x in asked:
        own = b" ".join(words[x["first"]:x["first"] + x["n"] + WINDOW - 1])
        yield _kid(own, x["off"]), x, own


def repeated_spans(recs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts with a window (tkey, copies); those that may lose words (tkey, copies, text); (tkey, spans) of those that do, as first word and
    word behind the last. ``recs`` has tkey (binary), doc (long) and recs (packed records), ``rows`` has tkey, doc and text."""
    some = recs.groupBy("tkey").agg(F.first("recs").alias("recs"), F.min("doc").alias("doc"), F.count(F.lit(1)).alias("copies"))
    texts = materialize(some, "op13-texts")

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = np.concatenate([np.frombuffer(x, _RECORD)["core"] for x in b.column("recs").to_pylist()] or [np.zeros(0, np.int64)])
            k, n = np.unique(k, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n.astype(np.int64))], names=["core", "n"])

    shared = materialize(texts.select("recs").mapInArrow(cores, "core long, n long").groupBy("core").agg(F.sum("n").alias("n")).where("n > 1").select("core"), "op13-cores")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [np.frombuffer(x, _RECORD) for x in b.column("recs").to_pylist()]
            if not got:
                continue
            every = np.concatenate(got)
            tkey = b.column("tkey").take(pa.array(np.repeat(np.arange(len(got)), [len(g) for g in got])))
            yield pa.RecordBatch.from_arrays([tkey, pa.array(every["core"]), pa.array(every["first"]), pa.array(every["n"]), pa.array(every["off"])], names=["tkey", "core", "first", "n", "off"])

    asked = texts.select("tkey", "recs").mapInArrow(unpack, "tkey binary, core long, first long, n short, off short").join(shared, "core")
    asked = asked.groupBy("tkey").agg(F.collect_list(F.struct("core", "first", "n", "off")).alias("asked"))  # of one text
    asked = asked.join(texts.select("tkey", "doc", "copies"), "tkey")
    # one row of each candidate text, equal rows counted into one before they move
    once = rows.groupBy("tkey", "doc").agg(F.first("text").alias("text"))
    found = materialize(once.join(asked, ["tkey", "doc"]).select("tkey", "copies", "text", "asked"), "op13-candidates")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, asked, copies in zip(*[b.column(c).to_pylist() for c in ("text", "asked", "copies")]):
                kinds: dict[tuple, int] = {}
                for kid, x, own in _stretches(text, asked):
                    kind = x["core"], 0, WIDTH - 1, x["off"], x["n"], kid, own
                    kinds[kind] = kinds.get(kind, 0) + copies
                rows = [(*k, n) for k, n in kinds.items()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_KIND_ARROW)], names=[*_KIND, "n"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tkey, text, asked in zip(*[b.column(c).to_pylist() for c in ("tkey", "text", "asked")]):
                got = [(kid, x["first"]) for kid, x, _ in _stretches(text, asked)]
                yield pa.RecordBatch.from_arrays([pa.array([tkey] * len(got), pa.binary()), pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.int64())], names=["tkey", "kid", "first"])

    runs = _runs_of(found.select("text", "asked", "copies").mapInArrow(cut, _KIND_TYPES))
    marks = found.select("tkey", "text", "asked").mapInArrow(place, "tkey binary, kid binary, first long")
    hit = marks.join(materialize(runs, "op13-runs"), "kid").select("tkey", "first", F.explode("runs").alias("r"))
    span = F.struct((F.col("first") + F.col("r.first")).alias("start"), (F.col("first") + F.col("r.last") + WINDOW).alias("end"))
    spans = hit.groupBy("tkey").agg(F.collect_list(span).alias("spans"))  # of one text
    return texts.select("tkey", "copies"), found.select("tkey", "copies", "text"), spans


def remove_passages(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, n_spans, n_kept, changed and, if ``keep_text``, kept (the words left, joined by one space); one row per document."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit((1 << 63) - 1)).cast("long").alias("doc"), F.unhex(F.md5(body)).alias("tkey"), body.alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                part = b.slice(k, 1024)
                found = records([t.encode() for t in part.column("text").to_pylist()])
                cols = [part.column("doc_id"), part.column("doc"), part.column("tkey"), pa.array([n for n, _, _ in found], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for _, _, t in found], pa.string()),
                        pa.array([r.tobytes() if len(r) else None for _, r, _ in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array([t for _, _, t in found], pa.binary())] if keep_text else []), names=["doc_id", "doc", "tkey", "n_words", "whole", "recs", *(["all"] if keep_text else [])])

    kind = docs.schema["doc_id"].dataType.simpleString()
    base = rows.mapInArrow(scan, f"doc_id {kind}, doc long, tkey binary, n_words long, whole string, recs binary" + (", all binary" if keep_text else ""))
    base = materialize(base, "op13-base")
    texts, found, spans = repeated_spans(base.where("recs is not null").select("tkey", "doc", "recs"), rows.select("tkey", "doc", "text"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for tkey, text, spans in zip(*[b.column(c).to_pylist() for c in ("tkey", "text", "spans")]):
                words, runs = text.encode().split(), merged(np.array([(s["start"], s["end"]) for s in spans], dtype=np.int64)).tolist()
                edges = [0, *[x for r in runs for x in r], len(words)]
                rest = [w for x, y in zip(edges[::2], edges[1::2]) for w in words[x:y]]
                left = b" ".join(rest)
                out.append((tkey, len(words) - len(rest), len(runs), hashlib.sha256(left).hexdigest(), left if keep_text else None))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary()))], names=["tkey", "n_removed", "n_spans", "kept_sha256", "kept"])

    schema = "tkey binary, n_removed long, n_spans long, kept_sha256 string, kept binary"
    part = found.where("copies = 1").join(spans, "tkey").select("tkey", "text", "spans").mapInArrow(keep, schema)
    gone = texts.where("copies > 1").select("tkey", F.lit(-1).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                                            F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"), F.lit(b"").alias("kept"))
    changes = materialize(part.unionByName(gone), "op13-changes")
    joined = base.drop("recs", "doc").join(changes, "tkey", "left")
    removed = F.when(F.col("n_removed") < 0, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long")
    kept = [F.when(F.col("kept_sha256").isNull(), F.col("all")).otherwise(F.col("kept")).cast("string").alias("kept")] if keep_text else []
    return joined.select("doc_id", "n_words", removed.alias("n_removed"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
                         F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), (F.col("n_words") - removed).alias("n_kept"), (removed > 0).alias("changed"), *kept)


SQL = rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (SELECT doc_id, s, md5(array_to_string(w[s:s + {WINDOW - 1}], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS s FROM t WHERE len(w) >= {WINDOW})),
hit AS (SELECT doc_id, s FROM k WHERE h IN (SELECT h FROM k GROUP BY h HAVING count(*) > 1)),
step AS (SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS d FROM hit),
gone AS (SELECT doc_id, CAST(sum(CASE WHEN d <= {WINDOW} THEN 0 ELSE 1 END) AS BIGINT) AS spans FROM step GROUP BY doc_id),
cut AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, unnest(range(s, s + {WINDOW})) AS i FROM hit)),
rest AS (SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.i) AS kept, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM t) t
    LEFT JOIN cut c ON t.doc_id = c.doc_id AND t.i = c.i WHERE c.i IS NULL GROUP BY t.doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256,
    coalesce(spans, 0) AS n_spans, CAST(coalesce(n, 0) AS BIGINT) AS n_kept, len(w) > coalesce(n, 0) AS changed
FROM t LEFT JOIN rest ON t.doc_id = rest.doc_id LEFT JOIN gone ON t.doc_id = gone.doc_id
"""


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_passages(table(spark, sf_dir, "documents"), keep_text=False)
