"""Runs of repeated words by internal pattern matching.

A run is a maximal stretch of words with a smallest period q that is at least ``POWER`` periods and ``LEAST`` words long. Candidates for q come from
dyadic blocks. The suffixes of a text are sorted by prefix doubling, so every block of 2^k words has an interval of the suffix
array; a wavelet tree over the array answers range successor queries: where does this block occur next? For a period of 2^k .. 2^(k+1) - 1 words
some aligned block of 2^k words in the run occurs again just one period on. The occurrences of a block that overlaps itself form a
progression; then the ends of two neighbouring progressions are one period apart. Each candidate is extended to both sides by the names of the
doubling steps (longest common extensions), which gives the exact run; runs of a multiple of the period coincide and the least one stays.

Texts are handled side by side as arrays, in groups of about equal length; suffixes are sorted within their own text. A text stays in one
task: its runs do not depend on other texts, so nothing is shuffled.

``periodic_runs`` returns the runs and the collapsed text (each run's first period only); ``op12`` derives the digests.

Defined results: a null, empty or blank text has no words and no runs; very long texts are handled whole, with about 4 bytes a word for each doubling
step; ties of the greatest exponent go to the smallest start, then the smallest period; repeated rows give repeated rows; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from remitlens.llm.common import table

POWER, LEAST = 4, 6
GROUP = 1 << 17  # words handled side by side


def doubled(first: np.ndarray, longest: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Names and group sizes of the strings of 1, 2, 4, ... words at each place, up to ``longest`` words or until all differ. A name is the number of
    smaller strings, so a group is the interval from its name on in the suffix array. ``first`` are names of the words."""
    n = len(first)
    size = np.bincount(first, minlength=n)[first].astype(np.int32)
    names, sizes, h = [first.astype(np.int32)], [size], 1
    while 2 * h <= longest:
        rank, size = names[-1], sizes[-1]
        open_ = np.flatnonzero(size > 1)
        if not len(open_):
            break
        old, key = rank[open_].astype(np.int64), rank[open_ + h].astype(np.int64)
        order = np.argsort(old * (n + 1) + key, kind="stable")
        old, key = old[order], key[order]
        at = np.arange(len(order))
        new_old = np.concatenate([[True], old[1:] != old[:-1]])
        new_key = new_old | np.concatenate([[True], key[1:] != key[:-1]])
        starts = np.flatnonzero(new_key)
        runs = np.diff(np.append(starts, len(order)))
        rank, size = rank.copy(), size.copy()
        rank[open_[order]] = old + np.repeat(starts, runs) - np.maximum.accumulate(np.where(new_old, at, 0))
        size[open_[order]] = np.repeat(runs, runs)
        names.append(rank)
        sizes.append(size)
        h *= 2
    return names, sizes


class WaveletTree:
    """Sequence of numbers, one bit a level from the highest; answers many range successor queries at once."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(int(values.max(initial=0)).bit_length(), 1)
        self.zeros: list[np.ndarray] = []
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b) & 1 == 1
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]).astype(np.int32))
            values = np.concatenate([values[~one], values[one]])

    def successor(self, left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest value of at least ``least`` in left .. right - 1, or -1."""
        lo, hi, below = left.astype(np.int64), right.astype(np.int64), np.zeros(len(left), np.int64)
        for k, zeros in enumerate(self.zeros):
            one = (least >> (self.bits - 1 - k)) & 1 == 1
            a, b = zeros[lo], zeros[hi]
            below += np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        below = np.where(least >> self.bits > 0, right - left, below)
        none = below >= right - left
        lo, hi, rank, value = left.astype(np.int64), right.astype(np.int64), np.where(none, 0, below), np.zeros(len(left), np.int64)
        for k, zeros in enumerate(self.zeros):
            a, b = zeros[lo], zeros[hi]
            one = rank >= b - a
            rank -= np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
            value |= np.where(one, 1 << (self.bits - 1 - k), 0)
        return np.where(none, -1, value)


def extended(names: list[np.ndarray], i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
    """Length of the longest common extension of the places i < j: from them on (step 1), or of what ends before them (step -1)."""
    got = np.zeros(len(i), np.int64)
    for k in range(len(names) - 1, -1, -1):
        width, todo = 1 << k, np.arange(len(i))
        while len(todo):
            a, b = (i[todo] + got[todo], j[todo] + got[todo]) if step > 0 else (i[todo] - got[todo] - width, j[todo] - got[todo] - width)
            same = (a >= 0) & (names[k][np.maximum(a, 0)] == names[k][np.maximum(b, 0)])
            todo = todo[same]
            got[todo] += width
            if k < len(names) - 1:  # a shorter string fits once at most
                break
    return got


def runs_of(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text given as words, by start, then period."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ids: dict = {}
    flat = np.full(int(sizes.sum()) + len(texts), -1, dtype=np.int64)  # behind each text one place that equals nothing
    begin = np.cumsum(sizes + 1) - sizes - 1
    for b, t in zip(begin.tolist(), texts):
        flat[b:b + len(t)] = [ids.setdefault(w, len(ids)) for w in t]
    text_of = np.repeat(np.arange(len(texts)), sizes + 1)
    key = text_of * (len(ids) + 1) + flat + 1
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    first = np.empty(len(flat), dtype=np.int64)
    first[order] = np.repeat(starts, np.diff(np.append(starts, len(flat))))
    names, counts = doubled(first, int(sizes.max(initial=0)) // POWER)
    array = np.argsort(names[-1], kind="stable")
    tree = WaveletTree(array - begin[text_of[array]])
    place = np.arange(len(flat)) - begin[text_of]
    found: list[np.ndarray] = []  # rows of (place, period)
    for k, (name, count) in enumerate(zip(names, counts)):
        width = 1 << k
        at = np.flatnonzero(count[::4 if k == 0 else width] >= POWER - 1) * (4 if k == 0 else width)

        def following(at: np.ndarray, after: np.ndarray, name: np.ndarray = name, count: np.ndarray = count) -> np.ndarray:
            """Next occurrence of the block at ``at`` behind the place ``after``, or far away."""
            got = tree.successor(name[at], name[at] + count[at], place[at] + (after - at) + 1)
            return np.where(got < 0, 1 << 40, got - place[at] + at)

        after = following(at, at)
        near = after - at
        fits = (near >= width) & (near < 2 * width)
        found.append(np.stack([at[fits], near[fits]], axis=1))
        own = near < width  # the block overlaps its next occurrence: a progression
        at, p = at[own], near[own]
        if len(at):
            last = at + (p + extended(names, at, at + p, 1) - width) // p * p
            then = following(at, last)
            good = then - last < 2 * width
            at, p, last, then = at[good], p[good], last[good], then[good]
            end = then + (p + extended(names, then, then + p, 1) - width) // p * p
            good = (end - last >= width) & (end - last < 2 * width)
            found.append(np.stack([last[good], (end - last)[good]], axis=1))
    cand = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    at, q = cand[:, 0], cand[:, 1]
    start = at - extended(names, at, at + q, -1)
    end = at + q + extended(names, at, at + q, 1)
    good = end - start >= np.maximum(LEAST, POWER * q)
    rows = np.stack([start, end, q], axis=1)[good]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if len(rows):
        least = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
        rows = rows[least]
        rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    for s, e, q in rows.tolist():
        t = int(text_of[s])
        out[t].append((s - int(begin[t]), e - s, q))
    return out


def grouped_runs(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """``runs_of`` in groups of texts of about equal length, at most GROUP words together or one text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted((k for k, t in enumerate(texts) if len(t) >= LEAST), key=lambda k: len(texts[k]))
    at = 0
    while at < len(order):
        end, size = at, 0
        while end < len(order) and (end == at or (size + len(texts[order[end]]) <= GROUP and len(texts[order[end]]) < 2 * len(texts[order[at]]) + 16)):
            size += len(texts[order[end]])
            end += 1
        for k, runs in zip(order[at:end], runs_of([texts[k] for k in order[at:end]])):
            out[k] = runs
        at = end
    return out


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without the repeats of each run's first period."""
    gone: set[int] = set()
    for start, length, period in runs:
        gone.update(range(start + period, start + length))
    return [w for i, w in enumerate(words) if i not in gone] if gone else words


def periodic_runs(docs: DataFrame, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None, keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_runs, the run of the greatest exponent (start, length, period, exponent_milli), digests of all runs and of the collapsed
    text, n_dropped and, if ``keep_text``, runs and collapsed; one row per document. ``rewrite`` changes the words of a document first."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_dropped"]
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                part = b.slice(k, 1024)
                texts = [(t or "").encode().split() for t in part.column("text").to_pylist()]
                if rewrite:
                    texts = [rewrite(d, t) for d, t in zip(part.column("doc_id").to_pylist(), texts)]
                out, kept = [], []
                every = grouped_runs(texts)
                for words, runs in zip(texts, every):
                    rest = collapsed(words, runs)
                    left = b" ".join(rest)
                    best: tuple = (None, None, None)
                    for r in runs:
                        if best[0] is None or r[1] * best[2] > best[1] * r[2]:
                            best = r
                    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
                    out.append((len(words), len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest(), len(words) - len(rest)))
                    kept.append(left.decode())
                cols = [part.column("doc_id"), *[pa.array([x[i] for x in out], pa.string() if names[i].endswith("sha256") else pa.int64()) for i in range(len(names))]]
                if keep_text:
                    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
                    cols += [pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r in every], kind), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *names, *(["runs", "collapsed"] if keep_text else [])])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_dropped long"
              + (", runs array<struct<start:long,length:long,period:long>>, collapsed string" if keep_text else ""))
    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A periodic tail where the checksum of the id is a multiple of ten; documents without an id stay as they are."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), planted, keep_text=False)


SQL = rf"""
WITH c AS (SELECT DISTINCT doc_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) AS h FROM documents),
t AS (SELECT d.doc_id, h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents d JOIN c ON d.doc_id = c.doc_id),
u AS (SELECT doc_id, w, len(w) AS n, h, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a FROM t),
v AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM u),
word AS (SELECT doc_id, n, i, w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] AS x FROM (SELECT *, unnest(range(n)) AS i FROM v)),
eq AS (SELECT l.doc_id, l.i, r.i - l.i AS q FROM word l JOIN word r ON l.doc_id = r.doc_id AND l.x = r.x AND r.i > l.i AND {POWER} * (r.i - l.i) <= l.n),
isle AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM eq) GROUP BY doc_id, q, g),
run AS (SELECT doc_id, s, len, min(q) AS q FROM isle WHERE len >= {LEAST} AND len >= {POWER} * q GROUP BY doc_id, s, len),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM run),
kept AS (SELECT w.doc_id, string_agg(x, ' ' ORDER BY w.i) AS kept, count(*) AS n FROM word w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i WHERE g.i IS NULL GROUP BY w.doc_id),
per AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
    first({{'s': s, 'len': len, 'q': q}} ORDER BY CAST(len AS DOUBLE) / q DESC, s, q) AS b FROM run GROUP BY doc_id)
SELECT u.doc_id, CAST(u.n AS BIGINT) AS n_words, coalesce(n_runs, 0) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.len AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period,
    CAST(1000 * b.len // b.q AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256, CAST(u.n - coalesce(k.n, 0) AS BIGINT) AS n_dropped
FROM u LEFT JOIN per ON u.doc_id = per.doc_id LEFT JOIN kept k ON u.doc_id = k.doc_id
"""
