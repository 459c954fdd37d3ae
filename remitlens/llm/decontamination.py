"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names (capitalised words inside a sentence, a run counts as one) and units after
numbers turn into typed placeholders, whose values are kept beside as slots; other words are lower-cased. Windows of
``WINDOW`` template tokens are hashed and joined with those of the benchmark. Matched windows on one diagonal (same
shift between item and document) form a candidate; it counts if its slots are consistent: every value of the item is
replaced by one value in the document throughout. A document holds an item if consistent windows cover at least
``COVER`` of the item's template, so a question asked again with other numbers or names is caught as well. A window that starts
with a capitalised first word is also hashed with a name there, as the same words may stand inside a sentence elsewhere.

Verbatim copies need no template: windows of lower-cased tokens with their values are hashed and joined as well, also where they have
few literals. A document also holds an item if such windows cover ``COVER`` of its tokens or a run of ``RUN`` tokens, whatever else on
the diagonal is inconsistent.

When the benchmark has at most ``FILTER_WINDOWS`` windows, their hashes are sent to the scan of the documents, which
then emits matching windows only; above that bound every window goes to the join. The join is the same in both cases.

Defined results: null and wordless texts hold nothing and match nothing; items of fewer than ``SHORTEST`` tokens (values included)
are too short to tell and match nothing, items shorter than a window are matched as one window; items of equal text count once, under
their smallest id; repeated documents are reported once per different (doc_id, text); empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm.common import row_key, table
from remitlens.session import materialize

WINDOW = 8
SHORTEST = 4
LITERALS = 3  # words in a window that are no placeholders
COVER = 0.5
RUN = 13  # tokens copied word for word that count whatever share of the item they are
FILTER_WINDOWS = 2_000_000
GROUP_CHARS = 400_000  # characters of texts that are hashed together

VERBATIM = 1 << 20  # starts the hashes of windows without placeholders
NUMBER, UNIT, NAME = 1, 2, 3
_TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+|[.!?:\n]+|[%€$£°]")
# fixed values: number words and units
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million billion".split())
UNITS = frozenset("% € $ £ ° percent mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years dollar dollars cent cents euro euros pound pounds mph kmh degree degrees".split())
_LITERAL, _CAPITAL, _STOP, _NUMBER, _UNIT, _SHOUT = range(6)


class Codes(dict):
    """Raw token -> (64-bit code with its kind in the low bits); forgets all when it has grown large."""

    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        low = token.lower()
        if token[0].isdigit() or low in NUMBER_WORDS:
            kind = _NUMBER
        elif low in UNITS:
            kind = _UNIT
        elif not token[0].isalpha():
            kind = _STOP
        elif token[0] == low[0]:
            kind = _LITERAL
        else:
            kind = _SHOUT if len(token) > 1 and token.isupper() else _CAPITAL
        self[token] = code = (xxhash.xxh64_intdigest(low) & ~7) | kind
        return code


class Templates:
    """Templates of several texts behind one another, as arrays over all of them."""

    def __init__(self, texts: list[str | None], codes: Codes) -> None:
        tokens = [_TOKEN.findall(t or "") for t in texts]
        sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        raw = [t for ts in tokens for t in ts]
        text = np.repeat(np.arange(len(texts)), sizes)
        got = np.fromiter(map(codes.__getitem__, raw), dtype=np.uint64, count=len(raw))
        kind = (got & np.uint64(7)).astype(np.int8)
        stop = kind == _STOP
        first = np.ones(len(raw), dtype=bool)
        first[1:] = stop[:-1] | (text[1:] != text[:-1])
        at = np.flatnonzero(~stop)
        code, kind, first, text = got[at] & ~np.uint64(7), kind[at], first[at], text[at]
        inside = text[1:] == text[:-1]  # a token and the one before it are of one text
        self.plain = Rolled(code.copy(), text)
        number = kind == _NUMBER
        unit = np.zeros(len(at), dtype=bool)
        unit[1:] = (kind[1:] == _UNIT) & number[:-1] & inside
        loud = kind == _SHOUT  # text in capitals has no names
        beside = np.zeros(len(at), dtype=bool)
        beside[1:] |= loud[:-1] & inside
        beside[:-1] |= loud[1:] & inside
        name = (kind == _CAPITAL) & ~first & ~beside
        lead = (kind == _CAPITAL) & first & ~beside
        code[number], code[unit], code[name] = NUMBER, UNIT, NAME
        keep = np.ones(len(at), dtype=bool)
        keep[1:] = ~(name[1:] & name[:-1] & inside)
        chosen = np.flatnonzero(keep)
        last = np.append(chosen[1:], len(at)) - 1
        self.raw, self.at = raw, at[chosen]
        self.last = at[last] + 1 if len(at) else at  # end of each in the raw tokens
        self.lead = lead[chosen]  # may be a name, but starts a sentence
        self.typed = Rolled(code[chosen], text[chosen])
        self.sizes = np.bincount(self.typed.text, minlength=len(texts)), np.bincount(self.plain.text, minlength=len(texts))
        self.begin = np.cumsum(self.sizes[0]) - self.sizes[0], np.cumsum(self.sizes[1]) - self.sizes[1]

    def slots(self, start: int, width: int, named: bool) -> list[str]:
        """Placeholders of a window with their values, in order; ``named`` takes its first token for a name."""
        kinds = self.typed.code[start:start + width].tolist()
        if named:
            kinds[0] = NAME
        return [f"{'?#u@'[c]}{' '.join(self.raw[self.at[k]:self.last[k]]).lower()}" for k, c in enumerate(kinds, start) if c <= 3]


_BASE = 0x9E3779B97F4A7C15
_STEPS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if len(_STEPS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            row = np.full(max(n, 1 << 16), base, dtype=np.uint64)
            row[0] = 1
            _STEPS[k] = np.cumprod(row, dtype=np.uint64)
    return _STEPS[0][:n], _STEPS[1][:n]


def _stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Rolled:
    """Codes of tokens with running sums, from which the hash of any window follows in a few steps."""

    def __init__(self, code: np.ndarray, text: np.ndarray) -> None:
        self.code, self.text = code, text
        self.up, down = _powers(len(code))
        self.mixed = _stirred(code * np.uint64(_BASE) + np.uint64(1))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.mixed * down, dtype=np.uint64)])
        self.literals = np.concatenate([[0], np.cumsum(code > 3)])

    def hashes(self, width: int, literals: int, start: int = 0, named: bool = False) -> np.ndarray:
        """One hash for each window, independent of where it lies; 0 where it leaves its text or has too few words beside placeholders.
        ``named`` takes the first token for a name."""
        n = max(len(self.code) - width + 1, 0)
        h = (self.sums[width:] - self.sums[:n]) * self.up[:n] if n else np.zeros(0, np.uint64)
        words = self.literals[width:] - self.literals[:n] if n else np.zeros(0, np.int64)
        if named:
            h += _stirred(np.array([NAME], np.uint64) * np.uint64(_BASE) + np.uint64(1)) - self.mixed[:n]
            words = words - (self.code[:n] > 3)
        h = _stirred(h + np.uint64((start + width) * 0xD6E8FEB86659FD93 % (1 << 64)))
        h[(words < min(literals, width)) | (self.text[:n] != self.text[width - 1:][:n])] = 0
        return h


def windows(rows: DataFrame, widths: list[int], only: np.ndarray | None) -> DataFrame:
    """(key, width, pos, h, slots, tokens) of the texts in ``rows`` (key, text); ``only`` limits them to known hashes.
    A width below zero marks windows of lower-cased tokens without placeholders."""
    known = None
    if only is not None:
        seen = np.zeros(1 << 20, dtype=bool)  # by the top bits: most windows are told by one look
        seen[only >> np.uint64(44)] = True
        known = rows.sparkSession.sparkContext.broadcast((only, seen))

    def held(h: np.ndarray) -> np.ndarray:
        """Places of the hashes that are asked for."""
        hit = np.flatnonzero(h)
        if known is not None:
            hashes, seen = known.value
            hit = np.flatnonzero(seen[h >> np.uint64(44)] & (h != 0))
            if len(hit):
                hit = hit[hashes[np.minimum(np.searchsorted(hashes, h[hit]), len(hashes) - 1)] == h[hit]]
        return hit

    names = ["key", "width", "pos", "h", "slots", "tokens"]

    def found(keys: list, t: Templates, width: int, asked: np.ndarray | None = None) -> list[tuple]:
        out, kind = [], 0 if width > 0 else 1
        rolled = t.plain if kind else t.typed
        todo = [(rolled.hashes(-width, 0, VERBATIM), False)] if kind else [(rolled.hashes(width, LITERALS), False)]
        if not kind and t.lead.any():
            h = rolled.hashes(width, LITERALS, named=True)
            h[~t.lead[:len(h)]] = 0
            todo.append((h, True))
        for h, named in todo:
            for i in held(h).tolist():
                text = int(rolled.text[i])
                if asked is None or asked[text]:
                    out.append((keys[text], width, i - int(t.begin[kind][text]), int(h[i].astype(np.int64)), [] if kind else t.slots(i, width, named), int(t.sizes[kind][text])))
        return out

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = Codes()
        for pdf in batches:
            keys, texts, at = pdf["key"].tolist(), pdf["text"].tolist(), 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end] or "") < GROUP_CHARS):
                    size += len(texts[end] or "")
                    end += 1
                t, part, out = Templates(texts[at:end], codes), keys[at:end], []
                if widths == [0]:
                    for kind, sign in enumerate((1, -1)):
                        own = np.clip(t.sizes[kind], 1, WINDOW)
                        for width in np.unique(own).tolist():
                            out += found(part, t, sign * width, own == width)
                else:
                    for width in widths:
                        out += found(part, t, width)
                yield pd.DataFrame(out, columns=names).astype({"width": "int32", "pos": "int32", "h": "int64", "tokens": "int32"})
                at = end

    return rows.mapInPandas(each, "key string, width int, pos int, h long, slots array<string>, tokens int")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, key, item_id, item_tokens, covered, changed_slots): items that documents hold, one row per pair."""
    items = benchmark.groupBy("text").agg(F.min("item_id").alias("item_id")).where("item_id is not null")
    items = items.select(F.col("item_id").cast("string").alias("key"), "text")
    # widths == [0]: windows of both kinds, as wide as the item where that is shorter than WINDOW
    theirs = materialize(windows(items, [0], None).where(F.col("tokens") >= SHORTEST), "op8-items")
    widths = sorted(r[0] for r in theirs.select("width").distinct().collect())  # at most 2 * WINDOW values
    n = theirs.count()
    only = None
    if n <= FILTER_WINDOWS:
        only = np.unique(np.array([r[0] for r in theirs.select("h").distinct().collect()], dtype=np.int64).view(np.uint64))
    texts = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    empty = "doc_id long, key string, item_id long, item_tokens int, covered int, changed_slots int"
    if n == 0:
        return docs.sparkSession.createDataFrame([], empty)
    mine = windows(texts.select(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "key").alias("key"), "text"), widths, only)
    m, t = mine.alias("m"), theirs.alias("t")
    pairs = F.arrays_zip(F.col("t.slots").alias("a"), F.col("m.slots").alias("b"))
    met = m.join(t, (F.col("m.h") == F.col("t.h")) & (F.col("m.width") == F.col("t.width"))).where(F.size("m.slots") == F.size("t.slots")).select(
        F.col("m.key").alias("dkey"), F.col("t.key").cast("long").alias("item_id"), F.col("t.tokens").alias("item_tokens"), F.col("t.width").alias("width"),
        (F.col("m.pos") - F.col("t.pos")).alias("shift"), F.col("t.pos").alias("pos"), pairs.alias("pairs")).distinct()
    # a group has at most as many windows as its item
    line = met.groupBy("dkey", "item_id", "item_tokens", "width", "shift").agg(
        F.collect_list("pos").alias("starts"), F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"))
    values = F.array_distinct(F.transform("pairs", lambda x: x["a"]))
    line = line.where(F.size(values) == F.size("pairs"))  # each value of the item has one value here
    changed = F.size(F.filter("pairs", lambda x: x["a"] != x["b"]))
    # the longest run of neighbouring windows on a diagonal, in tokens
    grown = lambda a, x: F.when(x == a["at"] + 1, a["n"] + 1).otherwise(1)
    longest = F.aggregate(F.sort_array(F.array_distinct("starts")), F.struct(F.lit(-2).alias("at"), F.lit(0).alias("n"), F.lit(0).alias("best")), lambda a, x: F.struct(
        x.alias("at"), grown(a, x).alias("n"), F.greatest(a["best"], grown(a, x)).alias("best")))["best"]
    run = F.when(F.col("width") < 0, longest - 1 - F.col("width")).otherwise(0)
    both = line.groupBy("dkey", "item_id", "item_tokens", "width").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("starts")))).alias("s"), F.max(changed).alias("changed_slots"), F.max(run).alias("run"))
    nexts = F.concat(F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0))), F.array(F.lit(1 << 30)))
    covered = F.aggregate(F.zip_with(F.col("s"), nexts, lambda a, b: b - a), F.lit(0), lambda acc, x: acc + F.least(x, F.abs("width")))
    both = both.withColumn("covered", covered).where((F.col("covered") >= F.col("item_tokens") * COVER) | (F.col("run") >= RUN))
    # a template's row comes before that of a verbatim copy
    best = F.max(F.struct((F.col("width") > 0).alias("typed"), "covered", "item_tokens", "changed_slots")).alias("best")
    both = both.groupBy("dkey", "item_id").agg(best).select("dkey", "item_id", "best.*")
    where = F.instr("dkey", ":")
    doc_id = F.expr("try_cast(substring_index(dkey, ':', 1) AS bigint)")
    return both.select(doc_id.alias("doc_id"), F.expr("substring(dkey, instr(dkey, ':') + 1)").alias("key"), "item_id", "item_tokens", "covered", "changed_slots").where(where > 0)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no benchmark item; the columns of ``docs``."""
    held = materialize(leaks(docs, benchmark).select(F.col("key").alias("_key")).distinct(), "op8-held")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), row_key(F.col("doc_id"), F.col("text")).alias("_key"))
    return rows.join(held, "_key", "left_anti").select("_row.*")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")
