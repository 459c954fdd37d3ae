"""Operators on documents against brute force: given tables and rows made to hurt."""

import base64
import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash

from remitlens.llm import decontamination, lengths, mixing, quality, repeats, sharding, simhash
from remitlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PARA = "Seven grey boats crossed the quiet harbour while old bells rang over the wet stones. " * 8


def nasty():
    rows = [
        (1, None, "en", "a", None), (2, "", None, None, 0), (3, " \t\n", "en", "a", 3), (4, "word", "en", "b", 4), (4, "word", "en", "b", 4),
        (None, "a null id but some text of several words", "en", None, None), (None, None, None, None, None),
        (5, PARA, "en", "a", len(PARA)), (6, PARA, "en", "b", len(PARA)), (7, "x" + PARA + " end", "en", "c", 1), (8, PARA[:380], "en", "c", 1),
        (9, "a" * 5000, "en", "c", 5000), (10, "the the " * 700, "en", "c", 1), (11, "é漢 字 😀 " * 60, "fr", "d", 1),
        (12, "\n".join(f"line {i} of this text with words" for i in range(60)), "en", "d", 1),
        (13, "one\x0btwo\x0cthree\x85four", "en", "d", 1),
    ]
    long_ = " ".join(f"w{(i * 7919) % 4001}" for i in range(60_000))
    return rows + [(20, long_, "en", "long", len(long_)), (21, long_ + " tail", "en", "long", 0)]


@pytest.fixture(scope="module")
def tables(spark):
    """name -> (DataFrame, rows): the given table, the nasty rows with clashing extra columns, an empty table."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    extra = "size long, shard int, slot string, key string, base int, more int, source_size long, copies int, fp int, h string, words string, n int, kept string"
    mean = spark.createDataFrame([(*r, 1, 2, "s", "k", 3, 4, 5, 6, 7, "h", "w", 8, "kept") for r in nasty()], f"{DOCS}, {extra}")
    none = spark.createDataFrame([], DOCS)
    return {k: (df, [tuple(r[:5]) for r in df.collect()]) for k, df in (("given", given), ("mean", mean), ("none", none))}


NAMES = ["given", "mean", "none"]


def order(x):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in x)


@pytest.mark.parametrize("name", NAMES)
def test_shards(tables, name):
    df, rows = tables[name]
    got = sharding.shard_documents(df).collect()
    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows), key=order)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=order) == want
    by = collections.defaultdict(list)
    for r in got:
        assert 0 <= r.shard < 40 and r.law == "bytes" and r.grown_shard is None
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    moved = sharding.shard_rows(df)
    assert moved.count() == len(rows) and {"shard", "slot"} <= set(moved.columns)


def test_shards_even_and_groups_whole(spark):
    rows = [(i, f"text {i % 700} " * (5 + i % 700 % 50)) for i in range(4000)] + [(10_000 + i, "hot copy of one text") for i in range(2000)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 8).toPandas()
    loads = got.groupby("shard")[["size", "tokens"]].sum()
    assert (loads.max() / loads.min() < 1.02).all() and got.groupby("shard").size().max() < 1.05 * len(rows) / 8
    groups = collections.defaultdict(set)
    texts = dict(rows)
    for r in got.itertuples():
        groups[texts[r.doc_id]].add(r.shard)
    assert len(groups.pop("hot copy of one text")) > 1 and all(len(v) == 1 for v in groups.values())


def test_place_prefers_the_highest_dot_product():
    residual = np.array([[10.0, 2.0], [2.0, 10.0]])
    assert sharding.place(np.array([[2.0, 0.1], [0.1, 2.0]]), residual).tolist() == [0, 1]


@pytest.mark.parametrize("name", NAMES)
def test_repeats(tables, name):
    df, rows = tables[name]
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    n, counts = repeats.LENGTH, collections.Counter()
    for _, b in data:
        counts.update(hash(b[k:k + n]) for k in range(len(b) - n + 1))
    want = []
    for i, b in data:
        cover = np.zeros(len(b) + 1, int)
        for k in range(len(b) - n + 1):
            if counts[hash(b[k:k + n])] > 1:
                cover[k] += 1
                cover[k + n] -= 1
        gone = np.cumsum(cover)[:len(b)] > 0
        rest = np.frombuffer(b, np.uint8)[~gone].tobytes()
        want.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(rest).hexdigest(), rest))
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in repeats.remove_repeats(df).collect()]
    assert sorted(got, key=order) == sorted(want, key=order)


def test_repeats_hot_cores_give_the_same(spark, monkeypatch):
    lines = [(i, f"{i} " * (i % 7) + PARA[: 420 + 9 * (i % 12)] + f" own words {i * i}") for i in range(60)]
    df = spark.createDataFrame(lines, "doc_id long, text string")
    usual = sorted(map(tuple, repeats.remove_repeats(df, False).collect()))
    monkeypatch.setattr(repeats, "HOT", 3)
    assert sorted(map(tuple, repeats.remove_repeats(df, False).collect())) == usual
    assert sum(r[2] for r in usual) > 0


def test_deep_shallow_sorts_and_finds_equal_windows():
    rng = np.random.default_rng(3)
    strings = [bytes(rng.integers(97, 99, rng.integers(0, 90)).astype(np.uint8)) for _ in range(400)]
    strings += [b"a" * k for k in range(80)] + [b"a" * 70 + bytes([98 + k % 3]) for k in range(9)]
    assert [strings[x] for x in repeats.deep_shallow(strings)] == sorted(strings)
    assert [strings[x] for x in repeats.blind_order(strings, list(range(len(strings))))] == sorted(strings)


@pytest.mark.parametrize("name", NAMES)
def test_mix(tables, name):
    df, rows = tables[name]
    got = mixing.mix_report(df).collect()
    size = [(i, s, len(WORD.findall(t or ""))) for i, t, _, s, _ in rows]
    assert sorted(((r.doc_id, r.source, r["size"]) for r in got), key=order) == sorted(size, key=order)
    totals, longest = collections.Counter(), collections.Counter()
    for _, s, n in size:
        totals[s] += n
        longest[s] = max(longest[s], n)
    names = sorted((s for s in totals if s is not None)) + [None] * (None in totals)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(totals.values())
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * unit > 2 * totals[s]}
        for s in full or open_:
            target[s] = 2.0 * totals[s] if full else weight[s] * unit
            left -= target[s] if full else 0
        open_ -= full or open_
    taken = collections.Counter()
    for r in got:
        assert r.source_size == totals[r.source] and abs(r.target - target[r.source]) < 1e-6 * (1 + target[r.source])
        assert r.taken == r.copies * r["size"] <= 2 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= longest[s] + 1e-6 for s in names)
    again = mixing.mix_report(df.repartition(3)).collect()
    assert sorted(map(tuple, again), key=order) == sorted(map(tuple, got), key=order)
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns
    assert sum(len(WORD.findall(r.text or "")) for r in mixed.collect()) == sum(taken.values())


def brute_quality(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    at = collections.defaultdict(list)
    for k in range(len(w) - 7):
        at[tuple(w[k:k + 8])].append(k)
    again = {k + j for v in at.values() if len(v) > 1 for k in v for j in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), len(w) < 20 or 100 * len(again) > 30 * len(w)


@pytest.mark.parametrize("name", NAMES)
def test_quality(tables, name):
    df, rows = tables[name]
    got = quality.judge(df).collect()
    want = sorted(((i, *brute_quality(t)) for i, t, *_ in rows), key=order)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=order) == want
    assert not any(r.kept and r.base_failed for r in got)
    cleaned = quality.clean_documents(df)
    assert cleaned.columns == df.columns and cleaned.count() == sum(r.kept for r in got)


def test_frequent_lines_deplete_and_copies_do_not(spark):
    notice = "Accept all cookies to read on and agree to everything that our many partners want from you today."
    spell = lambda i: "".join("abcdefghij"[int(c)] for c in str(i))
    own = lambda i: " ".join(f"own{spell(i)}word{spell(k)}" for k in range(30))
    rows = [(i, f"{notice}\n{own(i)}\n{own(i + 1000)}", "h") for i in range(60)]
    rows += [(100 + i, f"{notice}\n{notice.upper()}\nshort own tail {chr(97 + i)}{chr(98 + i)}", "h") for i in range(5)]
    rows += [(200 + i, "\n".join(own(9000 + k) for k in range(6)) + f"\nedited {spell(i)}", "h") for i in range(80)]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i].kept and got[i].removed_words == 18 for i in range(60))
    assert not any(got[100 + i].kept for i in range(5))
    assert all(got[200 + i].kept for i in range(80))
    out = {r.doc_id: r.text for r in quality.clean_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert notice not in out[3] and own(3) in out[3]


def test_lengths(spark, tables):
    import tiktoken

    ranks, pattern = lengths.load_ranks(lengths.default_vocabulary())
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for name in NAMES:
        df, rows = tables[name]
        n = [len(enc.encode_ordinary(t or "")) for _, t, *_ in rows]
        hist = lengths.histogram(lengths.encoded_lengths(df))
        got = hist.collect()
        assert {r.tokens: r.docs for r in got} == collections.Counter(n)
        for r in got:
            assert r.truncated_total == sum(min(x, r.tokens) for x in n) and r.docs_from == sum(x >= r.tokens for x in n)
            assert r.tokens_from == sum(x for x in n if x >= r.tokens) and r.lost_tokens == sum(n) - r.truncated_total
            assert r["quantile"] == pytest.approx(sum(x <= r.tokens for x in n) / len(n))
        for r in lengths.at_limits(hist, [0, 7, 10**9]).collect():
            assert r.truncated_total == sum(min(x, r.context) for x in n) and r.docs_cut == sum(x > r.context for x in n)


def slow_fingerprint(text):
    w = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = WORD.findall(w)
    shingles = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def linked(fps, ids):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    low = {}
    for k, i in enumerate(ids):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return [low.get(find(k)) for k in range(len(fps))]


@pytest.mark.parametrize("name", NAMES)
def test_simhash(tables, name):
    df, rows = tables[name]
    got = simhash.near_duplicates(df).collect()
    fps = [slow_fingerprint(t) for _, t, *_ in rows]
    want = list(zip([r[0] for r in rows], (f"{f:016x}" for f in fps), linked(fps, [r[0] for r in rows])))
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=order) == sorted(want, key=order)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and kept.count() == len({r.root for r in got})


def test_vantage_point_search_finds_all_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 200)
    monkeypatch.setattr(simhash, "LEAF", 8)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 700, dtype=np.uint64)
    near = [int(x) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)) for x in base for _ in range(2)]
    fps = sorted({int(x) for x in base} | set(near))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    low = linked(fps, list(range(len(fps))))
    mine = collections.defaultdict(set)
    for k, s in enumerate(signed):
        mine[roots.get(s, s)].add(k)
    assert {frozenset(v) for v in mine.values()} == {frozenset(k for k in range(len(fps)) if low[k] == r) for r in set(low)}


BENCH = [(1, "If Anna buys 3 apples and 5 pears at 2 dollars each how much does she pay in total for the 3 apples"),
         (2, "The tall tower of Paris was finished long before 1900 and many people came to see it every single day"), (3, None), (4, "two words"),
         (5, "The tall tower of Paris was finished long before 1900 and many people came to see it every single day")]


def test_templates_catch_changed_numbers_and_leave_others(spark):
    docs = [(10, "Well now. If Peter buys 7 apples and 9 pears at 4 dollars each how much does she pay in total for the 7 apples? Good."),
            (11, "If Peter buys 7 apples and 9 pears at 4 dollars each how much does she pay in total for the 8 apples"),
            (12, "Apples and pears are fruit that people buy at markets and pay for in coins of many kinds each day."),
            (13, "so THE TALL TOWER OF PARIS WAS FINISHED LONG BEFORE 1900 AND MANY PEOPLE CAME TO SEE IT EVERY SINGLE DAY!!"),
            (14, None), (15, ""), (None, "The tall tower of Rome was finished long before 1800 and many people came to see it every single day."), (16, "two words")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(BENCH, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.leaks(df, bench).collect()}
    assert set(got) == {(10, 1), (13, 2), (None, 2)} and got[10, 1].changed_slots >= 3 and got[13, 2].changed_slots == 0
    assert sorted(r.doc_id for r in decontamination.clean_documents(df, bench).collect()) == [11, 12, 14, 15, 16]
    none = bench.limit(0)
    assert decontamination.leaks(df, none).count() == 0 and decontamination.leaks(df.limit(0), bench).count() == 0


def test_templates_without_the_filter_agree(spark, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    df = spark.read.parquet(f"{SF}/documents.parquet")
    usual = sorted(map(tuple, decontamination.leaks(df, bench).collect()))
    monkeypatch.setattr(decontamination, "FILTER_WINDOWS", -1)
    assert sorted(map(tuple, decontamination.leaks(df, bench).collect())) == usual
    words = lambda t: re.findall(r"[^\W\d_]+|\d+", t.lower())
    items = {r.item_id: " ".join(words(r.text)) for r in bench.collect()}
    held = {(r.doc_id, i) for r in df.collect() for i, t in items.items() if f" {t} " in f" {' '.join(words(r.text))} "}
    assert held <= {(u[0], u[2]) for u in usual}


def test_every_query_is_there():
    assert [sum(k.startswith(f"op{n}_") for k in QUERIES) for n in range(1, 11)] == [1] * 10
    assert base64.b32encode(hashlib.sha1(b"").digest()) == b"3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
