"""Periodic runs against brute force: random and highly periodic words, hurtful rows; the wavelet tree against plain search."""

import hashlib
import random

import numpy as np

from remitlens.llm import periodic


def brute(w: list) -> list[tuple[int, int, int]]:
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def repeated(rng: random.Random, sizes: int = 24) -> list:
    """Powers of powers with breaks, over a small alphabet."""
    u = [rng.randrange(rng.randrange(1, 4)) for _ in range(rng.randrange(1, sizes))]
    if rng.random() < 0.5:
        u = u * rng.randrange(1, 4) + [rng.randrange(3)] * rng.randrange(4)
    w = [rng.randrange(3) for _ in range(rng.randrange(9))] + (u * 9)[:rng.randrange(len(u), 1 + 6 * len(u))] + [rng.randrange(3) for _ in range(rng.randrange(9))]
    return w + repeated(rng, sizes) if rng.random() < 0.3 else w


def test_runs_equal_brute_force_on_periodic_words():
    rng = random.Random(1)
    texts = [repeated(rng) for _ in range(4000)] + [[rng.randrange(2) for _ in range(n)] for n in range(200)]
    for got, t in zip(periodic.grouped_runs(texts), texts):
        assert got == brute(t), t


def test_every_short_period_in_every_place():
    """All primitive words of up to 7 letters over two, to the fourth power and a little more, at all offsets from the grid."""
    texts = []
    for q in range(1, 8):
        for bits in range(2 ** q):
            u = [bits >> k & 1 for k in range(q)]
            for pad in range(0, 8):
                texts.append([2 + k for k in range(pad)] + (u * 5)[:max(6, 4 * q) + bits % (q + 1)] + [99])
    for got, t in zip(periodic.grouped_runs(texts), texts):
        assert got == brute(t), t


def test_longer_periods_with_periodic_blocks():
    rng = random.Random(7)
    texts = []
    for _ in range(300):
        q = rng.randrange(8, 80)
        u, x = [], 0
        while len(u) < q:
            x += rng.random() < 0.4
            u += ([rng.randrange(2) for _ in range(rng.randrange(1, 4))] * q)[:rng.randrange(1, q)] + [3 + x % 2] * rng.randrange(2)
        texts.append([7] * rng.randrange(20) + (u[:q] * 6)[:4 * q + rng.randrange(q)] + [8, 9])
    for got, t in zip(periodic.grouped_runs(texts), texts):
        assert got == brute(t), t


def test_successor():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 100, 60)
    tree = periodic.WaveletTree(values)
    left, right, least = rng.integers(0, 60, 500), rng.integers(0, 61, 500), rng.integers(0, 140, 500)
    right = np.maximum(left, right)
    for a, b, x, got in zip(left, right, least, tree.successor(left, right, least)):
        assert got == min([v for v in values[a:b].tolist() if v >= x], default=-1)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_documents(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t", "one", "a " * 5, "a " * 6, "x\ty\n" * 3, "x\ty\n" * 4 + "x z", "a b\x1fc " * 4, " ".join(f"w{k % 700}" for k in range(3000)), "la " * 50_000]
    texts += [" ".join(f"v{x}" for x in repeated(rng)) for _ in range(60)] + ["x\ty\n" * 4] * 3
    rows = [(k if k % 7 else None, t, "clash", 3) for k, t in enumerate(texts)]
    got = periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, runs string, start int").repartition(3)).collect()
    want = []
    for d, t, *_ in rows:
        w = [x.decode() for x in (t or "").encode().split()]
        runs = brute(w) if len(w) < 10_000 else [(0, len(w), 1)]
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((d, len(w), len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(left), len(gone), left))
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.n_words, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256, r.n_dropped, r.collapsed) for r in got), key=key) == sorted(want, key=key)
    assert periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_planted_tail():
    words = [b"%d" % k for k in range(50)]
    ids = [d for d in range(300) if periodic.planted(d, words) != words]
    assert ids and periodic.planted(None, words) == words and periodic.planted(ids[0], []) == []
    import zlib
    for d in ids:
        h = zlib.crc32(str(d).encode())
        g = h // 10
        a, n = g % 50, 50
        p = 1 + (n - a) // (3 + g % 8)
        assert h % 10 == 0 and periodic.planted(d, words) == [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
