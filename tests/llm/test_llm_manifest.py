"""Merkle manifest against a plain recomputation, on hurtful rows and over several rounds of blocks."""

import hashlib
import zlib

import pytest

from remitlens.llm import manifest

SCHEMA = "source string, doc_id long, text string, lang string, n_chars long, leaf string, root long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r: dict, text) -> str:
    parts = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return sha("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))


def climb(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k:k + 3])) for k in range(0, len(levels[-1]), 3)])
    return levels


def path(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    out = []
    for level in levels[:-1]:
        own = at // 3 * 3
        out.append(("".join(level[own:at]), "".join(level[at + 1:own + 3])))
        at //= 3
    return out


def brute(rows: list[dict]) -> list[tuple]:
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees, held = [], []
    for s in sources:
        own = sorted([r for r in rows if r["source"] == s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        held.append(own)
        trees.append(climb([leaf(r, r["text"]) for r in own]))
    top = climb([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for k, (own, tree) in enumerate(zip(held, trees)):
        for at, r in enumerate(own):
            steps = path(tree, at) + path(top, k)
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            acc = leaf(r, text)
            for a, b in steps:
                acc = sha(a + acc + b)
            out.append((r["doc_id"], tree[0][at], tree[-1][0], root, sha("".join(a + b for a, b in steps)), acc, acc == root))
    return out


def rows_of(n: int) -> list[dict]:
    rows = [{"source": [None, "a", "b", "ä", "z"][k % 5] if k < 40 else "hot", "doc_id": k, "text": f"line {k}\nend", "lang": "en", "n_chars": k} for k in range(n)]
    rows += [{"source": "a", "doc_id": None, "text": None, "lang": None, "n_chars": None}, {"source": "a", "doc_id": 1, "text": "", "lang": "", "n_chars": 0},
             {"source": "lone", "doc_id": 5, "text": "x\n" * 200_000, "lang": "en", "n_chars": 1}]
    return rows + [dict(rows[50])] * 4


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_equals_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "BLOCK", 3 ** levels)
    rows = rows_of(300)
    df = spark.createDataFrame([(r["source"], r["doc_id"], r["text"], r["lang"], r["n_chars"], "clash", 7) for r in rows], SCHEMA)
    got = manifest.check_manifest(df, manifest.tampered())
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(rows), key=key)


def test_one_row_and_none(spark):
    one = spark.createDataFrame([("s", 3, "t", None, 1, "", 0)], SCHEMA)
    r = manifest.check_manifest(one, manifest.tampered()).collect()[0]
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == sha("") and r.verified
    assert manifest.check_manifest(one.where("doc_id < 0"), manifest.tampered()).count() == 0
