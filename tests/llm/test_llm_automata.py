"""Passage removal against brute force, on hurtful rows; automata against counting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from remitlens.llm import automata


def brute(texts: list) -> list[tuple]:
    words = [(t or "").encode().split() for t in texts]
    k = automata.WINDOW
    count = Counter(tuple(w[s:s + k]) for w in words for s in range(len(w) - k + 1))
    out = []
    for w in words:
        gone = {s + j for s in range(len(w) - k + 1) if count[tuple(w[s:s + k])] > 1 for j in range(k)}
        rest = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((len(w), len(gone), hashlib.sha256(rest).hexdigest(), rest.decode()))
    return out


def corpus() -> list:
    rng = random.Random(5)
    some = lambda n, v=400: [f"w{rng.randrange(v)}" for _ in range(n)]
    passage, notice = some(70), some(36)
    texts = [" ".join(some(rng.randrange(1, 60)) + passage[rng.randrange(4):70 - rng.randrange(4)] + some(rng.randrange(60))) for _ in range(80)]
    texts += ["\t".join(some(20) + notice) + "\n" + " ".join(some(30)) for _ in range(30)]
    near = some(200)
    for k in range(40):
        edit = list(near)
        edit[rng.randrange(200)] = f"edit{k}"
        texts.append("  ".join(edit))
    texts += [None, "", " \n", "one", " ".join(some(34)), " ".join(["a"] * 500), " ".join(["a", "b"] * 60), " ".join(some(50, 3)), " ".join(some(60)), " ".join(some(40)) + "\x1f" + "x"]
    texts += [" ".join(near)] * 5 + [" ".join(some(34))] * 3
    texts.append(" ".join(some(3000) + passage + some(3000, 2)))
    return texts


@pytest.mark.parametrize(("hot", "chunk"), [(2000, 1 << 19), (3, 64)])
def test_equals_brute_force(spark, monkeypatch, hot, chunk):
    monkeypatch.setattr(automata, "HOT", hot)
    monkeypatch.setattr(automata, "CHUNK", chunk)
    texts = corpus()
    df = spark.createDataFrame([(k if k % 9 else None, t, "clash", 1) for k, t in enumerate(texts)], "doc_id long, text string, tkey string, n long")
    got = automata.remove_passages(df.repartition(7)).collect()
    assert sorted((r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in got) == sorted(brute(texts))


def test_repeated_rows_and_no_rows(spark):
    text = " ".join(f"w{k}" for k in range(40))
    df = spark.createDataFrame([(1, text)] * 3 + [(2, "short")] * 2, "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed, r.changed) for r in automata.remove_passages(df).collect()) == [(1, 40, True)] * 3 + [(2, 0, False)] * 2
    assert automata.remove_passages(df.where("doc_id < 0")).count() == 0


def test_planted_passages_go_and_clean_documents_stay(spark):
    rng = random.Random(8)
    rows = []
    for k in range(60):
        body = [f"u{k}x{rng.randrange(10 ** 9)}" for _ in range(120)]
        if k < 40:  # 60 words that two documents share
            body[30:30] = [f"p{k // 2}y{j}" for j in range(60)]
        rows.append((k, " ".join(body)))
    got = {r.doc_id: r for r in automata.remove_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k].n_removed for k in range(60)] == [60] * 40 + [0] * 20


def test_matching_statistics_and_counts():
    rng = random.Random(3)
    texts = [[b"%d" % rng.randrange(4) for _ in range(rng.randrange(1, 80))] for _ in range(30)]
    times = [rng.randrange(1, 4) for _ in texts]
    auto = automata.Automaton.load(automata.build(texts, times).dump())
    count: Counter = Counter()
    for t, n in zip(texts, times):
        for i in range(len(t)):
            for j in range(i + 1, min(len(t), i + automata.WINDOW) + 1):
                count[tuple(t[i:j])] += n
    asked = [[b"%d" % rng.randrange(5) for _ in range(60)] for _ in range(20)] + texts[:5] + [[]]
    for t, (size, often) in zip(asked, automata.matching(auto, asked)):
        for j in range(len(t)):
            want = max((n for n in range(1, min(j + 1, automata.WINDOW) + 1) if count[tuple(t[j + 1 - n:j + 1])]), default=0)
            assert size[j] == want and often[j] == (count[tuple(t[j + 1 - want:j + 1])] if want else 0)
    assert np.all(auto.length[auto.link[1:]] < auto.length[1:])
