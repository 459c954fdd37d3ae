"""Planted byte passages: those of the contract's length go, shorter ones and clean documents stay."""

import random

from remitlens.llm import repeats


def words(rng: random.Random, n: int) -> str:
    return " ".join(f"{rng.randrange(10 ** 8):x}" for _ in range(n))


def test_planted_passages_go_and_clean_documents_stay(spark):
    rng, rows, planted, short, clean = random.Random(11), [], {}, [], []
    for k in range(40):
        passage = words(rng, 70)  # over 400 bytes
        assert len(passage) >= repeats.LENGTH
        for _ in range(2):
            planted[len(rows)] = len(passage)
            rows.append((len(rows), f"{words(rng, 30)}\n{passage}\n{words(rng, 30)}"))
    for k in range(20):
        passage = words(rng, 51)[:repeats.LENGTH - 20]  # over 50 words may still be too short
        for _ in range(2):
            short.append(len(rows))
            rows.append((len(rows), f"{words(rng, 60)}\n{passage}\n{words(rng, 60)}"))
    for k in range(40):
        clean.append(len(rows))
        rows.append((len(rows), words(rng, 200)))
    got = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    caught = sum(got[d].changed and n <= got[d].n_removed <= n + 12 for d, n in planted.items())
    assert (caught / len(planted), sum(not got[d].changed for d in clean) / len(clean)) == (1.0, 1.0)
    assert not any(got[d].changed for d in short)
    assert all(r.n_kept == r.n_bytes - r.n_removed == len(r.kept) for r in got.values())
