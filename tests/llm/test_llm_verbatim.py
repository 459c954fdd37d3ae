"""Decontamination of copies that templates alone do not tell."""

import pytest

from remitlens.llm import decontamination

LONG = " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}word" for k in range(60))
BENCH = [(1, "A shop sold 3 red apples before noon and many more pears in the late afternoon so how many were left of the 3 apples"),
         (2, LONG), (3, "Compute 12 x 30."), (4, "What is the capital of France?"), (5, "Anna Bob Carl Dora Emil Fritz Gina Hans Ida Jan")]
DOCS = [(10, "Well. A shop sold 3 red apples before noon and many more pears in the late afternoon so how many were left of the 8 apples. Good.", 1),
        (11, "Other words here " + " ".join(LONG.split()[20:45]) + " and some others", 2), (12, "Please compute 12 x 30 by hand", 3),
        (13, 'He asked, "What is the capital of France?" and left', 4), (14, 'He asked, "What is the capital of Spain?" and left', 4),
        (15, "we saw Anna Bob Carl Dora Emil Fritz Gina Hans Ida Jan there", 5), (16, "Other words " + " ".join(LONG.split()[20:32]) + " others", None),
        (17, "Please compute 13 x 30 by hand", None)]


@pytest.mark.parametrize("bound", [2_000_000, -1])
def test_verbatim_copies_are_found(spark, monkeypatch, bound):
    monkeypatch.setattr(decontamination, "FILTER_WINDOWS", bound)
    df = spark.createDataFrame([d[:2] for d in DOCS], "doc_id long, text string")
    found = decontamination.leaks(df, spark.createDataFrame(BENCH, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(d, i) for d, _, i in DOCS if i]
