"""Boosted trees against a plain implementation on a small table; many fits equal single fits; early stop; persistence."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from remitlens.operators import boosting
from remitlens.operators.boosting import Boost, Fit


def data(n: int = 200, seed: int = 1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 1)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > -0.3)).astype(int) | (rng.random(n) < 0.05)
    return x, y.astype(int)


def frame(spark, x, y, parts: int = 3):
    rows = [(Vectors.dense(a.tolist()), float(b), int(k % 5), 2.0 if b else 1.0) for k, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["features", "label", "fold", "w"]).repartition(parts)


def plain_tree(x, g, h, spec):
    """Best-first growth by trying every value of every feature: [(feature, value, gain)] in order and the leaf values of the rows."""
    leaves, out = {0: (np.ones(len(x), bool), 0)}, []

    def best(mask):
        found = (0.0, 0, 0.0)
        score = lambda m: g[m].sum() ** 2 / (h[m].sum() + spec.l2)
        for j in range(x.shape[1]):
            for v in np.unique(x[mask, j])[:-1]:
                lo, hi = mask & (x[:, j] <= v), mask & (x[:, j] > v)
                if lo.sum() >= spec.min_rows and hi.sum() >= spec.min_rows:
                    gain = score(lo) + score(hi) - score(mask)
                    if gain > found[0] + 1e-9:
                        found = (gain, j, v)
        return found

    known = {0: best(leaves[0][0])}
    while len(leaves) < spec.leaves:
        node = max(known, key=lambda k: known[k][0])
        gain, j, v = known.pop(node)
        if gain <= 1e-12:
            break
        mask, depth = leaves.pop(node)
        out.append((j, v, gain))
        for side in (mask & (x[:, j] <= v), mask & (x[:, j] > v)):
            k = 1 + max([*leaves, *known, node, len(out) * 2])
            leaves[k] = (side, depth + 1)
            known[k] = best(side) if depth + 1 < spec.depth else (0.0, 0, 0.0)
    value = np.zeros(len(x))
    for mask, _ in leaves.values():
        value[mask] = -spec.step * g[mask].sum() / (h[mask].sum() + spec.l2)
    return out, value


@pytest.mark.parametrize("spec", [Boost(rounds=3, leaves=6, depth=6, l2=1.5, min_rows=8), Boost(rounds=2, leaves=64, depth=3, min_rows=5, weight="w", step=0.3)])
def test_splits_gains_and_scores_equal_brute_force(spark, monkeypatch, spec):
    monkeypatch.setattr(boosting, "KEEP", 2)
    monkeypatch.setattr(boosting, "BINS", 200)
    monkeypatch.setattr(boosting, "TASK_ROWS", 50)
    x, y = data()
    model = boosting.fit_many(frame(spark, x, y), [Fit("m", None, spec)])[0][0]
    w = np.where(y == 1, 2.0, 1.0) if spec.weight else np.ones(len(y))
    share = (w * y).sum() / w.sum()
    score = np.full(len(x), np.log(share / (1 - share)))
    assert len(model.trees) == spec.rounds
    for tree in model.trees:
        p = 1 / (1 + np.exp(-score))
        splits, value = plain_tree(x, w * (p - y), w * p * (1 - p), spec)
        got = sorted((f, round(float(model.cuts[f][c]), 6), round(v, 6)) for f, c, v in zip(tree.feature, tree.cut, tree.gain) if f >= 0)
        assert got == sorted((j, round(float(v), 6), round(float(gain), 6)) for j, v, gain in splits)
        score += value
    assert np.allclose(model.raw(x), score)


def test_many_fits_equal_single_fits_and_leave_their_fold_out(spark):
    x, y = data(300, 3)
    table = frame(spark, x, y)
    fits = [Fit("a", f, Boost(rounds=3, leaves=5, min_rows=10)) for f in range(5)] + [Fit("b", f, Boost(rounds=5, leaves=8, depth=3, l2=1.0, min_rows=10)) for f in range(5)]
    models, held = boosting.fit_many(table, fits)
    rows = held.collect()
    assert len(rows) == 600 and {r.Model for r in rows} == {"a", "b"}
    for k in (1, 7):
        alone = boosting.fit_many(table.where(f"fold <> {fits[k].fold}"), [Fit("x", None, fits[k].spec)])[0][0]
        want = boosting.Boosted(models[k].cuts, models[k].base, models[k].trees).raw(x)
        if all(np.array_equal(a, b) for a, b in zip(alone.cuts, models[k].cuts)):
            assert np.allclose(alone.raw(x), want)
    mine = sorted(r.score for r in rows if r.Model == "b" and r.fold == 2)
    part = x[np.arange(300) % 5 == 2]
    assert np.allclose(mine, np.sort(1 / (1 + np.exp(-models[7].raw(part)))))


def test_early_stop_and_empty_classes(spark):
    rng = np.random.default_rng(5)
    x, y = np.round(rng.normal(size=(400, 3)), 1), rng.integers(0, 2, 400)
    model = boosting.fit_many(frame(spark, x, y), [Fit("m", None, Boost(rounds=60, patience=3, min_rows=5))])[0][0]
    assert 3 <= len(model.trees) < 60  # noise: the held-back loss does not fall
    one = boosting.fit_many(frame(spark, x, np.zeros(400, int)), [Fit("m", None, Boost(rounds=2))])[0][0]
    assert (one.raw(x) < -5).all()


def test_save_load_transform(spark, tmp_path):
    x, y = data()
    table = frame(spark, x, y)
    model = Boost(rounds=4, leaves=6, min_rows=5).fit(table)
    boosting.save(model, str(tmp_path / "m"))
    back = boosting.load(spark, str(tmp_path / "m"))
    got = back.transform(table).collect()
    want = {tuple(a): 1 / (1 + np.exp(-b)) for a, b in zip(x.tolist(), model.raw(x))}
    assert all(abs(r.probability[1] - want[tuple(r.features)]) < 1e-12 for r in got)
    assert sum(back.featureImportances) == pytest.approx(1.0)


@pytest.mark.parametrize("keep, write, direct", [(1, 2, 0), (1, 100, 1 << 30)])
def test_scores_stay_in_memory_between_writes_and_tasks_do_not_grow_with_rows(spark, monkeypatch, keep, write, direct):
    x, y = data(400, 4)
    table, fits = frame(spark, x, y, 6), [Fit("a", f, Boost(rounds=5, leaves=6, min_rows=5)) for f in (0, 3)]
    want = [m.raw(x) for m in boosting.fit_many(table, fits)[0]]
    stored = []
    real = boosting.materialize

    def counted(df, name):
        out = real(df, name)
        stored.append(len(out.inputFiles()))
        return out

    for name, value in (("materialize", counted), ("TASK_ROWS", 10), ("KEEP", keep), ("WRITE", write), ("DIRECT", direct), ("BLOCK_ROWS", 40), ("PIECE_ROWS", 16)):
        monkeypatch.setattr(boosting, name, value)
    models, held = boosting.fit_many(table, fits)
    assert all(np.allclose(m.raw(x), w) for m, w in zip(models, want))
    assert held.where("fold = 3").count() == 80 and held.count() == 160
    assert len(stored) == 1 + 5 // (keep * write)  # rows and scores were written every second round
    assert max(stored) <= spark.sparkContext.defaultParallelism  # there was a task for every 10 rows


def test_features_counted_together_equal_features_counted_alone(spark):
    rng, sizes = np.random.default_rng(8), [32, 2, 2, 1, 31, 2, 17, 200]
    cells = boosting.Cells([np.arange(s - 1) for s in sizes])
    assert sorted(j for g in cells.joint for j in g) == list(range(len(sizes))) and len(cells.joint) < len(sizes)
    bins = np.stack([rng.integers(0, s, 500) for s in sizes]).astype(np.uint8).T
    at, x = rng.integers(0, 3, 500), rng.normal(size=500)
    got = cells.each(boosting._sums(cells.indexes(bins), at, [x, x * x, None], 3, cells))
    for j, (start, size) in enumerate(zip(cells.starts, cells.sizes)):
        for part, w in enumerate((x, x * x, np.ones(500))):
            want = [np.bincount(bins[at == n, j], w[at == n], size) for n in range(3)]
            assert np.allclose(got[:, part, start:start + size], want)


def test_several_tasks_grow_more_than_one_tree(spark, monkeypatch):
    x, y = data(400, 6)
    monkeypatch.setattr(boosting, "TASK_ROWS", 40)
    monkeypatch.setattr(boosting, "PIECE_ROWS", 16)
    model = Boost(rounds=3, leaves=6, min_rows=5).fit(frame(spark, x, y, 6))
    assert len(model.trees) == 3


@pytest.mark.parametrize("sorted_at_once, whole, off", [(65_536, 16_384, 0), (300, 100, 4)])
def test_cuts_are_quantiles_from_few_points_of_each_task(spark, monkeypatch, sorted_at_once, whole, off):
    for name, value in (("SORTED", sorted_at_once), ("WHOLE", whole), ("POINTS", 64)):
        monkeypatch.setattr(boosting, name, value)
    x, y = np.random.default_rng(9).normal(size=(3000, 3)), np.zeros(3000)
    x[:, 1] = np.round(x[:, 1])
    x[:, 2] = 7.0
    values, rows = boosting.points(np.sort(x[:, 0]))
    assert len(values) == (3000 if whole > 3000 else 64) and rows.sum() == 3000
    got = boosting.bin_features(frame(spark, x, y))
    want = np.sort(x[:, 0])[[-(-k * 3000 // 32) - 1 for k in range(1, 32)]]
    ranks = np.searchsorted(np.sort(x[:, 0]), [got[0], want])
    assert len(got[0]) == 31 and np.abs(ranks[0] - ranks[1]).max() <= off * 10  # ten parts of 300 rows, half a stretch in each
    assert set(got[1]) <= set(x[:, 1]) and got[2].tolist() == [7.0]
    assert boosting.bin_features(frame(spark, x, y).where("label > 5")) == []


def test_rows_are_found_node_by_node_without_the_other_branches(spark):
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 9, (400, 3)).astype(np.uint8)
    tree = boosting.Tree()
    for node, feature, cut in ((0, 1, 4), (1, 0, 2), (2, 2, 6), (6, 1, 7)):
        left = tree.split(node, feature, cut, 1.0)
        tree.value[left], tree.value[left + 1] = float(left), left + 1.0
    at, some = tree.nodes(bins), np.flatnonzero(rng.random(400) < 0.7)
    found = tree.rows_at(bins.T, some)
    assert sorted(found) == [n for n, f in enumerate(tree.feature) if f < 0]
    assert all(np.array_equal(rows, some[at[some] == n]) for n, rows in found.items())

    class Columns(dict):  # only the tests on the way are read
        def __missing__(self, j):
            self[j] = bins.T[j]
            return self[j]

    read = Columns()
    assert list(tree.rows_at(read, some, [3])) == [3] and sorted(read) == [0, 1]
    assert np.array_equal(boosting._scores(bins, np.zeros((1, 400)), [[tree]])[0], np.array(tree.value)[at])
