"""Gradient-boosted trees for two classes, many fits in one scan.

Features are binned once into bytes and stored as blocks: one row holds up to ``BLOCK_ROWS`` rows of the table, feature by feature. All fits of a comparison or a search (model, fold, grid point) then grow their trees side by side: a pass over
the binned table adds gradients and hessians per (fit, node, feature, bin) in every task, the partial sums meet by (fit, node) or, if few, in the
driver, which sees sums only and picks splits. The number of jobs depends on rounds and depth, not on the number of fits.

Leaves hold Newton steps with an l2 term. Trees grow best first: the leaf of the greatest gain is split until ``leaves`` is reached. A pass asks for
all nodes that the queue may reach, so the queue's order is exact and a tree takes as many passes as it is deep. Only the smaller child of a
split is counted; its sibling is the parent less that child. With ``patience`` a tenth of the training rows is held back, and a fit ends when
their loss has not fallen for that many rounds.

Blocks are kept in memory as an RDD: a pass is one small job, and without planning a query each time it costs half as much. Barrier tasks that
exchange sums among themselves are no way out: each of their exchanges takes a second. Scores of rows are kept in memory every ``KEEP`` rounds, by the
pass that asks for the next root, and written every ``WRITE`` of these; in between a pass adds the few trees since then. There are about as many tasks as
cores, whatever the rows, so partial sums do not grow with the table. Features are counted together while their bins make up to ``JOINT`` cells.
"""

from __future__ import annotations

import gc
import heapq
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.session import materialize

BINS = 32
SORTED = 65_536  # rows that a task sorts at a time for the quantiles of the features
WHOLE = 16_384
POINTS = 4_096
TASK_ROWS = 6_000  # rows of a task at least, so that small tables are not ruled by task overhead
MOST_ROWS = 4_000_000  # rows of a task at most, where the cores would ask for more
BLOCK_ROWS = 32_768
PIECE_ROWS = 512  # rows of a block before blocks are dealt to the tasks
KEEP = 1
WRITE = 24
DIRECT = 1 << 25  # bytes of partial sums that go to the driver without meeting in tasks first
JOINT = 1024
SMALLEST_HESSIAN = 1e-3
HELD_BACK = 0.1


@dataclass(frozen=True)
class Boost:
    """A candidate. ``weight`` names a column of the training table, or is empty."""

    rounds: int = 100
    step: float = 0.1
    leaves: int = 31
    depth: int = 6
    l2: float = 0.0
    min_rows: int = 20
    weight: str = ""
    patience: int = 0

    def fit(self, table: DataFrame) -> Boosted:
        return fit_many(table, [Fit("model", None, self)])[0][0]

    def base(self, mean: float) -> float:
        """The score before the first tree, from the mean label."""
        share = min(max(mean, 1e-6), 1 - 1e-6)
        return float(np.log(share / (1.0 - share)))

    def slopes(self, score: np.ndarray, label: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
        """Gradient and hessian of the loss of each row."""
        p = 1.0 / (1.0 + np.exp(-score))
        return [w * (p - label), w * p * (1.0 - p)]


@dataclass(frozen=True)
class Fit:
    """One model to grow; rows of ``fold`` are left out."""

    name: str
    fold: int | None
    spec: Boost


@dataclass
class Tree:
    """Nodes as parallel lists; a leaf has feature -1, the right child follows the left one."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def nodes(self, bins: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """The leaf of each row of bins; ``at`` has the nodes where the rows were when the tree was smaller, and is moved on."""
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        at = np.zeros(len(bins), np.int64) if at is None else at
        rows = np.flatnonzero(feature[at] >= 0)
        while len(rows):
            here = at[rows]
            here = left[here] + (bins[rows, feature[here]] > cut[here])
            at[rows] = here
            rows = rows[feature[here] >= 0]
        return at

    def rows_at(self, columns: np.ndarray, rows: np.ndarray, wanted: Sequence[int] | None = None) -> dict[int, np.ndarray]:
        """Those of ``rows`` at each of the ``wanted`` nodes (at each leaf if none are named), in their order. ``columns`` are the bins by
        feature: node by node, one column is read at a time."""
        ends = {n for n, f in enumerate(self.feature) if f < 0} if wanted is None else set(wanted)
        leads = [n in ends for n in range(len(self.feature))]
        for n in range(len(leads) - 1, -1, -1):  # children follow their parents
            leads[n] = leads[n] or self.feature[n] >= 0 and (leads[self.left[n]] or leads[self.left[n] + 1])
        found, todo = {}, [(0, rows)]
        while todo:
            node, rows = todo.pop()
            if node in ends:
                found[node] = rows
            elif leads[node]:
                left, low = self.left[node], columns[self.feature[node]].take(rows) <= self.cut[node]
                if leads[left]:
                    todo.append((left, rows[low]))
                if leads[left + 1]:
                    todo.append((left + 1, rows[~low]))
        return found

    def split(self, node: int, feature: int, cut: int, gain: float) -> int:
        left = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, left, gain
        for column, empty in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.value, 0.0), (self.gain, 0.0)):
            column.extend([empty, empty])
        return left


def points(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of sorted ``x`` with their numbers of rows: all of them up to ``WHOLE`` rows, else the middles of ``POINTS`` stretches, so a rank
    is off by half a stretch at most."""
    if len(x) > WHOLE:
        ends = np.linspace(0, len(x), POINTS + 1).astype(np.int64)
        x, rows = x[(ends[:-1] + ends[1:]) // 2], np.diff(ends)
    else:
        rows = np.ones(len(x), np.int64)
    first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    return x[first], np.add.reduceat(rows, first)


def bin_features(table: DataFrame) -> list[np.ndarray]:
    """Cuts of each feature at its quantiles; a value lies in the first bin whose cut is not below it. Tasks sort ``SORTED`` rows at a time and
    send points of them, so no value moves by itself; ranks are exact up to ``WHOLE`` rows a task and to 1 in 8,192 of all rows at worst."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def sent() -> pa.RecordBatch:
            got = [points(x) for x in np.sort(np.concatenate(held).T, axis=1)]
            return pa.RecordBatch.from_arrays([pa.array(range(len(got)), pa.int32()), pa.array([v for v, _ in got], pa.list_(pa.float64())), pa.array([n for _, n in got], pa.list_(pa.int64()))], names=["j", "x", "n"])

        for b in batches:
            if b.num_rows:
                held.append(b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1))
            if sum(map(len, held)) >= SORTED:
                yield sent()
                held.clear()
        if held:
            yield sent()

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        x, n = np.concatenate(pdf["x"].to_list()), np.concatenate(pdf["n"].to_list())
        order = np.argsort(x, kind="stable")
        upto = np.cumsum(n[order])
        ranks = [-(-k * int(upto[-1]) // BINS) for k in range(1, BINS)]
        return pd.DataFrame({"j": pdf["j"].iloc[:1], "q": [x[order][np.searchsorted(upto, ranks)]]})

    each = table.select(vector_to_array("features").alias("x")).mapInArrow(summed, "j int, x array<double>, n array<long>")
    rows = each.groupBy("j").applyInPandas(cut, "j int, q array<double>").collect()  # one row per feature
    return [np.unique(np.array(r["q"], dtype=np.float64)) for r in sorted(rows, key=lambda r: r["j"])]


def to_bins(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1).astype(np.uint8) if len(cuts) else np.zeros((len(x), 0), np.uint8)


@dataclass
class Boosted:
    """A fitted model; ``transform`` adds the class probabilities to rows with a features vector."""

    cuts: list[np.ndarray]
    base: float
    trees: list[Tree]

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - named as in other tree models
        total = np.zeros(len(self.cuts))
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    total[f] += g
        return Vectors.dense((total / total.sum() if total.sum() else total).tolist())

    def raw(self, x: np.ndarray) -> np.ndarray:
        bins, score = to_bins(x, self.cuts), np.full(len(x), self.base)
        for t in self.trees:
            score += np.array(t.value)[t.nodes(bins)]
        return score

    def transform(self, df: DataFrame) -> DataFrame:
        @F.pandas_udf("double")
        def positive(x: pd.Series) -> pd.Series:
            return pd.Series(1.0 / (1.0 + np.exp(-self.raw(np.stack(x.to_list()))))) if len(x) else pd.Series([], dtype="float64")

        p = positive(vector_to_array("features"))
        return df.withColumn("_p", p).withColumn("probability", array_to_vector(F.array(1.0 - F.col("_p"), F.col("_p")))).drop("_p")

    def dumps(self) -> str:
        return json.dumps({"cuts": [c.tolist() for c in self.cuts], "base": self.base, "trees": [asdict(t) for t in self.trees]})

    @classmethod
    def loads(cls, text: str) -> Boosted:
        got = json.loads(text)
        return cls([np.array(c) for c in got["cuts"]], got["base"], [Tree(**t) for t in got["trees"]])


def _margins(x: np.ndarray, shape: tuple[int, ...]) -> list[np.ndarray]:
    """The sums by each feature, of sums (3 x node x joint cell) by all features of a group."""
    if len(shape) == 1:
        return [x]
    half = len(shape) // 2
    x = x.reshape(*x.shape[:2], int(np.prod(shape[:half])), -1)
    return [*_margins(x.sum(axis=3), shape[:half]), *_margins(x.sum(axis=2), shape[half:])]


class Cells:
    """Places of the bins of all features in one row of sums."""

    def __init__(self, cuts: Sequence[np.ndarray]) -> None:
        self.sizes = np.array([len(c) + 1 for c in cuts], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.total = int(self.sizes.sum())
        self.pad = np.minimum(np.arange(int(self.sizes.max(initial=1)))[None, :], self.sizes[:, None] - 1) + self.starts[:, None]
        self.real = np.arange(int(self.sizes.max(initial=1)))[None, :] < self.sizes[:, None]
        self.joint: list[list[int]] = []  # features that are counted together
        for j in np.argsort(self.sizes, kind="stable").tolist():
            if not self.joint or int(self.sizes[[*self.joint[-1], j]].prod()) > JOINT:
                self.joint.append([])
            self.joint[-1].append(j)
        self.shapes = [tuple(self.sizes[g].tolist()) for g in self.joint]
        self.spans = [int(np.prod(shape)) for shape in self.shapes]

    def indexes(self, bins: np.ndarray) -> list[np.ndarray]:
        """The joint cell of each row of bins, by group of features."""
        out = []
        for group, shape, span in zip(self.joint, self.shapes, self.spans):
            index = bins[:, group[0]].astype(np.uint16 if span <= 1 << 16 else np.int64)
            for j, size in zip(group[1:], shape[1:]):
                index *= size
                index += bins[:, j]
            out.append(index)
        return out

    def each(self, joint: list[np.ndarray]) -> np.ndarray:
        """node x 3 x bins of all features, from sums (3 x node x joint cell) by group."""
        parts, nodes = joint[0].shape[:2] if joint else (3, 1)
        out = np.empty((nodes, parts, self.total))
        for x, group, shape in zip(joint, self.joint, self.shapes):
            for j, by in zip(group, _margins(x, shape)):
                out[:, :, self.starts[j]:self.starts[j] + by.shape[2]] = by.transpose(1, 0, 2)
        return out

    def table(self, sums: np.ndarray) -> np.ndarray:
        """3 x feature x bin, features with fewer bins filled with zeros."""
        return np.where(self.real[None], sums.reshape(3, self.total)[:, self.pad], 0.0)


def best_split(hist: np.ndarray, spec: Boost) -> tuple[float, int, int]:
    """(gain, feature, cut) of sums (gradient, hessian, rows) x feature x bin; gain 0 where nothing may be split. Ties go to the first."""
    total = hist[:, 0].sum(axis=1)
    low = np.cumsum(hist, axis=2)
    high = total[:, None, None] - low
    good = (low[2] >= spec.min_rows) & (high[2] >= spec.min_rows) & (low[1] >= SMALLEST_HESSIAN) & (high[1] >= SMALLEST_HESSIAN)
    score = lambda s: s[0] ** 2 / np.maximum(s[1] + spec.l2, 1e-300)
    gain = np.where(good, score(low) + score(high) - score(total), 0.0)
    at = int(np.argmax(gain))
    return float(gain.flat[at]), at // hist.shape[2], at % hist.shape[2]


class Growing:
    """A fit while its trees grow."""

    def __init__(self, fit: Fit, base: float) -> None:
        self.fit, self.base, self.trees, self.losses, self.done = fit, base, [], [], False
        self.start()

    def start(self) -> None:
        self.tree, self.hist, self.split = Tree(), {}, {}
        self.level = {0: 0}
        self.children: dict[int, int] = {}

    def learn(self, node: int, hist: np.ndarray) -> None:
        self.hist[node] = hist
        self.split[node] = best_split(hist, self.fit.spec) if self.level[node] < self.fit.spec.depth else (0.0, 0, 0)

    def queue(self) -> list[int]:
        """Nodes in the order in which they are split, as far as is known."""
        order, heap = [], [(-self.split[0][0], 0)]
        while heap and len(order) < self.fit.spec.leaves - 1:
            gain, node = heapq.heappop(heap)
            if gain >= -1e-12:
                break
            order.append(node)
            for child in self._pair(node):
                if child in self.split:
                    heapq.heappush(heap, (-self.split[child][0], child))
        return order

    def _pair(self, node: int) -> tuple[int, ...]:
        return (self.children[node], self.children[node] + 1) if node in self.children else ()

    def wanted(self) -> list[tuple[int, int]]:
        """(parent, child to count) of the next pass; none when the tree is known."""
        if 0 not in self.split:
            return [(-1, 0)]
        out = []
        for node in self.queue()[:self.fit.spec.leaves - 2]:  # the children of the last split are leaves
            if node not in self.children:
                self._open(node)
            child = self.children[node]
            if child not in self.split and self.level[child] < self.fit.spec.depth:
                _, feature, cut = self.split[node]
                low = self.hist[node][2, feature, :cut + 1].sum()
                out.append((node, child if 2 * low <= self.hist[node][2, feature].sum() else child + 1))
        return out

    def _open(self, node: int) -> None:
        gain, feature, cut = self.split[node]
        self.children[node] = left = self.tree.split(node, feature, cut, gain)
        self.level[left] = self.level[left + 1] = self.level[node] + 1

    def counted(self, parent: int, child: int, hist: np.ndarray) -> None:
        self.learn(child, hist)
        if parent >= 0:
            other = 2 * self.children[parent] + 1 - child
            self.learn(other, self.hist[parent] - hist)

    def finish(self) -> None:
        """The tree of the queue's splits, its leaves with their steps."""
        final, place = Tree(), {0: 0}
        spec, order = self.fit.spec, self.queue()
        sums = {0: self.hist[0][:, 0].sum(axis=1)}
        for node in order:
            gain, feature, cut = self.split[node]
            if node not in self.children:
                self._open(node)
            left = final.split(place[node], feature, cut, gain)
            low = self.hist[node][:, feature, :cut + 1].sum(axis=1)
            for child, at, s in ((self.children[node], left, low), (self.children[node] + 1, left + 1, sums[node] - low)):
                place[child], sums[child] = at, s
        for node, at in place.items():
            final.value[at] = -spec.step * sums[node][0] / max(sums[node][1] + spec.l2, 1e-300)
        self.trees.append(final)
        if len(self.trees) >= spec.rounds:
            self.done = True
        self.start()


def _scores(bins: np.ndarray, stored: np.ndarray, since: list[list[Tree]]) -> np.ndarray:
    """Scores (fit x row) with the trees ``since`` the stored ones."""
    stored, every = stored.copy(), np.arange(len(bins))
    for k, trees in enumerate(since):
        for t in trees:
            for leaf, rows in t.rows_at(bins.T, every).items():
                stored[k, rows] += t.value[leaf]
    return stored


_KINDS = {"fold": np.int32, "late": np.bool_}  # of the columns of a block; labels, weights and scores are doubles


@dataclass
class Block:
    """Rows of the table side by side: ``bins`` row x feature (stored by feature), ``scores`` fit x row, the other columns by name."""

    bins: np.ndarray
    scores: np.ndarray
    columns: dict[str, np.ndarray]

    @classmethod
    def read(cls, batches: Iterator[pa.RecordBatch], names: Sequence[str], width: int, fits: int) -> Iterator[Block]:
        for b in batches:
            cells = [b.column(c) for c in (*names, "bins", "scores")]
            for i in range(b.num_rows):
                yield cls.of([v[i].as_buffer() for v in cells], names, width, fits)

    @classmethod
    def of(cls, cells: Sequence[bytes], names: Sequence[str], width: int, fits: int) -> Block:
        """A block from a stored row: the columns ``names``, bins and scores."""
        raw = {c: np.frombuffer(v, _KINDS.get(c, np.uint8 if c == "bins" else np.float64)) for c, v in zip((*names, "bins", "scores"), cells)}
        n = len(raw["fold"])
        return cls(raw.pop("bins").reshape(width, n).T, raw.pop("scores").reshape(fits, n), raw)

    def row(self) -> tuple[bytes, ...]:
        return tuple(np.ascontiguousarray(v).tobytes() for v in (*self.columns.values(), self.bins.T, self.scores))

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in self.row()], names=[*self.columns, "bins", "scores"])

    @classmethod
    def join(cls, blocks: Sequence[Block]) -> Block:
        return cls(np.concatenate([b.bins.T for b in blocks], axis=1).T, np.concatenate([b.scores for b in blocks], axis=1),
                   {c: np.concatenate([b.columns[c] for b in blocks]) for c in blocks[0].columns})


def _sums(indexes: Sequence[np.ndarray], at: np.ndarray, parts: Sequence[np.ndarray | None], nodes: int, cells: Cells) -> list[np.ndarray]:
    """By group of features, 3 x node x joint cell: sums of ``parts`` (None counts) over rows at their nodes."""
    out = []
    for index, span in zip(indexes, cells.spans):
        index = at * span + index
        out.append(np.stack([np.bincount(index, x, nodes * span).reshape(nodes, span) for x in parts]))
    return out


@dataclass
class Asked:
    """What a pass counts: the wanted nodes, the trees so far and the settings by fit."""

    nodes: dict[int, list[int]]
    trees: dict[int, Tree]
    specs: dict[int, tuple[int | None, Boost]]
    first: bool  # on the first pass of a round the losses of held-back rows are summed too, as node -1

    @classmethod
    def of(cls, growing: list[Growing], first: bool) -> Asked:
        wanted = {k: [c for _, c in g.wanted()] for k, g in enumerate(growing) if not g.done}
        wanted = {k: v for k, v in wanted.items() if v}
        return cls(wanted, {k: growing[k].tree for k in wanted}, {k: (growing[k].fit.fold, growing[k].fit.spec) for k in wanted}, first)

    def count(self, blocks: Iterator[Block], since: list[list[Tree]], cells: Cells) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        """The sums (3 x bins of all features) of the rows of blocks, by (fit, node)."""
        losses: dict[int, np.ndarray] = {}
        sums: dict[int, list[np.ndarray]] = {}
        for b in blocks:
            fold, label, late = (b.columns[c] for c in ("fold", "label", "late"))
            score, indexes = _scores(b.bins, b.scores, since), cells.indexes(b.bins)
            for k, nodes in self.nodes.items():
                out, spec = self.specs[k]
                use = np.ones(len(fold), bool) if out is None else fold != out
                w = b.columns[spec.weight] if spec.weight else np.ones(len(fold))
                if spec.patience and self.first:
                    held = use & late
                    z = np.where(label[held] == 1, -score[k, held], score[k, held])
                    losses[k] = losses.get(k, 0.0) + np.array([np.sum(w[held] * np.logaddexp(0.0, z)), w[held].sum()])
                if spec.patience:
                    use &= ~late
                there = self.trees[k].rows_at(b.bins.T, np.flatnonzero(use), nodes)
                rows = np.concatenate([there[n] for n in nodes])
                at = np.repeat(np.arange(len(nodes)), [len(there[n]) for n in nodes])
                parts = [*spec.slopes(score[k, rows], label[rows], w[rows]), None]
                got = _sums(indexes if len(nodes) == 1 and len(rows) == len(fold) else [x.take(rows) for x in indexes], at, parts, len(nodes), cells)
                sums[k] = [x + y for x, y in zip(sums[k], got)] if k in sums else got
        for k, loss in losses.items():
            yield (k, -1), loss
        for k, joint in sums.items():
            for node, x in zip(self.nodes[k], cells.each(joint)):
                yield (k, node), x


def _pass(state: RDD, growing: list[Growing], since: list[list[Tree]], cells: Cells, first: bool) -> dict[tuple[int, int], np.ndarray]:
    """The sums of every wanted (fit, node)."""
    asked = Asked.of(growing, first)
    if not asked.nodes:
        return {}

    def count(blocks: Iterator[Block]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        gc.freeze()  # what is loaded stays: the collection after a task, before the next may begin, need not look at it
        return asked.count(blocks, since, cells)

    rows, tasks = state.mapPartitions(count), state.getNumPartitions()
    if tasks * sum(map(len, asked.nodes.values())) * cells.total * 24 > DIRECT:
        rows = rows.reduceByKey(np.add, min(tasks, len(growing)))
    got: dict[tuple[int, int], np.ndarray] = {}
    for key, x in rows.collect():  # bounded by fits, leaves and cores, whatever the rows
        got[key] = got[key] + x if key in got else x
    return got


def _round(growing: list[Growing], cells: Cells, sums: Callable[[bool], dict[tuple[int, int], np.ndarray]]) -> dict[int, Tree]:
    """One more tree for each fit that is not done, by fit. ``sums`` gives those of a pass; its argument tells the first pass of a round."""
    first = True
    while got := sums(first):
        first = False
        for k, g in enumerate(growing):
            if g.done:
                continue
            if (k, -1) in got:
                loss, weight = got[k, -1]
                g.losses.append(loss / max(weight, 1e-300))
                n = g.fit.spec.patience
                if len(g.losses) > n and min(g.losses[-n:]) > min(g.losses[:-n]) - 1e-7:
                    g.done = True
                    continue
            for parent, child in g.wanted():
                if (k, child) in got:
                    g.counted(parent, child, cells.table(got[k, child]))
    new = {}
    for k, g in enumerate(growing):
        if not g.done:
            if 0 not in g.split:  # no row to learn from
                g.done = True
                continue
            g.finish()
            new[k] = g.trees[-1]
    return new


def _by_passes(stored: DataFrame, names: Sequence[str], growing: list[Growing], cells: Cells) -> tuple[DataFrame, list[list[Tree]]]:
    """All rounds; the blocks, and the trees since their scores."""
    since: list[list[Tree]] = [[] for _ in growing]
    width, fits = len(cells.sizes), len(growing)

    def blocks(df: DataFrame) -> RDD:
        return df.select(*names, "bins", "scores").rdd.map(lambda r: Block.of(r, names, width, fits))

    def frame(state: RDD) -> DataFrame:
        return stored.sparkSession.createDataFrame(state.map(Block.row), stored.schema, verifySchema=False)

    def added(state: RDD) -> RDD:
        new_trees = since  # of this moment
        return state.map(lambda b: Block(b.bins, _scores(b.bins, b.scores, new_trees), b.columns))

    state = blocks(stored).persist(StorageLevel.MEMORY_AND_DISK)
    done, old = 0, None
    while not all(g.done for g in growing):
        new_trees = _round(growing, cells, lambda first: _pass(state, growing, since, cells, first))
        if old is not None:  # the passes have filled the new scores
            old = old.unpersist() and None
        for k, tree in new_trees.items():
            since[k].append(tree)
        done += 1
        if done % KEEP == 0:
            new = added(state)
            if done % (KEEP * WRITE) == 0:  # a lost task starts from here
                new = blocks(materialize(frame(new), "boost-rows"))
            old, state = state, new.persist(StorageLevel.MEMORY_AND_DISK)  # kept in memory while it fits, made again where it is lost
            since = [[] for _ in growing]
    return frame(state), since


def fit_many(table: DataFrame, fits: Sequence[Fit], label: str = "label") -> tuple[list[Boosted], DataFrame]:
    """All ``fits`` on ``table`` (label, features, weight columns and, for fits with a fold, ``fold``); returns the models and the scores of left-out
    rows (Model, fold, label, score)."""
    cuts = bin_features(table)
    cells, width = Cells(cuts), len(cuts)
    weights = sorted({f.spec.weight for f in fits if f.spec.weight})
    names = ["fold", "label", "late", *weights]
    fold = F.col("fold").cast("int") if "fold" in table.columns else F.lit(0)
    late = F.pmod(F.xxhash64("features", label), F.lit(1000)) < int(HELD_BACK * 1000)
    rows = table.select(fold.alias("fold"), F.col(label).cast("double").alias("label"), late.alias("late"), *weights, vector_to_array("features").alias("x"))
    per = rows.groupBy("fold").agg(*[F.sum(w).alias(f"all_{w}") for w in weights], *[F.sum(F.col("label") * F.col(w)).alias(f"pos_{w}") for w in weights],
                                   F.count(F.lit(1)).alias("all_"), F.sum("label").alias("pos_")).collect()  # one row per fold

    def base(f: Fit) -> float:
        seen = [r for r in per if f.fold is None or r["fold"] != f.fold]
        pos, every = sum(r[f"pos_{f.spec.weight}"] for r in seen), sum(r[f"all_{f.spec.weight}"] for r in seen)
        return f.spec.base(pos / every if every else 0.5)

    growing = [Growing(f, base(f)) for f in fits]
    start = np.array([g.base for g in growing])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width)
            bins = to_bins(x, cuts)
            columns = {c: b.column(c).to_numpy(zero_copy_only=False).astype(_KINDS.get(c, np.float64)) for c in names}
            for i in range(0, b.num_rows, PIECE_ROWS):
                some = slice(i, i + PIECE_ROWS)
                yield Block(bins[some], start[:, None] + np.zeros(len(bins[some])), {c: v[some] for c, v in columns.items()}).batch()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Block] = []
        for b in Block.read(batches, names, width, len(fits)):
            held.append(b)
            if sum(len(h.bins) for h in held) > BLOCK_ROWS - PIECE_ROWS:
                yield Block.join(held).batch()
                held = []
        if held:
            yield Block.join(held).batch()

    schema = ", ".join(f"{c} binary" for c in (*names, "bins", "scores"))
    every = sum(r["all_"] for r in per)
    tasks = max(1, every // MOST_ROWS, min(every // TASK_ROWS, table.sparkSession.sparkContext.defaultParallelism))
    state = materialize(rows.mapInArrow(binned, schema).repartition(tasks).mapInArrow(joined, schema), "boost-rows")
    state, since = _by_passes(state, names, growing, cells)
    models = [Boosted(cuts, g.base, g.trees) for g in growing]
    called, folds = [f.name for f in fits], [f.fold for f in fits]

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in Block.read(batches, names, width, len(fits)):
            score = 1.0 / (1.0 + np.exp(-_scores(b.bins, b.scores, since)))
            fold, label = b.columns["fold"], b.columns["label"].astype(np.int32)
            for k, f in enumerate(folds):
                rows = np.flatnonzero(fold == f) if f is not None else []
                if len(rows):
                    yield pa.RecordBatch.from_arrays([pa.array([called[k]] * len(rows)), pa.array(fold[rows]), pa.array(label[rows]), pa.array(score[k, rows])], names=["Model", "fold", "label", "score"])

    return models, state.mapInArrow(left_out, "Model string, fold int, label int, score double")


def save(model: Boosted, path: str) -> None:
    SparkSession.active().createDataFrame([(model.dumps(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load(spark: SparkSession, path: str) -> Boosted:
    return Boosted.loads(spark.read.text(path, wholetext=True).first()["value"])


def grid(spec: Boost, **values: Sequence) -> list[Boost]:
    """All combinations of the given settings."""
    out = [spec]
    for name, options in values.items():
        out = [replace(s, **{name: v}) for s in out for v in options]
    return out
