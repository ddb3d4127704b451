"""Boosted regression trees of many training sets in shared passes (survey M7–M9).

MLlib fits one boosted model at a time, with a pass over the rows for every level of every tree. Here one pass serves
that level of the trees of all jobs (training set, rate, depth), so a search takes as many passes as one model does.
The trees are those of MLlib's ``GBTRegressor`` with squared error on all rows and features: the same candidate
thresholds (from a sample of the same size), the same gain, categories in order of their mean, the first of equal splits.

Every row is coded once: a number by its place among the thresholds of all training sets, a category by its level. What
a code means in a training set (its bin after that set's imputation and encoding) is a small table. Features with few codes
share one joint code, which holds them all, so a row keeps fewer codes and a task adds up fewer sums; those of each feature
are read off the joint ones. Rows are kept as blocks of joint codes with the predictions of all jobs. A pass counts rows and
adds residuals up by (job, node, bin); the sums are added up by job in a shuffle, where the best splits are found, so the
driver gets the splits and, up to ``KEPT_CELLS``, the sums of the nodes that it splits: of two children only the one with
fewer rows is added up, the other is the parent less that one. The counts of a root are those of the first tree's.

A table of few cells (``LOCAL_CELLS``) is coded, gathered and sent to the executors once, and every job grows its trees in a task
of its own: the same trees from the same sums, without a pass a level. Thousands of rounds on small tables are mostly passes' overhead.
"""

from __future__ import annotations

import json
import math
import pickle
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from .transformers import _StateModel

#: Rows of a block.
BLOCK = 65_536
#: Joint codes of several features at most.
JOINT_CODES = 1024
#: Cells (job, node, code) whose sums a task holds at once; more go to passes of their own.
PASS_CELLS = 16_000_000
#: Cells (job, node, bin) of a level whose sums are kept for the next one; of more, both children are added up.
KEPT_CELLS = 4_000_000
#: Jobs whose predictions are kept beside a row at once.
JOBS_AT_ONCE = 24
#: Cells (rows × features) of a table that every task may hold whole.
LOCAL_CELLS = 8_000_000
#: Cells (rows × features) that a task adds up in one go.
SUM_CELLS = 262_144
#: Rounds after which the rows' lineage is cut, as MLlib's checkpoint interval does.
CHECKPOINT_ROUNDS = 10


@dataclass(frozen=True)
class Job:
    """A model to fit: on the rows outside ``fold`` (None: on all), scored on those inside."""

    fold: int | None
    rate: float
    depth: int
    rounds: int


@dataclass
class Slot:
    """A feature as a training set sees it: bin of every code in training rows and in others; ``thresholds`` between the
    bins, or None for categories without an order."""

    bins: np.ndarray
    held: np.ndarray
    thresholds: np.ndarray | None
    n: int


@dataclass
class Coding:
    """How rows are coded: edges of the numeric columns, levels of the categorical ones. With ``parts`` a category's code
    also tells the row's part (the column ``__te_fold``)."""

    edges: dict[str, np.ndarray]
    levels: dict[str, list[str]]
    parts: int = 1

    @property
    def sizes(self) -> list[int]:
        return [len(e) + 2 for e in self.edges.values()] + [(len(v) + 1) * self.parts for v in self.levels.values()]

    @property
    def groups(self) -> list[list[int]]:
        """Features that share a joint code: the largest first, each where it fits, up to ``JOINT_CODES`` codes."""
        found: list[tuple[int, list[int]]] = []
        for f in sorted(range(len(self.sizes)), key=lambda f: -self.sizes[f]):
            for i, (codes, own) in enumerate(found):
                if codes * self.sizes[f] <= JOINT_CODES:
                    found[i] = codes * self.sizes[f], [*own, f]
                    break
            else:
                found.append((self.sizes[f], [f]))
        return [own for _, own in found]

    def joint(self, batch) -> np.ndarray:
        """(groups × rows) joint codes of an Arrow batch: the last feature's code runs fastest."""
        codes, groups = self.codes(batch), self.groups
        most = max(math.prod(self.sizes[f] for f in g) for g in groups)
        out = np.empty((len(groups), batch.num_rows), np.uint16 if most < 2 ** 16 else np.uint32)
        for i, group in enumerate(groups):
            at = np.zeros(batch.num_rows, np.int64)
            for f in group:
                at = at * self.sizes[f] + codes[f]
            out[i] = at
        return out

    def codes(self, batch) -> np.ndarray:
        """(features × rows) codes of an Arrow batch; a null number and a null category have codes of their own."""
        out = np.empty((len(self.sizes), batch.num_rows), np.uint16 if max(self.sizes) < 2 ** 16 else np.uint32)
        for i, (c, edges) in enumerate(self.edges.items()):
            col = batch.column(c)
            x = col.to_numpy(zero_copy_only=False)
            out[i] = np.where(np.asarray(col.is_null()), len(edges) + 1, np.searchsorted(edges, x, "left"))
        for i, (c, levels) in enumerate(self.levels.items(), len(self.edges)):
            d, place = batch.column(c).dictionary_encode(), {v: k for k, v in enumerate(levels)}
            of = np.array([*(place[v] for v in d.dictionary.to_pylist()), len(levels)], np.int64)
            at = of[d.indices.fill_null(len(of) - 1).to_numpy(zero_copy_only=False)]
            out[i] = at if self.parts == 1 else at * self.parts + batch.column("__te_fold").to_numpy(zero_copy_only=False)
        return out


def thresholds_of(values: np.ndarray, expected: float, most: int) -> np.ndarray:
    """MLlib's candidate thresholds of a feature: midpoints of all distinct values, or of the ``most`` that part the rows
    most evenly. Zeros are not counted but make up what the other values lack of the ``expected`` rows, as there."""
    v, n = np.unique(values[values != 0.0], return_counts=True)
    if not len(v):
        return np.empty(0)
    n = n.astype(float)
    rest = expected - n.sum()
    if rest > 2.220446049250313e-16 * n.sum() * 100:
        at = np.searchsorted(v, 0.0)
        v, n = np.insert(v, at, 0.0), np.insert(n, at, rest)
    middles = (v[:-1] + v[1:]) / 2.0
    if len(middles) <= most:
        return middles
    stride, out = expected / (most + 1), []
    before, target = n[0], stride
    for i in range(1, len(v)):
        now = before + n[i]
        if abs(before - target) < abs(now - target):
            out.append(middles[i - 1])
            target += stride
        before = now
    return np.array(out)


@dataclass(frozen=True)
class Layout:
    """Where the features' codes stand in the joint ones."""

    sizes: list[int]
    groups: list[list[int]]

    @classmethod
    def of(cls, coding: Coding) -> Layout:
        return cls(coding.sizes, coding.groups)

    @property
    def joint_sizes(self) -> list[int]:
        return [math.prod(self.sizes[f] for f in g) for g in self.groups]

    def spread(self, feature: int, table: np.ndarray) -> tuple[int, np.ndarray]:
        """(group, table by joint code) of a table by the feature's code."""
        g = next(i for i, own in enumerate(self.groups) if feature in own)
        shape = [self.sizes[f] if f == feature else 1 for f in self.groups[g]]
        return g, np.broadcast_to(table.reshape(shape), [self.sizes[f] for f in self.groups[g]]).ravel()

    def by_feature(self, sums: list[np.ndarray]) -> list[np.ndarray]:
        """Sums by (…, code) of every feature from those by (…, joint code) of every group."""
        out: list = [None] * len(self.sizes)
        for group, v in zip(self.groups, sums):
            v = v.reshape(*v.shape[:-1], *[self.sizes[f] for f in group])
            first = v.ndim - len(group)
            for i, f in enumerate(group):
                out[f] = v.sum(axis=tuple(first + k for k in range(len(group)) if k != i))
        return out


# ---------------------------------------------------------------- rows

#: A block of rows: target, folds, joint codes (a row a group of features), predictions (a row a job). Tuples, lists and arrays only, so
#: that tasks read blocks without this module.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def outside(fold: np.ndarray, job: Job) -> np.ndarray:
    """Which rows a job is not fitted on."""
    return np.zeros(len(fold), bool) if job.fold is None else fold == job.fold


def _coding_columns(df: DataFrame, coding: Coding) -> DataFrame:
    return df.select(F.col("y").cast("double").alias("y"), F.col("fold").cast("int").alias("fold"),
                     *[F.col(c).cast("double").alias(c) for c in coding.edges], *[F.col(c).cast("string").alias(c) for c in coding.levels],
                     *(["__te_fold"] if coding.parts > 1 else []))


def row_blocks(df: DataFrame, coding: Coding, jobs: int):
    """The rows of ``df`` (y, fold, columns of the coding) as an RDD of blocks."""
    def make(batches):
        import pyarrow as pa

        def block(parts):
            y, fold, codes = ([p[i] for p in parts] for i in range(3))
            y = np.concatenate(y)
            made = y, np.concatenate(fold), np.concatenate(codes, axis=1), np.zeros((jobs, len(y)))
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(made, 5)], pa.binary())], ["block"])

        parts, n = [], 0
        for b in batches:
            parts.append((b.column("y").to_numpy(zero_copy_only=False), b.column("fold").to_numpy(zero_copy_only=False).astype(np.int16), coding.joint(b)))
            n += b.num_rows
            if n >= BLOCK:
                yield block(parts)
                parts, n = [], 0
        if n:
            yield block(parts)

    return _coding_columns(df, coding).mapInArrow(make, "block binary").rdd.map(lambda r: pickle.loads(r.block))


@dataclass
class Node:
    n: float
    value: float
    feature: int = -1
    rule: object = None  # last bin on the left, or the categories there
    left: int = -1
    right: int = -1


@dataclass
class Tree:
    """A tree as it grows; ``tables`` holds, per split, the child's place by code (training rows, other rows)."""

    nodes: list[Node] = field(default_factory=list)
    tables: list[tuple] = field(default_factory=list)
    open: list[int] = field(default_factory=lambda: [0])
    parents: np.ndarray | None = None  # sums of the split nodes, if the open ones are their children in pairs

    @property
    def counted(self) -> list[int]:
        """The open nodes that a pass adds up: all, or of two children the one with fewer rows."""
        if self.parents is None:
            return self.open
        return [min(pair, key=lambda at: self.nodes[at].n) for pair in zip(self.open[::2], self.open[1::2])]

    def all_sums(self, sums: np.ndarray) -> np.ndarray:
        """Sums of all open nodes from those of the counted ones."""
        if self.parents is None:
            return sums
        rest = self.parents - sums
        rest[1][rest[0] == 0] = 0.0  # no rows, no rounding
        left = np.array([at == pair for at, pair in zip(self.counted, self.open[::2])])[None, :, None]
        return np.stack([np.where(left, sums, rest), np.where(left, rest, sums)], axis=2).reshape(2, -1, sums.shape[2])

    def split(self, at: int, found: tuple, slots: list[Slot]) -> None:
        _, _, feature, rule, nl, sl, nr, sr = found
        slot, node = slots[feature], self.nodes[at]
        node.feature, node.rule, node.left, node.right = feature, rule, len(self.nodes), len(self.nodes) + 1
        self.nodes += [Node(nl, sl / nl), Node(nr, sr / nr)]

        def child(bins):
            goes = np.isin(bins, rule) if slot.thresholds is None else bins <= rule
            return np.where(goes, node.left, node.right).astype(np.int32)
        self.tables.append((at, feature, child(slot.bins), None if slot.held is slot.bins else child(slot.held)))

    def over(self, layout: Layout) -> list[tuple]:
        """The tables by joint code: (node, group, child of training rows, of other rows)."""
        return [(node, *layout.spread(feature, own), None if other is None else layout.spread(feature, other)[1])
                for node, feature, own, other in self.tables]


def places(tables: list[tuple], codes: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The node that every row has come to by a tree's tables."""
    at = np.zeros(len(held), np.int32)
    for node, group, own, other in tables:  # parents come first
        to = own[codes[group]]
        if other is not None:
            to = np.where(held, other[codes[group]], to)
        np.copyto(at, to, where=at == node)
    return at


def _sums(jobs: list[Job], slots: dict, layout: Layout, trees: dict[int, Tree], score: bool, counts: bool):
    """Function over a task's blocks: (job, [held-out squared error, held-out rows, sums by (count | residual, counted node, bin)]).
    Without ``counts`` (a root whose counts are known) those are left at 0."""
    def run(blocks):
        sizes = layout.joint_sizes
        errors = {j: np.zeros(2) for j in trees}
        counted = {j: t.counted for j, t in trees.items()}
        total = {j: [np.zeros((2, len(counted[j]) * size)) for size in sizes] for j, t in trees.items() if t.open}
        tables = {j: t.over(layout) for j, t in trees.items() if t.open}
        for y, fold, codes, predicted in blocks:
            for j, tree in trees.items():
                held, opened = outside(fold, jobs[j]), counted[j]
                residual = y - predicted[j]
                if score and jobs[j].fold is not None:
                    errors[j] += (residual[held] ** 2).sum(), held.sum()
                if not opened:
                    continue
                own = total[j]
                if not tree.nodes and not counts:  # a root: rows that take no part add nothing
                    residual[held] = 0.0
                    for g, size in enumerate(sizes):
                        own[g][1, :size] += np.bincount(codes[g], weights=residual, minlength=size)
                    continue
                if tree.nodes:  # the first tree is fitted to the target, the others to the loss's gradient
                    place = np.full(len(tree.nodes), -1, np.int64)
                    place[opened] = np.arange(len(opened))
                    node = place[places(tables[j], codes, held)]
                else:
                    node = np.zeros(len(y), np.int64)
                node[held] = -1
                rows = np.flatnonzero(node >= 0)  # those that take part
                node, residual = node[rows], residual[rows]
                bases = {size: node * size for size in set(sizes)}
                for g, size in enumerate(sizes):
                    cell = bases[size] + codes[g][rows]
                    own[g][0] += np.bincount(cell, minlength=own[g].shape[1])
                    own[g][1] += np.bincount(cell, weights=residual, minlength=own[g].shape[1])
        for j, tree in trees.items():
            binned = []
            joint = [sums.reshape(2, -1, size) for sums, size in zip(total.get(j, []), sizes)]
            for f, sums in enumerate(layout.by_feature(joint) if joint else []):
                bins, n, _ = slots[jobs[j].fold][f]
                to = np.zeros((layout.sizes[f], n))
                to[np.arange(layout.sizes[f]), bins] = 1.0
                binned.append(sums @ to)
            yield j, np.concatenate([errors[j], np.concatenate(binned, axis=2).ravel()]) if binned else errors[j]
    return run


def best_splits(sums: np.ndarray, slots: list[tuple]) -> list[tuple]:
    """``slots``: (_, bins, whether nominal) of every feature. By node: (rows, sum, feature or -1, rule, rows and sum on the left, rows and sum on the right) of the split that lowers the variance most."""
    best = [(-np.inf, None)] * sums.shape[1]
    at, whole = 0, None
    for f, (_, bins, nominal) in enumerate(slots):
        count, total = sums[:, :, at:at + bins]
        at += bins
        if whole is None:
            whole = count.sum(1), total.sum(1)
        if bins < 2:
            continue
        order = None
        if nominal:
            with np.errstate(invalid="ignore", divide="ignore"):
                order = np.argsort(np.where(count > 0, total / count, np.inf), axis=1, kind="stable")
            count, total = np.take_along_axis(count, order, 1), np.take_along_axis(total, order, 1)
        n, s = np.cumsum(count, 1), np.cumsum(total, 1)
        nl, sl, nr, sr = n[:, :-1], s[:, :-1], n[:, -1:] - n[:, :-1], s[:, -1:] - s[:, :-1]
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = (sl ** 2 / nl + sr ** 2 / nr - s[:, -1:] ** 2 / n[:, -1:]) / n[:, -1:]
        gain = np.where((nl < 1) | (nr < 1), -np.inf, gain)
        for i, k in enumerate(gain.argmax(1)):
            if gain[i, k] > max(best[i][0], 0.0):
                rule = int(k) if order is None else sorted(int(c) for c in order[i, :k + 1])
                best[i] = gain[i, k], (f, rule, nl[i, k], sl[i, k], nr[i, k], sr[i, k])
    return [(n, s, *(split or (-1, None, 0.0, 0.0, 0.0, 0.0))) for n, s, (_, split) in zip(*whole, best)]


def boost(df: DataFrame, coding: Coding, slots: dict, jobs: list[Job], partitions: int, keep_trees: bool = True) -> list[tuple[list[Tree], list[float]]]:
    """Per job its trees (none unless ``keep_trees``) and the mean squared error on the rows of its fold after every round.

    ``slots``: training set → its features as ``Slot``, in the order of the coding."""
    if len(jobs) > JOBS_AT_ONCE:
        return [r for i in range(0, len(jobs), JOBS_AT_ONCE) for r in boost(df, coding, slots, jobs[i:i + JOBS_AT_ONCE], partitions, keep_trees)]
    spark, context = df.sparkSession, df.sparkSession.sparkContext
    layout, seen = Layout.of(coding), context.broadcast({j: [(s.bins, s.n, s.thresholds is None) for s in own] for j, own in slots.items()})
    state = row_blocks(df.coalesce(partitions), coding, len(jobs)).persist(StorageLevel.MEMORY_AND_DISK)
    models: list[list[Tree]] = [[] for _ in jobs]
    curves: list[list[float]] = [[] for _ in jobs]
    roots: dict[int | None, np.ndarray] = {}  # rows by bin of every training set
    saved: list[str] = []  # the last checkpoint

    def pass_over(rows, t, trees, score=False, keep=False):
        found = {}
        known = context.broadcast(roots) if score and roots else None
        for part in _parts(trees, sum(layout.joint_sizes)):
            def splits(row, part=part):
                j, v = row
                if len(v) == 2:
                    return j, (v, [], None)
                sums = v[2:].reshape(2, len(part[j].counted), -1)
                if known is not None:
                    sums[0] = known.value[jobs[j].fold]
                sums = part[j].all_sums(sums)
                return j, (v[:2], best_splits(sums, seen.value[jobs[j].fold]), sums if keep or (score and known is None) else None)

            def run(blocks, part=part):
                return _sums(jobs, seen.value, layout, part, score, known is None)(blocks)
            parts = max(1, min(len(part), rows.getNumPartitions()))
            for j, (error, *of) in rows.mapPartitions(run).reduceByKey(np.add, parts).map(splits).collect():  # of the open nodes
                found[j] = error, *of
                if of[1] is not None and score and known is None:
                    roots[jobs[j].fold] = of[1][0]
        if known is not None:
            known.unpersist()
        if score:
            for j, ((error, n), *_) in found.items():
                if t:
                    curves[j].append(float(error / n) if n else np.nan)
        return found

    most = max(j.rounds for j in jobs)
    before = None
    try:
        for t in range(most + 1):
            trees = {j: Tree() for j, job in enumerate(jobs) if t < job.rounds}
            done = {j: Tree(open=[]) for j, job in enumerate(jobs) if t == job.rounds}  # scored only
            for level in range(max([jobs[j].depth for j in trees], default=1)):
                growing = {j: tree for j, tree in trees.items() if tree.open and level < jobs[j].depth}
                if level and not growing:
                    break
                cells = sum(2 * len(t.open) * sum(s.n for s in slots[jobs[j].fold]) for j, t in growing.items())
                keep = cells <= KEPT_CELLS and any(level + 1 < jobs[j].depth for j in growing)
                found_by_job = pass_over(state, t, growing | (done if level == 0 else {}), level == 0, keep)
                if before is not None:  # the pass has made the new state
                    before.unpersist()
                    before = None
                    if state.is_checkpointed and (path := state.getCheckpointFile()):
                        _forget(spark, saved)  # a full grid has hundreds of them
                        saved.append(path)
                for j, (_, splits, sums) in found_by_job.items():
                    if j not in growing:
                        continue
                    tree, opened = trees[j], trees[j].open
                    tree.open = []
                    for at, found in zip(opened, splits):
                        if not tree.nodes:
                            tree.nodes.append(Node(found[0], found[1] / found[0]))
                        if found[2] >= 0:
                            tree.split(at, found, slots[jobs[j].fold])
                            tree.open += [tree.nodes[at].left, tree.nodes[at].right]
                    split = [i for i, found in enumerate(splits) if found[2] >= 0]
                    tree.parents = sums[:, split] if keep and split else None
            if not trees:
                break
            for j, tree in trees.items():
                if t:  # MLlib fits the gradient of the squared error, twice the residual
                    for node in tree.nodes:
                        node.value *= 2.0
                tree.parents = None
                if keep_trees:
                    models[j].append(Tree(tree.nodes))  # without the tables

            def step(block: Block, trees=trees, first=t == 0) -> Block:
                y, fold, codes, predicted = block
                predicted = predicted.copy()
                for j, tree in trees.items():
                    values = np.array([n.value for n in tree.nodes])
                    predicted[j] += (1.0 if first else jobs[j].rate) * values[places(tree.over(layout), codes, outside(fold, jobs[j]))]
                return y, fold, codes, predicted
            moved = state.map(step, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
            before, state = state, RDD(moved._jrdd, context, moved._jrdd_deserializer)  # does not hold the rounds before, as ``moved`` does
            if t % CHECKPOINT_ROUNDS == CHECKPOINT_ROUNDS - 1 and t + 1 < most:
                state.checkpoint()
    finally:
        state.unpersist()
        seen.unpersist()
        _forget(spark, saved)
    return list(zip(models, curves))


def _forget(spark, paths: list[str]) -> None:
    """Deletes checkpoints that no table reads any more."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _parts(trees: dict[int, Tree], codes: int):
    """The jobs of a pass in groups whose sums fit ``PASS_CELLS``."""
    part, cells = {}, 0
    for j, tree in trees.items():
        own = (len(tree.open) + 1) * codes
        if part and cells + own > PASS_CELLS:
            yield part
            part, cells = {}, 0
        part[j] = tree
        cells += own
    if part:
        yield part


# ---------------------------------------------------------------- tables that a task holds whole

def coded_rows(df: DataFrame, coding: Coding) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(target, folds, features × rows codes) of the rows of ``df``, on the driver: for tables of at most ``LOCAL_CELLS`` cells."""
    def make(batches):
        import pyarrow as pa
        for b in batches:
            made = b.column("y").to_numpy(zero_copy_only=False), b.column("fold").to_numpy(zero_copy_only=False).astype(np.int16), coding.codes(b)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(made, 5)], pa.binary())], ["block"])

    parts = [pickle.loads(r.block) for r in _coding_columns(df, coding).mapInArrow(make, "block binary").collect()]
    if not parts:
        return np.empty(0), np.empty(0, np.int16), np.empty((len(coding.sizes), 0), np.uint16)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts], axis=1)


def _classes(slots: list[Slot]) -> list[tuple[bool, np.ndarray, np.ndarray]]:
    """Features of alike numbers of bins, numbers and categories apart: (nominal, features, their bins' places in a row of all
    features' bins, one after the last for those that a feature lacks)."""
    at = np.concatenate([[0], np.cumsum([s.n for s in slots])])
    found: dict[tuple, list[int]] = {}
    for f, s in enumerate(slots):
        if s.n >= 2:
            found.setdefault((s.thresholds is None, math.ceil(math.log2(s.n))), []).append(f)
    out = []
    for (nominal, _), own in found.items():
        widest = max(slots[f].n for f in own)
        out.append((nominal, np.array(own), np.array([[at[f] + b if b < slots[f].n else at[-1] for b in range(widest)] for f in own])))
    return out


def _splits_at_once(sums: np.ndarray, bins: int, classes: list) -> tuple:
    """What ``best_splits`` finds, of all nodes as arrays: (gain, feature, rule, rows and sum on the left, rows and sum in all). A rule is
    the last bin on the left, or the categories there in the order of their means and how many of them go left."""
    nodes = sums.shape[1]
    whole = sums[:, :, :bins].sum(2)
    sums = np.concatenate([sums, np.zeros((2, nodes, 1))], axis=2)
    features = sorted(int(f) for _, own, _ in classes for f in own)
    place = {f: i for i, f in enumerate(features)}
    gains, ends = np.full((nodes, max(len(features), 1)), -np.inf), np.zeros((nodes, max(len(features), 1)), np.int64)
    left = np.zeros((2, nodes, max(len(features), 1)))
    orders: dict[int, tuple] = {}
    for nominal, own, at in classes:
        count, total = sums[0][:, at], sums[1][:, at]
        if nominal:
            with np.errstate(invalid="ignore", divide="ignore"):
                order = np.argsort(np.where(count > 0, total / count, np.inf), axis=2, kind="stable")
            count, total = np.take_along_axis(count, order, 2), np.take_along_axis(total, order, 2)
            orders.update({int(f): (order, i) for i, f in enumerate(own)})
        n, s = np.cumsum(count, 2), np.cumsum(total, 2)
        nl, sl, nr, sr = n[:, :, :-1], s[:, :, :-1], n[:, :, -1:] - n[:, :, :-1], s[:, :, -1:] - s[:, :, :-1]
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = (sl ** 2 / nl + sr ** 2 / nr - s[:, :, -1:] ** 2 / n[:, :, -1:]) / n[:, :, -1:]
        gain = np.where((nl < 1) | (nr < 1), -np.inf, gain)
        end = gain.argmax(2)[:, :, None]
        to = [place[int(f)] for f in own]
        ends[:, to] = end[:, :, 0]
        gains[:, to] = np.take_along_axis(gain, end, 2)[:, :, 0]
        left[0][:, to], left[1][:, to] = np.take_along_axis(nl, end, 2)[:, :, 0], np.take_along_axis(sl, end, 2)[:, :, 0]
    best = gains.argmax(1)  # the first of equal ones
    each = np.arange(nodes)
    feature = np.array(features or [-1])[best]
    return gains[each, best], feature, ends[each, best], left[:, each, best], whole, orders


def grow(rows: tuple, slots: list[Slot], job: Job, keep: bool) -> tuple[bytes | None, list[float]]:
    """The trees of a job on rows that are all here ((target, folds, codes)): (its state as ``BoostedTrees`` keeps it, compressed, if
    ``keep``; mean squared error on the rows of its fold after every round)."""
    y, fold, codes = rows
    held, rate = outside(fold, job), job.rate
    own, features = np.flatnonzero(~held), len(slots)
    first = np.concatenate([[0], np.cumsum([s.n for s in slots])]).astype(np.int64)
    width, classes = int(first[-1]), _classes(slots)
    bins = np.empty((features, len(y)), np.uint8 if max(s.n for s in slots) <= 256 else np.uint16)
    for f, s in enumerate(slots):
        bins[f] = s.bins[codes[f]]
        if s.held is not s.bins:
            bins[f, held] = s.held[codes[f, held]]
    predicted, trees, curve = np.zeros(len(y)), [], []

    def added(at, node, nodes, residual, counts):
        """(count | residual) × nodes × bins of the rows ``at``."""
        out = np.zeros((2, nodes, width))
        step = max(1, SUM_CELLS // max(len(at), 1))
        for f in range(0, features, step):
            g = min(f + step, features)
            span = first[g] - first[f]
            cell = (bins[f:g, at] + (first[f:g] - first[f])[:, None] + node * span).ravel()
            if counts:
                out[0, :, first[f]:first[g]] = np.bincount(cell, minlength=nodes * span).reshape(nodes, span)
            out[1, :, first[f]:first[g]] = np.bincount(cell, np.broadcast_to(residual[at], (g - f, len(at))).ravel(), nodes * span).reshape(nodes, span)
        return out

    root, none = None, np.zeros(len(own), np.int64)
    for t in range(job.rounds):
        residual = y - predicted
        if t and job.fold is not None:
            curve.append(float((residual[held] ** 2).mean()) if held.any() else math.nan)
        sums = added(own, none, 1, residual, root is None)
        if root is None:
            root = sums[0]
        sums[0] = root
        n, s = sums[:, 0, :slots[0].n].sum(1)
        number, value, split, rule, left, right = [float(n)], [float(s / n)], [-1], [None], [-1], [-1]
        at, opened = np.zeros(len(y), np.int64), np.array([0])  # the node of every row, the nodes that may be split
        place = np.zeros(len(y), np.int64)  # of the row's node among the open ones, -1: it is a leaf
        for level in range(job.depth):
            gain, feature, end, part, whole, orders = _splits_at_once(sums, slots[0].n, classes)
            goes_on = np.flatnonzero(gain > 0.0)
            if not len(goes_on):
                break
            new = len(number) + 2 * np.arange(len(goes_on))
            go = np.zeros((len(opened), max(s.n for s in slots)), bool)
            to = np.full(len(opened), -1, np.int64)
            to[goes_on] = np.arange(len(goes_on))
            for i, q in enumerate(goes_on):
                f, k, node = int(feature[q]), int(end[q]), int(opened[q])
                if slots[f].thresholds is None:
                    order, o = orders[f]
                    rule[node] = sorted(int(c) for c in order[q, o, :k + 1])
                    go[q, rule[node]] = True
                else:
                    rule[node] = k
                    go[q, :k + 1] = True
                split[node], left[node], right[node] = f, int(new[i]), int(new[i]) + 1
                nl, sl, nr, sr = part[0, q], part[1, q], whole[0, q] - part[0, q], whole[1, q] - part[1, q]
                number += [float(nl), float(nr)]
                value += [float(sl / nl), float(sr / nr)]
                split += [-1, -1]
                rule += [None, None]
                left += [-1, -1]
                right += [-1, -1]
            moves = np.flatnonzero((place >= 0) & (to[place] >= 0))
            p = place[moves]
            side = ~go[p, bins[feature[p], moves]]
            place[:] = -1
            place[moves] = 2 * to[p] + side
            at[moves] = new[to[p]] + side
            opened = np.stack([new, new + 1], axis=1).ravel()
            if level + 1 == job.depth:
                break
            sizes = np.array([number[q] for q in opened]).reshape(-1, 2)
            lesser = sizes.argmin(1)  # of two children the one with fewer rows is added up
            counted = np.full(len(opened), -1, np.int64)
            counted[2 * np.arange(len(lesser)) + lesser] = np.arange(len(lesser))
            rows_in = own[(place[own] >= 0)]
            rows_in = rows_in[counted[place[rows_in]] >= 0]
            some = added(rows_in, counted[place[rows_in]], len(lesser), residual, True)
            rest = sums[:, goes_on] - some
            rest[1][rest[0] == 0] = 0.0  # no rows, no rounding
            is_left = (lesser == 0)[None, :, None]
            sums = np.stack([np.where(is_left, some, rest), np.where(is_left, rest, some)], axis=2).reshape(2, -1, width)
        worth = np.array(value) * (2.0 if t else 1.0)  # MLlib fits the gradient of the squared error, twice the residual
        predicted += (rate if t else 1.0) * worth[at]
        if keep:
            trees.append([_node_row(slots, *of) for of in zip(number, worth.tolist(), split, rule, left, right)])
    if job.fold is not None:
        curve.append(float(((y - predicted)[held] ** 2).mean()) if held.any() else math.nan)
    return zlib.compress(json.dumps(_boosted_state(trees, rate)).encode(), 1) if keep else None, curve


def grow_apart(df: DataFrame, coding: Coding, slots: dict, jobs: list[Job], partitions: int, keep: bool) -> list[tuple[bytes | None, list[float]]]:
    """``grow`` for every job, each in a task of its own."""
    context = df.sparkSession.sparkContext
    seen = context.broadcast((coded_rows(df.coalesce(partitions), coding), slots))
    order = sorted(range(len(jobs)), key=lambda i: -jobs[i].rounds * jobs[i].depth)  # the longest first

    def run(i):
        rows, own = seen.value
        return i, grow(rows, own[jobs[i].fold], jobs[i], keep)
    try:
        found = dict(context.parallelize(order, len(order)).map(run).collect())
    finally:
        seen.unpersist()
    return [found[i] for i in range(len(jobs))]


# ---------------------------------------------------------------- model

def _node_row(slots: list[Slot], n, value, feature, rule, left, right) -> list:
    """A node as ``BoostedTrees`` keeps it."""
    if feature < 0:
        return [n, value, -1, None, -1, -1]
    limits = slots[feature].thresholds
    return [n, value, feature, [float(c) for c in rule] if limits is None else float(limits[rule]), left, right]


def _boosted_state(trees: list, rate: float) -> dict:
    return {"trees": trees, "weights": [1.0 if i == 0 else rate for i in range(len(trees))]}


class BoostedTrees(_StateModel):
    """Weighted sum of regression trees over ``features``. State: weights, and per tree its nodes as [rows, value, feature
    (-1: a leaf), threshold or categories that go left, left child, right child]."""

    @classmethod
    def of(cls, trees: list[Tree], rate: float, slots: list[Slot]) -> BoostedTrees:
        return cls(**_boosted_state([[_node_row(slots, n.n, n.value, n.feature, n.rule, n.left, n.right) for n in t.nodes] for t in trees], rate))

    @classmethod
    def of_state(cls, state: bytes) -> BoostedTrees:
        """The model of a state that ``grow`` gives."""
        out = cls()
        out._set(state=zlib.decompress(state).decode())
        return out

    @property
    def getNumTrees(self) -> int:  # noqa: N802 - named as in MLlib
        return len(self.s["trees"])

    def leaves(self):
        """Per tree its weight and its leaves as (value, [(feature, condition, goes left, share of rows)], share of all rows)."""
        for weight, nodes in zip(self.s["weights"], self.s["trees"]):
            out = []

            def walk(at, path, nodes=nodes, out=out):
                n, value, feature, rule, left, right = nodes[at]
                if feature < 0:
                    out.append((value, path, n / nodes[0][0]))
                    return
                condition = ("in", frozenset(rule)) if isinstance(rule, list) else ("le", rule)
                for child, goes in ((left, True), (right, False)):
                    walk(child, [*path, (feature, condition, goes, nodes[child][0] / n)])
            walk(0, [])
            yield weight, out

    def _transform(self, df: DataFrame) -> DataFrame:
        tables = _as_arrays(self.s)

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            rows = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, 1))
            out, each = np.zeros(len(x)), np.arange(len(x))
            for weight, value, feature, limit, sets, of_set, left, right, depth in tables:
                at = np.zeros(len(x), np.int32)
                for _ in range(depth):
                    f = feature[at]
                    v = rows[each, f]
                    goes = v <= limit[at]
                    if len(sets):
                        place = of_set[at]
                        code = np.where((v >= 0) & (v < sets.shape[1]), v, sets.shape[1] - 1).astype(np.int64)  # the last column is of no category
                        goes = np.where(place >= 0, sets[place, code], goes)
                    at = np.where(goes, left[at], right[at])
                out += weight * value[at]
            return pd.Series(out)

        return df.withColumn("prediction", predict(vector_to_array("features")))


def _as_arrays(state: dict) -> list[tuple]:
    """Per tree (weight, values, features, thresholds, sets of categories that go left, the node's set (-1: none), left and right
    children, depth); a leaf is its own child."""
    out = []
    for weight, nodes in zip(state["weights"], state["trees"]):
        n = len(nodes)
        value, feature, limit = np.array([x[1] for x in nodes]), np.array([max(x[2], 0) for x in nodes], np.int32), np.zeros(n)
        sets, of_set, most = [], np.full(n, -1, np.int32), 0
        left, right, level = np.arange(n, dtype=np.int32), np.arange(n, dtype=np.int32), [0] * n
        for i, (_, _, f, rule, a, b) in enumerate(nodes):  # parents come first
            if f < 0:
                continue
            left[i], right[i] = a, b
            level[a] = level[b] = level[i] + 1
            if isinstance(rule, list):
                of_set[i] = len(sets)
                sets.append([int(c) for c in rule])
                most = max(most, *sets[-1])
            else:
                limit[i] = rule
        mask = np.zeros((len(sets), most + 2), bool)
        for i, own in enumerate(sets):
            mask[i, own] = True
        out.append((weight, value, feature, limit, mask, of_set, left, right, max(level)))
    return out
