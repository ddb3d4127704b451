"""Random forests of small tables, a few trees a task (survey M6).

MLlib grows a forest in passes over groups of nodes, with the sums of every bin of every node; on a table that a task can hold, most of
that is overhead. Here a task grows whole trees. They are the trees of MLlib's ``RandomForestRegressor`` with all features as candidates on
rows of one partition: the same bootstrap counts, the same sums in the same order, the same gain and the first of equal splits.
"""

from __future__ import annotations

import json
import math
import zlib

import numpy as np

from .boosting import Slot, _classes, _node_row

#: Trees of a task.
TREES = 25
#: Cells (node, bin) whose sums a task holds at once.
CELLS = 300_000
EPSILON = 2.220446049250313e-16


def bootstrap_counts(spark, rows: int, trees: int, seed: int) -> np.ndarray:
    """How often every tree takes every row (rows × trees), as MLlib draws it for the first partition."""
    if not rows:
        return np.zeros((0, trees), np.uint8)
    jvm = spark._jvm
    draw = jvm.org.apache.commons.math3.distribution.PoissonDistribution(1.0)
    draw.reseedRandomGenerator(seed + 1)
    buffer = jvm.java.nio.ByteBuffer.allocate(4 * rows * trees)
    buffer.asIntBuffer().put(draw.sample(rows * trees))
    return np.frombuffer(bytes(buffer.array()), ">i4").reshape(rows, trees).astype(np.uint8)


def _impurity(n, s, q):
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(n == 0, 0.0, (q - (s * s) / n) / n)


def grow_tree(x: np.ndarray, y: np.ndarray, w: np.ndarray, held: np.ndarray, slots: list[Slot], depth: int, leaf: int, stops: list[int]):
    """(nodes as [rows, value, feature, rule, left, right], predictions of the held rows when the tree ends at each depth of ``stops``).

    ``x`` and ``held``: features × rows bins; ``w``: how often the tree takes a row."""
    own = np.flatnonzero(w)
    x, y, w = x[:, own], y[own], w[own].astype(float)
    weights = [w, w * y, w * y * y]
    first = np.concatenate([[0], np.cumsum([s.n for s in slots])]).astype(np.int64)
    width, classes = int(first[-1]), _classes(slots)
    features = np.array(sorted(int(f) for _, own, _ in classes for f in own), np.int64)
    place_of = {int(f): i for i, f in enumerate(features)}
    most = max(s.n for s in slots)
    node, at = np.zeros(len(y), np.int64), np.zeros(held.shape[1], np.int64)  # place among the open nodes (-1: in a leaf), id of held rows' nodes
    held_place = np.zeros(held.shape[1], np.int64)
    opened = np.array([0])
    stats, impurity = np.array([[a.sum()] for a in weights]), None
    nodes = [[float(stats[0, 0]), float(stats[1, 0] / stats[0, 0]) if len(y) else 0.0, -1, None, -1, -1]]
    found = {}

    def sums(rows, places, k):
        out = np.zeros((3, k, width + 1))
        step = max(1, 262_144 // max(len(rows), 1))
        for f in range(0, len(slots), step):
            g = min(f + step, len(slots))
            span = int(first[g] - first[f])
            cell = (x[f:g, rows] + (first[f:g] - first[f])[:, None] + places * span).ravel()
            for i in range(3):
                out[i, :, first[f]:first[g]] = np.bincount(cell, np.broadcast_to(weights[i][rows], (g - f, len(rows))).ravel(), k * span).reshape(k, span)
        return out

    for level in range(depth + 1):
        if level in stops:
            found[level] = np.array([n[1] for n in nodes])[at]
        if level == depth or not len(opened) or not len(features):
            break
        k = len(opened)
        gain, feature, end = np.full(k, -np.inf), np.zeros(k, np.int64), np.zeros(k, np.int64)
        left, right = np.zeros((3, k)), np.zeros((3, k))
        goes_left = np.zeros((k, most), bool)
        active = np.flatnonzero(node >= 0)
        active = active[np.argsort(node[active], kind="stable")]  # rows of a node stay in order
        starts = np.searchsorted(node[active], np.arange(k + 1))
        step = max(1, CELLS // (width + 1))
        for lo in range(0, k, step):
            hi = min(lo + step, k)
            rows = active[starts[lo]:starts[hi]]
            total = sums(rows, node[rows] - lo, hi - lo)
            gains, ends = np.full((hi - lo, len(features)), -np.inf), np.zeros((hi - lo, len(features)), np.int64)
            lefts, rights = np.zeros((3, hi - lo, len(features))), np.zeros((3, hi - lo, len(features)))
            summed, orders = [], {}
            for nominal, of, places in classes:
                own = total[:, :, places]
                if nominal:
                    with np.errstate(invalid="ignore", divide="ignore"):
                        order = np.argsort(np.where(own[0] > 0, own[1] / own[0], np.inf), axis=2, kind="stable")
                    own = np.take_along_axis(own, order[None], 3)
                    orders.update({int(f): (order, i) for i, f in enumerate(of)})
                c = np.cumsum(own, 3)
                summed.append((of, c[:, :, :, :-1], c[:, :, :, -1:] - c[:, :, :, :-1]))
            if impurity is None:  # the root's, from the first split that is looked at
                of, l, r = next(z for z in summed if features[0] in z[0])
                i = list(of).index(features[0])
                impurity = _impurity(*(l[:, :, i, 0] + r[:, :, i, 0]))
            for of, l, r in summed:
                n = l[0] + r[0]
                with np.errstate(invalid="ignore", divide="ignore"):
                    g = impurity[lo:hi, None, None] - l[0] / n * _impurity(*l) - r[0] / n * _impurity(*r)
                g = np.where((l[0] < leaf) | (r[0] < leaf) | ~(g >= 0.0), -np.inf, g)
                e = g.argmax(2)[:, :, None]
                to = [place_of[int(f)] for f in of]
                ends[:, to], gains[:, to] = e[:, :, 0], np.take_along_axis(g, e, 2)[:, :, 0]
                lefts[:, :, to] = np.take_along_axis(l, e[None], 3)[:, :, :, 0]
                rights[:, :, to] = np.take_along_axis(r, e[None], 3)[:, :, :, 0]
            best, each = gains.argmax(1), np.arange(hi - lo)
            gain[lo:hi], feature[lo:hi], end[lo:hi] = gains[each, best], features[best], ends[each, best]
            left[:, lo:hi], right[:, lo:hi] = lefts[:, each, best], rights[:, each, best]
            goes_left[lo:hi] = np.arange(most) <= end[lo:hi, None]
            for q in range(lo, hi):
                if slots[feature[q]].thresholds is None and gain[q] > 0:
                    order, i = orders[int(feature[q])]
                    goes_left[q] = False
                    goes_left[q, order[q - lo, i, :end[q] + 1]] = True
        goes_on = np.flatnonzero(gain > 0.0)
        if not len(goes_on):
            for d in stops:
                if d > level:
                    found[d] = np.array([n[1] for n in nodes])[at]
            break
        ids = len(nodes) + 2 * np.arange(len(goes_on))
        for q, i in zip(goes_on.tolist(), ids.tolist()):
            f, parent = int(feature[q]), nodes[opened[q]]
            nominal = slots[f].thresholds is None
            parent[2:] = [f, np.flatnonzero(goes_left[q, :slots[f].n]).tolist() if nominal else int(end[q]), i, i + 1]
            nodes.append([float(left[0, q]), float(left[1, q] / left[0, q]), -1, None, -1, -1])
            nodes.append([float(right[0, q]), float(right[1, q] / right[0, q]), -1, None, -1, -1])
        to = np.full(k + 1, -1, np.int64)
        to[goes_on] = np.arange(len(goes_on))
        stats = np.stack([left[:, goes_on], right[:, goes_on]], axis=2).reshape(3, -1)
        impurity = _impurity(*stats)
        still = np.abs(impurity) >= EPSILON  # the others are leaves
        renumbered = np.full(len(still) + 1, -1, np.int64)
        renumbered[:-1][still] = np.arange(still.sum())
        child_ids = np.stack([ids, ids + 1], axis=1).ravel()
        for places, values, known in ((node, x, None), (held_place, held, at)):
            moves = np.flatnonzero((places >= 0) & (to[places] >= 0))
            p = places[moves]
            child = 2 * to[p] + ~goes_left[p, values[feature[p], moves]]
            if known is not None:
                known[moves] = child_ids[child]
            places[:] = -1
            places[moves] = renumbered[child]
        opened, impurity = child_ids[still], impurity[still]
    for d in stops:  # the tree ended before
        if d not in found:
            found[d] = np.array([n[1] for n in nodes])[at]
    return nodes, np.array([found[d] for d in stops])


def grow_forests(spark, tables: dict, jobs: list[tuple], keep: bool) -> list[tuple[bytes | None, np.ndarray]]:
    """Per job (table, depth, least rows of a leaf, trees, depths to score): (its state as ``BoostedTrees`` keeps it, if ``keep``, mean
    prediction of the table's held rows by depth).

    ``tables``: name → (bins of the rows, target, bootstrap counts, bins of held rows, features as ``Slot``)."""
    context = spark.sparkContext
    seen = {name: context.broadcast(table) for name, table in tables.items()}
    parts = [(i, a, min(a + TREES, jobs[i][3])) for i in range(len(jobs)) for a in range(0, jobs[i][3], TREES)]

    def run(part):
        i, a, b = part
        name, depth, leaf, _, stops = jobs[i]
        x, y, counts, held, slots = seen[name].value
        total, trees = np.zeros((len(stops), held.shape[1])), []
        for t in range(a, b):
            nodes, predicted = grow_tree(x, y, counts[:, t], held, slots, depth, leaf, stops)
            total += predicted
            if keep:
                trees.append([_node_row(slots, *n) for n in nodes])
        return i, a, total, zlib.compress(json.dumps(trees).encode(), 1) if keep else None
    try:
        found = sorted(context.parallelize(parts, len(parts)).map(run).collect(), key=lambda r: r[:2])
    finally:
        for table in seen.values():
            table.unpersist()
    out = []
    for i, (_, _, _, trees, _) in enumerate(jobs):
        own = [r for r in found if r[0] == i]
        state = None
        if keep:
            grown = ",".join(zlib.decompress(r[3]).decode()[1:-1] for r in own)
            state = zlib.compress(f'{{"trees": [{grown}], "weights": {json.dumps([1.0 / trees] * trees)}}}'.encode(), 1)
        out.append((state, sum(r[2] for r in own) / trees))
    return out
