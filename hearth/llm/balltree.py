"""Exact top-k inner-product search with ball trees (operator 4).

Candidates are dealt into shards by a hash, and every shard becomes one ball tree
(centre, radius and row range per node, rows in leaf order), kept as one row of an
index table.  Queries go in blocks.  A block first searches one shard; the k-th
score it finds there is the bar it carries to all other shards, which one task
visits one after the other while the bar rises.  In a tree, nodes are taken from a
heap by their largest upper bound <q, centre> + |q| * radius, and a node is opened
only for the queries whose bound reaches their current k-th score (ties included,
since a smaller id may win).

Index rows have a bounded size (``SHARD_ROWS`` rows), so do query blocks; the number
of both follows the tables.  A pair of block and shard is one unit of work, joined on
the shard's number.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import written

SHARD_ROWS = 8192
BLOCK_QUERIES = 1024
LEAF_ROWS = 128
#: Shards that one unit of work visits in a row, passing on the k-th scores.
RUN_SHARDS = 16


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(id, v): floor(scale * x) of every component, x as double, as whole doubles.

    Rows without id, without vector, or with a null or non-finite component take no
    part.  Rows that repeat an id and its vector count once.
    """
    x = F.transform(F.col(vec_col).cast("array<double>"), lambda c: F.floor(c * scale).cast("double"))
    raw = F.col(vec_col).cast("array<double>")
    big = F.lit(float(np.finfo(np.float64).max))
    fine = F.forall(raw, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) <= big), F.lit(False)))
    return (df.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).filter(fine)
            .select(F.col(id_col).cast("long").alias("id"), x.alias("v")).distinct())


def build_tree(vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, ...]:
    """Order of the rows, and centre, radius, first and last row and right child of every node (preorder)."""
    order = np.arange(len(vectors))
    centre, radius, lo, hi, right = [], [], [], [], []

    def add(a: int, z: int) -> int:
        node = len(lo)
        own = vectors[order[a:z]]
        c = own.mean(0)
        d = np.sqrt(((own - c) ** 2).sum(1))
        centre.append(c)
        radius.append(float(d.max()))
        lo.append(a)
        hi.append(z)
        right.append(-1)
        return node

    stack = [(0, len(vectors), -1)]
    while stack:
        a, z, parent = stack.pop()
        node = add(a, z)
        if parent >= 0:
            right[parent] = node
        if z - a <= leaf_rows or radius[node] == 0:
            continue
        own = vectors[order[a:z]]
        # split along the line through two far points
        p = own[np.argmax(((own - centre[node]) ** 2).sum(1))]
        q = own[np.argmax(((own - p) ** 2).sum(1))]
        m = (z - a) // 2
        order[a:z] = order[a:z][np.argsort(own @ (q - p), kind="stable")]
        stack.append((a + m, z, node))  # the right child knows its parent
        stack.append((a, a + m, -1))  # the left child follows its parent
    return order, np.array(centre), np.array(radius), np.array(lo), np.array(hi), np.array(right)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: floats where they cannot lose a bit, else Python integers."""
    if not x.shape[1]:
        return np.zeros((len(q), len(x)), np.int64)
    top = np.abs(q).max(initial=0.0) * np.abs(x).max(initial=0.0) * x.shape[1]
    if top < 2.0 ** 53:
        return (q @ x.T).astype(np.int64)
    exact = np.array([[int(c) for c in r] for r in q], object) @ np.array([[int(c) for c in r] for r in x], object).T
    return np.clip(exact, NO_SCORE + 1, 2 ** 63 - 1).astype(np.int64)


#: Stand-ins for an absent candidate.
NO_SCORE, NO_ID = -(2 ** 63 - 1), 2 ** 63 - 1


class Best:
    """The k best (score, id) of every query of a block: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), NO_SCORE)
        self.id = np.full((n, k), NO_ID)

    def bar(self) -> np.ndarray:
        return self.score[:, -1]

    def offer(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """``score`` and ``ids`` (rows x candidates); absent candidates have the least score and the largest id."""
        s = np.concatenate([self.score[rows], score], axis=1)
        i = np.concatenate([self.id[rows], ids], axis=1)
        if s.shape[1] > 4 * self.k:  # all that reach the k-th score, ties included
            least = -np.partition(-s, self.k - 1, axis=1)[:, self.k - 1]
            width = int((s >= least[:, None]).sum(1).max())
            at = np.argsort(-s, axis=1, kind="stable")[:, :width]
            s, i = np.take_along_axis(s, at, 1), np.take_along_axis(i, at, 1)
        at = np.lexsort((i, -s), axis=1)[:, :self.k]
        self.score[rows] = np.take_along_axis(s, at, 1)
        self.id[rows] = np.take_along_axis(i, at, 1)


def search(tree: dict, q: np.ndarray, qid: np.ndarray, best: Best) -> int:
    """Branch and bound of one block in one tree; returns the number of leaves opened."""
    centre, radius, lo, hi, right, x, ids = (tree[k] for k in ("centre", "radius", "lo", "hi", "right", "x", "ids"))
    x, q = x.astype(np.float64), q.astype(np.float64)
    d = max(x.shape[1], q.shape[1])  # a shorter vector ends in zeros
    q, x, centre = (np.pad(m, ((0, 0), (0, d - m.shape[1]))) for m in (q, x, centre))
    norm = np.sqrt((q ** 2).sum(1))

    def bound(node: int, rows: np.ndarray) -> np.ndarray:
        b = q[rows] @ centre[node] + norm[rows] * radius[node]
        return b + 1e-9 * (np.abs(b) + norm[rows] * (np.sqrt((centre[node] ** 2).sum()) + radius[node])) + 1e-6

    rows = np.arange(len(q))
    b = bound(0, rows)
    heap = [(-float(b.max(initial=-np.inf)), 0, rows, b)]
    opened = 0
    while heap:
        _, node, rows, b = heapq.heappop(heap)
        live = b >= best.bar()[rows]
        rows = rows[live]
        if not len(rows):
            continue
        if right[node] < 0:
            opened += 1
            a, z = lo[node], hi[node]
            score = _products(q[rows], x[a:z])
            who = np.broadcast_to(ids[a:z], score.shape)
            own = who == qid[rows][:, None]
            best.offer(rows, np.where(own, NO_SCORE, score), np.where(own, NO_ID, who))
            continue
        for child in (node + 1, int(right[node])):
            b = bound(child, rows)
            heapq.heappush(heap, (-float(b.max()), child, rows, b))
    return opened


def _matrix(column: list, width: int | None = None) -> np.ndarray:
    width = max((len(v) for v in column), default=0) if width is None else width
    out = np.zeros((len(column), width))
    for r, v in zip(out, column):
        r[:len(v)] = v
    return out


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the shortest type that holds them."""
    for kind in (np.int16, np.int32):
        if np.abs(x).max(initial=0) <= np.iinfo(kind).max:
            return x.astype(kind)
    return x


def _pack(arrays: dict[str, np.ndarray]) -> bytes:
    import io
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    import io
    with np.load(io.BytesIO(blob)) as z:
        return {k: z[k] for k in z.files}


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(shard, tree): one ball tree per shard of about ``shard_rows`` rows of (id, v)."""
    shards = max(1, -(-vectors.count() // shard_rows))

    def build(key, pdf):
        import pandas as pd
        pdf = pdf.sort_values("id", kind="stable")
        x = _matrix(list(pdf["v"]))
        order, centre, radius, lo, hi, right = build_tree(x, leaf_rows)
        blob = _pack({"x": _narrow(x[order]), "ids": pdf["id"].to_numpy(np.int64)[order], "centre": centre, "radius": radius,
                      "lo": lo, "hi": hi, "right": right})
        return pd.DataFrame({"shard": [key[0]], "tree": [blob]})

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(build, "shard long, tree binary")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS,
          block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best inner products of every query, ties to the smaller id.

    Both tables are (id, v) as ``integer_vectors`` makes them.  A candidate with the
    query's own id is left out; with fewer candidates than k, all are returned; no
    queries or no candidates give no rows.  Vectors of other lengths end in zeros.
    Scores beyond the range of a long stop at its ends.  A query id that occurs with
    several vectors is answered once for each: k rows of ranks 1 to k per vector.
    """
    index = written(build_index(vectors, shard_rows), "ball-index")
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    blocks_n = max(1, -(-queries.count() // block_queries))

    def block(key, pdf):
        import pandas as pd
        # a query is known by its block and its place there: an id may come with several vectors
        pdf = pdf.assign(t=pdf["v"].map(tuple)).sort_values(["id", "t"], kind="stable")
        return pd.DataFrame({"block": [key[0]], "queries": [_pack({"q": _narrow(_matrix(list(pdf["v"]))), "ids": pdf["id"].to_numpy(np.int64)})]})

    blocks = written(queries.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks_n))).groupBy("block").applyInPandas(
        block, "block long, queries binary"), "ball-queries")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Units (block, run) in order: the shards of one unit follow each other and share the k-th scores."""
        unit, best, q = None, None, None

        def result() -> pa.RecordBatch:
            n = len(q["ids"])
            return pa.record_batch([
                pa.array(np.full(n, unit[0])), pa.array(np.arange(n, dtype=np.int32)), pa.array(q["ids"]),
                pa.array(best.score.tolist(), pa.list_(pa.int64())), pa.array(best.id.tolist(), pa.list_(pa.int64()))],
                names=["block", "place", "query_id", "scores", "ids"])

        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if unit != (r["block"], r["run"]):
                    if unit is not None:
                        yield result()
                    unit, q = (r["block"], r["run"]), _unpack(r["queries"])
                    best = Best(len(q["ids"]), k)
                    if r["bars"] is not None:  # a bar from another shard: its holders come back in the final choice
                        best.score[:] = np.array(r["bars"])[:, None]
                search(_unpack(r["tree"]), q["q"], q["ids"], best)
        if unit is not None:
            yield result()

    schema = "block long, place int, query_id long, scores array<bigint>, ids array<bigint>"

    runs = -(-shards // RUN_SHARDS)

    def units(jobs: DataFrame, n: int) -> DataFrame:
        # about one unit per partition: a task holds the trees of one run
        rows = jobs.join(blocks, "block").join(index, "shard").select("block", "run", "shard", "queries", "tree", "bars")
        return rows.repartition(n, "block", "run").sortWithinPartitions("block", "run", "shard").mapInArrow(run, schema)

    home = F.pmod("block", F.lit(shards))
    seeds = blocks.select("block", home.alias("shard"), F.lit(-1).cast("long").alias("run"),
                          F.lit(None).cast("array<bigint>").alias("bars"))
    first = written(units(seeds, blocks_n), "ball-first")
    own = F.array_sort(F.collect_list(F.struct("place", F.element_at("scores", -1).alias("bar"))))
    bars = first.groupBy("block").agg(own.alias("own")).select("block", F.col("own.bar").alias("bars"))  # in order of place
    rest = (blocks.select("block", home.alias("home"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
            .filter("shard <> home").select("block", F.col("shard").cast("long").alias("shard"),
                                            F.floor(F.col("shard") / RUN_SHARDS).cast("long").alias("run")))
    found = first.union(units(rest.join(bars, "block", "left"), blocks_n * runs))
    best = found.select("block", "place", "query_id", F.explode(F.arrays_zip("scores", "ids")).alias("e")).select(
        "block", "place", "query_id", F.col("e.scores").alias("score"), F.col("e.ids").alias("vec_id")).filter(
        F.col("vec_id") != NO_ID)
    order = Window.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
