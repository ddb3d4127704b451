"""Merkle manifest of a dataset (operator 13).

Every row is a leaf; per source the leaves in id order form a tree of arity ``ARITY``, and the
roots of the sources form one more.  A tree is worked in aligned blocks of ``ARITY ** LEVELS``
nodes: a block keeps each of its levels as one concatenated string of hex digests, in which a
parent is the hash of a substring of fixed width, and the siblings of a node are what flanks it
in that substring.  The block roots are the nodes of the next, much shorter table, and so on until one
is left; their paths come back down by joins on the block, one row a block.

A hot source is many blocks, dealt like those of any other source.  Positions come from a range
sort of (source, id, leaf), of which one row per partition goes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import written

ARITY = 3
#: Levels of a block, so 729 nodes: a block's levels take about 70 KB.
LEVELS = 6
#: Hex characters of a digest.
WIDTH = 64


def digest(text: Column) -> Column:
    """Lower-case hex of SHA-256."""
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    v = value.cast("string")
    return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))


# ---------------------------------------------------------------- one block

def _node(level: Column, i: Column) -> Column:
    """Digest ``i`` (from 0) of a level; levels are held as bytes, so a slice costs its length only."""
    return F.substring(level, (i * WIDTH + 1).cast("int"), F.lit(WIDTH))


def _parents(level: Column) -> Column:
    """The next level: the hash of each run of ``ARITY`` digests (the last run may be shorter)."""
    run = WIDTH * ARITY
    n = F.ceil(F.octet_length(level) / run).cast("int")
    return F.concat_ws("", F.transform(F.sequence(F.lit(0), n - 1),
                                       lambda i: F.sha2(F.substring(level, i * run + 1, F.lit(run)), 256))).cast("binary")


def _flanks(level: Column, i: Column) -> Column:
    """(left, right): what stands before and after digest ``i`` in its run, as strings."""
    at = i % ARITY
    start = (i - at) * WIDTH
    return F.struct(F.substring(level, (start + 1).cast("int"), (at * WIDTH).cast("int")).cast("string").alias("left"),
                    F.substring(level, (start + (at + 1) * WIDTH + 1).cast("int"),
                                ((ARITY - 1 - at) * WIDTH).cast("int")).cast("string").alias("right"))


def _height(block: Column, nodes: Column) -> Column:
    """Levels that a block goes up: to the tree's root where the block is the whole tree, else all of them.

    Only block 0 can be the whole tree; if it is full, both are the same.
    """
    h = F.lit(LEVELS)
    for k in reversed(range(LEVELS)):
        h = F.when((block == 0) & (nodes <= ARITY ** k), F.lit(k)).otherwise(h)
    return h


def _blocks(nodes: DataFrame) -> DataFrame:
    """(grp, pos, hash, …) → written rows (grp, block, height, nodes, l0, l1, …, root), one per aligned block."""
    rest = [c for c in nodes.columns if c not in ("grp", "pos")]
    b = nodes.groupBy("grp", F.floor(F.col("pos") / ARITY ** LEVELS).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", *rest))).alias("nodes"))  # at most ARITY ** LEVELS
    b = (b.withColumn("l0", F.concat_ws("", F.col("nodes.hash")).cast("binary"))
         .withColumn("height", _height(F.col("block"), F.size("nodes"))))
    for k in range(LEVELS):
        b = b.withColumn(f"l{k + 1}", F.when(F.col("height") > k, _parents(F.col(f"l{k}"))).otherwise(F.col(f"l{k}")))
    return written(b.withColumn("root", F.col(f"l{LEVELS}").cast("string")), "merkle-blocks")


def _path(i: Column) -> Column:
    """The flanks of node ``i`` of a block, from its own level up to the block's root."""
    return F.array_compact(F.array(*[F.when(F.col("height") > k, _flanks(F.col(f"l{k}"), F.floor(i / ARITY ** k)))
                                     for k in range(LEVELS)]))


# ---------------------------------------------------------------- trees of blocks

#: What is known of the root of a tree: (grp, hash) → (grp, up, …), the path from there on and any constants.
Finish = Callable[[DataFrame], DataFrame]


def _above(blocks: DataFrame, finish: Finish) -> DataFrame:
    """(grp, block, up, …): the path from the root of each block on.

    While a tree has more than one block, the block roots are the nodes of another round, with
    ``ARITY ** LEVELS`` times fewer rows.
    """
    roots = blocks.select("grp", F.col("block").alias("pos"), F.col("root").alias("hash"))
    if not blocks.agg(F.max("block")).first()[0]:
        return finish(roots.select("grp", "hash")).withColumn("block", F.lit(0).cast("long"))
    return _node_paths(_blocks(roots), finish).withColumnRenamed("pos", "block")


def _node_paths(blocks: DataFrame, finish: Finish, *keep: str) -> DataFrame:
    """(grp, pos, up, …) of every node of the blocks, with the fields ``keep`` of the nodes."""
    above = _above(blocks, finish)
    rest = [c for c in above.columns if c not in ("grp", "block", "up")]
    first = F.col("block") * ARITY ** LEVELS
    nodes = F.transform("nodes", lambda x: F.struct(
        x["pos"].alias("pos"), *[x[c].alias(c) for c in keep], F.concat(_path(x["pos"] - first), F.col("up")).alias("up")))
    return blocks.drop("root").join(above, ["grp", "block"]).select("grp", F.explode(nodes).alias("x"), *rest).select("grp", "x.*", *rest)


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``pos``, the place (from 0) of each row in its ``grp`` (a string without nulls) in the given order.

    A range sort deals the rows, so one group may span many tasks; rows count from the start of their
    group within the task.  Only the first group of a task goes on from the one before: one row per
    task reaches the driver, and one number per task goes back.
    """
    fields = [*rows.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("k", T.LongType()),
              T.StructField("head", T.BooleanType())]
    at = rows.columns.index("grp")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, length, head = None, 0, True  # the group of the row before, rows of it so far, is it the task's first
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            grp = batch.column(at)
            new = np.ones(n, bool)
            new[1:] = np.asarray(pc.not_equal(grp[1:], grp[:-1]))
            new[0] = last is None or grp[0].as_py() != last
            starts = np.maximum.accumulate(np.where(new, np.arange(n), -1))  # -1: group of the batch before
            k = np.arange(n) - starts
            goes_on = starts < 0
            k[goes_on] = np.arange(n)[goes_on] + length
            heads = np.full(n, head)
            changes = np.flatnonzero(new)
            if last is None:
                changes = changes[1:]
            if len(changes):
                heads[changes[0]:] = False
                head = False
            last, length = grp[n - 1].as_py(), int(k[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(k, pa.int64()), pa.array(heads)],
                                             names=[*batch.schema.names, "k", "head"])

    s = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order).withColumn("part", F.spark_partition_id())
    s = written(s.mapInArrow(count, T.StructType(fields)), "merkle-sorted")
    runs = s.groupBy("part", "grp").agg(F.count(F.lit(1)).alias("rows"))
    run = F.struct("grp", "rows")
    edges = runs.groupBy("part").agg(F.min(run).alias("head"), F.max(run).alias("tail"), F.count(F.lit(1)).alias("runs"))
    starts, last, so_far = [], None, 0
    for e in sorted(edges.collect(), key=lambda e: e["part"]):
        start = so_far if e["head"]["grp"] == last else 0
        if start:
            starts.append((e["part"], start))
        last, so_far = e["tail"]["grp"], e["tail"]["rows"] + (start if e["runs"] == 1 else 0)
    starts = F.broadcast(rows.sparkSession.createDataFrame(starts, "part int, start long"))  # at most one a task
    pos = F.col("k") + F.when(F.col("head"), F.coalesce("start", F.lit(0))).otherwise(0)
    return s.join(starts, "part", "left").withColumn("pos", pos).select(*rows.columns, "pos")


# ---------------------------------------------------------------- documents

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(text: Column) -> Column:
    """A row's digest, with ``text`` in place of its text."""
    return digest(F.concat(*[field(text if c == "text" else F.col(c)) for c in FIELDS]))


def leaves(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """Written rows (row, grp, id, hash, altered): the leaf of each document, and the one that an altered text gives.

    ``altered`` is a text column or null where the text is as it was; ``grp`` is the source with a
    mark before it (empty for a null source, which therefore comes first).
    """
    altered = F.lit(None).cast("string") if altered is None else altered
    grp = F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit(""))
    return written(docs.select(
        F.monotonically_increasing_id().alias("row"), grp.alias("grp"), F.col("doc_id").alias("id"),
        leaf(F.col("text")).alias("hash"), F.when(altered.isNotNull(), leaf(altered)).alias("altered")), "merkle-leaves")


def _roots_tree(subroots: DataFrame) -> DataFrame:
    """(grp, hash) of the sources → (grp, up, subroot, root): the paths in the tree over them."""
    nodes = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "hash")
    blocks = _blocks(_numbered(nodes, "name").select("grp", "pos", "hash", "name"))
    none = F.array().cast("array<struct<left: string, right: string>>")
    paths = _node_paths(blocks, lambda r: r.select("grp", none.alias("up"), F.col("hash").alias("root")), "hash", "name")
    return written(paths.select(F.col("name").alias("grp"), "up", F.col("hash").alias("subroot"), "root"), "merkle-roots")


def proofs(leaf_rows: DataFrame) -> DataFrame:
    """id, leaf, subroot, root, proof (array of left and right siblings), folded_root of every leaf.

    ``folded_root`` is recomputed from the altered leaf (the leaf itself, where there is none) and the siblings.
    """
    nodes = _numbered(leaf_rows, "id", "hash", "row").select("grp", "pos", "hash", "id", "altered")
    blocks = _blocks(nodes)
    j = blocks.drop("root").join(_above(blocks, _roots_tree), ["grp", "block"])  # one row a block on both sides
    first = F.col("block") * ARITY ** LEVELS
    rows = F.transform("nodes", lambda x: F.struct(
        x["id"].alias("id"), x["hash"].alias("leaf"), F.coalesce(x["altered"], x["hash"]).alias("start"),
        F.concat(_path(x["pos"] - first), F.col("up")).alias("proof")))
    out = j.select(F.explode(rows).alias("x"), "subroot", "root").select("x.*", "subroot", "root")
    folded = F.aggregate("proof", F.col("start"), lambda h, p: digest(F.concat(p["left"], h, p["right"])))
    return out.select("id", "leaf", "subroot", "root", "proof", folded.alias("folded_root"))


def manifest(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of ``docs``.

    Leaves stand in order of doc_id within their source (null ids first; rows that repeat an id by leaf,
    and wholly equal rows have equal leaves).  A null source is a group of its own, before all others.
    Null fields have their own mark, so that null and empty differ.  An empty table gives no rows.
    Columns beyond ``FIELDS`` are not read.
    """
    p = proofs(leaves(docs, altered))
    siblings = F.concat_ws("", F.transform("proof", lambda x: F.concat(x["left"], x["right"])))
    return p.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", digest(siblings).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def newlines_removed(divisor: int = 2) -> Column:
    """The tampering of the check: texts without their newlines, where ``divisor`` divides the CRC-32 of the id."""
    hit = F.crc32(F.col("doc_id").cast("string")) % divisor == 0
    return F.when(hit, F.translate(F.col("text"), "\n", ""))
