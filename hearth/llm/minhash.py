"""MinHash near-dedup with SuperMinHash signatures (operator 7).

1. Each text becomes the set of its 5-word shingles (64-bit hashes).  Equal sets are
   one class; only the class representative (smallest doc_id) goes on, so groups of
   exact copies cost one row.
2. A SuperMinHash signature per class: every element draws a permutation of the
   slots, level by level, and the element's rank at level j is j plus a fraction; a
   slot keeps the least rank it has seen.  Once every slot is below the next level,
   no later level can change anything and the draw stops early.
3. Banding: classes that agree on all rows of a band share a bucket.  Members are
   compared with two centres of the bucket (stars, never all pairs), first on the
   signatures, then on the full sets; the links are merged by union-find on tables
   (large-star / small-star).
4. What still lies in different components of a bucket is compared block against
   block inside tasks.  On the signatures, this gives clusters of classes that look
   alike (a forest per block, fewer rows than members); the full sets of each cluster
   are then held against each other in the same way, and the links found are merged
   with the others.

A pair at the threshold shares at least one of 32 bands of 4 rows with probability
1 - (1 - 0.75^4)^32 = 0.999995; pairs above it more surely.  A pair is left out before
verification only if its 128 slots agree in fewer than ``SLOT_FLOOR`` places, which at
the threshold has a probability below 1e-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import written
from hearth.llm.components import components

SHINGLE = 5
PERCENT = 75
SLOTS = 128
BANDS = 32
#: Least number of equal slots (of 128) for which a pair is verified.
SLOT_FLOOR = 68
#: Ids up to which a list of ids is broadcast (8 MB); longer ones are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Classes in one block of the block-against-block comparison.
BLOCK = 256
CACHE_WORDS = 1_000_000
#: Elements that are ranked together (bounds the memory of a long text).
CHUNK = 1 << 15

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15
_PRIME = np.uint64(0x100000001B3)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's output function."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the words of a text, in order."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    found = (raw.lower() if lower else raw).split()  # on bytes: A-Z and ASCII white space only
    return np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words: the whole sequence as one."""
    w = word_hashes(text, lower=True)
    if not len(w):
        return np.empty(0, np.uint64)
    n = min(size, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for k in range(n):
        h = _mix(h * _PRIME + w[k:len(w) - n + 1 + k])
    return np.unique(h)


def super_minhash(elements: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signature (float64 per slot) of a set of 64-bit hashes."""
    h = np.full(slots, np.inf)
    for at in range(0, len(elements), CHUNK):
        seed = elements[at:at + CHUNK]
        perm = np.broadcast_to(np.arange(slots, dtype=np.uint8), (len(seed), slots)).copy() if slots <= 256 else \
            np.broadcast_to(np.arange(slots, dtype=np.int32), (len(seed), slots)).copy()
        row = np.arange(len(seed))
        for j in range(slots):
            if h.max() < j:  # ranks of this level on are j or more: nothing can change
                break
            draw = _mix(seed + np.uint64((2 * j + 1) * _STEP % 2**64))
            rank = j + (draw >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
            other = _mix(seed + np.uint64((2 * j + 2) * _STEP % 2**64))
            k = j + (other % np.uint64(slots - j)).astype(np.int64)
            slot = perm[row, k]
            perm[row, k] = perm[:, j]
            np.minimum.at(h, slot, rank)
    return h


def signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n, cid, sig): the set's size, a 64-bit name of the set (null: empty), 32 bits of each slot."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cid", pa.int64()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 1000):
                b = batch.slice(part, 1000)
                n, cid, sig = [], [], []
                for text in b.column(1).to_pylist():
                    s = shingles(text, size)
                    n.append(len(s))
                    cid.append(_name(s))
                    sig.append(_mix(super_minhash(s).view(np.uint64)).astype("<u4").tobytes() if len(s) else None)
                yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(cid, pa.int64()),
                                       pa.array(sig, pa.binary())], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n long, cid long, sig binary")


def _name(s: np.ndarray) -> int | None:
    if not len(s):
        return None
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(cid, items): the shingle hashes themselves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 200):
                sets = [shingles(t, size) for t in batch.slice(part, 200).column(0).to_pylist()]
                yield pa.record_batch([pa.array([_name(s) for s in sets], pa.int64()),
                                       pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["cid", "items"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "cid long, items array<bigint>")


def _alike(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of (a, b), the pairs whose signatures agree in ``SLOT_FLOOR`` slots."""
    p = (pairs.join(classes.select(F.col("cid").alias("a"), F.col("sig").alias("sa")), "a")
         .join(classes.select(F.col("cid").alias("b"), F.col("sig").alias("sb")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(batch.num_rows, -1) for i in (2, 3))
                yield batch.filter(pa.array((x == y).sum(1) >= SLOT_FLOOR)).select([0, 1])

    return p.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, size: int) -> DataFrame:
    """Of (a, b), the pairs whose full sets overlap by ``percent`` of their union."""
    sets = _class_sets(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), classes, docs, size)
    p = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("items").alias("ia")), "a")
         .join(sets.select(F.col("cid").alias("b"), F.col("items").alias("ib")), "b"))
    both = F.size(F.array_intersect("ia", "ib"))
    return p.select("a", "b", both.alias("both"), (F.size("ia") + F.size("ib")).alias("sum")).filter(
        100 * F.col("both") >= percent * (F.col("sum") - F.col("both"))).select("a", "b")


def _chunked(members: DataFrame, group: str, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """Blocks of about ``BLOCK`` members of each group as arrays, and pairs (x, y) of blocks of one group.

    members: group, size (of the group), cid and ``fields``.
    """
    chunks = F.ceil(F.col("size") / BLOCK).cast("long")
    blocks = members.withColumn("chunk", F.pmod(F.xxhash64("cid", group), chunks)).groupBy(group, "chunk").agg(
        F.first("size").alias("size"), *[F.collect_list(f).alias(f) for f in fields])
    large = blocks.filter(F.col("size") > BLOCK)
    x = large.select(group, F.col("chunk").alias("cx"), F.struct(*fields).alias("x"))
    y = large.select(group, F.col("chunk").alias("cy"), F.struct(*fields).alias("y"))
    return blocks.select(F.struct(*fields).alias("x")), x.join(y, group).filter("cx < cy").select("x", "y")


def _forest(members: DataFrame, group: str, fields: list[str], near) -> DataFrame:
    """Links (a, b) that connect what ``near`` calls near inside each group, at most one fewer than members.

    ``near(x, y)`` yields for every member of block x the mask of near members of block y.
    """
    def links_of(x: dict, y: dict, own: bool) -> pa.RecordBatch:
        cid = np.array(x["cid"] if own else x["cid"] + y["cid"], np.int64)
        first = 0 if own else len(x["cid"])  # y's members start here
        tree = np.arange(len(cid))
        a, b = [], []
        for i, mask in enumerate(near(x, y)):
            at = np.flatnonzero(mask) + first
            at = at[tree[at] != tree[i]]
            trees, one = np.unique(tree[at], return_index=True)
            a += [int(cid[i])] * len(one)
            b += cid[at[one]].tolist()
            tree[np.isin(tree, trees)] = tree[i]
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                yield links_of(r["x"], r.get("y", r["x"]), "y" not in r)

    inside, across = _chunked(members, group, fields)
    return inside.mapInArrow(run, "a long, b long").union(across.mapInArrow(run, "a long, b long"))


def _alike_in_blocks(percent: int):
    """Members of other labels whose sizes and signatures allow a link."""
    def near(x: dict, y: dict) -> Iterator[np.ndarray]:
        sx, sy = (np.frombuffer(b"".join(z["sig"]), "<u4").reshape(len(z["cid"]), -1) for z in (x, y))
        n, label = np.array(y["n"]), np.array(y["label"])
        for i in range(len(sx)):
            mask = (label != x["label"][i]) & (100 * np.minimum(n, x["n"][i]) >= percent * np.maximum(n, x["n"][i]))
            at = np.flatnonzero(mask)
            mask[at] = (sy[at] == sx[i]).sum(1) >= SLOT_FLOOR
            yield mask
    return near


def _linked_in_blocks(percent: int):
    """Members of other labels whose full sets overlap by ``percent`` of their union."""
    def near(x: dict, y: dict) -> Iterator[np.ndarray]:
        n, label = np.array([len(s) for s in y["items"]]), np.array(y["label"])
        items = np.concatenate([np.array(s, np.int64) for s in y["items"]])
        owner = np.repeat(np.arange(len(n)), n)
        order = np.argsort(items, kind="stable")
        items, owner = items[order], owner[order]
        for i, s in enumerate(x["items"]):
            s = np.array(s, np.int64)
            lo, hi = np.searchsorted(items, s), np.searchsorted(items, s, side="right")
            reps = hi - lo
            hits = np.repeat(lo - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())
            both = np.bincount(owner[hits], minlength=len(n))
            yield (label != x["label"][i]) & (100 * both >= percent * (n + len(s) - both))
    return near


def _class_sets(ids: DataFrame, classes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(cid, items) of the classes named in ids (cid)."""
    reps = written(ids.join(classes.select("cid", "rep"), "cid").select(F.col("rep").alias("doc_id")).distinct(), "near-ids")
    if reps.count() <= BROADCAST_IDS:  # else both sides are shuffled on the id
        reps = F.broadcast(reps)
    # (a doc_id that stands for several texts gives a set too many, which no link names)
    return written(_sets(docs.join(reps, "doc_id", "left_semi"), size).groupBy("cid").agg(F.first("items").alias("items")), "near-sets")


def links(classes: DataFrame, docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """(a, b): verified links between classes, enough to connect every component."""
    keys = F.array(*[F.xxhash64(F.lit(b), F.expr(f"substring(sig, {4 * (SLOTS // BANDS) * b + 1}, {4 * (SLOTS // BANDS)})"))
                     for b in range(BANDS)])
    rows = classes.select("cid", "n", F.explode(keys).alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    buckets = written(rows.join(sizes, "key"), "near-buckets")
    # the text that copies were made from meets more of them than they meet each other: the most met class is a centre
    met = buckets.groupBy("cid").agg(F.sum("size").alias("met"))
    centres = buckets.join(met, "cid").groupBy("key").agg(
        F.min(F.struct("cid", "n")).alias("lo"), F.max(F.struct("met", "cid", "n")).alias("hi"))
    starred = buckets.join(centres, "key")

    def star(c: str) -> DataFrame:
        return starred.filter(F.col("cid") != F.col(f"{c}.cid")).filter(
            100 * F.least("n", f"{c}.n") >= percent * F.greatest("n", f"{c}.n")).select(
            F.least("cid", f"{c}.cid").alias("a"), F.greatest("cid", f"{c}.cid").alias("b"))

    first = written(_alike(star("lo").union(star("hi")).distinct(), classes), "near-pairs")
    found = written(_verified(first, classes, docs, percent, size), "near-links")
    # members of a bucket that the stars have not joined
    labels = components(found)
    labelled = buckets.filter("size > 2").select("key", "size", "cid", "n").join(
        labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("root", "cid")).drop("root")
    labelled = written(labelled, "near-labels")
    mixed = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("key")
    rest = labelled.join(mixed, "key", "left_semi").join(classes.select("cid", "sig"), "cid")
    # clusters of classes that look alike: forests, not pairs; then the full sets of each cluster, block against block
    forest = written(_forest(rest, "key", ["cid", "n", "label", "sig"], _alike_in_blocks(percent)).distinct(), "near-forest")
    clusters = written(components(forest).withColumnRenamed("node", "cid").withColumnRenamed("root", "cluster"), "near-clusters")
    sized = clusters.join(clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")), "cluster")
    members = sized.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("root", "cid")).drop("root")
    members = members.join(_class_sets(clusters.select("cid"), classes, docs, size), "cid")
    return found.union(_forest(members, "cluster", ["cid", "label", "items"], _linked_in_blocks(percent)))


def groups(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Rows are linked whose shingle sets overlap by ``percent`` of their union;
    component_id is the smallest doc_id reachable.  Null and empty texts are linked
    with nothing, nor are rows without a doc_id.  Rows that repeat a doc_id are
    judged by their own texts, one result row each.  An empty table gives no rows.
    """
    return _grouped(docs, percent, size).drop("cid")


def _grouped(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """``groups`` with the rows' cid (null where nothing links them)."""
    f = written(signatures(docs, size), "near-signatures")
    linked = f.filter("cid is not null and doc_id is not null")
    classes = written(linked.groupBy("cid").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")),
                      "near-classes")
    roots = components(links(classes, docs, percent, size)).withColumnRenamed("node", "cid")
    named = classes.select("cid", "rep").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = named.groupBy("root").agg(F.min("rep").alias("least"))
    of = named.join(least, "root").select("cid", "least")
    out = f.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("cid")).alias("cid")).join(of, "cid", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"), "cid").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _class_names(texts: DataFrame) -> DataFrame:
    """(doc_id, text) with the cid of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cid = [_name(shingles(text)) for text in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("doc_id"), b.column("text"), pa.array(cid, pa.int64())], names=["doc_id", "text", "cid"])

    return texts.mapInArrow(run, "doc_id long, text string, cid long")


def dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near copies, the one of the smallest doc_id.

    Of rows that repeat both doc_id and text, one stays; rows without words all stay.
    Rows that repeat a doc_id with different texts stay or go each by its own text.
    """
    g = written(_grouped(docs, percent, SHINGLE).select("doc_id", "cid", "kept"), "near-verdicts")
    rejected = written(g.filter(~F.col("kept")).select("doc_id", "cid").distinct(), "near-drop")
    ids = rejected.select("doc_id").distinct()
    if rejected.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    # ids of which one text stays and another goes
    mixed = written(g.filter("kept").join(ids, "doc_id", "left_semi").select("doc_id").distinct(), "near-mixed")
    if not mixed.take(1):
        kept = docs.join(ids, "doc_id", "left_anti")
    else:
        some = docs.join(mixed, "doc_id", "left_semi")
        texts = some.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).distinct()
        gone = _class_names(texts).join(rejected, ["doc_id", "cid"], "left_semi").select("doc_id", "text")
        kept = docs.join(ids, "doc_id", "left_anti").unionByName(some.join(gone, ["doc_id", "text"], "left_anti").select(*docs.columns))
    twice = written(kept.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]")).groupBy("doc_id").count().filter("count > 1").select("doc_id"), "near-twice")
    if not twice.take(1):
        return kept
    once = kept.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(twice, "doc_id", "left_anti").union(once)
