"""Repeated passages by sparse suffix arrays (operator 6).

1. Of all suffixes of a text only those at minimiser positions are kept: places whose
   hash of the next ``KMER`` words is least among ``WINDOW`` neighbours.  The choice
   follows from the words, so copies of a passage of KMER + WINDOW - 1 words or more
   keep at least one suffix at the same place.
2. Suffixes whose first words occur nowhere else cannot match; the others get the
   words after and before them (16-bit hashes, a bounded number).
3. These are sorted as suffixes (range partitioned, so that a very common passage
   spreads over tasks) and every suffix is compared with its nearest neighbours of
   another document.  Matches are extended to the right and to the left; the first
   and last rows of every task are compared across tasks afterwards.
4. Matches of ``MIN_WORDS`` words or more are merged per document.  Longer passages
   are covered by the overlapping matches of the suffixes inside them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import written
from hearth.llm.minhash import _PRIME, _mix, word_hashes

MIN_WORDS = 50
KMER = 12
WINDOW = 36
#: Words kept after and before a suffix: enough that any passage of MIN_WORDS is measured whole.
RIGHT, LEFT = 52, 40
#: Equal suffix starts nearer than this in one text (runs of a few words) are kept once.
RUN = 8

_CONTEXT = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32()),
                      ("right", pa.binary()), ("left", pa.binary())])
_SPAN = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("edge", pa.int32()),
                   ("part", pa.int32()), ("pos", pa.int32()), ("right", pa.binary()), ("left", pa.binary()), ("key", pa.int64())])


def kmer_hashes(w: np.ndarray, k: int = KMER) -> np.ndarray:
    h = np.zeros(max(0, len(w) - k + 1), np.uint64)
    for i in range(k if len(h) else 0):
        h = _mix(h * _PRIME + w[i:len(w) - k + 1 + i])
    return h


def minimisers(h: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the least hash (leftmost) of every window; all of a shorter text is one window."""
    if not len(h):
        return np.empty(0, np.int64)
    if len(h) <= window:
        return np.array([int(h.argmin())])
    out = []
    step = 1 << 15  # windows at a time, so that a long text needs little memory
    for at in range(0, len(h) - window + 1, step):
        part = h[at:at + step + window - 1]
        view = np.lib.stride_tricks.sliding_window_view(part, window)
        out.append(np.unique(view.argmin(1) + np.arange(len(view)) + at))
    places = np.unique(np.concatenate(out))
    near = (np.diff(places) < RUN) & (h[places[1:]] == h[places[:-1]])
    if near.any():
        kept, last = [int(places[0])], {int(h[places[0]]): int(places[0])}
        for p in places[1:].tolist():
            x = int(h[p])
            if p - last.get(x, -RUN) >= RUN:
                kept.append(p)
                last[x] = p
        places = np.array(kept)
    return places


def suffixes(docs: DataFrame) -> DataFrame:
    """(key, doc_id, pos): the suffixes kept of every text, key a hash of their first words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                keys, ids, places = [], [], []
                b = batch.slice(part, 500)
                for d, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    h = kmer_hashes(word_hashes(text))
                    at = minimisers(h)
                    keys.append(h[at].view(np.int64))
                    ids.append(np.full(len(at), d, np.int64))
                    places.append(at.astype(np.int32))
                if keys:
                    yield pa.record_batch([pa.array(np.concatenate(x)) for x in (keys, ids, places)], names=["key", "doc_id", "pos"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id is not null and text is not null")
    return rows.mapInArrow(run, "key long, doc_id long, pos int")


def contexts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(key, doc_id, pos, right, left) of the given places: 16-bit hashes of the words around them (0: none)."""
    per_doc = places.groupBy("doc_id").agg(F.array_distinct(F.collect_list("pos")).alias("at"))  # bounded by the text
    j = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(per_doc, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 100):
                cols: list[list] = [[], [], [], [], []]
                b = batch.slice(part, 100)
                for d, text, at in zip(*(c.to_pylist() for c in b.columns)):
                    w = word_hashes(text)
                    h = kmer_hashes(w)
                    at = np.array(sorted(p for p in at if p < len(h)), np.int64)
                    if not len(at):
                        continue
                    short = np.zeros(LEFT + len(w) + RIGHT, "<u2")
                    short[LEFT:LEFT + len(w)] = np.maximum(_mix(w) & np.uint64(0xFFFF), np.uint64(1))
                    right = short[(at + LEFT)[:, None] + np.arange(RIGHT)]
                    left = short[(at + LEFT - 1)[:, None] - np.arange(LEFT)]
                    cols[0] += h[at].view(np.int64).tolist()
                    cols[1] += [d] * len(at)
                    cols[2] += at.tolist()
                    cols[3] += [r.tobytes() for r in right]
                    cols[4] += [x.tobytes() for x in left]
                yield pa.record_batch([pa.array(c, t.type) for c, t in zip(cols, _CONTEXT)], schema=_CONTEXT)

    return j.select("doc_id", "text", "at").mapInArrow(run, "key long, doc_id long, pos int, right binary, left binary").distinct()


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the rows of two matrices (0 ends a text)."""
    differ = (a != b) | (a == 0)
    return np.where(differ.any(1), differ.argmax(1), a.shape[1])


def _matches(doc: np.ndarray, pos: np.ndarray, key: np.ndarray, right: np.ndarray, left: np.ndarray,
             min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop) of the matches of every suffix with its nearest neighbours of another document."""
    n = len(doc)
    new = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])  # runs of one document
    run = np.searchsorted(new, np.arange(n), side="right") - 1
    before, after = new[run] - 1, np.r_[new[1:], n][run]
    out: tuple[list, list, list] = ([], [], [])
    for other in (before, after):
        i = np.flatnonzero((other >= 0) & (other < n))
        j = other[i]
        same = key[i] == key[j]
        i, j = i[same], j[same]
        r, x = _common(right[i], right[j]), _common(left[i], left[j])
        good = r + x >= min_words
        out[0].append(i[good])
        out[1].append((pos[i] - x)[good])
        out[2].append((pos[i] + r)[good])
    return tuple(np.concatenate(c) for c in out)


def _columns(rows: pa.Table) -> tuple[np.ndarray, ...]:
    def words_of(name: str, width: int) -> np.ndarray:
        return np.frombuffer(b"".join(rows[name].to_pylist()), "<u2").reshape(len(rows), width)
    return (rows["doc_id"].to_numpy(), rows["pos"].to_numpy().astype(np.int64), rows["key"].to_numpy(),
            words_of("right", RIGHT), words_of("left", LEFT))


def matches(found: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, start, stop): matches of sorted neighbours among ``contexts`` rows."""
    order = ["key", "right", "left", "doc_id", "pos"]
    dealt = found.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # one range partition
        if not held:
            return
        rows = pa.Table.from_batches(held)
        doc, pos, key, right, left = _columns(rows)
        i, start, stop = _matches(doc, pos, key, right, left, min_words)
        none = [None] * len(i)
        yield pa.record_batch([pa.array(doc[i]), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))]
                              + [pa.array(none, t.type) for t in list(_SPAN)[3:]], schema=_SPAN)
        # the outermost rows: the first and the last document run's end on both sides
        ends = sorted({0, len(doc) - 1, *np.flatnonzero(doc != doc[0])[:1].tolist(), *np.flatnonzero(doc != doc[-1])[-1:].tolist()})
        e = rows.take(ends)
        yield pa.record_batch([e["doc_id"].combine_chunks(), *[pa.array([None] * len(ends), pa.int32())] * 2,
                               pa.array(range(len(ends)), pa.int32()), e["part"].combine_chunks(), e["pos"].combine_chunks(),
                               e["right"].combine_chunks(), e["left"].combine_chunks(), e["key"].combine_chunks()], schema=_SPAN)

    out = written(dealt.select("key", "doc_id", "pos", "right", "left", "part").mapInArrow(
        run, "doc_id long, start int, stop int, edge int, part int, pos int, right binary, left binary, key long"), "suffix-matches")
    inner = out.filter("edge is null").select("doc_id", "start", "stop")
    edges = out.filter("edge is not null").orderBy("part", "edge").toArrow()  # at most 4 rows per partition
    if not len(edges):
        return inner
    doc, pos, key, right, left = _columns(edges)
    i, start, stop = _matches(doc, pos, key, right, left, min_words)
    outer = found.sparkSession.createDataFrame(
        list(zip(doc[i].tolist(), start.tolist(), stop.tolist())), "doc_id long, start int, stop int")
    return inner.union(outer)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document that shares a passage of ``min_words`` words or more with another.

    doc_id, n_repeated (words in such passages), n_spans, spans ("start:stop" in words,
    stop exclusive, comma-joined).  Words are compared as they are.  Passages that a
    document repeats only within itself do not count.  Null and empty texts and rows
    without doc_id have no passages; rows that repeat a doc_id are one document.
    """
    kept = written(suffixes(docs), "suffixes")
    common = kept.groupBy("key").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).filter("x < y").select("key")
    places = kept.join(common, "key", "left_semi").select("doc_id", "pos")
    found = written(contexts(docs, places), "suffix-contexts")
    spans = matches(found, min_words).groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("s"))
    start = F.array().cast("array<struct<start:int,stop:int>>")

    def step(acc, s):  # sorted spans: the last one grows or a new one follows
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1),
                         F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["stop"] >= s["start"]), grown).otherwise(F.concat(acc, F.array(s)))

    merged = spans.select("doc_id", F.aggregate("s", start, step).alias("s"))
    return merged.select(
        "doc_id", F.aggregate("s", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"]).alias("n_repeated"),
        F.size("s").cast("long").alias("n_spans"),
        F.array_join(F.transform("s", lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string"))), ",").alias("spans"))
