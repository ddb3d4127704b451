"""Best-fit packing of tokenised documents (operator 8).

1. Documents become token ids (word by word, with a bounded cache of words already
   encoded), an end id is added, longer ones are cut into full pieces.
2. The histogram of piece lengths (at most ``capacity`` rows, whatever the corpus)
   goes to the driver.  The configuration linear program over it
   (min sum x_c, sum_c a_cl x_c >= n_l) is solved by multiplicative weights: dual
   weights on the lengths, an unbounded-knapsack dynamic program prices the best
   configuration, its weight is raised, the lengths it covers are made cheaper.
   The fractional solution is rounded down; what is left is solved again, and the
   last few pieces are placed by best fit.
3. Each configuration used ``count`` times is ``count`` sequences.  Pieces get a rank
   within their length (counted per hash bucket, so a hot length is split) and the
   rank picks sequence and offset from the plan.

Only the histogram and the plan (numbers of lengths and configurations, bounded by
``capacity`` and the rounds) pass through the driver.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import written

CAPACITY = 4096
END_ID = 1
#: Words kept encoded in one Python worker.
CACHE_WORDS = 400_000
#: Texts that a task holds as Python strings at once.
SLICE = 500

_STATE: dict = {}

_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_PUNCT = np.zeros(256, bool)
for _lo, _hi in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _PUNCT[_lo:_hi] = True


def _spelled(tokenizer) -> dict[str, str]:
    """Lower-case Latin-1 letter → how the tokenizer spells it for its model; a letter that it normalises or splits is left out."""
    letters = [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xDF, 0x100)) if chr(c).isalpha()]
    out = {}
    for x in letters:
        parts = tokenizer.pre_tokenizer.pre_tokenize_str(x)
        if len(parts) == 1 and tokenizer.normalizer.normalize_str(x) == x:
            out[x] = parts[0][0]
    return out


class _Words(dict):
    """bytes of a lower-cased chunk → its ids as little-endian uint32 bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(path)
        # the model alone, for words of letters, which normalising (but for case) and splitting leave whole
        self.model = self.full.model
        self.letters = _spelled(self.full)
        self.specials = [t.content.encode().lower() for t in self.full.get_added_tokens_decoder().values()]

    def __missing__(self, chunk: bytes) -> bytes:
        if chunk.isalpha():  # a-z only
            ids = [t.id for t in self.model.tokenize(chunk.decode())]
        else:
            word = chunk.decode()
            low = word.lower()
            if low.isalpha() and self.letters.keys() >= set(low):
                ids = [t.id for t in self.model.tokenize("".join(map(self.letters.__getitem__, low)))]
            else:
                ids = self.full.encode(word, add_special_tokens=False).ids
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[chunk] = out
        return out


def encoder(path: str):
    """text → ids (little-endian uint32 bytes) equal to ``Tokenizer.encode`` of the whole text.

    For tokenizers that lower-case and drop white space, no token spans ASCII white
    space or a change from a letter a-z to an ASCII sign, so the ids of a text are
    those of its chunks.  Texts that hold a special token's string are encoded whole.
    """
    state = _STATE.get(path)
    if state is None:
        state = _STATE[path] = _Words(path)
    get = state.__getitem__

    def encode(text: str) -> bytes:
        low = text.encode("utf-8", "surrogatepass").lower()
        if any(s in low for s in state.specials):
            return np.array(state.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if not low:
            return b""
        b = np.frombuffer(low, np.uint8)
        cut = np.flatnonzero(_LETTER[b[:-1]] & _PUNCT[b[1:]]) + 1
        if len(cut):
            low = np.insert(b, cut, 32).tobytes()
        return b"".join(map(get, low.split()))

    return encode


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the pieces of every row of ``docs``.

    Null text is empty: one piece that holds the end id alone.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        slices = (whole.slice(first, SLICE) for whole in batches for first in range(0, whole.num_rows, SLICE))
        for batch in slices:
            rows: list[tuple] = []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    rows.append((d, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                                   *[pa.array(c, pa.int64()) for c in cols[2:]]],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def knapsack(lengths: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded-knapsack dynamic program over ascending ``lengths``.

    Returns the best worth of every capacity and a length that attains it (0: none).
    """
    best, take = np.zeros(capacity + 1), [0] * (capacity + 1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    names = lengths.tolist()
    for c in range(names[0], capacity + 1):
        n = upto[c]
        worth = best[c - lengths[:n]]
        worth += value[:n]
        i = int(worth.argmax())
        if worth[i] > best[c - 1]:
            best[c], take[c] = worth[i], names[i]
        else:
            best[c] = best[c - 1]
    return best, np.array(take)


def _config(take: np.ndarray, capacity: int) -> dict[int, int]:
    out: dict[int, int] = {}
    while capacity > 0:
        length = int(take[capacity])
        if length:
            out[length] = out.get(length, 0) + 1
        capacity -= length or 1
    return out


def solve_lp(need: np.ndarray, eta: float = 1.0, longest: int = 64, others: int = 256, columns: int = 64,
             slack: float = 0.002, seed: int = 5) -> list[tuple[dict[int, int], float]]:
    """Fractional cover of ``need`` (by length) by configurations, by multiplicative weights.

    Every round prices configurations under the current duals (partial pricing:
    the longest lengths left and a seeded draw of the others): of one dynamic
    program, the best for each length that it must hold, as long as its worth is
    within ``slack`` of the optimum (at most ``columns``).  Each is used as far as
    the scarcest of its lengths allows, and makes what it covers cheaper by
    exp(-eta * share covered).  A configuration uses up at least one length, so
    there are at most as many as lengths, whatever the counts.
    """
    capacity = len(need) - 1
    rng = np.random.default_rng(seed)
    dual = np.arange(capacity + 1) / capacity
    left = need.astype(np.float64)
    used: list[tuple[dict[int, int], float]] = []
    while len(open_ := np.flatnonzero(left)):
        rest = open_[:-longest]
        if len(rest) > others:
            rest = np.sort(rng.choice(rest, others, replace=False))
        priced = np.concatenate([rest, open_[-longest:]])
        best, take = knapsack(priced, dual[priced], capacity)
        worth = dual[priced] + best[capacity - priced]  # of the best configuration that holds this length
        order = np.argsort(-worth, kind="stable")[:columns]
        for length in priced[order[worth[order] >= (1 - slack) * best[capacity]]].tolist():
            config = _config(take, capacity - length)
            config[length] = config.get(length, 0) + 1
            at, mult = np.fromiter(config, np.int64), np.fromiter(config.values(), np.float64)
            amount = float(np.min(left[at] / mult))
            if amount <= 0:
                continue
            amount = float(int(amount)) or amount  # whole sequences where there is one
            used.append((config, amount))
            left[at] -= mult * amount
            dual[at] *= np.exp(-eta * mult * amount / need[at])
            left[left < 1e-9] = 0
    return used


def plan_bins(lengths: np.ndarray, counts: np.ndarray,
              capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """[([(length, multiplicity), ...], number of sequences), ...] holding every piece once."""
    need = np.zeros(capacity + 1, np.int64)
    np.add.at(need, lengths, counts)
    plan: list[tuple[list[tuple[int, int]], int]] = []
    if need[capacity]:  # full pieces are sequences of their own
        plan.append(([(capacity, 1)], int(need[capacity])))
        need[capacity] = 0
    left = need.copy()
    for config, amount in solve_lp(need):
        # rounded down; the pieces of the parts cut off are left for best fit
        times = min([int(amount)] + [int(left[x]) // m for x, m in config.items()])
        if times:
            plan.append((sorted(config.items(), reverse=True), times))
            for x, m in config.items():
                left[x] -= m * times
    return plan + _best_fit({int(x): int(left[x]) for x in np.flatnonzero(left)}, capacity)


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best fit, longest first, on a histogram: the sequences are kept by free room."""
    rooms: dict[int, list[list[int]]] = {}
    free = np.zeros(capacity + 1, np.int64)  # sequences by room left
    for length in sorted((k for k, n in left.items() if n), reverse=True):
        for _ in range(left[length]):
            fits = np.flatnonzero(free[length:])
            room = length + int(fits[0]) if len(fits) else capacity
            if len(fits):
                content = rooms[room].pop()
                free[room] -= 1
            else:
                content = []
            content.append(length)
            rooms.setdefault(room - length, []).append(content)
            free[room - length] += 1
    return [([(x, c.count(x)) for x in dict.fromkeys(c)], 1) for cs in rooms.values() for c in cs]


def place_table(plan: list[tuple[list[tuple[int, int]], int]]) -> pd.DataFrame:
    """Intervals of ranks: pieces of ``length`` with rank in [lo, lo + count) go to sequence base + rank - lo."""
    rows, given, base = [], {}, 0
    for config, times in plan:
        offset = 0
        for length, mult in config:
            for _ in range(mult):
                lo = given.get(length, 0)
                rows.append((length, lo, base, offset))
                given[length] = lo + times
                offset += length
        base += times
    return pd.DataFrame(rows, columns=["length", "lo", "base", "offset"]).sort_values(
        ["length", "lo"], kind="stable").reset_index(drop=True)


def ranked(parts: DataFrame, buckets: int) -> DataFrame:
    """Add ``rank`` (from 0) within ``length``, counted per hash bucket and then shifted by the buckets before."""
    b = parts.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    inner = b.withColumn("_r", F.row_number().over(
        Window.partitionBy("length", "_b").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1)
    counts = b.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_b")
                              .rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("length", "_b", F.coalesce(before, F.lit(0)).alias("_before"))
    return (inner.join(counts, ["length", "_b"])
            .withColumn("rank", F.col("_r") + F.col("_before")).drop("_b", "_r", "_before"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         buckets: int | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every row of ``docs`` is packed, repeated rows once each; null text counts as
    empty; an empty table gives no rows.
    """
    spark = docs.sparkSession
    parts = written(pieces(docs, tokenizer, capacity, end_id), "pack-pieces")
    hist = parts.groupBy("length").count().toPandas()  # at most `capacity` rows
    table = place_table(plan_bins(hist["length"].to_numpy(np.int64), hist["count"].to_numpy(np.int64), capacity))
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a length and the number within it as one sorted key, for a binary search
    cols = {c: table[c].to_numpy(np.int64) for c in ("length", "lo", "base", "offset")}
    shared = spark.sparkContext.broadcast((cols["length"], cols["lo"], cols["base"], cols["offset"]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, lo, base, offset = shared.value
        for batch in batches:
            n = batch.column(3).to_numpy(zero_copy_only=False)
            r = batch.column(5).to_numpy(zero_copy_only=False)
            at = np.empty(len(n), np.int64)
            for x in np.unique(n):  # within one length the intervals are sorted by lo
                a, z = np.searchsorted(lengths, x), np.searchsorted(lengths, x, side="right")
                own = n == x
                at[own] = a + np.searchsorted(lo[a:z], r[own], side="right") - 1
            yield pa.record_batch([*batch.columns[:5], pa.array(base[at] + r - lo[at]), pa.array(offset[at])],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked(parts, buckets).select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
