"""Packing tokenised documents into sequences of one length.

Documents are cut into pieces; how often each combination of piece lengths
that fills a sequence is used is solved on the histogram of lengths by
non-negative least squares, rounded down, and what is left over is packed
greedily, still on the histogram: its size depends on the sequence length,
not on the documents.  Pieces then find their place by their rank among the
pieces of the same length.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .wordtable import encode

WINDOW = 2048
#: The id that ends each document.
END = 1
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """Pieces of each document's ids and ``end``: full windows, half a window
    if the rest has as much, and the rest.  A null text is empty: its one
    piece is ``end``."""
    def emit(doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> pa.Table:
        ends = np.cumsum(counts)
        # every document's ids with the end put after them
        flat = np.insert(ids.astype("<u4"), ends, end).astype("<u4")
        total = np.asarray(counts, np.int64) + 1
        begin = np.append(0, np.cumsum(total))
        rows: list[tuple[int | None, int, int, int, int]] = []
        for d, b, n in zip(doc_ids, begin.tolist(), total.tolist()):
            at = 0
            while at < n:
                rest = n - at
                size = window if rest >= window else window // 2 if rest >= window // 2 else rest
                rows.append((d, at, size, zlib.crc32(flat[b + at:b + at + size].tobytes()), n))
                at += size
        return pa.table({c: pa.array([r[i] for r in rows], pa.int64()) for i, c in
                         enumerate(("doc_id", "start", "length", "ids_crc32", "doc_tokens"))})

    return encode(docs, tokenizer, emit, PIECES)


def combinations(window: int = WINDOW, grid: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Up to three lengths, none over half of it, that fill a window or an
    even share of it down to an eighth (unused places are 0), and how many
    such shares a window has.  Of three lengths, the middle one is half the
    share or a multiple of a grid-th of it."""
    out = []
    for times in (1, 2, 4, 8):
        share = window // times
        half, step = share // 2, max(1, share // grid)
        some = {(half, share - half, 0)}
        for b in {half, *range(step, half, step)}:
            for a in range(1, half + 1):
                c = share - a - b
                if 1 <= c <= half:
                    some.add(tuple(sorted((a, b, c), reverse=True)))
            if share - b <= half:
                some.add((share - b, b, 0))
        out += [(*lengths, times) for lengths in sorted(some, reverse=True)]
    table = np.array(out, np.int64)
    return table[:, :3], table[:, 3]


def solve(hist: np.ndarray, combos: np.ndarray, times: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 of the combinations that bring the lengths used
    near the histogram (least squares, by multiplicative steps that never
    leave x >= 0)."""
    h = hist.astype(np.float64).copy()
    h[0] = 0
    used = (combos > 0) * times[:, None]

    def gather(y: np.ndarray) -> np.ndarray:
        return (y[combos] * used).sum(1)

    def spread(x: np.ndarray) -> np.ndarray:
        return np.bincount(combos.ravel(), weights=(x[:, None] * used).ravel(), minlength=len(h))

    want = gather(h)
    x = np.where(np.where(used > 0, h[combos], 1).min(1) > 0, 1.0, 0.0)
    for _ in range(rounds):
        x *= want / np.maximum(gather(spread(x)), 1e-12)
    return x


def plan(hist: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, repeats): together they use each length as
    often as ``hist`` has it."""
    left = hist.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []

    def use(lengths: tuple[int, ...], times: int) -> None:
        if times > 0:
            out.append((lengths, times))
            for n in lengths:
                left[n] -= times

    use((window,), int(left[window]))
    combos, shares = combinations(window)
    x = solve(left, combos, shares)
    for k in np.argsort(-x, kind="stable"):
        if x[k] < 1:
            break
        lengths = tuple(int(n) for n in combos[k] if n) * int(shares[k])
        use(lengths, min(int(x[k]), *(int(left[n]) // lengths.count(n) for n in lengths)))
    # what is left: the longest piece, then again and again the longest that fits
    there = [n for n in range(1, window + 1) if left[n]]
    while there:
        lengths, free = [], window
        while free:
            i = bisect.bisect_right(there, free)
            while i and left[there[i - 1]] <= lengths.count(there[i - 1]):
                i -= 1
            if not i:
                break
            lengths.append(there[i - 1])
            free -= there[i - 1]
        use(tuple(lengths), min(int(left[n]) // lengths.count(n) for n in set(lengths)))
        there = [n for n in there if left[n]]
    return out


def place(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """``cut`` (rows with ``length`` and columns that order them, doc_id and
    start) with sequence_id, from 0, and offset in the sequence."""
    spark = cut.sparkSession
    cut = stage(cut, "pieces")  # ranks and counts must come from the same rows
    hist = np.zeros(window + 1, np.int64)
    for r in cut.groupBy("length").count().collect():  # one row for each length
        hist[r.length] = r["count"]
    slots: dict[int, list[tuple[int, int, int]]] = {}
    used = np.zeros(window + 1, np.int64)
    sequence = 0
    for lengths, times in plan(hist, window):
        at = 0
        for n in lengths:
            slots.setdefault(n, []).append((int(used[n]), sequence, at))
            used[n] += times
            at += n
        sequence += times
    table = {n: tuple(np.array(x, np.int64) for x in zip(*s, strict=True)) for n, s in slots.items()}

    @F.arrow_udf("sequence_id long, offset long")
    def find(length: pa.Array, rank: pa.Array) -> pa.Array:
        n, r = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        seq, off = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
        for k in np.unique(n).tolist():
            rows = np.flatnonzero(n == k)
            first, base, at = table[k]
            slot = np.searchsorted(first, r[rows], "right") - 1
            seq[rows], off[rows] = base[slot] + r[rows] - first[slot], at[slot]
        return pa.StructArray.from_arrays([pa.array(seq), pa.array(off)], names=["sequence_id", "offset"])

    # the rank of a piece among those of its length: in one of many buckets,
    # after all pieces of the buckets before; no length is ranked in one task
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    before = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    running = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("length", "_bucket", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = (dealt.withColumn("_rank", F.row_number().over(within) - 1).join(before, ["length", "_bucket"])
              .withColumn("_at", find(F.col("length"), F.col("_rank") + F.col("_before"))))
    return ranked.select(*[F.col(f"`{c}`") for c in cut.columns], "_at.sequence_id", "_at.offset")


def pack_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Query op8: every piece of every document with its place."""
    return place(pieces(docs, tokenizer))
