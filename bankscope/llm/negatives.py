"""Hard negatives by angles to reference directions.

Every row keeps its norm and the angle to the reference direction nearest to
it.  By the triangle inequality of angles, the angle between an anchor and a
row lies between the difference and the sum of their angles to a reference;
times the norms, its cosine bounds their score from both sides, widened by
more than rounding can amount to.  An anchor visits only cells of rows (of
one reference and one range of angles) whose bounds reach its window of
scores, and is scored there, in integers, only against the run of rows whose
own bounds do.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, tidied
from .knn import _matrix, _products, _widen

#: Reference directions, and ranges of angles of each, at most; and rows for
#: each of them.
MOST_REFERENCES, MOST_RANGES = 32, 16
ROWS_PER_REFERENCE, ROWS_PER_RANGE = 20_000, 10_000
#: Labels are told apart modulo this number in cells.
LABELS = 64
#: Rows of a block of a cell, and anchors that visit it together, at most.
MOST_ROWS, MOST_ANCHORS = 16_384, 8_192
#: By this much all angles are widened: far more than rounding.
SLACK = 1e-5
#: Score of what is not wanted.
_NO = np.iinfo(np.int64).min


def labelled(vectors: DataFrame, label: Column, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, label, v): floor(scale * x) of each component x as double.  Rows
    without an id, a label or a vector, or with a null or non-finite
    component, are left out."""
    v = F.col(vector)
    whole = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(whole & F.col(vec_id).isNotNull())
            .select(F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
            .where("label is not null"))


def _angles(x: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the references (of length 1; a zero vector: a right angle)."""
    dim = max(x.shape[1], references.shape[1])
    x, r = _widen(x, dim).astype(np.float64), _widen(references, dim)
    norm = np.sqrt((x * x).sum(1))
    return norm, np.arccos(np.clip((x @ r.T) / np.maximum(norm, 1e-300)[:, None], -1, 1))


def _score_bounds(norm: np.ndarray, angle: np.ndarray, least: np.ndarray, most: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of anchors (norm, angle to the reference) with
    rows of angles in [least, most] and norms in [low, high]."""
    near = np.cos(np.maximum(0, np.maximum(least - angle, angle - most) - SLACK))
    far = np.cos(np.minimum(math.pi, angle + most + SLACK))
    slack = 1 + 1e-9 * norm * high
    upper = norm * np.where(near > 0, high, low) * near + slack
    lower = norm * np.where(far > 0, low, high) * far - slack
    return lower, upper


def _run(angles: np.ndarray, norm: np.ndarray, angle: np.ndarray, low: float, high: float, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For anchors that want scores in [least, most]: the run of rows (of
    ascending angles to the reference, norms in [low, high]) that may have them."""
    with np.errstate(divide="ignore", invalid="ignore"):
        # beyond `wide` from the anchor the cosine is too small
        size = np.where(least > 0, high, low) * norm
        wide = np.arccos(np.clip((least - 1) / size * (1 - 1e-9 * np.sign(least)), -1, 1))
        wide = np.where((size > 0) & (least - 1 > -size), wide, math.pi)
        # within `close` of the reference the cosine of the sum is too large
        size = np.where(most > 0, low, high) * norm
        close = np.arccos(np.clip((most + 1) / size * (1 + 1e-9 * np.sign(most)), -1, 1))
        close = np.where((size > 0) & (most + 1 < size) & (most > 0), close, 0)
    begin = np.searchsorted(angles, np.maximum(angle - wide, close - angle) - SLACK, "left")
    return begin, np.maximum(begin, np.searchsorted(angles, angle + wide + SLACK, "right"))


def _best(s: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the k largest scores of each anchor, ties to smaller ids."""
    bar = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] if s.shape[1] > k else np.full(len(s), _NO)
    a, r = np.nonzero((s >= bar[:, None]) & (s > _NO))
    order = np.lexsort((ids[r], -s[a, r], a))
    a, r = a[order], r[order]
    place = np.arange(len(a)) - np.searchsorted(a, a, "left")
    return a[place < k], r[place < k]


class Cells:
    """Rows dealt to cells, with the cells' summaries: a bounded number of
    cells, whatever the table."""

    def __init__(self, rows: DataFrame, references: np.ndarray, ranges: int):
        spark = rows.sparkSession
        self.references, self.ranges = references, ranges

        @tidied
        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, 4096):
                    part = b.slice(at, 4096)
                    norm, angle = _angles(_matrix(part.column(2)), references)
                    near = angle.argmin(1)
                    angle = angle[np.arange(len(near)), near]
                    bucket = part.column(1).to_numpy() % LABELS
                    cell = (bucket * len(references) + near) * ranges + np.minimum((angle / math.pi * ranges).astype(np.int64), ranges - 1)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(norm), pa.array(angle), pa.array(cell.astype(np.int32))],
                                                     names=["id", "label", "v", "norm", "angle", "cell"])

        self.rows = stage(rows.select("id", "label", "v").mapInArrow(place, "id long, label long, v array<long>, norm double, angle double, cell int"), "cells")
        summary = (self.rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("angle"), F.max("angle"), F.min("norm"), F.max("norm"), F.min("label"), F.max("label"))
                   .orderBy("cell").collect())  # at most LABELS x MOST_REFERENCES x MOST_RANGES rows of eight numbers
        self.cell, self.n = (np.array([r[k] for r in summary], np.int64) for k in (0, 1))
        self.least, self.most, self.low, self.high = (np.array([r[k] for r in summary], np.float64) for k in (2, 3, 4, 5))
        self.first_label, self.last_label = (np.array([r[k] for r in summary], np.int64) for k in (6, 7))
        self.blocks = -(-self.n // MOST_ROWS)
        # only cells of more than one block need a number drawn; as many rows as cells at most
        large = F.broadcast(spark.createDataFrame([(int(c), int(b)) for c, b in zip(self.cell, self.blocks, strict=True) if b > 1], "cell int, blocks int"))
        self.dealt = (self.rows.join(large, "cell", "left")
                      .withColumn("block", F.coalesce(F.pmod(F.xxhash64("id", F.lit(13)), F.col("blocks")), F.lit(0)).cast("int")).drop("blocks"))

    def visits(self, anchors: DataFrame, wanted: Callable, extra: str) -> DataFrame:
        """``anchors`` (id, label, v, and the columns ``extra``) by the blocks they
        visit, with ``least``: ``wanted`` takes a batch and the bounds of its
        scores in all cells, and says which cells count, and the least score
        that may matter to an anchor."""
        references, cell, blocks = self.references, self.cell, self.blocks
        bounds = self.least, self.most, self.low, self.high
        near = cell // self.ranges % len(references)
        names = [*anchors.columns, "least", "cell", "block"]

        @tidied
        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, 64):
                    part = b.slice(at, 64)
                    norm, angle = _angles(_matrix(part.column(2)), references)
                    lower, upper = _score_bounds(norm[:, None], angle[:, near], *(x[None, :] for x in bounds))
                    visited, least = wanted(part, lower, upper)
                    row, to = np.nonzero(visited)
                    copies = blocks[to]
                    row, to = np.repeat(row, copies), np.repeat(to, copies)
                    block = np.arange(len(to)) - np.repeat(np.cumsum(copies) - copies, copies)
                    for i in range(0, len(row), 4096):
                        j = slice(i, i + 4096)
                        yield pa.RecordBatch.from_arrays([*(c.take(pa.array(row[j])) for c in part.columns), pa.array(least[row[j]]),
                                                          pa.array(cell[to[j]].astype(np.int32)), pa.array(block[j].astype(np.int32))], names=names)

        return anchors.mapInArrow(route, f"id long, label long, v array<long>, {extra}, least double, cell int, block int")

    def solved(self, visits: DataFrame, solve: Callable, schema: str) -> DataFrame:
        """``solve`` (rows, anchors) of each block with the anchors that visit
        it.  Blocks with many visitors are copied once for each MOST_ANCHORS
        of them; blocks that none visits aren't copied at all."""
        visits = stage(visits, "visits")
        parts = (visits.groupBy("cell", "block").agg(F.ceil(F.count("*") / MOST_ANCHORS).cast("int").alias("parts")))
        by = ["cell", "block"]
        held = (self.dealt.join(parts, by).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                .select("id", "label", "v", "norm", "angle", *by, "part"))
        asked = visits.join(parts, by).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")
        references, ranges, names = self.references, self.ranges, [x.split()[0] for x in schema.split(", ")]

        def run(key, found: pa.Table, anchors: pa.Table) -> pa.Table:
            out = [np.empty(0, np.int64) for _ in names]
            if found.num_rows and anchors.num_rows:
                ref = references[key[0].as_py() // ranges % len(references)][None, :]
                found = found.take(np.argsort(found["angle"].to_numpy(), kind="stable"))
                rows = {"id": found["id"].to_numpy(), "label": found["label"].to_numpy(), "v": _matrix(found["v"]), "angle": found["angle"].to_numpy(),
                        "low": found["norm"].to_numpy().min(), "high": found["norm"].to_numpy().max()}
                norm, angle = (np.concatenate(x) for x in zip(*(_angles(_matrix(anchors["v"].slice(i, 1024)), ref) for i in range(0, anchors.num_rows, 1024)), strict=True))
                order = np.argsort(angle[:, 0], kind="stable")
                step = max(1, (1 << 20) // len(rows["id"]))  # scores held at once
                got = [solve(rows, anchors.take(order[i:i + step]), norm[order[i:i + step]], angle[order[i:i + step], 0]) for i in range(0, len(order), step)]
                out = [np.concatenate(x) for x in zip(*got, strict=True)]
            return pa.table(dict(zip(names, out, strict=True)))

        return held.groupBy(*by, "part").cogroup(asked.groupBy(*by, "part")).applyInArrow(run, schema)


def _scores(rows: dict, anchors: pa.Table, norm: np.ndarray, angle: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, slice]:
    """Integer scores of the run of rows that the anchors may want, _NO outside
    of an anchor's own run."""
    begin, end = _run(rows["angle"], norm, angle, rows["low"], rows["high"], least, most)
    at = slice(int(begin.min()), int(end.max()))
    place = np.arange(at.start, at.stop)
    s = _products(_matrix(anchors["v"]), rows["v"][at])
    return np.where((place >= begin[:, None]) & (place < end[:, None]), s, _NO), at


def positives(cells: Cells, anchors: DataFrame, k: int) -> DataFrame:
    """(anchor, rank, id, score): the k best other rows of an anchor's label.
    ``anchors``: (id, label, v, copies), copies: how many rows have its id."""
    cell, n, first, last = cells.cell, cells.n, cells.first_label, cells.last_label
    bucket = cell // cells.ranges // len(cells.references)

    def wanted(part: pa.RecordBatch, lower: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        label, copies = part.column(1).to_numpy()[:, None], part.column(3).to_numpy()[:, None]
        own = bucket == label % LABELS
        # k rows of the label, beside the anchor's own, set the bar
        sure = np.where(own & (first == label) & (last == label), lower, -np.inf)
        order = np.argsort(-sure, axis=1)
        there = np.cumsum(n[order], axis=1) >= k + copies
        at = np.where(there.any(1), there.argmax(1), len(n) - 1)
        bar = np.take_along_axis(sure, np.take_along_axis(order, at[:, None], 1), 1)
        bar = np.where(there.any(1)[:, None], np.maximum(bar, -(2.0**62)), -(2.0**62))
        return own & (upper >= bar), bar[:, 0]

    def solve(rows: dict, part: pa.Table, norm: np.ndarray, angle: np.ndarray):
        s, at = _scores(rows, part, norm, angle, part["least"].to_numpy(), np.full(len(norm), 2.0**62))
        ids = part["id"].to_numpy()
        s[(rows["label"][at] != part["label"].to_numpy()[:, None]) | (rows["id"][at] == ids[:, None])] = _NO
        a, r = _best(s, rows["id"][at], k)
        return ids[a], rows["id"][at][r], s[a, r]

    visits = cells.visits(anchors.select("id", "label", "v", "copies"), wanted, "copies long")
    w = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    return (cells.solved(visits, solve, "anchor long, id long, score long")
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k))


def mine(rows: DataFrame, anchors: DataFrame, k: int = 5, n_positives: int = 5, percent: tuple[int, int] = (80, 100)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each row of ``anchors`` and each of its best
    ``n_positives`` other rows of the same label, the k best rows of another
    label whose score is from percent[0] to percent[1] hundredths of the
    positive's.  Both tables: (id, label, v), see ``labelled``; scores are
    integer inner products and must fit into 55 bits; ties go to the smaller
    id.  ``anchors`` are rows of ``rows``, all that have their ids.  Vectors
    of other lengths count as filled up with zeros.

    Fewer where there are fewer; none where a positive's score is below 0.  A
    row of the anchor's id is never its positive or negative.  Rows that come
    twice are rows of their own among positives and negatives; of anchors of
    one id the one with the smallest label and vector counts.  An empty table
    gives an empty result.
    """
    spark = rows.sparkSession
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("id"), "id", "label", "v").limit(min(MOST_REFERENCES, max(1, n // ROWS_PER_REFERENCE)))
    references = [r.v for r in sample.select("v").collect()]
    if not references:
        return spark.createDataFrame([], result)
    x = _matrix(pa.array(references, pa.list_(pa.int64()))).astype(np.float64)
    norm = np.sqrt((x * x).sum(1))
    x = x[norm > 0] / norm[norm > 0, None]
    if not len(x):  # only zero vectors in the sample: any direction will do
        x = np.ones((1, 1))
    cells = Cells(rows, x, min(MOST_RANGES, max(1, n // ROWS_PER_RANGE)))
    anchors = (anchors.groupBy("id").agg(F.min(F.struct("label", "v")).alias("a"), F.count("*").alias("copies"))
               .select("id", "a.label", "a.v", "copies"))
    low, high = percent
    first, last = cells.first_label, cells.last_label
    found = stage(positives(cells, anchors, n_positives), "positives")
    windows = (found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", F.col("id").alias("positive"), "score"))).alias("p"))
               .select("anchor", F.transform("p", lambda p: p["score"]).alias("scores")))
    asked = anchors.join(windows, F.col("id") == F.col("anchor")).select("id", "label", "v", "scores")

    def limits(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the windows: whole numbers from low to high hundredths."""
        return -(-scores * low // 100), scores * high // 100

    def wanted(part: pa.RecordBatch, lower: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p, there = _padded(part.column(3), n_positives)
        a, b = limits(p)
        label = part.column(1).to_numpy()[:, None]
        other = (first != label) | (last != label)
        there &= a <= b
        hit = np.zeros(lower.shape, bool)
        for i in range(n_positives):
            hit |= there[:, i:i + 1] & (upper >= a[:, i:i + 1]) & (lower <= b[:, i:i + 1])
        return other & hit, np.where(there, a, 2**62).min(1).astype(np.float64)

    def solve(rows: dict, part: pa.Table, norm: np.ndarray, angle: np.ndarray):
        p, there = _padded(part["scores"], n_positives)
        a, b = limits(p)
        there &= a <= b
        s, at = _scores(rows, part, norm, angle, part["least"].to_numpy(), np.where(there, b, -(2**62)).max(1).astype(np.float64))
        ids = part["id"].to_numpy()
        s[(rows["label"][at] == part["label"].to_numpy()[:, None]) | (rows["id"][at] == ids[:, None])] = _NO
        out = []
        for i in range(n_positives):
            w = np.where(there[:, i:i + 1] & (s >= a[:, i:i + 1]) & (s <= b[:, i:i + 1]), s, _NO)
            x, r = _best(w, rows["id"][at], k)
            out.append((ids[x], np.full(len(x), i + 1), rows["id"][at][r], s[x, r]))
        return [np.concatenate(x) for x in zip(*out, strict=True)]

    local = cells.solved(cells.visits(asked, wanted, "scores array<long>"), solve, "anchor long, positive long, id long, score long")
    w = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    best = local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    p = found.select(F.col("anchor").alias("_a"), F.col("rank").alias("_r"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (best.join(p, (F.col("anchor") == F.col("_a")) & (F.col("positive") == F.col("_r")))
            .select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def _padded(lists: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists as rows of a matrix, and where it has values."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    n = np.diff(lists.offsets.to_numpy())
    there = np.arange(width) < n[:, None]
    out = np.zeros((len(n), width), np.int64)
    out[there] = lists.flatten().to_numpy(zero_copy_only=False)
    return out, there
