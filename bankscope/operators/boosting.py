"""Gradient-boosted trees whose rows and columns are drawn per tree.

MLlib draws columns per node and fits residuals; here each tree is grown on
its own seeded share of the columns and rows, with second-order leaves
(-G / (H + 1)).  Features are binned once.  A level of a tree is one pass: every
task adds up the gradients of its rows by (node, column, bin) and Spark sums
those tables; the driver sees them summed, as many cells as nodes x columns x
bins, and picks the splits.  A table of at most ``AT_ONCE`` rows is the work of
one task instead (the trees are the same).  Gradients are whole numbers of a fixed unit, so
that sums, and with them the trees, do not depend on the partitioning.

There are thousands of passes, so each is one small job without a plan of its
own, over blocks of rows (an array a column) that are persisted with the
margin of every row (the sum of the trees so far), anew after each tree.  What a
tree is grown on (its columns and rows, with their gradients) is persisted
beside them for the passes of its levels.  Of two children a pass adds up the
lighter one; the other has what is left of their parent's cells.
Every ``EVERY`` trees the blocks are checkpointed, which cuts lineage.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stages import delete, materialize, release

# Functions that run in tasks travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bins of a column at most, and the accuracy of their edges (see percentile_approx).
BINS, ACCURACY = 256, 10_000
#: Trees between two checkpoints of the blocks.
EVERY = 20
#: Tasks up to which the driver adds up their tables by itself.
FEW = 32
#: Rows up to which one task grows all trees (about 40 bytes a row): passes
#: over so little would be nothing but the starts of jobs.
AT_ONCE = 1 << 18
#: Rows of a batch that are added up in floating point: exact below 2**53.
_ROWS = 1 << 20
#: Rows of a block, and of a task of a pass at least: fewer take less time than its start.
_BLOCK, _TASK = 1 << 16, 1 << 17
#: Weight of the leaves' squares, and the least curvature of a child.
LAMBDA, LEAST_WEIGHT = 1.0, 1.0


@dataclass(frozen=True)
class Settings:
    """Of a model; ``loss``: "logistic" (labels 0 and 1) or "squared"."""

    loss: str
    trees: int = 300
    depth: int = 6
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = 42


@dataclass
class Tree:
    """Node i has the children 2i + 1 (value <= threshold) and 2i + 2; a leaf
    has no column (-1)."""

    column: np.ndarray
    threshold: np.ndarray
    #: the last bin on the left
    bin: np.ndarray
    value: np.ndarray

    def leaves(self, x: np.ndarray, by: np.ndarray, levels: int, columns: np.ndarray | None = None) -> np.ndarray:
        """Where rows (values or bins) end after so many levels; ``by``:
        threshold or bin; ``x``: an array for each of ``columns`` (of all)."""
        split, own = self.column >= 0, np.arange(len(self.column))
        at = np.where(split, self.column if columns is None else np.searchsorted(columns, self.column), 0).astype(np.int64) * x.shape[1]
        # a row stays at a leaf: nothing is above its limit
        limit = np.where(split, by, np.inf if by.dtype.kind == "f" else BINS - 1).astype(x.dtype)
        left, flat, row = np.where(split, 2 * own + 1, own), np.ascontiguousarray(x).ravel(), np.arange(x.shape[1])
        node = np.zeros(x.shape[1], np.int64)
        for _ in range(levels):
            node = left.take(node) + (flat.take(at.take(node) + row) > limit.take(node))
        return node


@dataclass
class TreeModel:
    """A fitted model; ``transform`` adds its prediction."""

    columns: list[str]
    settings: Settings
    base: float
    unit: float
    trees: list[Tree] = field(default_factory=list)

    def _values(self, x: np.ndarray) -> np.ndarray:
        m = np.full(x.shape[1], self.base)
        for t in self.trees:
            m += t.value[t.leaves(x, t.threshold, self.settings.depth)]
        return 1 / (1 + np.exp(-m)) if self.settings.loss == "logistic" else m * self.unit

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """``df`` with the probability of class 1, or the predicted value."""
        given, n, model = df.columns, len(df.columns), self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns[n:]])
                yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(model._values(x))], names=[*given, output])

        asked = df.select("*", *[F.col(c).cast("double").alias(f"_x_{i}") for i, c in enumerate(self.columns)])
        return asked.mapInArrow(run, df.withColumn(output, F.lit(0.0).cast("double")).schema)

    def save(self, spark: SparkSession, path: str) -> str:
        """The nodes as a Parquet table; what else there is as JSON."""
        rows = [(t, i, int(c), float(tree.threshold[i]), int(tree.bin[i]), float(tree.value[i]))
                for t, tree in enumerate(self.trees) for i, c in enumerate(tree.column) if c >= 0 or tree.value[i]]
        meta = json.dumps({"columns": self.columns, "settings": vars(self.settings), "base": self.base, "unit": self.unit, "n_trees": len(self.trees)})
        nodes = spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, bin int, value double")
        nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        # written last: a model without it is not whole
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        settings = Settings(**meta["settings"])
        out = cls(meta["columns"], settings, meta["base"], meta["unit"], [_empty(settings.depth) for _ in range(meta["n_trees"])])
        for r in spark.read.parquet(f"{path}/nodes").collect():  # at most trees x 2^(depth + 1) rows
            t = out.trees[r.tree]
            t.column[r.node], t.threshold[r.node], t.bin[r.node], t.value[r.node] = r.feature, r.threshold, r.bin, r.value
        return out


def _empty(depth: int) -> Tree:
    n = 2 ** (depth + 1) - 1
    return Tree(np.full(n, -1, np.int16), np.zeros(n), np.zeros(n, np.int16), np.zeros(n))


def bin_edges(df: DataFrame, columns: Sequence[str]) -> list[np.ndarray]:
    """Of each column the values that end its bins: quantiles that occur in it."""
    share = F.array(*[F.lit(k / BINS) for k in range(1, BINS)])
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), share, ACCURACY).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return [np.unique(np.array(q or [], np.float64)) for q in row]


def _drawn(key: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows a tree is grown on."""
    with np.errstate(over="ignore"):
        x = key.view(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + tree * 0xD1B54A32D192ED03) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)) < np.uint64(int(share * 2**53))


def _gradients(loss: str, margin: np.ndarray, y: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives, in units of 2**-bits."""
    if loss == "logistic":
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
    else:
        g, h = margin - y, np.ones(len(y))
    return np.rint(g * 2.0**bits), np.rint(h * 2.0**bits)


_STATE = "key long, y double, bins binary"


def _bins(state: pa.RecordBatch) -> np.ndarray:
    """Bins of the rows of a stage, an array for each column."""
    raw, at = state.column("bins").buffers()[2], state.column("bins").offset
    width = len(state.column("bins")[0].as_py())
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8)[at * width:(at + state.num_rows) * width].reshape(-1, width).T)


def _columns(s: Settings, number: int, n: int) -> np.ndarray:
    """The columns that a tree is grown on."""
    return np.sort(np.random.default_rng([s.seed, number]).permutation(n)[:max(1, int(s.column_share * n))])


def _grown_on(key: np.ndarray, y: np.ndarray, x: np.ndarray, m: np.ndarray, s: Settings, number: int, columns: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """What a tree is grown on: bins, gradients and curvatures."""
    here = np.flatnonzero(_drawn(key, s.seed, number, s.row_share))
    return np.stack([x[c].take(here) for c in columns]), *_gradients(s.loss, m.take(here), y.take(here), bits)


def _add(total: np.ndarray, x: np.ndarray, g: np.ndarray, h: np.ndarray, tree: Tree, level: int, columns: np.ndarray, place: np.ndarray) -> None:
    """Add the gradients and curvatures of some rows to the cells of those
    nodes of a level that have a place."""
    size = total.shape[1] * BINS
    for i in range(0, len(g), _ROWS):
        j = slice(i, i + _ROWS)
        to = place.take(tree.leaves(x[:, j], tree.bin, level, columns))
        rows = np.flatnonzero(to >= 0)
        first = to.take(rows) * BINS
        values = [v[j].take(rows) for v in (g, h)]
        for k in range(len(columns)):
            slot = first + x[k, j].take(rows)
            for part, v in enumerate(values):
                total[part, :, k] += np.bincount(slot, v, size).astype(np.int64).reshape(-1, BINS)


def _grow(s: Settings, edges: list[np.ndarray], columns: np.ndarray, bits: int, cells: Callable[[Tree, int, np.ndarray], np.ndarray]) -> Tree:
    """A tree; ``cells`` adds up those of the nodes of a level that have a place."""
    tree = _empty(s.depth)
    place, parents = np.full(len(tree.column), -1), np.zeros((2, 0, len(columns), BINS), np.int64)
    place[0] = 0
    for level in range(s.depth):
        some, first = cells(tree, level, place), 2**level - 1
        whole = np.zeros((2, 2**level, *some.shape[2:]), np.int64)
        for node in np.flatnonzero(place >= 0):
            whole[:, node - first] = some[:, place[node]]
            if node:
                other = ((node - 1) ^ 1) + 1
                whole[:, other - first] = parents[:, (node - 1) // 2 - 2**(level - 1) + 1] - some[:, place[node]]
        if not _split(whole, tree, level, columns, edges, s, bits):
            break
        place, parents = np.full(len(tree.column), -1), whole
        for i, node in enumerate(first + np.flatnonzero(tree.column[first:first + 2**level] >= 0)):
            weight = whole[1, node - first, np.searchsorted(columns, tree.column[node])]
            left = weight[:tree.bin[node] + 1].sum()
            place[2 * node + (1 if left <= weight.sum() - left else 2)] = i
    return tree


def _blocks(state: DataFrame, base: float, tasks: int) -> RDD:
    """The rows of a stage as blocks (key, y, bins, margin) of bytes."""

    def joined(some: list[tuple]) -> pa.RecordBatch:
        one = [np.concatenate(v, axis=-1) for v in zip(*some, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (*one, np.full(len(one[0]), base))], names=["key", "y", "bins", "margin"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[tuple] = []
        for b in batches:
            if b.num_rows:
                some.append((b.column("key").to_numpy(), b.column("y").to_numpy(), _bins(b)))
            if sum(len(v[0]) for v in some) >= _BLOCK:
                yield joined(some)
                some = []
        if some:
            yield joined(some)

    packed = state.coalesce(tasks).mapInArrow(run, "key binary, y binary, bins binary, margin binary")
    return packed.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)


def _arrays(block: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, labels, bins and margins of a block."""
    key = np.frombuffer(block[0], np.int64)
    return key, np.frombuffer(block[1]), np.frombuffer(block[2], np.uint8).reshape(-1, len(key)), np.frombuffer(block[3])


def _after(blocks: RDD, tree: Tree, depth: int) -> RDD:
    """The blocks with the margins that they have after one more tree."""

    def moved(block: tuple) -> tuple:
        _, _, x, m = _arrays(block)
        return *block[:3], (m + tree.value.take(tree.leaves(x, tree.bin, depth))).tobytes()

    return blocks.map(moved).persist(StorageLevel.MEMORY_AND_DISK)


def _sample(blocks: RDD, s: Settings, number: int, columns: np.ndarray, bits: int) -> RDD:
    """Of each block what a tree is grown on, as bytes."""
    return blocks.map(lambda b: tuple(v.tobytes() for v in _grown_on(*_arrays(b), s, number, columns, bits)))


def _cells(sample: RDD, tree: Tree, level: int, columns: np.ndarray, place: np.ndarray, few: bool) -> np.ndarray:
    """Gradients and curvatures of those nodes of a level that have a place,
    by (node, column, bin): one pass."""
    shape = (2, int(place.max()) + 1, len(columns), BINS)

    def run(rows: Iterator[tuple]) -> Iterator[np.ndarray]:
        total = np.zeros(shape, np.int64)
        for r in rows:
            g, h = np.frombuffer(r[1]), np.frombuffer(r[2])
            _add(total, np.frombuffer(r[0], np.uint8).reshape(len(columns), -1), g, h, tree, level, columns, place)
        yield total

    parts = sample.mapPartitions(run)
    return sum(parts.collect(), np.zeros(shape, np.int64)) if few else parts.treeReduce(np.add)


def _grown_at_once(state: DataFrame, base: float, s: Settings, edges: list[np.ndarray], bits: int) -> list[Tree]:
    """All trees of a table of a few rows, grown in one task: the same ones as
    by passes, as all sums are whole numbers."""
    names = ("column", "threshold", "bin", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = [(b.column("key").to_numpy(), b.column("y").to_numpy(), _bins(b)) for b in batches if b.num_rows]
        key, y, x = (np.concatenate(v, axis=-1) for v in zip(*some, strict=True))
        m = np.full(len(y), base)
        for number in range(s.trees):
            columns = _columns(s, number, len(x))
            sample = _grown_on(key, y, x, m, s, number, columns, bits)

            def cells(tree: Tree, level: int, place: np.ndarray) -> np.ndarray:
                total = np.zeros((2, int(place.max()) + 1, len(columns), BINS), np.int64)  # noqa: B023
                _add(total, *sample, tree, level, columns, place)  # noqa: B023
                return total

            tree = _grow(s, edges, columns, bits, cells)
            m = m + tree.value.take(tree.leaves(x, tree.bin, s.depth))
            yield pa.RecordBatch.from_arrays([pa.array([number]), *[pa.array([getattr(tree, c).tobytes()], pa.binary()) for c in names]], names=["number", *names])

    rows = state.coalesce(1).mapInArrow(run, "number long, " + ", ".join(f"{c} binary" for c in names)).collect()  # a row of a few KB for each tree
    like = _empty(s.depth)
    return [Tree(*[np.frombuffer(r[c], getattr(like, c).dtype).copy() for c in names]) for r in sorted(rows, key=lambda r: r.number)]


def _split(cells: np.ndarray, tree: Tree, level: int, columns: np.ndarray, edges: list[np.ndarray], s: Settings, bits: int) -> bool:
    """Set the best split of each node of a level, and its children's values;
    whether any node was split."""
    g, h = cells.astype(np.float64) / 2.0**bits
    left_g, left_h = g.cumsum(2), h.cumsum(2)
    all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g**2 / (left_h + LAMBDA) + right_g**2 / (right_h + LAMBDA) - all_g**2 / (all_h + LAMBDA)
    gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = -np.inf
    first, any_ = 2**level - 1, False
    if level == 0:
        tree.value[0] = -s.rate * all_g[0, 0, 0] / (all_h[0, 0, 0] + LAMBDA)
    for k in range(len(gain)):
        node = first + k
        if node and tree.column[(node - 1) // 2] < 0:
            continue
        best = int(gain[k].argmax())
        c, b = divmod(best, BINS)
        if not gain[k, c, b] > 1e-6 or b >= len(edges[columns[c]]):
            continue
        any_ = True
        tree.column[node], tree.bin[node], tree.threshold[node], tree.value[node] = columns[c], b, edges[columns[c]][b], 0
        tree.value[2 * node + 1] = -s.rate * left_g[k, c, b] / (left_h[k, c, b] + LAMBDA)
        tree.value[2 * node + 2] = -s.rate * right_g[k, c, b] / (right_h[k, c, b] + LAMBDA)
    return any_


def fit(train: DataFrame, columns: Sequence[str], label: str, settings: Settings, key: str = "customer_id", at_once: int = AT_ONCE) -> TreeModel:
    """A model of ``label`` by numeric ``columns``.  ``key`` draws the rows of
    each tree.  Up to ``at_once`` rows are one task's work, more are searched
    by one pass for each level; the trees are the same.  Rows without a label are left out, missing values count as 0;
    of no rows the model is a constant 0 (logistic: one half)."""
    columns, s = list(columns), settings
    given = train.where(F.col(label).isNotNull()).select(F.xxhash64(key).alias("key"), F.col(label).cast("double").alias("y"),
                                                         *[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(columns)])
    raw = materialize(given, "trees-rows")
    names = [f"x{i}" for i in range(len(columns))]
    total = raw.agg(F.count("*").alias("n"), F.sum(F.col("y").cast("decimal(38,6)")).alias("sum"), F.max(F.abs("y")).alias("most")).first()
    if not total.n:
        release(raw)
        return TreeModel(columns, s, 0.0, 1.0)
    mean = float(total["sum"]) / total.n
    if s.loss == "logistic":
        unit, mean = 1.0, min(max(mean, 1e-6), 1 - 1e-6)
        base = float(np.log(mean / (1 - mean)))
    else:
        unit = float(total.most) or 1.0
        base = mean / unit
    bits = min(30, 60 - int(total.n).bit_length())
    edges = bin_edges(raw, names)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([np.searchsorted(e, c.to_numpy(zero_copy_only=False), "left") for e, c in zip(edges, b.columns[2:], strict=True)], axis=1).astype(np.uint8)
            bins = pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.shape[1]), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(b.column(1).to_numpy() / unit), bins], names=["key", "y", "bins"])

    spark = raw.sparkSession
    cores = spark.sparkContext.defaultParallelism
    spread = raw if total.n <= at_once or raw.rdd.getNumPartitions() >= cores else raw.repartition(cores)
    state = materialize(spread.mapInArrow(binned, _STATE), "trees-state")
    release(raw)
    if total.n <= at_once:
        trees = _grown_at_once(state, base, s, edges, bits)
        release(state)
        return TreeModel(columns, s, base, unit, trees)
    blocks, before, files = _blocks(state, base, -(-total.n // _TASK)), None, []
    few = blocks.getNumPartitions() <= FEW
    model = TreeModel(columns, s, base, unit)
    for number in range(s.trees):
        if number and number % EVERY == 0:
            blocks.checkpoint()
        drawn = _columns(s, number, len(columns))
        sample = _sample(blocks, s, number, drawn, bits)

        def cells(tree: Tree, level: int, place: np.ndarray) -> np.ndarray:
            if level == 1:
                sample.persist(StorageLevel.MEMORY_AND_DISK)  # noqa: B023
            found = _cells(sample, tree, level, drawn, place, few)  # noqa: B023
            if level == 0 and before is not None:  # the first pass has made the blocks that follow  # noqa: B023
                before.unpersist()  # noqa: B023
            return found

        tree = _grow(s, edges, drawn, bits, cells)
        if number and number % EVERY == 0:
            for f in files:
                delete(spark, f)
            files = [blocks.getCheckpointFile()]
        sample.unpersist()
        model.trees.append(tree)
        before = blocks
        if number + 1 < s.trees:
            blocks = _after(blocks, tree, s.depth)
    before.unpersist()
    for f in files:
        delete(spark, f)
    release(state)
    return model
