"""Exact top-k search by inner product as a Voronoi join.

Data and queries are grouped by their nearest pivot.  Summaries of the data
groups (radius, the smallest distances to the pivot) bound the scores that a
group of queries can reach in a group of data from both sides; a query is
handed only to the groups of data that may hold one of its k best, and is
solved there against blocks of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Pivots at most, however large the table; they and the summaries of their
#: groups (a few numbers each) are all that comes to the driver.
MOST_PIVOTS = 128
#: Rows of a block of data, and of a block of queries, at most.
MOST_ROWS = 20_000


def integers(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, v): floor(scale * x) of each component x as double.  Rows whose
    vector is null, or has a null or non-finite component, are left out."""
    v = F.col(vector)
    whole = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(whole).select(F.col(vec_id).alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def _matrix(v: pa.Array, dim: int = 0) -> np.ndarray:
    """Rows of int64; shorter vectors are filled up with zeros."""
    if isinstance(v, pa.ChunkedArray):
        v = v.combine_chunks()
    n = np.diff(v.offsets.to_numpy())
    flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    dim = max(dim, int(n.max(initial=0)))
    if len(n) and (n == dim).all():
        return flat.reshape(len(n), dim)
    out = np.zeros((len(n), dim), np.int64)
    out[np.arange(dim) < n[:, None]] = flat
    return out


def _widen(a: np.ndarray, dim: int) -> np.ndarray:
    return a if a.shape[1] >= dim else np.pad(a, ((0, 0), (0, dim - a.shape[1])))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point while they stay under 2**53."""
    dim = max(a.shape[1], b.shape[1])
    a, b = _widen(a, dim), _widen(b, dim)
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(dim, 1) < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    dim = max(x.shape[1], pivots.shape[1])
    x, p = _widen(x, dim).astype(np.float64), _widen(pivots, dim).astype(np.float64)
    cell = ((p * p).sum(1) - 2 * (x @ p.T)).argmin(1)
    return cell, np.sqrt(((x - p[cell]) ** 2).sum(1))


def _grouped(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, v, cell, dist) by the nearest pivot."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                cell, dist = _nearest(_matrix(part.column(1)), pivots)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(dist)],
                                                 names=["id", "v", "cell", "dist"])

    return vectors.select("id", "v").mapInArrow(assign, "id long, v array<long>, cell int, dist double")


def _routes(pivots: np.ndarray, cells: np.ndarray, radius: np.ndarray, near: list[list[float]], k: int):
    """For a matrix of queries: which data groups may hold one of the k best
    of each.  The k + 1 best lower bounds count, as a query's own row is no
    candidate."""
    p = pivots[cells].astype(np.float64)
    owner = np.repeat(np.arange(len(cells)), [len(x) for x in near])
    least = np.array([d for x in near for d in x])

    def survivors(q: np.ndarray) -> np.ndarray:
        dim = max(q.shape[1], p.shape[1])
        q, c = _widen(q, dim).astype(np.float64), _widen(p, dim)
        score, length = q @ c.T, np.sqrt((q * q).sum(1))[:, None]
        lower = score[:, owner] - length * least
        if lower.shape[1] > k:
            bar = np.partition(lower, lower.shape[1] - k - 1, axis=1)[:, lower.shape[1] - k - 1]
        else:
            bar = np.full(len(q), -np.inf)
        slack = 1e-6 * (1 + np.abs(score).max(initial=0))
        return score + length * radius + slack >= bar[:, None]

    return survivors


def top_k(data: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, id, score): the k rows of ``data`` (id, v) with the
    largest inner products with each row of ``queries`` (id, v), without the
    row of the query's own id; ties go to the smaller id.  Fewer rows where
    ``data`` has fewer.  Scores must fit into 64 bits.  Vectors of other
    lengths count as filled up with zeros.  Rows without an id or a vector
    take no part.  Rows of ``data`` with one id are candidates of their own;
    of queries with one id the smallest vector is asked for."""
    spark = data.sparkSession
    data = data.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    queries = queries.where(F.col("id").isNotNull() & F.col("v").isNotNull()).groupBy("id").agg(F.min("v").alias("v"))
    n, n_queries = data.count(), queries.count()
    sample = data.orderBy(F.xxhash64("id"), "id").limit(min(MOST_PIVOTS, max(1, math.isqrt(n) // 2)))
    pivots = _matrix(pa.array([r.v for r in sample.select("v").collect()], pa.list_(pa.int64())))
    if not len(pivots):
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    # blocks small enough for every task to have some, and of bounded size
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = max(64, min(MOST_ROWS, n // (4 * tasks)))
    grouped = _grouped(data, pivots)
    # a row, and k + 1 rows, for each pivot
    summary = grouped.groupBy("cell").agg(F.count("*").alias("n"), F.max("dist").alias("radius")).orderBy("cell").collect()
    closest = Window.partitionBy("cell").orderBy("dist")
    near: dict[int, list[float]] = {r.cell: [] for r in summary}
    for r in (grouped.select("cell", "dist", F.row_number().over(closest).alias("r")).where(F.col("r") <= k + 1).collect()):
        near[r.cell].append(r.dist)
    cells = np.array([r.cell for r in summary])
    blocks = np.array([-(-r.n // rows) for r in summary])
    survivors = _routes(pivots, cells, np.array([r.radius for r in summary]), [near[c] for c in cells], k)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                row, to = np.nonzero(survivors(_matrix(part.column(1))))
                copies = blocks[to]
                row, to = np.repeat(row, copies), np.repeat(to, copies)
                block = np.arange(len(to)) - np.repeat(np.cumsum(copies) - copies, copies)
                for i in range(0, len(row), 8192):
                    j = slice(i, i + 8192)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(row[j])), part.column(1).take(pa.array(row[j])),
                         pa.array(cells[to[j]].astype(np.int32)), pa.array(block[j].astype(np.int32))],
                        names=["id", "v", "cell", "block"])

    query_blocks = max(1, -(-n_queries // MOST_ROWS))
    asked = (queries.select("id", "v").mapInArrow(route, "id long, v array<long>, cell int, block int")
             .withColumn("part", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int")))
    per_cell = np.ones(int(cells.max()) + 1, int)
    per_cell[cells] = blocks
    n_blocks = F.element_at(F.array(*[F.lit(int(x)) for x in per_cell]), F.col("cell") + 1)
    # a block goes only to the parts of the queries that visit it
    visits = asked.select(*[F.col(c).alias(c) for c in ("cell", "block", "part")]).distinct()
    held = (grouped.withColumn("block", F.pmod(F.xxhash64("id", F.lit(7)), n_blocks).cast("int"))
            .join(visits, ["cell", "block"]).select("id", "v", "cell", "block", "part"))

    def solve(key, found: pa.Table, wanted: pa.Table) -> pa.Table:
        out = []
        ids, v = found.column("id").to_numpy(), _matrix(found.column("v")) if found.num_rows else None
        for at in range(0, wanted.num_rows if len(ids) else 0, 1024):
            part = wanted.slice(at, 1024)
            q = part.column("id").to_numpy()
            s = _products(_matrix(part.column("v")), v)
            order = np.lexsort((np.broadcast_to(ids, s.shape), -s), axis=1)[:, :k + 1]
            best = ids[order]
            ok = best != q[:, None]
            ok &= np.cumsum(ok, axis=1) <= k
            row = np.nonzero(ok)[0]
            out.append((q[row], best[ok], np.take_along_axis(s, order, 1)[ok]))
        cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 3
        return pa.table({"query_id": cols[0], "id": cols[1], "score": cols[2]})

    by = ("cell", "block", "part")
    local = held.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(solve, "query_id long, id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score"))

