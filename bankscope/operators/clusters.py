"""KMeans whose starts advance together (M14): every step of all of them is
one scan of the table.

Points are whole numbers of a fixed unit, so that sums, centres and costs do
not depend on the partitioning.  A start picks its centres by the squared
distance to those it has (each row draws from its key), one scan per centre
for all starts; then Lloyd steps follow until its centres stay.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Functions that run in tasks travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A unit of a point's components, for values about [0, 1].
UNIT = 2**-20

Centers = list[list[tuple[float, ...]]]


def _distance(x: Sequence[Column], center: Sequence[float]) -> Column:
    """Squared distance, in squared units."""
    out = F.lit(0.0)
    for c, v in zip(x, center, strict=True):
        out = out + (c - F.lit(float(v))) * (c - F.lit(float(v)))
    return out


def nearest(x: Sequence[Column], centers: Sequence[Sequence[float]]) -> tuple[Column, Column]:
    """The nearest of some centres (the first of several) and its squared distance."""
    each = F.array_min(F.array(*[F.struct(_distance(x, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)]))
    return each["i"], each["d"]


def _points(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [F.round(F.coalesce(F.col(c), F.lit(0.0)) / F.lit(UNIT)).cast("long") for c in columns]


def seeds(points: DataFrame, names: Sequence[str], k: int, starts: int, seed: int, key: str) -> Centers:
    """The first centres of every start: a row is drawn by its squared
    distance to the centres drawn before (evenly at first), as the smallest
    of exponential waiting times."""
    x = [F.col(n) for n in names]
    out: Centers = [[] for _ in range(starts)]
    for pick in range(k):
        rows = []
        for s in range(starts):
            u = (F.pmod(F.xxhash64(F.col(key), F.lit(seed + s), F.lit(pick)), F.lit(2**40)) + 1) / F.lit(float(2**40))
            far = nearest(x, out[s])[1] if pick else F.lit(1.0)
            wait = F.when(far > 0, -F.log(u) / far)  # null, thus never drawn, at a centre
            rows.append(F.min(F.when(wait.isNotNull(), F.struct(wait.alias("w"), F.col(key).alias("k"), *names))).alias(f"s{s}"))
        row = points.agg(*rows).first()
        for s in range(starts):
            r = row[f"s{s}"]
            # fewer different points than centres: the last one again
            out[s].append(tuple(float(r[n]) for n in names) if r is not None else out[s][-1] if out[s] else (0.0,) * len(names))
    return out


def _partial_sums(centers: list[tuple[int, np.ndarray]], names: Sequence[str]) -> Callable:
    """A task's rows, costs and sums by (start, cluster).  In Arrow, as centres
    inside an expression would have Spark compile each step anew."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list[int]] = {}
        for b in batches:
            if not b.num_rows:
                continue
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1)
            for s, center in centers:
                d = ((x[:, None, :] - center[None]) ** 2).cumsum(axis=2)[:, :, -1]
                nearest = d.argmin(axis=1)  # the first of several
                cost = np.rint(d[np.arange(len(x)), nearest])
                for c in np.unique(nearest).tolist():
                    here = nearest == c
                    new = [int(here.sum()), int(cost[here].astype(np.int64).sum()), *(int(v) for v in x[here].astype(np.int64).sum(axis=0))]
                    old = total.get((s, c))
                    total[s, c] = new if old is None else [p + q for p, q in zip(old, new, strict=True)]
        rows = [(*at, v[0], *map(Decimal, v[1:])) for at, v in total.items()]
        kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.decimal128(38, 0)] * (1 + len(names))]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["start", "cluster", "n", "cost", *names])

    return run


def lloyd(points: DataFrame, names: Sequence[str], centers: Centers, steps: int = 100) -> tuple[Centers, list[int]]:
    """Centres that stay, or those after so many steps, and the cost of each
    start, in whole squared units.  A step moves all starts that have not come to rest, in
    one scan: sums by (start, cluster)."""
    centers = [list(c) for c in centers]
    costs = [0] * len(centers)
    moving = list(range(len(centers)))
    values = points.select(*[F.col(n).cast("double") for n in names])
    kinds = "start int, cluster int, n long, cost decimal(38,0), " + ", ".join(f"{n} decimal(38,0)" for n in names)
    for _ in range(steps):
        sums = (values.mapInArrow(_partial_sums([(s, np.array(centers[s])) for s in moving], names), kinds).groupBy("start", "cluster")
                .agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(n).alias(n) for n in names])
                .collect())  # starts x k rows
        new = {s: list(centers[s]) for s in moving}
        total = dict.fromkeys(moving, 0)
        for r in sums:
            new[r.start][r.cluster] = tuple(float(r[n]) / r.n for n in names)
            total[r.start] += int(r.cost)
        for s in list(moving):
            costs[s] = total[s]
            if new[s] == centers[s]:
                moving.remove(s)
            centers[s] = new[s]
        if not moving:
            break
    return centers, costs


def kmeans(df: DataFrame, columns: Sequence[str], k: int = 3, starts: int = 10, seed: int = 42, key: str = "customer_id",
           steps: int = 100) -> tuple[DataFrame, float]:
    """``df`` with ``cluster`` (0 to k - 1) of the start with the least cost
    (the first of several), and that cost: the sum of squared distances.
    ``df`` should be a stage: it is read once per step.  Missing values count
    as 0; of no rows the cost is 0."""
    names = [f"_p{i}" for i in range(len(columns))]
    points = df.select(F.col(key), *[c.alias(n) for c, n in zip(_points(df, columns), names, strict=True)])
    centers, costs = lloyd(points, names, seeds(points, names, k, starts, seed, key), steps)
    best = min(range(starts), key=lambda s: costs[s])
    cluster = nearest(_points(df, columns), centers[best])[0]
    return df.withColumn("cluster", cluster), costs[best] * UNIT * UNIT
