"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these ASCII characters.
WORD_GAP = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the
    session.  Only a local session may go without it; it then uses the
    checkpoint folder that the library sets for tests."""
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    from ..session import checkpoint_dir

    return checkpoint_dir(spark).rstrip("/")


#: The stages made on the way to one that ``lasting`` writes.
_MADE: ContextVar[list[DataFrame] | None] = ContextVar("made", default=None)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back:
    lineage ends there and a lost executor loses none of it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    if (made := _MADE.get()) is not None:
        made.append(out)
    return out


def lasting(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``build`` gives, as a stage; those made on the way to it, which
    nothing else may read, are released."""
    token = _MADE.set([])
    try:
        out, made = stage(build(), name), _MADE.get()
    finally:
        _MADE.reset(token)
    release(*made[:-1])
    if (outer := _MADE.get()) is not None:
        outer.append(out)
    return out


#: Files of a stage up to which it is sent to every executor.
SMALL_MB = 24


def small(staged: DataFrame) -> DataFrame:
    """A stage to be broadcast if its files are small enough, however the
    session's own limit is set; as it is otherwise, for a shuffled join."""
    jvm, path = staged.sparkSession._jvm, staged._llm_path
    where = jvm.org.apache.hadoop.fs.Path(path)
    size = where.getFileSystem(staged.sparkSession._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
    return F.broadcast(staged) if size <= SMALL_MB << 20 else staged


def release(*stages: DataFrame) -> None:
    """Delete the files of stages that nothing reads any more, and let Spark
    clean the shuffle files of plans that are no longer referred to."""
    for df in stages:
        jvm, path = df.sparkSession._jvm, df._llm_path
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
    free_shuffles()


def free_shuffles() -> None:
    """Let Spark clean the shuffle files of plans that are no longer referred
    to now, not whenever the driver happens to collect its garbage."""
    gc.collect()
    SparkSession.getActiveSession()._jvm.System.gc()


#: Bytes of a batch that goes to a Python worker: rows are counted in
#: thousands by default, and texts may be very long.
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let no batch for Python workers hold much more than BATCH_BYTES."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def tidied(run: Callable) -> Callable:
    """A function of batches that gives its worker's memory back at its end:
    idle workers stay, and later stages share the executor with them."""
    def around(batches):
        import ctypes
        import gc

        import pyarrow

        yield from run(batches)
        gc.collect()
        pyarrow.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
        if trim:
            trim(0)

    return around


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns named so in any letter case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def ascii_lower(c: Column | str) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(c: Column | str) -> Column:
    """The words of a text (null: none)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.coalesce(c, F.lit("")), WORD_GAP), lambda w: w != "")


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins
    (with the end of the last); null texts are empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def slices(starts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` units each, or of one row."""
    i, n = 0, len(starts) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + most, "right")) - 1)
        yield i, j
        i = j


def ranges(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of ``lengths``, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    begin = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(begin, lengths)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id on an edge; component is the smallest id
    reachable.  Alternating large-star and small-star steps: each takes the
    smallest neighbour by a map-side combined aggregate and hands it to the
    neighbours by an equi-join, so no component is ever gathered in one task."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = stage(e, "edges")

    def stars() -> bool:
        """Every id has one edge to a smaller one, or none and edges from larger ones."""
        ends = e.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            e.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()

    while not stars():
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (both.join(low, F.col("u") == F.col("k")).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        small_low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        joined = large.join(small_low, F.col("u") == F.col("k"))
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(small_low.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct())
        e, gone = stage(small, "edges"), e
        release(gone)
    return (e.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))


def _clusters(many: DataFrame) -> DataFrame:
    """``many`` (sig, rep, code, component) with all signatures as one whose
    member with the most of them is the same, so that a pair that shares a
    number of signatures is compared in few places; ``sig`` is that member."""
    degree = many.groupBy("rep").agg(F.count("*").alias("degree"))
    central = many.join(degree, "rep").groupBy("sig").agg(F.max(F.struct("degree", "rep")).alias("one"))
    return many.join(central, "sig").select(F.col("one.rep").alias("sig"), "rep", "code", "component").distinct()


#: Members of a signature up to which all its pairs are simply joined.
FEW = 24


def components_by_signature(members: DataFrame, verify: Callable[[DataFrame], DataFrame], large: Callable[[DataFrame], DataFrame],
                            rounds: int = 2, near: Callable[[Column, Column], Column] | None = None) -> tuple[DataFrame | None, DataFrame]:
    """Components (id, component; None without a link) of the graph whose
    edges are the pairs of ``members`` (sig, rep, code) that share a
    signature and pass ``near`` (of their codes) and ``verify``; and the
    links found.

    ``verify`` takes pairs (x, y), x < y, and adds ``linked``.  In each of
    some rounds the members of a signature are compared with one of them
    only, so that a group of copies costs as many comparisons as it has
    members; a signature whose members are then all joined is done.  At the
    end all that are still apart are compared, so no link is missed: the
    pairs of signatures with few members are joined; ``large`` takes the
    members (sig, rep, code, component) of the others, in clusters, and gives
    links (x, y) between components, block by block: all that it takes to join
    these, or, with their ``sig``, one at least for each x that has any there.
    It is then called again with those x, as long as it finds links, so that a
    group of copies gives no link for each pair.
    """
    near = near or (lambda a, b: F.lit(True))
    checked: list[DataFrame] = []
    component = None

    def state() -> DataFrame:
        if component is None:
            return members.withColumn("component", F.col("rep"))
        return stage(members.join(component, F.col("rep") == F.col("id"), "left")
                     .select("sig", "rep", "code", F.coalesce("component", "rep").alias("component")), "members")

    def check(pairs: DataFrame | None, links: DataFrame | None = None) -> DataFrame | None:
        """Verify new pairs and take links as they are; the components with them."""
        new = []
        if pairs is not None:
            pairs = pairs.select(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")).distinct()
            for c in checked:
                pairs = pairs.join(c.select("x", "y"), ["x", "y"], "left_anti")
            new.append(stage(verify(pairs), "pairs"))
        if links is not None:
            links = links.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
            for c in new:
                links = links.join(c.select("x", "y"), ["x", "y"], "left_anti")
            new.append(stage(links.select("x", "y", F.lit(True).alias("linked")), "links"))
        checked.extend(new)
        if all(c.where("linked").isEmpty() for c in new):
            return component
        return lasting(lambda: connected_components(reduce(DataFrame.unionByName, checked).where("linked"), "x", "y"), "components")

    def spent(m: DataFrame) -> None:
        if m is not members and hasattr(m, "_llm_path"):
            release(m)

    for r in range(rounds):
        m = state()
        one = F.min(F.struct(F.xxhash64("rep", F.lit(r)).alias("h"), F.col("rep").alias("q"), F.col("component").alias("c"), F.col("code").alias("d")))
        apart = m.groupBy("sig").agg(one.alias("one"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        component = check(m.join(apart.select("sig", "one.q", "one.c", "one.d"), "sig")
                          .where((F.col("component") != F.col("c")) & near(F.col("code"), F.col("d"))).select(F.col("rep").alias("p"), "q"))
        spent(m)
    before = state()
    m = before
    apart = (m.groupBy("sig").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low <> high").select("sig", "n"))
    m = stage(m.join(apart, "sig"), "apart")
    spent(before)
    few = m.where(F.col("n") <= FEW).drop("n")
    pairs = (few.select("sig", F.col("rep").alias("p"), F.col("component").alias("a"), F.col("code").alias("c"))
             .join(few.select("sig", F.col("rep").alias("q"), F.col("component").alias("b"), F.col("code").alias("d")), "sig")
             .where((F.col("a") < F.col("b")) & near(F.col("c"), F.col("d"))).select("p", "q"))
    many = m.where(F.col("n") > FEW).drop("n")
    many = stage(_clusters(many), "clusters")
    links = None if many.isEmpty() else stage(large(many), "links")
    component = check(pairs, links)
    spent(m)
    while links is not None and "sig" in links.columns and not links.isEmpty():
        # a member without a link in a cluster has none there later either
        left = many.drop("component").join(links.select("sig", F.col("x").alias("rep")), ["sig", "rep"], "left_semi")
        left = left.join(component, F.col("rep") == F.col("id")).drop("id")
        apart = left.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("sig")
        left = stage(left.join(apart, "sig"), "clusters")
        release(many, links)
        many, links = left, stage(large(left), "links")
        component = check(None, links)
    release(many)
    return component, reduce(DataFrame.unionByName, checked).where("linked")
