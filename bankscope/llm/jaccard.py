"""Documents linked by the Jaccard similarity of their word n-grams.

PartEnum: sets of similar size share a size band, in which similarity allows
at most k differences.  The feature domain is cut by hash into parts, each
part into cells; some parts have at most one difference, so that leaving out
one of its cells leaves equal subsets: the hash of what a set has in a part
without one cell is a signature, and sufficiently similar sets share one.
Candidates come from shared signatures and are checked exactly.

A group of copies shares most signatures.  Sets that are equal count once,
and each set of a signature is first compared with one of its sets only;
what these links already join needs no further comparison.  What stays apart
though many sets share its signature is compared in blocks, by matrix
products: without a row for each pair, though the products themselves grow
with the square of such a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components_by_signature, free_shuffles, slices, small, stage, tidied, utf8
from .wordtable import UNIT, cut_words, hash_words, mixed, pack as pack_int, pack_long, unpack, unpack_long

#: Cells of a part; a signature leaves out one.
CELLS = 3
#: Features of the sets that are signed together.
GROUP = 1 << 21
#: The bits of a signature that are kept: unlike subsets that agree in them
#: cost a comparison, no more.
_KEPT = np.uint64((1 << 48) - 1)
#: Bits of a set's sketch.
SKETCH = 1024
#: Sets of a block, where many sets share a signature.
BLOCK = 512
_STEP = np.uint64(0xBF58476D1CE4E5B9)


def feature_sets(raw: np.ndarray, at: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct ``size``-word
    shingles, A-Z in lower case; with fewer words, of the whole sequence."""
    raw = raw.copy()
    raw[(raw >= 65) & (raw <= 90)] += 32
    words, counts = cut_words(raw, at)
    coded = words.dictionary_encode()
    h = hash_words(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
    ends = np.append(0, np.cumsum(counts))
    for i, n in enumerate(counts.tolist()):
        w = h[ends[i]:ends[i + 1]]
        take = min(n, size)
        if not n:
            yield w
            continue
        s = np.full(n - take + 1, take, np.uint64)
        for k in range(take):
            s = mixed(s * _STEP + w[k:k + n - take + 1])
        yield np.unique(s)


def _band_edges(similarity: tuple[int, int]) -> np.ndarray:
    """First sizes of the bands, up to what fits into 32 bits.  Wide bands
    need fewer sets to sign twice, narrow ones leave the parts more to hold,
    which counts where similarity is low."""
    a, b = similarity
    ratio = (b / a) ** (3 if 10 * a >= 9 * b else 1)
    out = [1]
    while out[-1] < 1 << 31:
        out.append(max(out[-1] + 1, int(out[-1] * ratio)))
    return np.array(out)


def signatures(features: np.ndarray, similarity: tuple[int, int], edges: np.ndarray) -> np.ndarray:
    """The signatures of a set under ``similarity`` (a / b, as integers).
    Each set signs in its band; if a similar larger set may lie in the next
    band, also there."""
    a, b = similarity
    n = len(features)
    own = int(np.searchsorted(edges, n, "right")) - 1
    out = []
    for band in (own, own + 1):
        if band > own and n * b < edges[band] * a:
            break
        largest = int(edges[band + 1]) - 1
        # differences of two similar sets: (b - a) / (b + a) of their sizes
        k = (b - a) * 2 * largest // (b + a)
        if k == 0:
            out.append(mixed(np.array([np.sum(mixed(features)) ^ np.uint64(band)], np.uint64)))
            continue
        # k differences spoil k / 2 parts at most, so spare + 1 parts are good
        spare = k // 16 + 1
        parts = k // 2 + 1 + spare
        m = mixed(features ^ mixed(np.array([band], np.uint64)))
        cell = (m % np.uint64(parts)).astype(np.int64) * CELLS + ((m >> np.uint64(40)) % np.uint64(CELLS)).astype(np.int64)
        sums = np.zeros(parts * CELLS, np.uint64)
        np.add.at(sums, cell, mixed(m))
        sums, held = sums.reshape(parts, CELLS), np.bincount(cell, minlength=parts * CELLS).reshape(parts, CELLS)
        left = sums.sum(1, keepdims=True, dtype=np.uint64) - sums
        empty = held.sum(1, keepdims=True) == held
        place = np.arange(parts * CELLS, dtype=np.uint64).reshape(parts, CELLS) + np.uint64(band << 40)
        signed = mixed(left + mixed(place))
        # Empty subsets, which many sets have in common, sign only for a set
        # that has them in more than the spare parts.  Of two similar sets, if
        # either has them in fewer, some good part leaves it no empty subset,
        # and there both have equal ones; if neither has, both sign them.
        out.append(signed.ravel() if empty.any(1).sum() > spare else signed[~empty])
    return np.concatenate(out)


def _each(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int | None, np.ndarray]]:
    for b in batches:
        raw, at = utf8(b.column(1))
        for i, j in slices(at, UNIT // 2):
            yield from zip(b.column(0).slice(i, j - i).to_pylist(), feature_sets(raw[at[i]:at[j]], at[i:j + 1] - at[i], size), strict=True)


def _groups_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """The sets of some megabytes of text at a time."""
    group, total = [], 0
    for i, f in _each(batches, size):
        group.append((i, f))
        total += len(f)
        if total >= GROUP:
            yield group
            group, total = [], 0
    if group:
        yield group


def _node(features: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit numbers that stand for a set."""
    x = xxhash.xxh3_128_digest(features.tobytes())
    return int.from_bytes(x[:8], "big", signed=True), int.from_bytes(x[8:], "big", signed=True)


def _sketch(features: np.ndarray) -> np.ndarray:
    """Whether an odd number of features falls on each of SKETCH places: two
    sketches differ in no more bits than their sets in features."""
    odd = np.bincount((features % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _block_links(a: int, b: int):
    """For two blocks of sets, or one with itself: links that join what their
    components leave apart."""
    def run(table: pa.Table) -> pa.Table:
        rep, component = (table.column(c).to_numpy() for c in ("rep", "component"))
        lists = table.column("set").combine_chunks()
        n = np.diff(lists.offsets.to_numpy())
        _, feature, count = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(n)), n)
        use = count[feature] > 1
        number = np.cumsum(count > 1) - 1
        row, feature = row[use], number[feature[use]]
        order = np.argsort(feature, kind="stable")
        row, feature = row[order], feature[order]
        common = np.zeros((len(n), len(n)), np.float32)
        for lo in range(0, int(feature[-1]) + 1 if len(feature) else 0, 4096):
            i, j = np.searchsorted(feature, (lo, lo + 4096))
            x = np.zeros((len(n), 4096), np.float32)
            x[row[i:j], feature[i:j] - lo] = 1
            common += x @ x.T
        common = common.astype(np.int64)
        linked = common * b >= (n[:, None] + n[None, :] - common) * a
        x, y = np.nonzero(linked & (component[:, None] < component[None, :]))
        # of all links those that join two groups, by union and find over the components
        parent = {c: c for c in component.tolist()}

        def find(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        out = []
        for u, v in zip(x.tolist(), y.tolist(), strict=True):
            p, q = find(int(component[u])), find(int(component[v]))
            if p != q:
                parent[p] = q
                out.append((rep[u], rep[v]))
        return pa.table({"x": pa.array([u for u, _ in out], pa.int64()), "y": pa.array([v for _, v in out], pa.int64())})

    return run


def link(docs: DataFrame, size: int = 3, similarity: tuple[int, int] = (90, 100),
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links_found) of every row of ``docs``.

    Two documents link when their sets' intersection is at least a / b of
    their union, ``similarity`` being (a, b); component_id is the smallest
    doc_id reachable by links, the document's own included.  n_links_found counts
    the links that were looked at between different sets, not those inside a
    group that others already join.  A null or wordless text has an empty set
    and links with nothing.  A document with a null doc_id links with nothing
    and has a null component_id.  A doc_id that comes again is another row of
    the same document.
    """
    a, b = similarity
    edges = _band_edges(similarity)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for i, f in _each(batches, size):
            rows.append((i, len(f), *_node(f)))
            if len(rows) >= 8192:
                yield pack(rows)
        yield pack(rows)

    def pack(rows: list) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], names=["doc_id", "n", "node", "check"])
        rows.clear()
        return out

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups_of(batches, size):
            nodes, sets = zip(*{_node(f)[0]: f for i, f in group if i is not None and len(f)}.items(), strict=True) if any(
                i is not None and len(f) for i, f in group) else ((), ())
            if not nodes:
                continue
            signed = [signatures(f, similarity, edges) & _KEPT for f in sets]
            sig = np.concatenate(signed)
            who = np.repeat(np.array(nodes, np.int64), [len(x) for x in signed])
            order = np.argsort(sig, kind="stable")
            sig, who = sig[order], who[order]
            # of sets here that share a signature one goes on for all; the others are members already
            first = np.append(True, sig[1:] != sig[:-1])
            more = ~first
            shared = np.append(more[1:], False) & first  # those that go on for others too
            rows = [(int(who[0]) % parts, False, pack_long(sig[more]), pack_long(who[more].view(np.uint64)), None)] if more.any() else []
            s, w, flag = sig[first], who[first], shared[first]
            part = (s >> np.uint64(16)).astype(np.int64) * parts >> 32
            cut = np.searchsorted(part, np.arange(parts + 1))
            for p in range(parts):
                i, j = cut[p], cut[p + 1]
                if i < j:
                    there, at = np.unique(w[i:j], return_inverse=True)
                    rows.append((p, True, pack_long(np.diff(s[i:j], prepend=np.uint64(0))), pack_long(there.view(np.uint64)),
                                 pack_int(at.astype(np.uint32) * 2 + flag[i:j])))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()))], names=["part", "open", "sigs", "nodes", "at"])

    def gather(table: pa.Table) -> pa.Table:
        """The signatures of a part that different sets share, and who."""
        out_s, out_w, sigs, who, flags = [], [], [], [], []
        for r in table.to_pylist():
            nodes = unpack_long(r["nodes"]).view(np.int64)
            if r["open"]:
                at = unpack(r["at"])
                sigs.append(np.cumsum(unpack_long(r["sigs"]), dtype=np.uint64))
                who.append(nodes[at >> 1])
                flags.append(at & 1)
            else:
                out_s.append(unpack_long(r["sigs"]))
                out_w.append(nodes)
        if sigs:
            s, w, f = (np.concatenate(x) for x in (sigs, who, flags))
            order = np.lexsort((w, s))
            s, w, f = s[order], w[order], f[order]
            run = np.cumsum(np.append(False, s[1:] != s[:-1]))
            several = np.append(False, (s[1:] == s[:-1]) & (w[1:] != w[:-1])) | (f > 0)
            use = np.bincount(run, weights=several)[run] > 0
            out_s.append(s[use])
            out_w.append(w[use])
        return pa.table({"sig": np.concatenate(out_s).view(np.int64), "node": np.concatenate(out_w)}) if out_s else pa.table(
            {"sig": pa.array([], pa.int64()), "node": pa.array([], pa.int64())})

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, f in _each(batches, size):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([len(f)], pa.int64()), pa.array([_sketch(f)], pa.list_(pa.int64())),
                                              pa.array([f.view(np.int64)], pa.list_(pa.int64()))], names=["rep", "n", "sketch", "set"])

    described = stage(d.mapInArrow(tidied(describe), "doc_id long, n long, node long, check long"), "jaccard-documents")
    classes = (described.where("n > 0 and doc_id is not null").groupBy("node", "check").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n")))
    signed = d.mapInArrow(tidied(sign), "part int, open boolean, sigs binary, nodes binary, at binary")
    members = signed.groupBy("part").applyInArrow(gather, "sig long, node long").distinct()
    # from here on a set is its smallest document
    members = stage(members.join(classes, "node").select("sig", "rep", F.col("n").alias("code")), "jaccard-members")
    del signed
    free_shuffles()  # of the signatures
    wanted = small(stage(members.select("rep").distinct(), "jaccard-wanted"))
    sets = d.join(wanted, d.doc_id == wanted.rep, "left_semi").mapInArrow(tidied(features), "rep long, n long, sketch array<long>, set array<long>")
    # the sets are shuffled only if an id has several rows
    again = described.join(wanted, described.doc_id == wanted.rep, "left_semi").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    sets = stage(sets if again.isEmpty() else sets.dropDuplicates(["rep"]), "jaccard-sets")
    del again
    free_shuffles()  # of the texts

    def verify(pairs: DataFrame) -> DataFrame:
        """Pairs x < y and whether they are linked.  Sets are fetched only for
        pairs whose sketches differ in no more bits than linked sets can."""
        def of(name: str, *columns: str) -> DataFrame:
            return sets.select(F.col("rep").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

        bits = F.aggregate(F.zip_with("sketch_x", "sketch_y", lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda t, u: t + u)
        sketched = pairs.join(of("x", "n", "sketch"), "x").join(of("y", "n", "sketch"), "y")
        sketched = stage(sketched.select("x", "y", (bits * (a + b) <= (F.col("n_x") + F.col("n_y")) * (b - a)).alias("near")), "jaccard-sketched")
        both = of("x", "set").join(small(sketched).where("near"), "x").join(of("y", "set"), "y").withColumn("both", F.size(F.array_intersect("set_x", "set_y")))
        linked = F.col("both") * b >= (F.size("set_x") + F.size("set_y") - F.col("both")) * a
        return both.select("x", "y", linked.alias("linked")).unionByName(sketched.where("not near").select("x", "y", F.lit(False).alias("linked")))

    def blocks(many: DataFrame) -> DataFrame:
        """Links between components in the signatures that many sets share:
        matrix products of blocks of sets, each cluster of signatures once."""
        cluster = many.select(F.col("sig").alias("cluster"), "rep", "component")
        size = cluster.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
        dealt = cluster.join(size, "cluster").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("n")).cast("int"))
        pairs = dealt.select("cluster", "rep", "component", "own", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
        pairs = pairs.select("cluster", "rep", "component", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        return pairs.join(sets, "rep").groupBy("cluster", "i", "j").applyInArrow(_block_links(a, b), "x long, y long").distinct()

    def similar_sizes(n: F.Column, m: F.Column) -> F.Column:
        return F.least(n, m) * b >= F.greatest(n, m) * a

    component, links = components_by_signature(members, verify, blocks, near=similar_sizes)
    degree = links.select(F.explode(F.array("x", "y")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links_found"))
    by_class = classes.join(component, F.col("rep") == F.col("id"), "left").drop("id") if component is not None else classes.withColumn("component", F.lit(None).cast("long"))
    by_class = (by_class.join(degree, F.col("rep") == F.col("id"), "left")
                .select(F.col("node").alias("_node"), F.col("check").alias("_check"), F.coalesce("component", "rep").alias("_component"), F.coalesce("n_links_found", F.lit(0)).alias("_links")))
    return (described.join(by_class, (F.col("n") > 0) & (F.col("node") == F.col("_node")) & (F.col("check") == F.col("_check")), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id")).alias("component_id"),
                    F.coalesce("_links", F.lit(0)).cast("long").alias("n_links_found")))
