"""How far the sources of a language differ from each other, and in which
terms: an audit by Arrow's compute functions.

Tasks lower, split, dictionary-encode and hash-group whole batches of texts
and hand on partial counts of (language, source, term), dealt by term to
shards, as packed columns.  A shard merges its columns by another hash
grouping and keeps the terms that enough documents hold.  Counts of the terms
kept are dealt anew, so that all sources of a term meet: a dense matrix of
sources by terms then gives its share of every divergence, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stage, tidied, utf8
from .wordtable import hash_words, mixed

#: What stands between terms: all of ASCII but its letters.
GAP = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of a language that hold a kept term, at least.
LEAST_DOCS = 30
#: Added to every count, and the units of a probability.
PSEUDO, UNITS = 5, 1_000_000_000
#: Terms listed of each source.
TOP = 50
#: Bytes of text counted at once (one text may be larger), and for each shard
#: of partial counts.
SLICE_BYTES, SHARD_BYTES = 6 << 20, 8 << 20
#: Cells (sources x terms) of a matrix.
CELLS = 1 << 16

_KEYS = ["lang", "source", "term"]
_KEPT = "lang string, source string, term string, n long, first boolean"


def _codes(a: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = a.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _counted(lang: pa.Array, source: pa.Array, text: pa.Array) -> tuple[pa.Table, np.ndarray]:
    """Occurrences, and documents, of each (lang, source, term), with a row
    without a term for each (lang, source); and a hash of language and term."""
    (a, langs), (b, sources) = _codes(lang), _codes(source)
    group = a * len(sources) + b
    parts = pc.split_pattern_regex(pc.ascii_lower(text), GAP)
    doc, term = pc.list_parent_indices(parts), pc.list_flatten(parts)
    some = pc.greater(pc.binary_length(term), 0)  # a split leaves empty strings at both ends
    coded = term.filter(some).dictionary_encode()
    terms = coded.dictionary
    per_doc = pa.table({"doc": doc.filter(some), "term": coded.indices}).group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    of_doc = pa.array(group[per_doc["doc"].to_numpy()] * (len(terms) + 1) + per_doc["term"].to_numpy())
    sums = pa.table({"k": of_doc, "n": per_doc["count_all"]}).group_by("k", use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    empty = np.unique(group) * (len(terms) + 1) + len(terms)
    key = np.append(sums["k"].to_numpy(), empty)
    group, term = np.divmod(key, len(terms) + 1)
    of_term = np.append(hash_words(terms.cast(pa.large_binary())), np.uint64(0))
    of_lang = np.array([xxhash.xxh3_64_intdigest(x) for x in langs.to_pylist()], np.uint64)
    zeros = np.zeros(len(empty), np.int64)
    out = pa.table({"lang": pa.DictionaryArray.from_arrays(pa.array((group // len(sources)).astype(np.int32)), langs),
                    "source": pa.DictionaryArray.from_arrays(pa.array((group % len(sources)).astype(np.int32)), sources),
                    "term": pa.concat_arrays([terms, pa.nulls(1, pa.large_string())]).take(pa.array(term)),
                    "n": np.append(sums["n_sum"].to_numpy(), zeros), "n_docs": np.append(sums["n_count"].to_numpy(), zeros)})
    return out, mixed(of_term[term] + of_lang[group // len(sources)])


def counts(docs: DataFrame, shards: int) -> DataFrame:
    """Partial counts of ``docs`` (lang, source, text) as (shard, columns):
    of a language's term all are in one shard."""
    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, at = utf8(b.column(2))
            for i, j in slices(at, SLICE_BYTES):
                # an array of its own: ascii_lower misreads one that begins within its data
                text = pa.LargeStringArray.from_buffers(j - i, pa.py_buffer(at[i:j + 1] - at[i]), pa.py_buffer(raw[at[i]:at[j]]))
                table, h = _counted(*(b.column(k).slice(i, j - i).cast(pa.large_string()) for k in range(2)), text)
                shard = (h % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                table, edges = table.take(pa.array(order)).combine_chunks(), np.searchsorted(shard[order], np.arange(shards + 1))
                rows = []
                for s in np.unique(shard).tolist():
                    rows.append((s, _packed(table.slice(edges[s], edges[s + 1] - edges[s]))))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["shard", "columns"])

    named = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return named.mapInArrow(count, "shard int, columns binary")


def _packed(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    # only the languages and sources that the slice has
    t = pa.table({c: t[c].cast(pa.large_string()).dictionary_encode() if c in ("lang", "source") else t[c] for c in t.column_names})
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def _merged(table: pa.Table, least_docs: int) -> pa.Table:
    """Merge a shard's columns; keep terms of enough documents.  ``first``
    marks one row of each term of a language, and of each without one."""
    parts = [pa.ipc.open_stream(x.as_buffer()).read_all() for x in table["columns"]]
    t = pa.concat_tables([p.set_column(0, "lang", p["lang"].cast(pa.large_string())).set_column(1, "source", p["source"].cast(pa.large_string())) for p in parts])
    t = t.combine_chunks()
    (a, langs), (b, sources), (c, terms) = (_codes(pc.fill_null(t[x].combine_chunks(), "")) for x in _KEYS)
    sums = (pa.table({"k": (a * len(terms) + c) * len(sources) + b, "n": t["n"], "d": t["n_docs"]})
            .group_by("k", use_threads=False).aggregate([("n", "sum"), ("d", "sum")]))
    order = np.argsort(sums["k"].to_numpy())
    k, n, d = (sums[x].to_numpy()[order] for x in ("k", "n_sum", "d_sum"))
    of_term = k // len(sources)
    start = np.flatnonzero(np.append(True, of_term[1:] != of_term[:-1]))
    size = np.diff(np.append(start, len(k)))
    none = pc.equal(terms, "").to_numpy(zero_copy_only=False)[of_term % len(terms)]  # a term is never empty
    kept = none | (np.repeat(np.add.reduceat(d, start), size) >= least_docs)
    first = np.zeros(len(k), bool)
    first[start] = True
    a, c, b = of_term // len(terms), of_term % len(terms), k % len(sources)
    return pa.table({"lang": langs.take(pa.array(a[kept])).cast(pa.string()), "source": sources.take(pa.array(b[kept])).cast(pa.string()),
                     "term": terms.take(pa.array(c[kept], mask=none[kept])).cast(pa.string()), "n": n[kept], "first": first[kept]})


def _share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNITS * count / total), exactly, for count <= total < 2**53:
    three decimal digits of the quotient at a time."""
    whole, rest = np.divmod(count, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


def _shard(key: tuple, found: pa.Table, groups: pa.Table, top: int, pseudo: int) -> pa.Table:
    """A shard's share of each pair's divergence, and its best terms."""
    lang = key[0].as_py()
    order = pc.sort_indices(groups["source"])
    sources, totals = groups["source"].take(order).combine_chunks(), groups["total"].take(order).to_numpy()
    vocabulary = int(groups["vocabulary"][0].as_py())
    size = len(sources)
    terms = found["term"].combine_chunks().unique()
    terms = terms.take(pc.sort_indices(terms))  # by bytes, as ties go
    n = np.zeros((size, len(terms)), np.int64)
    n[pc.index_in(found["source"].combine_chunks(), value_set=sources).to_numpy(), pc.index_in(found["term"].combine_chunks(), value_set=terms).to_numpy()] = found["n"].to_numpy()
    p = _share(n + pseudo, (totals + pseudo * vocabulary)[:, None]) if vocabulary else n
    q = _share(n.sum(0) + pseudo, np.array([totals.sum() + pseudo * vocabulary])) if vocabulary else n.sum(0)
    who, part, item, value = [], [], [], []
    for a in range(size):
        others = np.flatnonzero(np.arange(size) != a)
        far = np.abs(p - p[a]).sum(1)[others]
        ahead = p[a] - q
        best = np.flatnonzero((n[a] > 0) & (ahead > 0))
        best = best[np.argsort(-ahead[best], kind="stable")[:top]]
        who.append(np.full(len(others) + len(best), a))
        part += ["pair"] * len(others) + ["term"] * len(best)
        item += [sources.take(pa.array(others)), terms.take(pa.array(best))]
        value += [far, ahead[best]]
    row = sources.take(pa.array(np.concatenate(who)))
    return pa.table({"lang": pa.array([lang] * len(row), pa.string()), "source": row, "part": pa.array(part, pa.string()),
                     "item": pa.concat_arrays([x.cast(pa.string()) for x in item]), "value": pa.array(np.concatenate(value).astype(np.int64))})


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, pseudo: int = PSEUDO) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (lang, source,
    text; other columns are not read).

    Terms are runs of ASCII letters (in lower case) and anything not ASCII.
    A language keeps the terms that ``least_docs`` of its rows hold.  p of a
    kept term is 1 + floor(10**9 * (count + pseudo) / (N + pseudo * V)) in a
    source, with N its count of all V kept terms; q the same in the whole
    language.  Part ``pair``: how far each other source of the language is,
    the sum of the differences of their p over all kept terms; part ``term``:
    the ``top`` terms of the source whose p is most above q.  Ranks go by
    value, largest first, then by the item's bytes.

    Null lang, source and text are empty strings; a row that comes twice
    counts twice; a source without a kept term has pairs and no terms; a
    language of one source has no pairs; an empty table has no rows.  Counts
    of a language must stay below 2**53.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))

    def merge(table: pa.Table) -> pa.Table:
        return _merged(table, least_docs)

    kept = stage(counts(docs, shards).groupBy("shard").applyInArrow(merge, _KEPT), "audit")
    group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = kept.groupBy("lang").agg(F.count(F.when(F.col("first"), F.col("term"))).alias("vocabulary"),
                                       F.count(F.when(F.col("term").isNull(), 1)).alias("n_sources"))
    of_lang = of_lang.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("vocabulary") * F.col("n_sources") / CELLS)).cast("int"))
    held = (kept.where("term is not null").join(of_lang.select("lang", "shards"), "lang")
            .select("lang", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"), "source", "term", "n"))
    dealt = group.join(of_lang, "lang").select(F.col("lang").alias("lang"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
                                               F.col("source").alias("source"), "total", "vocabulary")

    def solve(key, found: pa.Table, groups: pa.Table) -> pa.Table:
        return _shard(key, found, groups, top, pseudo)

    shares = held.groupBy("lang", "shard").cogroup(dealt.groupBy("lang", "shard")).applyInArrow(solve, "lang string, source string, part string, item string, value long")
    by = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (shares.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
            .withColumn("rank", F.row_number().over(by)).where((F.col("part") == "pair") | (F.col("rank") <= top))
            .select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")))
