"""Language-model scores from a hierarchical Pitman-Yor model of word pairs.

Restaurants: one for each context, the word before (48 bits of its hash, so
as good as one for each word), all with the root restaurant as parent, whose
base is uniform over the known words and one unknown.  Customers of a context
are the training tokens that follow it; each table of a context sends one
customer to the root.  Gibbs sweeps seat the customers of every dish anew, one
after the other, given the last sweep's tables elsewhere; probabilities are
averaged over the last sweeps.

The tokens are dealt by word, packed, so that a word's root counts are at
hand where its contexts are.  A context's customers lie in many parts: after
each sweep its tables are added up by ranges of the contexts' hashes, and each
part is told the sums of its own contexts; tables and sums are kept in a stage
until the next sweep.  Very frequent words, found on a sample of the
documents, are dealt by word and context instead, and their root counts go
through the driver.  Random numbers are hashes of word, context, sweep and
place in the row of customers, so neither the number of parts nor the choice
of these words changes what is drawn.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, slices, stage, tidied, utf8
from .wordtable import cut_words, hash_words, mixed, pack, unpack

#: Bytes of text in a unit of documents, and for each part of the words.
UNIT, PART = 8 << 20, 12 << 20
#: Of so many documents one is looked at for very frequent words.
SAMPLE = 16
SWEEPS, AVERAGED = 5, 3
STRENGTH = 1.0
#: Bits of a context's hash, and what stands for the root in random numbers.
BITS, _ROOT = 48, np.uint64(1 << 63)
#: Customers that are seated at a time, and of one dish after which only the
#: places of those who open a table are drawn.
CHUNK, MANY = 1 << 20, 1 << 24
_END, _BEGIN = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b"\n", b"\t"))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def pack_hashes(a: np.ndarray) -> bytes:
    """Ascending numbers of BITS bits, byte by byte, compressed."""
    b = np.ascontiguousarray(a, np.uint64).view(np.uint8).reshape(-1, 8)[:, :BITS // 8]
    return zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(b.T).tobytes())


def unpack_hashes(b: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(BITS // 8, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :BITS // 8] = raw.T
    return out.view(np.uint64).ravel()


def tokens(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that lie one after the other: the hash of each token (words
    with A-Z in lower case, then one end for each text), the context, the text
    it is in, and the number of tokens of each text."""
    raw = raw.copy()
    raw[(raw >= 65) & (raw <= 90)] += 32
    words, counts = cut_words(raw, at)
    coded = words.dictionary_encode()
    h = hash_words(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
    ends = np.cumsum(counts)
    h = np.insert(h, ends, _END)
    counts = counts + 1
    last = np.cumsum(counts) - 1
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[np.append(0, last[:-1] + 1)] = _BEGIN
    return h, before >> np.uint64(64 - BITS), np.repeat(np.arange(len(counts)), counts), counts


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for b in batches:
        raw, at = utf8(b.column(1))
        for i, j in slices(at, UNIT):
            yield b.slice(i, j - i), raw[at[i]:at[j]], at[i:j + 1] - at[i]


def frequent(docs: DataFrame, parts: int) -> np.ndarray:
    """Hashes of words that make up more than a quarter of an even part of
    the sampled tokens: 4 x parts at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw, at in _units(batches):
            h = tokens(raw, at)[0]
            w, n = np.unique(h, return_counts=True)
            many = n * 8 * parts >= len(h)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(w[many].view(np.int64), 0)), pa.array(np.append(n[many], 0)),
                                              pa.array(np.append(np.zeros(many.sum(), np.int64), len(h)))], names=["w", "n", "total"])

    seen = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(SAMPLE)) == 0).mapInArrow(tidied(count), "w long, n long, total long")
    total = seen.agg(F.sum("total")).first()[0] or 0
    rows = seen.groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") * 4 * parts > total).select("w").collect()
    return np.sort(np.array([r.w for r in rows], np.int64).view(np.uint64))


def _is_in(h: np.ndarray, some: np.ndarray) -> np.ndarray:
    at = np.searchsorted(some, h)
    return (at < len(some)) & (some[np.minimum(at, max(len(some) - 1, 0))] == h) if len(some) else np.zeros(len(h), bool)


_PAIR = "part int, unit string, words binary, pairs binary, ids binary, contexts binary, entries binary, docs binary, counts binary, train binary, doc_ids array<long>, tokens binary"
_PART = ("part int, words binary, pairs binary, ids binary, contexts binary, customers binary, entries binary, units array<string>, "
         "entry_units binary, docs binary, counts binary, unit string, doc_ids array<long>, tokens binary")
_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _table(rows: list[dict], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({c: pa.array([r.get(c) for r in rows], _KINDS[k]) for c, k in fields})


def _rows(table: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    """One row at a time, so that no two are unpacked at once."""
    for i in range(table.num_rows):
        yield {c: table.column(c)[i].as_py() for c in table.schema.names}


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.append(True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])))


def deal(docs: DataFrame, parts: int, hot: np.ndarray) -> DataFrame:
    """The tokens of all documents in one row for each part of the words:
    its words, the contexts and training customers of each, and in which
    documents each pair stands how often.  Further rows hold the document
    ids and lengths of each unit."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (b, raw, at) in enumerate(_units(batches)):
            h, c, d, counts = tokens(raw, at)
            ids, train = b.column(0).to_pylist(), np.array(b.column(2).to_pylist(), np.uint8)
            unit = f"{TaskContext.get().partitionId()}-{number}"
            salt = np.where(_is_in(h, hot), c + np.uint64(1), np.uint64(0))
            part = ((((h + salt) * _ODD) >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((d, c, h, part))
            h, c, d, part = h[order], c[order], d[order], part[order]
            first = _starts(part, h, c, d)  # of a pair in a document
            n = np.diff(np.append(first, len(h)))
            h, c, d, part = h[first], c[first], d[first], part[first]
            edges = np.searchsorted(part, np.arange(parts + 1))
            flags = pack(train)
            for p in np.flatnonzero(np.diff(edges)).tolist():
                i, j = edges[p], edges[p + 1]
                pair = _starts(h[i:j], c[i:j])
                word = _starts(h[i:j][pair])
                own, place = np.unique(c[i:j][pair], return_inverse=True)
                row = {"part": p, "unit": unit, "words": zstandard.compress(h[i:j][pair][word].tobytes()), "pairs": pack(np.diff(np.append(word, len(pair)))),
                       "ids": pack_hashes(own), "contexts": pack(place), "entries": pack(np.diff(np.append(pair, j - i))), "docs": pack(d[i:j]),
                       "counts": pack(n[i:j]), "train": flags}
                yield from _table([row], _PAIR).to_batches()
            spread = xxhash.xxh3_64_intdigest(unit.encode()) % parts
            yield from _table([{"part": spread, "unit": unit, "doc_ids": ids, "tokens": pack(counts)}], _PAIR).to_batches()

    def merge(table: pa.Table) -> pa.Table:
        out: list[dict] = []
        part, words, ids, contexts, n_entries, customers, unit_no, docs_, counts, units = None, [], [], [], [], [], [], [], [], []
        shift = 0
        for r in _rows(table):
            part = r["part"]
            if r["words"] is None:
                out.append({c: r[c] for c in ("part", "unit", "doc_ids", "tokens")})
                continue
            words.append(np.repeat(np.frombuffer(zstandard.decompress(r["words"]), np.uint64), unpack(r["pairs"])))
            e, d, n = unpack(r["entries"]), unpack(r["docs"]), unpack(r["counts"])
            ids.append(unpack_hashes(r["ids"]))
            contexts.append(unpack(r["contexts"]) + np.uint32(shift))
            shift += len(ids[-1])
            n_entries.append(e)
            customers.append(np.add.reduceat(n.astype(np.int64) * unpack(r["train"])[d], np.cumsum(e, dtype=np.int64) - e))
            docs_.append(d)
            counts.append(n)
            unit_no.append(np.full(len(d), len(units), np.uint32))
            units.append(r["unit"])
        if units:
            own, place = np.unique(np.concatenate(ids), return_inverse=True)
            w, k = np.concatenate(words), np.concatenate(customers)
            c, e = place.astype(np.uint32)[np.concatenate(contexts)], np.concatenate(n_entries).astype(np.int64)
            del words, ids, contexts, customers, n_entries, place
            order = np.lexsort((c, w))
            begin = np.cumsum(e) - e
            w, c, k = w[order], c[order], k[order]
            entry = np.arange(int(e.sum())) + np.repeat(begin[order] - (np.cumsum(e[order]) - e[order]), e[order])
            e = e[order]
            pair = _starts(w, c)
            word = _starts(w[pair])
            out.append({"part": part, "words": zstandard.compress(w[pair][word].tobytes()), "pairs": pack(np.diff(np.append(word, len(pair)))),
                        "ids": pack_hashes(own), "contexts": pack(c[pair]), "customers": pack(np.add.reduceat(k, pair)), "entries": pack(np.add.reduceat(e, pair)),
                        "units": units, "entry_units": pack(np.concatenate(unit_no)[entry]), "docs": pack(np.concatenate(docs_)[entry]),
                        "counts": pack(np.concatenate(counts)[entry])})
        return _table(out, _PART)

    return docs.mapInArrow(tidied(cut), _PAIR).groupBy("part").applyInArrow(merge, _PART)


def _draws(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Random numbers from 0 to 1, the same for the same key and place."""
    return (mixed(key + place.astype(np.uint64) * _ODD) >> np.uint64(11)) * 2.0 ** -53


def key(words: np.ndarray, contexts: np.ndarray, seed: int, sweep: int) -> np.ndarray:
    return mixed(words + mixed(contexts + (np.uint64(seed * 1000 + sweep) << np.uint64(BITS))))


def _sit(there: np.ndarray, n: np.ndarray, tables: np.ndarray, weight: np.ndarray, discount: float, keys: np.ndarray) -> np.ndarray:
    """Tables of each dish after ``n`` more customers than ``there``.

    Customer j opens a table if his number u < w / (w + j - discount t), so
    if t is above a threshold of his own.  Tables are counted from the
    customers before, again until nothing changes: counts only grow from one
    pass to the next, and those of the first k customers are right after k
    passes at the latest (a few passes, as a table more or less hardly
    moves anyone)."""
    row = np.repeat(np.arange(len(n)), n)
    begin = np.cumsum(n) - n
    j = np.arange(len(row)) + (there - begin)[row]
    w = weight[row]
    with np.errstate(divide="ignore"):
        least = (w + j - w / _draws(keys[row], j)) / discount
    least[j == 0] = -1
    t = tables[row]
    while True:
        upto = np.append(0, np.cumsum(t > least))
        now = upto[:-1] + (tables - upto[begin])[row]
        if np.array_equal(now, t):
            return tables + upto[begin + n] - upto[begin]
        t = now


def _stay(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """log gamma(x) - log gamma(x + w), x from some 100 on."""
    s = lambda x: 1 / (12 * x) - 1 / (360 * x ** 3)
    return w - w * np.log(x + w) - (x - 0.5) * np.log1p(w / x) + s(x) - s(x + w)


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, keys: np.ndarray, many: int = MANY, chunk: int = CHUNK) -> np.ndarray:
    """Tables of each dish after its customers sat down one after the other:
    a new table against all tables of the dish as ``weight`` to the customers
    there, less ``discount`` a table.

    From ``many`` customers on the place of the next who opens a table is
    drawn by inverting the probability that none does until then, which has
    the same distribution and takes time by tables, not by customers."""
    tables = np.minimum(customers, 1).astype(np.int64)
    live = np.flatnonzero(customers > 1)
    n = np.minimum(customers[live], many).astype(np.int64) - 1
    edges = np.cumsum(n)
    i = 0
    while i < len(live):
        j = max(i + 1, int(np.searchsorted(edges, (edges[i - 1] if i else 0) + chunk, "right")))
        at, rest = live[i:j], n[i:j].copy()
        there = np.ones(len(at), np.int64)
        while rest.any():  # more than one time only for a dish of more than ``chunk`` customers
            now = np.minimum(rest, chunk)
            tables[at] = _sit(there, now, tables[at], weight[at], discount, keys[at])
            there, rest = there + now, rest - now
        i = j
    live = np.flatnonzero(customers > many)
    there, step = np.full(len(live), many, np.int64), 0
    while len(live):
        w, left = weight[live], customers[live] - there
        x = there - discount * tables[live]
        u = np.log(np.maximum(_draws(keys[live], np.full(len(live), (1 << 62) + step)), 2.0 ** -54))
        none = lambda m: _stay(x + m, w) - _stay(x, w)  # noqa: E731, B023
        opens = none(left) < u
        low, high = np.zeros_like(left), left.copy()
        while (high - low > 1).any():
            mid = (low + high) // 2
            over = none(mid) < u
            low, high = np.where(over, low, mid), np.where(over, mid, high)
        tables[live[opens]] += 1
        there, step = there + high, step + 1
        keep = opens & (there < customers[live])
        live, there = live[keep], there[keep]
    return tables


@dataclass
class Shared:
    """What all parts know after a sweep: the root's customers and tables,
    and those of the very frequent words."""

    customers: float
    tables: float
    hot: dict[int, tuple[int, int]] = field(default_factory=dict)


@dataclass
class Model:
    tokens: int
    known: int
    discount: float
    root_discount: float
    hot_tokens: dict[int, int]
    seed: int
    shared: list[Shared] = field(default_factory=list)
    states: list[DataFrame] = field(default_factory=list)  # the first and the last ones

    def __getstate__(self) -> dict:  # tasks get the numbers, not the tables
        return self.__dict__ | {"states": []}


class _Part:
    """The words of a part."""

    def __init__(self, row: dict, hot: np.ndarray, with_entries: bool = False):
        self.part = row["part"]
        self.words = np.frombuffer(zstandard.decompress(row["words"]), np.uint64)
        n = unpack(row["pairs"]).astype(np.int64)
        self.first = np.cumsum(n) - n
        self.word = np.repeat(np.arange(len(n)), n)
        self.ids, self.context = unpack_hashes(row["ids"]), unpack(row["contexts"])
        self.customers = unpack(row["customers"]).astype(np.int64)
        self.hot = _is_in(self.words, hot)
        self.tokens = np.add.reduceat(self.customers, self.first)
        if with_entries:
            self.entries = unpack(row["entries"]).astype(np.int64)
            self.units, self.unit = row["units"], unpack(row["entry_units"])
            self.docs, self.counts = unpack(row["docs"]).astype(np.int64), unpack(row["counts"]).astype(np.int64)

    def state(self, rows: list[dict]) -> dict[str, np.ndarray]:
        """Of a sweep: the tables of each pair, the root's customers and
        tables of each word, and the sums of each context of the part."""
        own = next(r for r in rows if r["root_tables"] is not None)
        out = {c: unpack(own[c]).astype(np.int64) for c in ("tables", "customers", "root_tables")}
        told = sorted((r for r in rows if r["root_tables"] is None), key=lambda r: r["bucket"])
        for c in ("context_tables", "context_customers"):
            if told and told[0][c] is not None:
                out[c] = np.concatenate([np.frombuffer(zstandard.decompress(r[c]), np.int64) for r in told])
        return out

    def root(self, model: Model, shared: Shared, state: dict[str, np.ndarray]) -> np.ndarray:
        """The root's probability of each word."""
        customers, tables = state["customers"].copy(), state["root_tables"].copy()
        for i in np.flatnonzero(self.hot).tolist():
            customers[i], tables[i] = shared.hot.get(int(self.words[i]), (0, 0))
        new = (STRENGTH + model.root_discount * shared.tables) / (model.known + 1)
        return (customers - model.root_discount * tables + new) / (STRENGTH + shared.customers)

    def seated(self, model: Model, sweep: int, shared: Shared, state: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """The tables after another sweep."""
        weight = (STRENGTH + model.discount * state["context_tables"][self.context]) * self.root(model, shared, state)[self.word]
        tables = seat(self.customers, weight, model.discount, key(self.words[self.word], self.ids[self.context], model.seed, sweep))
        customers = np.add.reduceat(tables, self.first)
        new = (STRENGTH + model.root_discount * shared.tables) / (model.known + 1)
        root_tables = seat(customers, np.full(len(customers), new), model.root_discount, key(self.words, np.full(len(customers), _ROOT), model.seed, sweep))
        return {"tables": tables, "customers": customers, "root_tables": root_tables}


#: Of a sweep: the tables of each part, and rows for ranges of the contexts.
_SEATS = ("part int, bucket int, ids binary, n binary, tables binary, customers binary, root_tables binary, hot long, hot_tokens long, hot_customers long, "
          "tokens long, known long, pairs1 long, pairs2 long, words1 long, words2 long, root_n long, root_t long")
_STATE = "part int, bucket int, tables binary, customers binary, root_tables binary, context_tables binary, context_customers binary"
_NUMBERS = ["tokens", "known", "pairs1", "pairs2", "words1", "words2", "root_n", "root_t"]


def _told(p: _Part, state: dict[str, np.ndarray], buckets: int, first: bool) -> pa.Table:
    """What a part tells after a sweep: its tables; those of its contexts, by
    range of their hashes; the counts of the very frequent words."""
    k, n, cold = p.customers, p.tokens, ~p.hot
    kinds = np.add.reduceat(np.minimum(k, 1), p.first)[cold]
    own = {"part": p.part, **{c: pack(state[c]) for c in ("tables", "customers", "root_tables")},
           "root_n": int(state["customers"][cold].sum()), "root_t": int(state["root_tables"][cold].sum())}
    if first:
        own |= {"tokens": int(n.sum()), "known": int((n[cold] > 0).sum()), **{f"pairs{i}": int((k == i).sum()) for i in (1, 2)},
                **{f"words{i}": int((kinds == i).sum()) for i in (1, 2)}}
    rows = [own]
    tables = np.bincount(p.context, weights=state["tables"], minlength=len(p.ids)).astype(np.int64)
    customers = np.bincount(p.context, weights=k, minlength=len(p.ids)).astype(np.int64)
    bucket = (p.ids >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(BITS - 16)
    at = np.append(_starts(bucket), len(bucket))
    for i, j in zip(at, at[1:]):
        rows.append({"part": p.part, "bucket": int(bucket[i]), "ids": pack_hashes(p.ids[i:j]), "tables": zstandard.compress(tables[i:j].tobytes()),
                     "n": zstandard.compress(customers[i:j].tobytes()) if first else None})
    for i in np.flatnonzero(p.hot).tolist():
        rows.append({"part": p.part, "hot": int(p.words[i:i + 1].view(np.int64)[0]), "hot_tokens": int(n[i]), "hot_customers": int(state["customers"][i])})
    return _table(rows, _SEATS)


def _answers(seats: DataFrame) -> DataFrame:
    """Each part's own tables, and for its contexts the sums over all parts."""
    def add(table: pa.Table) -> pa.Table:
        ids = [unpack_hashes(x.as_py()) for x in table["ids"]]
        edges = np.cumsum([0, *map(len, ids)])
        _, place = np.unique(np.concatenate(ids), return_inverse=True)
        rows = [{"part": x.as_py(), "bucket": y.as_py()} for x, y in zip(table["part"], table["bucket"])]
        for c, out in (("tables", "context_tables"), ("n", "context_customers")):
            if table[c].null_count:
                continue
            values = np.concatenate([np.frombuffer(zstandard.decompress(x.as_py()), np.int64) for x in table[c]])
            sums = np.zeros(int(place.max()) + 1, np.int64)
            np.add.at(sums, place, values)
            for r, i, j in zip(rows, edges, edges[1:]):
                r[out] = zstandard.compress(sums[place[i:j]].tobytes())
        return _table(rows, _STATE)

    own = seats.where("root_tables is not null").select("part", "bucket", "tables", "customers", "root_tables",
                                                        F.lit(None).cast("binary").alias("context_tables"), F.lit(None).cast("binary").alias("context_customers"))
    return own.unionByName(seats.where("ids is not null").select("part", "bucket", "ids", "n", "tables").groupBy("bucket").applyInArrow(add, _STATE))


def fit(dealt: DataFrame, hot: np.ndarray, buckets: int, sweeps: int = SWEEPS, averaged: int = AVERAGED, seed: int = 1) -> Model:
    """Sample the seating; what comes to the driver after each sweep is a few
    sums and two numbers for each very frequent word."""
    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in _rows(b):
                p = _Part(row, hot)
                tables = np.minimum(p.customers, 1)
                customers = np.add.reduceat(tables, p.first)
                yield from _told(p, {"tables": tables, "customers": customers, "root_tables": np.minimum(customers, 1)}, buckets, True).to_batches()

    def sweep(model: Model, s: int):
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            p = _Part(next(_rows(left)), hot)
            return _told(p, p.seated(model, s, model.shared[-1], p.state(right.to_pylist())), buckets, False)

        return run

    model: Model | None = None
    for s in range(sweeps + 1):
        if s == 0:
            seats = stage(dealt.mapInArrow(tidied(begin), _SEATS), "lm-seats")
        else:
            seats = stage(dealt.groupBy("part").cogroup(model.states[-1].groupBy("part")).applyInArrow(sweep(model, s), _SEATS), "lm-seats")
        total = seats.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _NUMBERS]).first()
        shared = sorted((r.hot & (1 << 64) - 1, r.n, r.k) for r in seats.where("hot is not null").groupBy("hot").agg(
            F.sum("hot_tokens").alias("n"), F.sum("hot_customers").alias("k")).collect())
        words, n = np.array([w for w, _, _ in shared], np.uint64), np.array([k for _, _, k in shared], np.int64)
        if s == 0:
            discount = lambda one, two: max(0.05, min(0.95, one / max(1, one + 2 * two)))
            model = Model(total.tokens, total.known + sum(n > 0 for _, n, _ in shared), discount(total.pairs1, total.pairs2),
                          discount(total.words1 + int((n == 1).sum()), total.words2 + int((n == 2).sum())), {w: n for w, n, _ in shared}, seed)
            t = np.minimum(n, 1)
        else:
            new = (STRENGTH + model.root_discount * model.shared[-1].tables) / (model.known + 1)
            t = seat(n, np.full(len(n), new), model.root_discount, key(words, np.full(len(n), _ROOT), seed, s))
        model.shared.append(Shared(total.root_n + int(n.sum()), total.root_t + int(t.sum()), {w: (k, int(x)) for (w, _, k), x in zip(shared, t)}))
        model.states.append(stage(_answers(seats), "lm-state"))
        release(seats)
        if len(model.states) > averaged + 1:  # the first has the customers of each context
            release(model.states.pop(1))
    return model


def probabilities(p: _Part, model: Model, states: dict[int, dict[str, np.ndarray]]) -> np.ndarray:
    """Of each pair of a part: the probability of the word in the context,
    the mean over the sweeps of ``states``, of which 0 has the customers of
    each context as well."""
    out = np.zeros(len(p.word))
    n = states[0]["context_customers"][p.context]
    last = sorted(states)[1:] or [0]
    for s in last:
        x = states[s]
        out += (p.customers - model.discount * x["tables"] + (STRENGTH + model.discount * x["context_tables"][p.context])
                * p.root(model, model.shared[s], x)[p.word]) / (STRENGTH + n)
    return out / len(last)


_SUMS = "unit string, part int, docs binary, known binary, base binary, score binary"


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sweeps: int = SWEEPS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity) of every row: log10 probabilities of the text under the
    smoothed counts of words and under the model.

    Documents whose crc32 of the id as text, mod 7, is 2 are held out.  A
    null text is empty: its one token is the end.  A null id counts as the
    empty text and comes back as null.  Rows that come twice, ids that clash
    and files that hold the same rows are texts of their own: each counts, and
    each has its row in the result.  An empty table gives an empty result;
    with no training token every score is that of the base alone.
    """
    held = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), (~held).alias("train"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // PART))
    hot = frequent(d, parts)
    everything = stage(deal(d, parts, hot), "lm-tokens")
    dealt = everything.where("words is not null")
    model = fit(dealt.select("part", "words", "pairs", "ids", "contexts", "customers"), hot, parts, sweeps)
    last = [0, *range(len(model.shared) - len(model.states) + 1, len(model.shared))]
    columns = [c.split()[0] for c in _STATE.split(", ")]
    states = reduce(DataFrame.unionByName, [x.select(*columns, F.lit(i).alias("sweep")) for i, x in zip(last, model.states)])

    def partial(left: pa.Table, right: pa.Table) -> pa.Table:
        row = next(_rows(left))
        p = _Part(row, hot, True)
        told: dict[int, list[dict]] = {}
        for r in _rows(right):
            told.setdefault(r["sweep"], []).append(r)
        n = p.tokens.copy()
        for i in np.flatnonzero(p.hot).tolist():
            n[i] = model.hot_tokens.get(int(p.words[i]), 0)
        base = np.log10((n + 1) / (model.tokens + model.known + 1))
        best = np.log10(probabilities(p, model, {i: p.state(x) for i, x in told.items()}))
        pair = np.repeat(np.arange(len(p.word), dtype=np.int32), p.entries)
        order = np.argsort(p.unit, kind="stable")
        edges = np.searchsorted(p.unit[order], np.arange(len(p.units) + 1))
        rows = []
        for u, (i, j) in enumerate(zip(edges, edges[1:])):
            at = order[i:j]
            d, k, x = p.docs[at], p.counts[at], pair[at]
            word = p.word[x]
            size = int(d.max()) + 1
            known, low, high = (np.bincount(d, weights=v, minlength=size) for v in (k * (n[word] > 0), k * base[word], k * best[x]))
            docs_ = np.flatnonzero(np.bincount(d, minlength=size))
            rows.append({"unit": p.units[u], "part": p.part, "docs": pack(docs_), "known": pack(known[docs_]), "base": low[docs_].tobytes(),
                         "score": high[docs_].astype(np.float32).tobytes()})
        return _table(rows, _SUMS)

    def total(key, info: pa.Table, parts: pa.Table) -> pa.Table:
        out = []
        rows = sorted(parts.to_pylist(), key=lambda r: r["part"])
        for r in info.to_pylist():
            n = len(r["doc_ids"])
            known, base, best = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            for x in rows:
                at = unpack(x["docs"]).astype(np.int64)
                known[at] += unpack(x["known"])
                base[at] += np.frombuffer(x["base"])
                best[at] += np.frombuffer(x["score"], np.float32)
            out.append(pa.table({"doc_id": pa.array(r["doc_ids"], pa.int64()), "n_tokens": pa.array(unpack(r["tokens"]).astype(np.int64)),
                                 "n_known": known, "base_score": base, "score": best}))
        return pa.concat_tables(out)

    sums = dealt.groupBy("part").cogroup(states.groupBy("part")).applyInArrow(partial, _SUMS)
    infos = everything.where("words is null").select("unit", "doc_ids", "tokens")
    scored = infos.groupBy("unit").cogroup(sums.groupBy("unit")).applyInArrow(total, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    again = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return scored.select("doc_id", again.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                         "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
