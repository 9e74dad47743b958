"""Removal of long byte strings that come more than once, by a family of
hashed indexes of anchors.

A string of LONG bytes is found through its anchor: the place in it where the
hash of the next GRAM bytes is smallest, so equal strings have their anchors
at the same offset.  Only places that are anchors are indexed, about one in
seventy.  An entry of the index stands for all equal neighbourhoods of
anchors (the bytes of all strings that share the anchor) and counts them.

No suffix array is built or sorted: the index is a table by the hashes of an
anchor's gram and of its neighbourhood.  New batches of documents get an index
of their own (level 0); two levels of one size are added up by these hashes
into one of twice the size.  Once all batches are in, a neighbourhood that comes twice is repeated as a whole;
where different neighbourhoods share a gram, their strings are compared one
by one, once for each neighbourhood, however often it comes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, slices, small, stage, tidied, utf8, without
from .wordtable import mixed, pack, pack_long, unpack, unpack_long

#: Bytes of a string that counts as repeated, and of a gram.
LONG, GRAM = 200, 64
#: Batches in which the documents are indexed.
BATCHES = 4
#: Bytes of text that are searched at a time, and strings that are compared
#: before they are dealt.
UNIT, STRINGS = 2 << 20, 1 << 21
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOW = np.uint64(0xFFFFFFFF)


def _powers(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, np.uint64)
    x[:1] = 1
    return np.multiply.accumulate(x)


class _Hashed:
    """Hashes of any stretch of the bytes of some texts."""

    def __init__(self, raw: np.ndarray):
        byte = mixed(np.arange(1000, 1256, dtype=np.uint64))
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(byte[raw] * _powers(_BASE, len(raw)), out=self.sums[1:])
        self.back = _powers(_INVERSE, len(raw) + 1)

    def of(self, begin, end) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.back[begin]


def anchors(raw: np.ndarray, at: np.ndarray) -> tuple[_Hashed, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each run of strings with one anchor: the text it is in, the
    anchor, and the places where its first and its last string begin."""
    h = _Hashed(raw)
    none = np.empty(0, np.int64)
    n = len(raw) - LONG + 1
    if n < 1:
        return h, none, none, none, none
    grams = len(raw) - GRAM + 1
    # by hash, then by place: the first of equal grams wins
    key = mixed((h.sums[GRAM:] - h.sums[:-GRAM]) * h.back[:grams]) & ~_LOW | np.arange(grams, dtype=np.uint64)
    width, need = 1, LONG - GRAM + 1
    while 2 * width <= need:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < need:
        key = np.minimum(key[:len(key) - (need - width)], key[need - width:])
    anchor = (key & _LOW).astype(np.int64)
    text = np.searchsorted(at, np.arange(n), "right") - 1
    whole = np.arange(n) + LONG <= at[text + 1]
    first = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])) & whole
    last = np.append((anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~whole[1:], True) & whole
    lo, hi = np.flatnonzero(first), np.flatnonzero(last)
    return h, text[lo], anchor[lo], lo, hi


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for b in batches:
        raw, at = utf8(b.column(1))
        for i, j in slices(at, UNIT):
            yield b.slice(i, j - i), raw[at[i]:at[j]], at[i:j + 1] - at[i]


def _classes(h: _Hashed, a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gram at each anchor and its neighbourhood, as 64 bits each."""
    gram = h.of(a, a + GRAM)
    shape = ((a - lo) * LONG + (hi - lo)).astype(np.uint64)
    return gram.view(np.int64), mixed(h.of(lo, hi + LONG) ^ mixed(shape)).view(np.int64)


_ENTRY = "gram long, class long, doc long, place long"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, class, doc, place) of each anchor; place holds where its first
    string begins, how many there are and how far the anchor is from the
    first: lo * 2**16 + strings * 2**8 + offset."""
    for b, raw, at in _texts(batches):
        h, text, a, lo, hi = anchors(raw, at)
        gram, c = _classes(h, a, lo, hi)
        place = ((lo - at[text]) << 16) + ((hi - lo + 1) << 8) + (a - lo)
        yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(c), b.column(0).take(pa.array(text)), pa.array(place)],
                                         names=["gram", "class", "doc", "place"])


def _twice(docs: DataFrame, doc_id: str) -> DataFrame | None:
    """The ids (_twice) of several rows; None where there are none."""
    ids = docs.select(F.col(doc_id).cast("long").alias("_twice")).where("_twice is not null")
    several = stage(ids.groupBy("_twice").agg(F.count("*").alias("_n")).where("_n > 1").select("_twice"), "suffixes-ids")
    if several.isEmpty():
        release(several)
        return None
    return several


def _keyed(docs: DataFrame, doc_id: str, text: str, twice: DataFrame | None, *more: F.Column) -> DataFrame:
    """(doc, text): a row without an id goes by a hash of its text, one whose
    id others have too by a hash of both, so that rows with one key hold the
    same text."""
    key = F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(text))
    if twice is not None:
        docs = docs.join(small(twice), F.col(doc_id).cast("long") == F.col("_twice"), "left")
        key = F.when(F.col("_twice").isNotNull(), F.xxhash64("_twice", text)).otherwise(key)
    return docs.select(*more, key.alias("doc"), F.col(text).cast("string").alias("text"))


def index(batch: DataFrame) -> DataFrame:
    """The index of a batch (doc, text): an entry for each neighbourhood,
    with how often it comes and one of its places."""
    found = batch.where(F.octet_length("text") >= LONG).mapInArrow(tidied(_find), _ENTRY)
    return found.groupBy("gram", "class").agg(F.count("*").alias("n"), F.min("doc").alias("doc"), F.min_by("place", "doc").alias("place"))


def merge(one: DataFrame, other: DataFrame) -> DataFrame:
    return one.unionByName(other).groupBy("gram", "class").agg(F.sum("n").alias("n"), F.min("doc").alias("doc"), F.min_by("place", "doc").alias("place"))


class Family:
    """Levels of the index; level k holds 2**k batches."""

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}

    def add(self, batch: DataFrame) -> None:
        level, new = 0, stage(index(batch), "suffixes-0")
        while level in self.levels:
            old = self.levels.pop(level)
            level += 1
            new, gone = stage(merge(old, new), f"suffixes-{level}"), (old, new)
            release(*gone)
        self.levels[level] = new

    def whole(self) -> DataFrame:
        """All levels merged into one."""
        parts = [self.levels.pop(k) for k in sorted(self.levels)]
        out = parts[0]
        for other in parts[1:]:
            out, gone = stage(merge(out, other), "suffixes-all"), (out, other)
            release(*gone)
        return out


def _runs(x: np.ndarray) -> Iterator[tuple[int, int]]:
    if len(x):
        cut = np.flatnonzero(np.diff(x) != 1)
        yield from zip(x[np.append(0, cut + 1)].tolist(), x[np.append(cut, len(x) - 1)].tolist())


def _strings(h: _Hashed, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of some neighbourhoods in one text: the hash of each of their strings
    with its offset, which neighbourhood it is of, and the offset."""
    lo, n, off = place >> 16, place >> 8 & 255, place & 255
    which = np.repeat(np.arange(len(lo)), n)
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    begin = lo[which] + step
    return mixed(h.of(begin, begin + LONG) + (off[which] - step).astype(np.uint64)), which, off[which] - step


def _parts_of(x: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` even ranges of 64 bits a number lies in."""
    return ((x >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


_PACKED = "part int, open boolean, keys binary, classes binary, at binary, offsets binary"
_NAMES = [x.split()[0] for x in _PACKED.split(", ")]
_KINDS = (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary())


def _marks(part: int, classes: np.ndarray, offsets: np.ndarray, parts: int) -> list[tuple]:
    """Rows that say which offsets of which neighbourhoods are repeated,
    dealt by neighbourhood."""
    c = classes.view(np.uint64)
    to = _parts_of(c, parts)
    order = np.lexsort((offsets, c, to))
    c, offsets, to = c[order], offsets[order], to[order]
    cut = np.searchsorted(to, np.arange(parts + 1))
    rows = []
    for p in range(parts):
        i, j = cut[p], cut[p + 1]
        if i < j:
            there, at = np.unique(c[i:j], return_inverse=True)
            rows.append((p, False, None, pack_long(there), pack(at), pack(offsets[i:j])))
    return rows


def _batch(rows: list[tuple], kind: type = pa.RecordBatch):
    return kind.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_KINDS)], names=_NAMES)


def repeated(docs: DataFrame, family: Family) -> DataFrame:
    """(class, spans) of the neighbourhoods with a repeated string: first and
    last offset of runs of such strings, before the anchor."""
    whole = family.whole()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    strings, offset = F.expr("place >> 8 & 255"), F.expr("place & 255")
    span = F.struct((offset - strings + 1).cast("int").alias("a"), offset.cast("int").alias("b"))
    full = stage(whole.where("n > 1").select("class", F.array(span).alias("spans")), "suffixes-full")
    several = whole.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1").select("gram")
    # one place of each neighbourhood, however often it comes
    places = (whole.join(several, "gram").select("class", "doc", "place", (F.col("n") > 1).alias("full"))
              .groupBy("doc").agg(F.collect_list(F.struct("class", "place", "full")).alias("places")))
    places = stage(places, "suffixes-places")
    release(whole)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The strings of neighbourhoods, dealt by their hash.  Of equal ones
        here only one goes on, marked; the others are known to be repeated."""
        held: list[tuple] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            string, c, full, off = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((c, string))
            string, c, full, off = string[order], c[order], full[order], off[order]
            first = np.append(True, string[1:] != string[:-1])
            again = ~first
            flag = np.append(again[1:], False) & first
            known = again & ~full
            rows = _marks(0, c[known], off[known], parts) if known.any() else []
            s, c, full, off, flag = string[first], c[first], full[first], off[first], flag[first]
            to = _parts_of(s, parts)
            cut = np.searchsorted(to, np.arange(parts + 1))
            for p in range(parts):
                i, j = cut[p], cut[p + 1]
                if i < j:
                    there, at = np.unique(c[i:j], return_inverse=True)
                    rows.append((p, True, pack_long(np.diff(s[i:j], prepend=np.uint64(0))), pack_long(there.view(np.uint64)),
                                 pack(at.astype(np.uint32) * 4 + full[i:j] * 2 + flag[i:j]), pack(off[i:j])))
            yield _batch(rows)

        for b in batches:
            for k in range(b.num_rows):
                rows = b.column(2)[k].values
                c, place, full = (rows.field(x).to_numpy(zero_copy_only=False) for x in ("class", "place", "full"))
                h = _Hashed(np.frombuffer(b.column(1)[k].as_py().encode(), np.uint8))
                for i in range(0, len(c), 4096):
                    string, which, off = _strings(h, place[i:i + 4096])
                    held.append((string, c[i:i + 4096][which], full[i:i + 4096][which].astype(bool), off))
                    size += len(string)
                    if size >= STRINGS:
                        yield from out()
                        held.clear()
                        size = 0
        if held:
            yield from out()

    def compare(table: pa.Table) -> pa.Table:
        """Strings of a part that different neighbourhoods have."""
        rows = table.to_pylist()
        known = [r for r in rows if not r["open"]]
        rows = [r for r in rows if r["open"]]
        out = [tuple(r[k] for k in _NAMES) for r in known]
        if rows:
            string, c, at, off = [], [], [], []
            for r in rows:
                a = unpack(r["at"])
                string.append(np.cumsum(unpack_long(r["keys"]), dtype=np.uint64))
                c.append(unpack_long(r["classes"])[a >> 2])
                at.append(a)
                off.append(unpack(r["offsets"]))
            string, c, at, off = (np.concatenate(x) for x in (string, c, at, off))
            order = np.lexsort((c, string))
            string, c, at, off = string[order], c[order], at[order], off[order]
            run = np.cumsum(np.append(False, string[1:] != string[:-1]))
            twice = np.append(False, (string[1:] == string[:-1]) & (c[1:] != c[:-1])) | (at & 1 > 0)
            use = (np.bincount(run, weights=twice)[run] > 0) & (at & 2 == 0)
            if use.any():
                out += _marks(0, c[use].view(np.int64), off[use], parts)
        return _batch(out, pa.Table)

    def join(table: pa.Table) -> pa.Table:
        """Runs of the repeated offsets of each neighbourhood."""
        rows = table.to_pylist()
        c = np.concatenate([unpack_long(r["classes"])[unpack(r["at"])] for r in rows])
        off = np.concatenate([unpack(r["offsets"]) for r in rows]).astype(np.int64)
        order = np.lexsort((off, c))
        c, off = c[order], off[order]
        new = np.append(True, c[1:] != c[:-1])
        # the same offset may be marked twice
        first = np.flatnonzero(new | np.append(True, np.diff(off) > 1))
        last = np.append(first[1:], len(off)) - 1
        head = np.flatnonzero(new[first])
        spans = pa.StructArray.from_arrays([pa.array(off[first].astype(np.int32)), pa.array(off[last].astype(np.int32))], names=["a", "b"])
        return pa.table({"class": pa.array(c[first][head].view(np.int64)),
                         "spans": pa.ListArray.from_arrays(pa.array(np.append(head, len(first)).astype(np.int32)), spans)})

    packed = docs.join(places, "doc").select("doc", "text", "places").mapInArrow(tidied(expand), _PACKED)
    marks = packed.groupBy("part").applyInArrow(compare, _PACKED)
    partly = marks.groupBy("part").applyInArrow(join, "class long, spans array<struct<a:int,b:int>>")
    out = stage(full.unionByName(partly), "suffixes-repeated")
    del packed, marks, partly
    release(places, full)
    return out


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every
    row: what is left of its text, taken as UTF-8, without each byte of a
    string of LONG bytes that begins anywhere else too, as the input has
    them.  ``spans`` are the first byte and the end of each run that goes.

    Texts that are null or shorter than LONG lose nothing; a null text is
    empty.  Each row is a place of its own, also where rows have the same id,
    with the same or with different texts, and where they have none.
    """
    docs = without(docs, "_twice")
    twice = _twice(docs, doc_id)
    d = _keyed(docs, doc_id, text, twice)
    family = Family()
    for k in range(batches):
        family.add(d.where(F.pmod(F.xxhash64("doc", F.lit(3)), F.lit(batches)) == k))
    marked = repeated(d, family)
    found = d.where(F.octet_length("text") >= LONG).mapInArrow(tidied(_find), _ENTRY).select("class", "doc", "place")
    anchor = F.expr("(place >> 16) + (place & 255)")
    spans = (found.join(marked, "class").select("doc", F.explode("spans").alias("s"), anchor.alias("x"))
             .select("doc", (F.col("x") - F.col("s.b")).alias("first"), (F.col("x") - F.col("s.a") + LONG).alias("end"))
             .groupBy("doc").agg(F.collect_list(F.struct("first", "end")).alias("found")))
    spans = stage(spans, "suffixes-spans")
    release(marked)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, t, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                raw = (t or "").encode()
                if s.is_valid and len(s.values):
                    change = np.zeros(len(raw) + 1, np.int32)
                    np.add.at(change, s.values.field("first").to_numpy(zero_copy_only=False), 1)
                    np.add.at(change, s.values.field("end").to_numpy(zero_copy_only=False), -1)
                    gone = np.cumsum(change[:-1]) > 0
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    runs = [{"first": x, "end": y + 1} for x, y in _runs(np.flatnonzero(gone))]
                else:
                    kept, runs = raw, []
                rows.append((i, len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), runs))
            kinds = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(),
                     "spans": pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))}
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds.values())], names=list(kinds))

    joined = _keyed(docs, doc_id, text, twice, F.col(doc_id).cast("long").alias("doc_id")).join(spans, "doc", "left")
    return joined.select("doc_id", "text", "found").mapInArrow(
        tidied(cut), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<first:long,end:long>>")
