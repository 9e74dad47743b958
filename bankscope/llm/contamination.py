"""Documents that hold passages of a test set, by suffix arrays.

The words of a run of documents (a shard) are numbered by the words of the
test set, and the suffixes that begin with words of it are sorted: the shard's
suffix array.  Every window of the test set is looked up there by binary
search, which gives its range of suffixes, thus all places where it occurs.
Windows that follow each other in a document and in an item make up the
longest verbatim matches.

The test set comes in blocks of bounded size; only one block at a time is on
the driver and on the executors.  Documents never leave their task: nothing
is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import ascii_lower, release, slices, stage, tidied, utf8, without

#: Words of a window; an item of fewer is one window.
WINDOW = 10
#: Words of the test set in a block, about, and of an item in a row of it.
BLOCK_WORDS = 2_000_000
ROW_WORDS = 50_000
#: Bytes of text whose words are numbered together (one text may be larger),
#: and words of a shard.
SLICE_BYTES = 8 << 20
SHARD_WORDS = 1 << 20
#: Pairs of a place in a document and one in the test set looked at together.
PAIRS = 1 << 20

#: Letters, digits and all that is not ASCII make up words.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: The same for column functions.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Block(NamedTuple):
    """Words of some items, one after the other, a 0 after each row of them."""

    vocabulary: pa.Array
    ids: np.ndarray
    #: of each word: its item (an index into names) and place in the item
    item: np.ndarray
    at: np.ndarray
    #: of each word: whether the item ends in this row, thus fewer words than a window are all of it
    whole: np.ndarray
    names: list[str | None]


def cut(raw: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of texts (their bytes, and where each begins and the last
    ends), and how many each has."""
    kind = _WORD[raw]
    first = kind.copy()
    first[1:] &= ~kind[:-1]
    begin = at[:-1][at[:-1] < at[1:]]  # words end with their text
    first[begin] = kind[begin]
    size = np.cumsum(kind, dtype=np.int64)
    starts = np.flatnonzero(first)
    offsets = np.append(size[starts] - 1, size[-1] if len(size) else 0).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(_LOWER[raw[kind]]))
    return words, np.diff(np.searchsorted(starts, at))


def blocks(benchmark: DataFrame, item_id: str, text: str, window: int) -> Iterator[Block]:
    """The test set in blocks.  Long items come in rows whose windows join up
    without a gap; the driver reads the rows of one partition at a time."""
    w = F.filter(F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), GAP), lambda x: x != "")
    rows = (benchmark.select(F.col(item_id).cast("string").alias("item"), w.alias("w"), F.size(w).alias("n")).where("n > 0")
            .withColumn("start", F.explode(F.expr(f"sequence(0, greatest(0, n - {window}), {ROW_WORDS})")))
            .select("item", "start", F.col("n"), F.expr(f"slice(w, start + 1, {ROW_WORDS + window - 1})").alias("w")))
    held, total = [], 0
    for r in rows.toLocalIterator():
        held.append(r)
        total += len(r.w)
        if total >= BLOCK_WORDS:
            yield _block(held)
            held, total = [], 0
    if held:
        yield _block(held)


def _block(rows: list) -> Block:
    names = sorted({r.item for r in rows if r.item is not None}) + [None]
    index = {x: i for i, x in enumerate(names)}
    coded = pa.array([x for r in rows for x in r.w], pa.large_string()).dictionary_encode()
    sizes = np.array([len(r.w) for r in rows])
    last = np.cumsum(sizes)
    ids = np.insert(coded.indices.to_numpy().astype(np.int32) + 1, last, 0)
    places = np.concatenate([np.append(np.arange(len(r.w)) + r.start, -1) for r in rows])
    return Block(coded.dictionary, ids, np.repeat([index[r.item] for r in rows], sizes + 1).astype(np.int32), places.astype(np.int32),
                 np.repeat([r.n == len(r.w) for r in rows], sizes + 1), names)


def run_lengths(ids: np.ndarray) -> np.ndarray:
    """How many words other than 0 follow from each place on."""
    stops = np.append(np.flatnonzero(ids == 0), len(ids))
    return stops[np.searchsorted(stops, np.arange(len(ids)))] - np.arange(len(ids))


def windows(b: Block, window: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By number of words: the different windows (sorted), where windows are
    in the block, and which one each is.  Windows shorter than ``window`` are
    whole items."""
    runs = run_lengths(b.ids)
    begins = np.append(True, b.ids[:-1] == 0) & (b.ids > 0)
    out = []
    for m in sorted({min(int(x), window) for x in runs[begins]}):
        at = np.flatnonzero(runs >= m) if m == window else np.flatnonzero(begins & b.whole & (runs == m))
        if len(at):
            kinds, which = np.unique(b.ids[at[:, None] + np.arange(m)], axis=0, return_inverse=True)
            out.append((kinds, at, which.reshape(-1)))
    return out


def suffix_array(ids: np.ndarray, least: int, depth: int, bits: int) -> np.ndarray:
    """Places sorted by their next ``depth`` words; those with fewer than
    ``least`` words before the next 0 are left out, as no window begins there."""
    at = np.flatnonzero(run_lengths(ids) >= least)
    each = 62 // bits  # words in one key
    padded = np.append(ids, np.zeros(depth, ids.dtype)).astype(np.int64)
    keys = []
    for k in range(0, depth, each):
        key = np.zeros(len(at), np.int64)
        for j in range(k, min(k + each, depth)):
            key = key << bits | padded[at + j]
        keys.append(key)
    return at[np.lexsort(keys[::-1])]


def search(ids: np.ndarray, array: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The range in the suffix array of each of ``wanted`` (rows of words)."""
    m = wanted.shape[1]

    def bound(rows: np.ndarray, beyond: bool) -> np.ndarray:
        lo, hi = np.zeros(len(rows), np.int64), np.full(len(rows), len(array), np.int64)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            there, here = ids[array[mid][:, None] + np.arange(m)], rows[open_]
            unlike = there != here
            k = unlike.argmax(1)
            r = np.arange(len(open_))
            less = there[r, k] < here[r, k]
            less |= beyond & ~unlike[r, k]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]

    low = bound(wanted, False)
    high = low.copy()
    some = np.flatnonzero(low < len(array))
    some = some[(ids[array[low[some]][:, None] + np.arange(m)] == wanted[some]).all(1)] if len(some) else some
    high[some] = bound(wanted[some], True)
    return low, high


def _matches(m: int, place: np.ndarray, kind: np.ndarray, at: np.ndarray, which: np.ndarray, b: Block):
    """For places in documents (ascending) with the windows found there: the
    pairs (place, item), each once, and the longest matches (place, words, place in the
    block) that don't continue one further left, one for each place."""
    order = np.argsort(which, kind="stable")
    ends = np.searchsorted(which[order], np.arange(int(which.max()) + 2))
    lengths = ends[kind + 1] - ends[kind]
    window_at = np.full(len(b.ids) + 1, -1)
    window_at[at] = which
    found = {k: [np.empty(0, np.int64)] for k in ("places", "items", "starts", "words", "tests")}
    for i, j in slices(np.append(0, np.cumsum(lengths)), PAIRS):
        n = lengths[i:j]
        row = np.repeat(np.arange(i, j), n)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        t = at[order[ends[kind[row]] + inside]]
        pair = np.unique(row * len(b.names) + b.item[t])
        found["places"].append(place[pair // len(b.names)])
        found["items"].append(pair % len(b.names))
        left = np.maximum(row - 1, 0)
        follows = (row > 0) & (place[left] == place[row] - 1) & (t > 0) & (window_at[t - 1] == kind[left])
        row, t = row[~follows], t[~follows]
        size, alive = np.full(len(row), m, np.int64), np.arange(len(row))
        k = 1
        while len(alive):
            to = row[alive] + k
            ok = to < len(place)
            alive, to = alive[ok], to[ok]
            ok = (place[to] == place[row[alive]] + k) & (window_at[np.minimum(t[alive] + k, len(b.ids))] == kind[to])
            alive = alive[ok]
            size[alive] += 1
            k += 1
        best = np.lexsort((t, -size, row))
        best = best[np.append(True, row[best][1:] != row[best][:-1])] if len(best) else best
        found["starts"].append(place[row[best]])
        found["words"].append(size[best])
        found["tests"].append(t[best])
    return [np.concatenate(found[k]).astype(np.int64) for k in found]


def _searched(b: Block, window: int):
    """A function of texts (bytes, offsets) that finds the block's windows:
    words of each text, words inside windows, and for each text its items and
    matches."""
    kinds = windows(b, window)
    least = min((k[0].shape[1] for k in kinds), default=window)
    bits = max(1, len(b.vocabulary).bit_length())

    def run(raw: np.ndarray, at: np.ndarray, covered: list):
        words, counts = cut(raw, at)
        known = pc.fill_null(pc.index_in(words, value_set=b.vocabulary), -1).to_numpy().astype(np.int32) + 1
        del words
        # a 0 after the words of each text
        last = np.cumsum(counts)
        ids = np.insert(known, last, 0) if len(counts) else known
        begin = last - counts + np.arange(len(counts))
        items: list[list[int]] = [[] for _ in counts]
        matches: list[list[tuple]] = [[] for _ in counts]
        hit = np.zeros(len(ids) + 1, np.int32)
        found: list[list] = [[] for _ in kinds]
        for i in range(0, len(ids), SHARD_WORDS):
            # every window that begins in a shard lies in it
            shard = ids[i:i + SHARD_WORDS + window - 1]
            sa = suffix_array(shard, least, window, bits)
            if not len(sa):
                continue
            padded = np.append(shard, np.zeros(window, ids.dtype))
            for to, (rows, _, _) in zip(found, kinds, strict=True):
                low, high = search(padded, sa, rows)
                some = np.flatnonzero(high > low)
                n = (high - low)[some]
                place = sa[np.repeat(low[some], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                mine = place < SHARD_WORDS
                to.append((place[mine] + i, np.repeat(some, n)[mine]))
        for to, (rows, where, which) in zip(found, kinds, strict=True):
            if not to:
                continue
            m = rows.shape[1]
            place, kind = (np.concatenate(x) for x in zip(*to, strict=True))
            order = np.argsort(place)
            place, kind = place[order], kind[order]
            np.add.at(hit, place, 1)
            np.add.at(hit, place + m, -1)
            if not len(place):
                continue
            p, item, s, size, t = _matches(m, place, kind, where, which, b)
            doc = np.searchsorted(begin, p, "right") - 1
            pair = np.unique(doc * len(b.names) + item)
            for d, x in zip((pair // len(b.names)).tolist(), (pair % len(b.names)).tolist(), strict=True):
                if b.names[x] is not None:
                    items[d].append(b.names[x])
            doc = np.searchsorted(begin, s, "right") - 1
            for d, *x in zip(doc.tolist(), (s - begin[doc]).tolist(), size.tolist(), b.item[t].tolist(), b.at[t].tolist(), strict=True):
                matches[d].append((x[0], x[1], b.names[x[2]], x[3]))
        inside = np.cumsum(hit[:-1]) > 0
        for d, (s, n) in enumerate(zip(begin.tolist(), counts.tolist(), strict=True)):
            for x, y in covered[d]:
                inside[s + x:s + y] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.astype(np.int8), [0]))))
        owner = np.searchsorted(begin, edge[::2], "right") - 1
        spans: list[list[tuple[int, int]]] = [[] for _ in counts]
        for d, x, y in zip(owner.tolist(), (edge[::2] - begin[owner]).tolist(), (edge[1::2] - begin[owner]).tolist(), strict=True):
            spans[d].append((x, y))
        return counts, spans, items, matches

    return run


_SPAN = T.StructType().add("start", T.LongType()).add("end", T.LongType())
_MATCH = T.StructType().add("start", T.LongType()).add("words", T.LongType()).add("item", T.StringType()).add("item_start", T.LongType())
#: What a search adds to documents.
_ADDED = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("hit_spans", T.ArrayType(_SPAN)),
                       T.StructField("items", T.ArrayType(T.StringType())), T.StructField("matches", T.ArrayType(_MATCH))])
ADDED = tuple(_ADDED.names)


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words; hit_spans: the runs (start, end: words) of what
    lies inside any occurrence of a window of ``benchmark``; items: the ids,
    as sorted strings, of the items whose windows occur; matches: the longest
    verbatim matches (start, words, item, item_start), one for each place
    where a match begins that no other continues to the left, the smaller
    place in the test set where several are as long.

    Words are runs of ASCII letters (in lower case), digits and anything not
    ASCII.  A window: ``window`` words of an item in a row; an item of fewer,
    but not none, is one window.  A null text or one without words has no
    words and no hits; rows that come twice both stay; an empty test set hits
    nothing; an item that comes twice counts once; of an item without an id
    the words are hit, but it is not among ``items``.  Columns of ``docs`` of
    the names added are replaced.  An item longer than ROW_WORDS + window may
    have a match in two parts, at the rows' ends.
    """
    spark = docs.sparkSession
    docs = without(docs, *ADDED)
    kept = docs.columns
    types = dict(zip(ADDED, to_arrow_schema(_ADDED).types, strict=True))
    schema = T.StructType([*docs.schema.fields, *_ADDED.fields])
    found = before = None
    nothing = Block(pa.array([], pa.large_string()), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, bool), [None])

    def searched(df: DataFrame, block: Block) -> DataFrame:
        given = spark.sparkContext.broadcast(block)
        at_text = kept.index(text)
        again = "n_words" in df.columns

        @tidied
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            look = _searched(given.value, window)
            for batch in batches:
                raw, at = utf8(batch.column(at_text))
                for i, j in slices(at, SLICE_BYTES):
                    part = batch.slice(i, j - i)
                    old = {n: part.column(len(kept) + k).to_pylist() for k, n in enumerate(ADDED)} if again else None
                    covered = [[(s["start"], s["end"]) for s in x] for x in old["hit_spans"]] if again else [()] * (j - i)
                    counts, spans, items, matches = look(raw[at[i]:at[j]], at[i:j + 1] - at[i], covered)
                    if again:
                        items = [set(a) | set(b) for a, b in zip(old["items"], items, strict=True)]
                        matches = [[tuple(x.values()) for x in a] + b for a, b in zip(old["matches"], matches, strict=True)]
                    values = (counts, [[{"start": x, "end": y} for x, y in s] for s in spans], [sorted(set(x), key=str.encode) for x in items],
                              [[dict(zip(("start", "words", "item", "item_start"), m, strict=True)) for m in _longest(x)] for x in matches])
                    cols = [pa.array(v, types[n]) for n, v in zip(ADDED, values, strict=True)]
                    yield pa.RecordBatch.from_arrays([*part.columns[:len(kept)], *cols], names=[*kept, *ADDED])

        return df.mapInArrow(run, schema)

    for block in blocks(benchmark, item_id, item_text, window):
        if found is not None:  # what was found so far travels with the documents
            found, spent = stage(found, "contamination"), before
            if spent is not None:
                release(spent)
            before = found
        found = searched(docs if found is None else found, block)
    return searched(docs, nothing) if found is None else found


def _longest(matches: list[tuple]) -> list[tuple]:
    """One match for each start: the longest, the first where several are."""
    best: dict[int, tuple] = {}
    for m in sorted(matches, key=lambda m: (m[0], -m[1], m[2] is None, m[2] or "", m[3])):
        best.setdefault(m[0], m)
    return list(best.values())


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without any passage of ``benchmark`` (see ``find``)."""
    return find(docs, benchmark, **options).where(F.size("hit_spans") == 0).select(*[F.col(f"`{c}`") for c in without(docs, *ADDED).columns])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_hit, n_items,
    items_sha256 (of the comma-joined ids), contaminated; and longest_match,
    in words."""
    found = find(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    longest = F.coalesce(F.array_max(F.transform("matches", lambda m: m["words"])), F.lit(0))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hit_spans") > 0).alias("contaminated"),
                        longest.cast("long").alias("longest_match"))
