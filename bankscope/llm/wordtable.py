"""Encoding by a table of distinct words.

White space never lies within a token, so a text's ids are its words' ids one
after the other.  Texts are cut into words in units of some megabytes; each
unit asks the word table, dealt by word hash, for the ids of its distinct
words; a part of the table encodes each of its distinct words once and
answers every unit; a unit's ids then come back by word position.  Only word
lists, id lists and coded texts are shuffled, all packed.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, tidied, utf8

#: Bytes of text in a unit.
UNIT = 16 << 20
#: The bytes between words (space and 9 to 13).
_GAP = np.zeros(256, bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True


def cut_words(raw: np.ndarray, at: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The words of texts that lie one after the other, and how many words
    each text has."""
    if not len(raw):
        return pa.array([], pa.large_binary()), np.zeros(len(at) - 1, np.int64)
    inside = ~_GAP[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    # a text's first byte begins a word though the text before ends in one
    starts = at[:-1][at[:-1] < at[1:]]
    first[starts] = inside[starts]
    last[starts[1:] - 1] = inside[starts[1:] - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last)
    offsets = np.append(0, np.cumsum(end + 1 - begin))
    data = raw[inside]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data)]), np.diff(np.searchsorted(begin, at))


def word_bytes(words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of non-empty words, one after the other, and where each
    begins (with the end of the last)."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]] if len(words) else np.empty(0, np.uint8), at - at[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number, one to one."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(words: pa.LargeBinaryArray) -> np.ndarray:
    """64-bit hashes: the sum of random numbers of the bytes, each times one
    of its place, mixed with the length."""
    data, at = word_bytes(words)
    if not len(words):
        return np.empty(0, np.uint64)
    n = np.diff(at)
    place = mixed(np.arange(int(n.max()), dtype=np.uint64))
    byte = mixed(np.arange(256, 512, dtype=np.uint64))
    where = np.arange(len(data)) - np.repeat(at[:-1], n)
    return mixed(np.add.reduceat(byte[data] * place[where], at[:-1]) + n.astype(np.uint64))


def pack(a: np.ndarray) -> bytes:
    """Numbers of up to four bytes, byte by byte, compressed."""
    b = np.ascontiguousarray(a, np.uint32).view(np.uint8).reshape(-1, 4)
    return zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(b.T).tobytes())


def unpack(b: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view(np.uint32).ravel()


def pack_long(a: np.ndarray) -> bytes:
    """Numbers of eight bytes, byte by byte, compressed."""
    b = np.ascontiguousarray(a, np.uint64).view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(b.T).tobytes())


def unpack_long(b: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).ravel()


def flatten(ids: np.ndarray, begin: np.ndarray, length: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The ids of the words ``codes``, where word w has
    ids[begin[w]:begin[w] + length[w]]."""
    n = length[codes]
    end = np.cumsum(n)
    if not len(end):
        return ids[:0]
    return ids[np.arange(end[-1]) + np.repeat(begin[codes] - (end - n), n)]


class _Grown:
    """Numbers that are added to; the room for them doubles."""

    def __init__(self, kind: type):
        self.values, self.size = np.empty(1024, kind), 0

    def add(self, new: np.ndarray) -> None:
        if self.size + len(new) > len(self.values):
            room = np.empty(2 * (self.size + len(new)), self.values.dtype)
            room[:self.size] = self.values[:self.size]
            self.values = room
        self.values[self.size:self.size + len(new)] = new
        self.size += len(new)


class _Unit:
    """Distinct words, most frequent first, and the words of each text."""

    def __init__(self, doc_ids: pa.Array, raw: np.ndarray, at: np.ndarray, parts: int):
        words, self.counts = cut_words(raw, at)
        self.doc_ids = doc_ids
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(-np.bincount(codes, minlength=len(coded.dictionary)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        self.codes = rank[codes]
        self.words = coded.dictionary.take(pa.array(order))
        self.part = (hash_words(self.words) % np.uint64(parts)).astype(np.int64)
        h = xxhash.xxh3_128(self.codes.tobytes())
        h.update(word_bytes(self.words)[0].tobytes())
        h.update(repr((doc_ids.to_pylist(), self.counts.tolist())).encode())
        self.key = h.hexdigest()

    def lists(self) -> Iterator[tuple[int, bytes]]:
        """The words of each part, with a line feed between."""
        order = np.argsort(self.part, kind="stable")
        data, at = word_bytes(self.words.take(pa.array(order)))
        lined = np.insert(data, at[1:], 10)
        edges = np.append(_starts(self.part[order]), len(order))
        for i, j in zip(edges.tolist(), edges[1:].tolist()):
            yield int(self.part[order[i]]), lined[at[i] + i:at[j] + j - 1].tobytes()


def _starts(x: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.empty(0, np.int64)


def _units(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[_Unit]:
    for b in batches:
        raw, at = utf8(b.column(1))
        for i, j in slices(at, UNIT):
            yield _Unit(b.column(0).slice(i, j - i), raw[at[i]:at[j]], at[i:j + 1] - at[i], parts)


def encode(docs: DataFrame, tokenizer: str, emit: Callable[[list, np.ndarray, np.ndarray], pa.Table], schema: str,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``emit(doc ids, ids of all their tokens, tokens of each)`` for every
    unit of documents; its tables have ``schema``.

    ``tokenizer``: the JSON of a tokenizer whose tokens hold no white space.
    Null texts are empty.  ``docs`` is read twice and must give the same rows
    in the same order, as a table does; if it does not, the join fails.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u in _units(batches, parts):
            z = zstandard.ZstdCompressor(3)
            rows = [(u.key, p, z.compress(w)) for p, w in u.lists()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.binary()))],
                                             names=["unit", "part", "words"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(tokenizer)
        tok.no_truncation()
        tok.no_padding()
        known: dict[bytes, int] = {}
        length, ids = _Grown(np.int64), _Grown(np.uint32)  # of all known words
        begin = _Grown(np.int64)
        for b in batches:
            for unit, part, packed in zip(*[c.to_pylist() for c in b.columns], strict=True):
                words = zstandard.ZstdDecompressor().decompress(packed).split(b"\n")
                new = [w for w in words if w not in known]
                for i in range(0, len(new), 4096):
                    some = new[i:i + 4096]
                    found = [e.ids for e in tok.encode_batch_fast([w.decode("utf-8", "replace") for w in some], add_special_tokens=False)]
                    known.update(zip(some, range(len(known), len(known) + len(some))))
                    n = np.fromiter(map(len, found), np.int64, len(found))
                    begin.add(ids.size + np.cumsum(n) - n)
                    length.add(n)
                    ids.add(np.fromiter(chain.from_iterable(found), np.uint32))
                at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                yield pa.RecordBatch.from_arrays([pa.array([unit]), pa.array([part], pa.int32()), pa.array([pack(length.values[at])]),
                                                  pa.array([pack(flatten(ids.values, begin.values, length.values, at))])],
                                                 names=["unit", "part", "lengths", "ids"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u in _units(batches, parts):
            yield pa.RecordBatch.from_arrays([pa.array([u.key]), pa.array([u.doc_ids.to_pylist()], pa.list_(pa.int64())),
                                              pa.array([pack(u.counts)]), pa.array([pack(u.codes)]), pa.array([pack(u.part)])],
                                             names=["unit", "doc_ids", "counts", "codes", "parts"])

    def join(key, coded: pa.Table, table: pa.Table) -> pa.Table:
        out = []
        parts_found = {p: (unpack(n), unpack(i)) for p, n, i in zip(*[table.column(c).to_pylist() for c in ("part", "lengths", "ids")], strict=True)}
        if table.num_rows and not coded.num_rows:
            raise ValueError("the documents differ between two reads")
        for row in coded.to_pylist():
            part, codes, counts = unpack(row["parts"]), unpack(row["codes"]), unpack(row["counts"]).astype(np.int64)
            order = np.argsort(part, kind="stable")
            asked = np.unique(part).tolist()
            if any(p not in parts_found for p in asked):
                raise ValueError("the documents differ between two reads")
            length = np.empty(len(part), np.int64)
            got = np.concatenate([parts_found[p][0] for p in asked]) if asked else np.empty(0, np.uint32)
            ids = np.concatenate([parts_found[p][1] for p in asked]) if asked else np.empty(0, np.uint32)
            length[order] = got
            begin = np.empty(len(part), np.int64)
            begin[order] = np.cumsum(got.astype(np.int64)) - got
            flat = flatten(ids, begin, length, codes)
            upto = np.append(0, np.cumsum(length[codes]))
            ends = np.append(0, np.cumsum(counts))
            out.append(emit(row["doc_ids"], flat, np.diff(upto[ends])))
        return pa.concat_tables(out)

    asked = d.mapInArrow(tidied(ask), "unit string, part int, words binary").repartition("part")
    answers = asked.mapInArrow(tidied(answer), "unit string, part int, lengths binary, ids binary")
    coded = d.mapInArrow(tidied(texts), "unit string, doc_ids array<long>, counts binary, codes binary, parts binary")
    return coded.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(join, schema)


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Query op3: number of tokens of each document, SHA-256 of its ids and
    of the text that they decode to: the pieces with a space between."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(tokenizer)
    # the id-to-piece table: as large as the vocabulary
    pieces = [(tok.id_to_token(i) or "").encode() for i in range(tok.get_vocab_size(with_added_tokens=True))]

    def emit(doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> pa.Table:
        ends = np.append(0, np.cumsum(counts)).tolist()
        little = ids.astype("<u4")
        a, b = [], []
        for i, j in zip(ends, ends[1:]):
            a.append(hashlib.sha256(little[i:j].tobytes()).hexdigest())
            b.append(hashlib.sha256(b" ".join([pieces[k] for k in ids[i:j].tolist()])).hexdigest())
        return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(counts, pa.int64()),
                         "ids_sha256": pa.array(a, pa.string()), "decoded_sha256": pa.array(b, pa.string())})

    return encode(docs, tokenizer, emit, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
