import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from bankscope.llm import packing, wordtable
from bankscope.llm.queries import tokenizer_json

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(tokenizer_json())
    t.no_truncation()
    t.no_padding()
    return t


def test_ids_and_text_like_the_library(docs, given, tok):
    want = sorted(((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())
                   for r in given for ids in [tok.encode(r[1] or "", add_special_tokens=False).ids]), key=str)
    assert sorted(map(tuple, wordtable.digests(docs, tokenizer_json()).collect()), key=str) == want


def test_unusual_white_space_and_small_units(spark, tok, monkeypatch):
    texts = ["a b  c　d", "x\x1cy\x1dz \x0b\x0c", "don't WE'LL 'tis", "Å é́", "<|startoftext|>a<|endoftext|>", "İIı ẞß ΑΣ ΣΑΣ", "tail "]
    monkeypatch.setattr(wordtable, "UNIT", 10)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).cache()
    got = {r.doc_id: r.ids_sha256 for r in wordtable.digests(df, tokenizer_json()).collect()}
    assert got == {i: hashlib.sha256(np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest() for i, t in enumerate(texts)}


def test_words_never_cross_texts():
    import pyarrow as pa

    from bankscope.llm.common import utf8

    texts = ["ab c", "", "d", None, " e", "f ", "  ", "gh"]
    raw, at = utf8(pa.array(texts))
    words, counts = wordtable.cut_words(raw, at)
    assert words.to_pylist() == [b"ab", b"c", b"d", b"e", b"f", b"gh"] and counts.tolist() == [2, 0, 1, 0, 1, 1, 0, 1]
    assert len(set(wordtable.hash_words(words).tolist())) == 6
    x = np.array([0, 1, 255, 70000, 2**32 - 1], np.uint32)
    assert wordtable.unpack(wordtable.pack(x)).tolist() == x.tolist()


def test_packing(docs, given, tok):
    import zlib
    from collections import defaultdict

    out = packing.pack_documents(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), tokenizer_json()).collect()
    ids = {r[0]: np.array(tok.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4") for r in given if r[0] is not None}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert by_doc.keys() == ids.keys() and sorted(by_sequence) == list(range(len(by_sequence)))
    for i, some in by_doc.items():
        at = 0
        for r in sorted(some, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids[i])) and zlib.crc32(ids[i][at:at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids[i])
    for some in by_sequence.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048


def test_rows_without_id_and_twice(docs, empty):
    assert packing.pack_documents(docs, tokenizer_json()).where("doc_id is null").count() >= 1
    out = packing.pack_documents(docs, tokenizer_json())
    assert out.groupBy("sequence_id", "offset").count().where("count > 1").count() == 0
    assert packing.pack_documents(empty, tokenizer_json()).collect() == []
    assert wordtable.digests(empty, tokenizer_json()).collect() == []


def test_plan_uses_the_histogram_and_pads_little():
    rng = np.random.default_rng(2)
    hist = np.bincount(np.minimum(rng.geometric(0.004, 200_000), 1024), minlength=2049)
    hist[2048] = 1000
    plan = packing.plan(hist)
    used = np.zeros(2049, int)
    for lengths, times in plan:
        assert sum(lengths) <= 2048 and times > 0
        for n in lengths:
            used[n] += times
    assert (used == hist).all()
    assert 1 - (hist * np.arange(2049)).sum() / 2048 / sum(t for _, t in plan) < 0.001
    # the least-squares part by itself brings the squared distance down to less than half
    combos, times = packing.combinations()
    assert (combos.sum(1) * times == 2048).all()
    left = hist.copy()
    left[2048] = 0
    x = packing.solve(left, combos, times)
    fit = np.bincount(combos.ravel(), weights=(x[:, None] * (combos > 0) * times[:, None]).ravel(), minlength=2049)
    fit[0] = 0
    assert (x >= 0).all() and ((left - fit) ** 2).sum() < 0.5 * (left.astype(float) ** 2).sum()


def test_one_length_only():
    hist = np.zeros(2049, int)
    hist[700] = 10
    assert sum(t * len(n) for n, t in packing.plan(hist)) == 10
    assert packing.plan(np.zeros(2049, int)) == []
