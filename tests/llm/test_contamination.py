import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st

from bankscope.llm import contamination as C

from .fixtures import LOWER

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, n_words string, items int, hit string, Matches int"


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items, window=10):
    """Rows of the report, by looking every window up everywhere."""
    out = []
    tests = [(i, w) for i, w in ((i, words(t)) for i, t in items) if w]
    for doc_id, text in docs:
        w = words(text)
        hit, ids, longest = set(), set(), 0
        for i, t in tests:
            m = min(len(t), window)
            for k in range(len(w) - m + 1):
                for x in range(len(t) - m + 1):
                    if w[k:k + m] == t[x:x + m]:
                        hit.update(range(k, k + m))
                        if i is not None:
                            ids.add(str(i))
                        n = m
                        while k + n < len(w) and x + n < len(t) and w[k + n] == t[x + n]:
                            n += 1
                        longest = max(longest, n)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit), longest))
    return sorted(out, key=str)


def _tables(spark, docs, items):
    return (spark.createDataFrame([(*d, "x", 1, "y", 2) for d in docs], SCHEMA).repartition(3),
            spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, start string"))


def _report(spark, docs, items):
    return sorted(map(tuple, C.report(*_tables(spark, docs, items)).collect()), key=str)


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(4)
    vocab = [a + b for a in ("ka", "lo", "ß", "7", "東") for b in ("ri", "n", "to", "ä", "")]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice((12, 15, 30)))) for i in range(12)]
    items += [(20, items[3][1]), (3, items[3][1]), (21, "just Five words, no more"), (22, "!!!"), (23, None), (24, ""), (None, text(11)), (25, "one"), (26, "Just five")]
    docs = [(i, text(rng.choice((0, 3, 40, 200)))) for i in range(40)]
    for i, t in items:
        w = words(t)
        docs.append((100 + (i or 0), f"{text(20)}. {'; '.join(w).upper() if i != 7 else ' '.join(w[:9])}\t{text(5)}"))
        docs.append((200 + (i or 0), f"{text(3)} {' '.join(w[1:])} {text(3)} {' '.join(w[-10:])} {' '.join(w)}"))
    docs += [(300, None), (301, ""), (302, items[0][1]), (302, items[1][1]), (None, items[2][1]), (303, "just five words"), docs[45], (304, f"{items[4][1]} {text(30_000)} {items[5][1]}")]
    return docs, items


def test_like_brute_force(spark, planted):
    docs, items = planted
    got = _report(spark, docs, items)
    assert got == brute(docs, items) and sum(r[5] for r in got) > 20 and not all(r[5] for r in got)


def test_small_blocks_shards_and_slices(spark, planted, monkeypatch):
    """The test set in many blocks, rows and shards: the same but for matches that a row's end cuts."""
    docs, items = planted
    for k, v in (("BLOCK_WORDS", 60), ("ROW_WORDS", 7), ("SHARD_WORDS", 16), ("SLICE_BYTES", 300), ("PAIRS", 3)):
        monkeypatch.setattr(C, k, v)
    assert [r[:6] for r in _report(spark, docs[:60], items)] == [r[:6] for r in brute(docs[:60], items)]


def test_matches_and_removal(spark, planted):
    docs, items = planted
    found = {r.doc_id: r for r in C.find(*_tables(spark, docs, items)).collect()}
    w = words(items[0][1])
    (m,) = found[302].matches if words(found[302].text) == w else [None]
    assert m is None or (m.start, m.words, m.item, m.item_start) == (0, len(w), "0", 0)
    for r in found.values():
        for m in r.matches:
            item = next(words(t) for i, t in items if (None if i is None else str(i)) == m.item and words(t)[m.item_start:m.item_start + m.words] == words(r.text)[m.start:m.start + m.words])
            assert m.words >= min(10, len(item))
    left = C.decontaminate(*_tables(spark, docs, items))
    assert left.columns == ["doc_id", "text", "hit"]
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((r[0] for r in brute(docs, items) if not r[5]), key=str)


def test_empty_tables(spark, planted):
    docs, items = planted
    assert _report(spark, [], items) == []
    assert _report(spark, docs[:5], []) == brute(docs[:5], [])


def test_common_passage_in_many_items(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    items = [(i, f"a{i} {passage} b{i}") for i in range(300)]
    docs = [(i, f"x {passage} y {passage}") for i in range(20)]
    assert _report(spark, docs, items) == brute(docs, items)


@settings(max_examples=60, deadline=None)
@drawn(st.lists(st.integers(0, 3), max_size=80), st.integers(1, 5))
def test_suffix_array_is_sorted_and_search_finds_all(ids, m):
    ids = np.array(ids, np.int32)
    sa = C.suffix_array(ids, m, m, 3)
    padded = np.append(ids, np.zeros(m, ids.dtype))
    rows = [tuple(padded[i:i + m]) for i in sa]
    assert rows == sorted(rows) and sorted(sa) == [i for i in range(len(ids)) if len(ids) - i >= m and ids[i:i + m].all()]
    wanted = np.array([[1 + (k >> j & 1) for j in range(m)] for k in range(1 << m)], np.int32)
    low, high = C.search(padded, sa, wanted)
    for w, a, b in zip(wanted, low, high, strict=True):
        assert sorted(sa[a:b]) == [i for i in sorted(sa) if (padded[i:i + m] == w).all()]
