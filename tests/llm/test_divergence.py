import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from bankscope.llm import divergence

from .fixtures import LOWER

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "lang string, source string, text string, term string, n int, part string"


def brute(rows, least=30, top=50, pseudo=5):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in ((a or "", b or "", t or "") for a, b, t in rows):
        found = TERM.findall(text.translate(LOWER))
        groups[lang].add(source)
        count[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        v = len(kept)

        def shares(c):
            total = sum(c[t] for t in kept) + pseudo * v
            return {t: 1 + 10**9 * (c[t] + pseudo) // total for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t])[:top]
            for part, x in (("pair", sorted(pairs)), ("term", terms)):
                out += [(lang, s, part, i.decode(), -n, r + 1) for r, (n, i) in enumerate(x)]
    return sorted(out)


def _run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(5)
    return sorted(map(tuple, divergence.audit(df, **options).collect()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    words = [a + b for a in ("ka", "Lo", "ß", "éa", "東", "x") for b in ("ri", "N", "to", "ä", "", "zz")] + ["don't", "a1b", "--", "\x7f"]
    out = [(rng.choice(("en", "de")), rng.choice(("web", "web", "web", "books", "")), " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for _ in range(400)]
    out += [(None, None, None), ("fr", "one", "alone"), ("es", "a", None), ("es", "b", ""), ("en", "web", "long " * 60_000), out[0], out[0], ("de", None, "lo")]
    return out


def test_like_brute_force(spark, rows):
    got = _run(spark, rows)
    assert got == brute(rows) and {r[0] for r in got} >= {"en", "de", "es"}
    assert [r for r in got if r[0] == "es"] == [("es", "a", "pair", "b", 0, 1), ("es", "b", "pair", "a", 0, 1)]


def test_in_many_shards_and_partial_counts(spark, rows, monkeypatch):
    want = brute(rows, 3, 4, 2)
    monkeypatch.setattr(divergence, "CELLS", 20)
    monkeypatch.setattr(divergence, "SHARD_BYTES", 2000)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 500)
    assert _run(spark, rows, least_docs=3, top=4, pseudo=2) == want


def test_ties_go_by_bytes(spark):
    rows = [("en", s, t) for s, t in (("a", "z é"), ("b", "q w"), ("c", "q w")) for _ in range(30)]
    got = _run(spark, rows)
    assert got == brute(rows)
    assert [r[3] for r in got if r[:3] == ("en", "a", "pair")] == ["b", "c"] and [r[3] for r in got if r[:3] == ("en", "a", "term")] == ["z", "é"]


def test_no_rows(spark):
    assert _run(spark, []) == []


def test_shares_beyond_64_bits():
    n, total = np.array([0, 7, 10**12, 10**15]), np.array([10**15])
    assert divergence._share(n, total).tolist() == [1 + 10**9 * int(x) // 10**15 for x in n]
