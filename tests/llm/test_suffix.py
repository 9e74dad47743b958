import hashlib
import random
from collections import Counter

from bankscope.llm import suffix


def brute(texts: list[tuple[int, bytes]]) -> dict[int, tuple]:
    n = suffix.LONG
    seen = Counter(b[k:k + n] for _, b in texts for k in range(len(b) - n + 1))
    out = {}
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if seen[b[k:k + n]] > 1:
                gone[k:k + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1])), hashlib.sha256(kept).hexdigest())
    return out


def _check(df, texts, **more):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.remove_repeats(df, **more).collect()}
    assert got == brute([(i, (t or "").encode()) for i, t in texts])
    return got


def test_like_brute_force(docs, given):
    out = suffix.remove_repeats(docs)
    assert out.count() == len(given)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()}
    assert got == brute([(r[0], (r[1] or "").encode()) for r in given])
    assert sum(x[1] for x in got.values()) > 1000


def test_passages_in_other_contexts(spark, monkeypatch):
    """Passages around the length that counts, edited copies, strings that
    overlap themselves; any number of batches gives the same."""
    monkeypatch.setattr(suffix, "STRINGS", 3000)
    rng = random.Random(5)
    line = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    base, passage = line(1500), line(260)
    texts = [(i, line(300) + passage[rng.randrange(60):260 - rng.randrange(60)] + line(200)) for i in range(40)]
    for i in range(40, 70):
        k = rng.randrange(1500)
        texts.append((i, base[:k] + "X" + base[k + 1:]))
    texts += [(70, "ab" * 400), (71, "z" * 199), (72, "z" * 200), (73, "y" * 201), (74, line(200)), (75, None), (76, "")]
    texts.append((77, texts[74][1]))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3).cache()
    for batches in (1, 3, 4):
        _check(df, texts, batches=batches)


def test_columns_and_empty_table(docs, empty):
    out = suffix.remove_repeats(docs)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    assert suffix.remove_repeats(empty).collect() == []


def test_one_id_with_two_texts(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij ") for _ in range(300))
    shared = word()
    rows = [(1, word() + shared), (1, shared + word()), (1, None), (2, word()), (2, ""), (3, shared), (3, shared), (None, shared[:250]), (4, word())]
    out = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out)
    want = brute([(k, (t or "").encode()) for k, (_, t) in enumerate(rows)])
    assert got == sorted((i or 0, *want[k]) for k, (i, _) in enumerate(rows))
