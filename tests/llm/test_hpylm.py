import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from bankscope.llm import hpylm

from . import fixtures as B


@pytest.fixture(scope="module")
def scored(docs):
    return hpylm.score(docs).collect()


def test_counts_and_base_score(scored, given):
    tokens = [(r[0], B.words((r[1] or "").translate(B.LOWER)) + ["\n"]) for r in given]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in tokens]
    seen = Counter(w for (_, t), h in zip(tokens, held) if not h for w in t)
    n, known = sum(seen.values()), len(seen)
    want = sorted(((i, h, len(t), sum(w in seen for w in t), n) for (i, t), h in zip(tokens, held)), key=str)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in scored), key=str) == want
    base = {i: sum(math.log10((seen[w] + 1) / (n + known + 1)) for w in t) for i, t in tokens}
    for r in scored:
        assert r.base_score == pytest.approx(base[r.doc_id], rel=1e-9)
        assert r.score < 0 and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))


def test_model_beats_the_base_on_held_out_text(spark):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(60)]
    follow = {w: rng.sample(vocab, 4) for w in vocab}

    def text():
        out = [rng.choice(vocab)]
        while len(out) < 80:
            out.append(rng.choice(follow[out[-1]]))
        return " ".join(out)

    df = spark.createDataFrame([(i, text()) for i in range(300)], "doc_id long, text string").cache()
    out = [r for r in hpylm.score(df).collect() if r.held_out]
    base, model = (sum(getattr(r, c) for r in out) / sum(r.n_tokens for r in out) for c in ("base_score", "score"))
    assert model > base + 0.5 and len(out) > 20


def _fitted(spark, texts, parts, hot, sweeps=3):
    df = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, train boolean")
    dealt = hpylm.deal(df, parts, hot).where("words is not null").cache()
    model = hpylm.fit(dealt, hot, parts, sweeps)
    rows = [hpylm._Part(r.asDict(), hot) for r in dealt.collect()]
    told = [[r.asDict() for r in x.collect()] for x in (model.states[0], model.states[-1])]
    states = [[p.state([r for r in x if r["part"] == p.part]) for p in rows] for x in told]
    return model, rows, *states


def _hash(word):
    return hpylm.tokens(np.frombuffer(word, np.uint8), np.array([0, len(word)]))[0][:1]


def test_probabilities_sum_to_one(spark):
    """Over all known words and the unknown one, in every context; the sums
    that the parts are told are those over all parts."""
    texts = ["a b a c a b", "b a b b c", "c c a d", "d a b e"] * 3
    for some in (np.empty(0, np.uint64), _hash(b"a")):
        model, rows, first, last = _fitted(spark, texts, 3, some)
        shared = model.shared[-1]
        assert model.known == 6 and model.tokens == sum(len(t.split()) + 1 for t in texts)
        roots, rest, seats, sums = {}, Counter(), Counter(), {}
        for p, zero, x in zip(rows, first, last):
            roots |= dict(zip(p.words.tolist(), p.root(model, shared, x).tolist()))
            for c, k, t in zip(p.ids[p.context].tolist(), p.customers.tolist(), x["tables"].tolist()):
                assert 1 <= t <= k
                rest[c] += k - model.discount * t
                seats[c] += t
            for c, t, n in zip(p.ids.tolist(), x["context_tables"].tolist(), zero["context_customers"].tolist()):
                assert sums.setdefault(c, (t, n)) == (t, n)
        unknown = (hpylm.STRENGTH + model.root_discount * shared.tables) / (model.known + 1) / (hpylm.STRENGTH + shared.customers)
        assert sum(roots.values()) + unknown == pytest.approx(1)
        assert set(rest) == set(sums)
        for c, x in rest.items():
            assert seats[c] == sums[c][0]
            assert (x + hpylm.STRENGTH + model.discount * seats[c]) / (hpylm.STRENGTH + sums[c][1]) == pytest.approx(1)


def test_scores_do_not_depend_on_the_parts(monkeypatch, docs):
    """Nor on which words are dealt by word and context."""
    found = []
    for n, size, some in ((2, 12 << 20, None), (13, 20_000, None), (5, 60_000, np.sort(np.concatenate([_hash(b"the"), _hash(b"a"), [hpylm._END]])))):
        monkeypatch.setattr(hpylm, "PART", size)
        if some is not None:
            monkeypatch.setattr(hpylm, "frequent", lambda *_: some)  # noqa: B023
        found.append(sorted(((str(r.doc_id), r.n_tokens, r.n_known, r.score) for r in hpylm.score(docs.repartition(n)).collect())))
    for other in found[1:]:
        assert [x[:3] for x in other] == [x[:3] for x in found[0]]
        assert [x[3] for x in other] == pytest.approx([x[3] for x in found[0]], rel=1e-5)


def test_against_a_plain_sampler(spark):
    """Scores of a model that seats customers at tables of its own, in plain
    Python, with averages over runs of both."""
    rng = random.Random(3)
    texts = [" ".join(rng.choices("abcdef", [8, 4, 2, 2, 1, 1], k=12)) for _ in range(25)]
    got = Counter()
    for seed in range(3):
        model, rows, first, last = _fitted_seed(spark, texts, seed)
        for p, zero, x in zip(rows, first, last):
            prob = hpylm.probabilities(p, model, {0: zero, len(model.shared) - 1: x})
            for w, c, q in zip(p.words[p.word].tolist(), p.ids[p.context].tolist(), prob.tolist()):
                got[w, c] += q / 3
    pairs = Counter()
    for t in texts:
        h, c, _, _ = hpylm.tokens(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))
        pairs.update(zip(h.tolist(), c.tolist()))
    want = Counter()
    known, d, e, runs = len({w for w, _ in pairs}), model.discount, model.root_discount, 30
    for _ in range(runs):
        tables = {p: 1 for p in pairs}
        top = {w: 1 for w, _ in pairs}
        for _ in range(4):
            of_context, of_word = Counter(), Counter()
            for (w, c), t in tables.items():
                of_context[c] += t
                of_word[w] += t
            total, new = sum(of_word.values()), (1 + e * sum(top.values())) / (known + 1)
            root = {w: (of_word[w] - e * top[w] + new) / (1 + total) for w in top}
            now = {}
            for (w, c), n in pairs.items():
                weight, t = (1 + d * of_context[c]) * root[w], 1
                for j in range(1, n):
                    t += rng.random() < weight / (weight + j - d * t)
                now[w, c] = t
            tables = now
            for w in top:
                n, t = sum(x for (v, _), x in tables.items() if v == w), 1
                for j in range(1, n):
                    t += rng.random() < new / (new + j - e * t)
                top[w] = t
        of_context, of_word, size = Counter(), Counter(), Counter()
        for (w, c), t in tables.items():
            of_context[c] += t
            of_word[w] += t
            size[c] += pairs[w, c]
        total, new = sum(of_word.values()), (1 + e * sum(top.values())) / (known + 1)
        for (w, c), n in pairs.items():
            root = (of_word[w] - e * top[w] + new) / (1 + total)
            want[w, c] += (n - d * tables[w, c] + (1 + d * of_context[c]) * root) / (1 + size[c]) / runs
    assert set(got) == set(want)
    low = sum(n * math.log10(got[p]) for p, n in pairs.items()) / pairs.total()
    assert low == pytest.approx(sum(n * math.log10(want[p]) for p, n in pairs.items()) / pairs.total(), abs=0.01)
    assert max(abs(got[p] - want[p]) for p in pairs) < 0.05


def _fitted_seed(spark, texts, seed):
    none = np.empty(0, np.uint64)
    df = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, train boolean").coalesce(1)
    dealt = hpylm.deal(df, 2, none).where("words is not null").cache()
    model = hpylm.fit(dealt, none, 2, 4, 1, seed)
    rows = [hpylm._Part(r.asDict(), none) for r in dealt.collect()]
    told = [[r.asDict() for r in x.collect()] for x in (model.states[0], model.states[-1])]
    return model, rows, *[[p.state([r for r in x if r["part"] == p.part]) for p in rows] for x in told]


def test_seating_has_the_expected_tables():
    """Against customers that sit down one by one at real tables, also where
    they sit down in several rounds and where only the places of those who
    open a table are drawn."""
    rng = np.random.default_rng(4)
    for n, weight, discount in ((5, 0.7, 0.5), (60, 3.0, 0.8), (900, 5.0, 0.6), (1500, 60.0, 0.9)):
        keys = hpylm.key(np.arange(3000, dtype=np.uint64), np.full(3000, 7, np.uint64), 1, n)
        args = np.full(3000, n), np.full(3000, weight), discount, keys
        want = []
        for _ in range(400):
            tables = 1
            for j, u in enumerate(rng.random(n - 1), 1):
                tables += u < weight / (weight + j - discount * tables)
            want.append(tables)
        got = hpylm.seat(*args)
        error = 4 * np.std(want) / 20 + 1e-9
        assert abs(got.mean() - np.mean(want)) < error
        assert (hpylm.seat(*args, chunk=700) == got).all()
        jumped = hpylm.seat(*args, many=300)
        assert abs(jumped.mean() - np.mean(want)) < error and 0.85 < jumped.std() / got.std() < 1.15
        # one by one, with the same random numbers
        for i in range(3):
            t = 1
            for j in range(1, n):
                t += hpylm._draws(keys[i:i + 1], np.array([j]))[0] < weight / (weight + j - discount * t)
            assert t == got[i]
    assert hpylm.seat(np.array([0, 1, 2]), np.ones(3), 0.5, np.arange(3, dtype=np.uint64))[:2].tolist() == [0, 1]
    huge = hpylm.seat(np.array([10 ** 12]), np.array([2.0]), 0.1, np.array([5], np.uint64))
    assert 20 < huge[0] < 500


def test_empty_and_untrained_tables(spark, empty):
    assert hpylm.score(empty).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = hpylm.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and r.base_score == 0 and math.isfinite(r.score)


def test_a_file_and_its_copy(spark, tmp_path):
    """Each row of equal files counts and comes back, with the counts of both."""
    rows = [(i, f"the cat {i % 3} sat on the mat") for i in range(6)]
    for name in "ab":
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"file://{tmp_path}/{name}")
    once = {r.doc_id: r for r in hpylm.score(spark.read.parquet(f"file://{tmp_path}/a")).collect()}
    both = hpylm.score(spark.read.parquet(f"file://{tmp_path}/a", f"file://{tmp_path}/b")).collect()
    assert sorted(r.doc_id for r in both) == sorted([*range(6)] * 2)
    for r in both:
        assert (r.n_tokens, r.train_tokens) == (once[r.doc_id].n_tokens, 2 * once[r.doc_id].train_tokens)
        assert r.n_known <= r.n_tokens
        # twice the training makes them likelier; scores that are added up would be twice as low
        assert 1.2 * once[r.doc_id].score < r.score < 0
    assert all(len({x.score for x in both if x.doc_id == i}) == 1 for i in range(6))
