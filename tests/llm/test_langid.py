import random
import zlib

import numpy as np

from bankscope.llm import langid

VOCAB = {"aa": "the of and to in that is was for with", "bb": "der die und das mit nicht auf ist ein zu", "cc": "les des est que une dans pour qui sur pas"}


def _text(rng, lang, n):
    return " ".join(rng.choice(VOCAB[lang].split()) for _ in range(n))


def _docs(spark, n=400):
    rng = random.Random(2)
    rows = [(i, _text(rng, lang, rng.choice((8, 40))), lang) for i in range(n) for lang in [rng.choice(list(VOCAB))]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").cache()


def test_held_out_accuracy(spark):
    out = langid.identify(_docs(spark)).join(_docs(spark).select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(held) > 50 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_mixture_is_found(spark):
    model = langid.train(_docs(spark))
    rng = random.Random(4)
    mixed = [(1, _text(rng, "aa", 150) + " " + _text(rng, "bb", 75), None), (2, _text(rng, "cc", 200), None), (3, _text(rng, "cc", 200).upper(), None)]
    out = {r.doc_id: r for r in langid.detect(spark.createDataFrame(mixed, "doc_id long, text string, lang string"), model).collect()}
    assert out[1].lang_pred == "aa" and set(out[1].lang_mix) == {"aa", "bb"} and 0.55 < out[1].lang_mix["aa"] < 0.78
    assert set(out[2].lang_mix) == {"cc"} == set(out[3].lang_mix) and out[2].score > 0.95


def test_expectation_maximisation_raises_the_likelihood():
    rng = np.random.default_rng(0)
    p, n = rng.random((3, 50)), rng.integers(1, 9, 50).astype(float)
    values = [langid._em(p, n, n.sum(), k)[1] for k in range(1, 12)]
    assert all(b >= a - 1e-9 for a, b in zip(values, values[1:]))


def test_edges_of_the_table(spark, docs, empty, given):
    out = langid.identify(docs).collect()
    assert len(out) == len(given)
    by = {r.doc_id: r for r in out}
    for r in given:
        if r[0] is not None and (r[1] is None or not any(c.isalpha() for c in r[1])):
            assert (by[r[0]].lang_pred, by[r[0]].score, by[r[0]].lang_mix) == ("und", 0.0, {})
    full = langid.detect(docs, langid.train(docs))
    assert "Lang_Pred" not in full.columns and full.columns.count("score") == 1 and full.count() == len(given)
    assert langid.identify(empty).collect() == []
    none = langid.detect(docs, langid.train(empty))
    assert none.where("lang_pred <> 'und'").count() == 0
