"""Language identification by a mixture of languages for each document.

Each language has a multinomial over hashed byte trigrams of lower-cased
text, counted over all labelled training documents.  A document is taken as a
mixture of languages: expectation-maximisation estimates its proportions, and
the set of languages is the one of largest penalised likelihood among the
sets that grow by the next most present language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, tidied, utf8, without

#: Hashed trigrams; the model has this many numbers for each language.
BUCKETS = 1 << 15
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_p: np.ndarray  # languages x buckets


def _padded(text: str) -> F.Column:
    """Lower case with a space at either end, so that one letter has a trigram."""
    return F.concat(F.lit(" "), F.lower(text), F.lit(" "))


def _trigrams(raw: np.ndarray) -> np.ndarray:
    """Hashed byte trigrams that start at each byte but the last two."""
    if len(raw) < 3:
        return np.empty(0, np.int32)
    x = raw.astype(np.uint32)
    x = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
    return ((x * np.uint32(2654435761)) >> np.uint32(32 - 15)).astype(np.int32)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of a partition; its size depends on the languages
    and buckets, not on the documents."""
    total: dict[str, np.ndarray] = {}

    def flush():
        for lang, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(c[at])], names=["lang", "bucket", "n"])
        total.clear()

    for b in batches:
        raw, at = utf8(b.column(0))
        langs = b.column(1).to_pylist()
        for i, j in slices(at, 1 << 20):
            for k in range(i, j):
                t = _trigrams(raw[at[k]:at[k + 1]])
                if len(t):
                    c = total.get(langs[k])
                    if c is None:
                        if len(total) >= 256:  # then what is counted so far goes out first
                            yield from flush()
                        c = total[langs[k]] = np.zeros(BUCKETS, np.int64)
                    c += np.bincount(t, minlength=BUCKETS)
    yield from flush()


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Count the trigrams of every row with a text and a language.  What
    comes to the driver is languages x BUCKETS numbers, whatever the rows."""
    rows = (docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
            .select(_padded(text).alias("t"), F.col(lang).alias("l"))
            .mapInArrow(tidied(_counts), "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))).toPandas()
    names = sorted(rows["lang"].unique())
    c = np.full((len(names), BUCKETS), 0.5)
    c[rows["lang"].map({n: i for i, n in enumerate(names)}).to_numpy(dtype=np.int64), rows["bucket"].to_numpy()] += rows["n"]
    return LanguageModel(names, np.log(c / c.sum(1, keepdims=True)).astype(np.float32))


def _em(p: np.ndarray, n: np.ndarray, total: float, rounds: int) -> tuple[np.ndarray, float]:
    """Proportions and log likelihood of a mixture with the given columns."""
    w = np.full(p.shape[0], 1.0 / p.shape[0])
    for _ in range(rounds):
        mix = w @ p
        new = w * (p @ (n / mix)) / total
        done = np.abs(new - w).max() < 1e-3
        w = new
        if done:
            break
    return w, float(n @ np.log(np.maximum(w @ p, 1e-300)))


def mixture(log_p: np.ndarray, grams: np.ndarray, penalty: float, rounds: int = 30) -> tuple[list[int], np.ndarray]:
    """Languages of a document, most present first, and their proportions."""
    ids, n = np.unique(grams, return_counts=True)
    n = n.astype(np.float64)
    total = n.sum()
    lp = log_p[:, ids].astype(np.float64)
    top = lp.max(0)
    p = np.exp(lp - top)
    w, _ = _em(p, n, total, rounds)
    order = np.argsort(-w, kind="stable")
    alone = np.log(np.maximum(p, 1e-300)) @ n
    best = [int(np.argmax(alone))]
    share, value = np.ones(1), float(alone[best[0]])
    for size in range(2, int((w > 0.02).sum()) + 1):
        chosen = [int(k) for k in order[:size]]
        s, ll = _em(p[chosen], n, total, rounds)
        if ll - penalty * (size - 1) * np.log(total + 1) > value:
            value = ll - penalty * (size - 1) * np.log(total + 1)
            best, share = chosen, s
    order = np.argsort(-share, kind="stable")
    return [best[k] for k in order], share[order]


def detect(docs: DataFrame, model: LanguageModel, text: str = "text", penalty: float = 8.0,
           prefix: str = "") -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` (the most present
    language), ``score`` (its proportion, drawn towards an even split by one
    trigram of each language, so that short texts are less sure) and
    ``lang_mix`` (map of the chosen languages to their proportions).

    A null text, one without a letter, or any text when no language was
    learned gives ``und``, 0.0 and an empty map.  Columns of ``docs`` with
    these names (any letter case, after ``prefix``) are replaced.
    """
    log_p, langs = model.log_p, model.languages

    @F.arrow_udf("lang_pred string, score double, lang_mix map<string,double>")
    def predict(texts: pa.Array) -> pa.Array:
        raw, at = utf8(texts)
        known = texts.is_valid().to_numpy(zero_copy_only=False)
        out = []
        for k in range(len(known)):
            if not known[k] or not langs:
                out.append((UNKNOWN, 0.0, []))
                continue
            grams = _trigrams(raw[at[k]:at[k + 1]])
            which, share = mixture(log_p, grams, penalty)
            sure = (share[0] * len(grams) + 1) / (len(grams) + len(langs))
            out.append((langs[which[0]], float(sure), [(langs[i], float(s)) for i, s in zip(which, share, strict=True)]))
        pred, score, mix = zip(*out, strict=True) if out else ((), (), ())
        pa.default_memory_pool().release_unused()
        return pa.StructArray.from_arrays(
            [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(mix, pa.map_(pa.string(), pa.float64()))],
            names=["lang_pred", "score", "lang_mix"])

    names = [f"{prefix}{n}" for n in ("lang_pred", "score", "lang_mix")]
    seen = F.when(F.col(text).rlike(r"\p{L}"), _padded(text))
    # the struct is computed once and its fields are taken from a column
    d = without(docs, *names).withColumn("_llm_lang", predict(seen))
    return d.select("*", *[F.col(f"_llm_lang.{n}").alias(f"{prefix}{n}") for n in ("lang_pred", "score", "lang_mix")]).drop("_llm_lang")


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows kept out of training: crc32 of the id as text, mod 5, is 0 (a
    null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def identify(docs: DataFrame) -> DataFrame:
    """The contract of query op9: learn from the rows not held out, predict
    every row."""
    model = train(docs.where(~held_out()))
    return (detect(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "lang_mix"))


def keep_sure(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Pipeline stage: rows whose language is found and holds at least half
    of the text; the columns stay as they are."""
    model = train(docs.where(~held_out()))
    out = detect(docs, model, prefix="_op9_")
    return out.where((F.col("_op9_lang_pred") != UNKNOWN) & (F.col("_op9_score") >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])
