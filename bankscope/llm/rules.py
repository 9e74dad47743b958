"""Quality rules with thresholds that adapt to each language and source.

Measures of a document are counted with column functions alone.  Their
distribution in each (language, source) is a log-binned histogram: bins whose
ends differ by a fixed ratio, so that any quantile is right within
``ACCURACY``; sketches merge by adding counts and their size depends on the
range of values, not on the rows.  A document fails where a measure lies
beyond the outer fences of its group, quartile +- REACH interquartile ranges.
A group with few documents takes the merged sketch of its language, a
language with few that of all documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_GAP, stage, without, words

WINDOW = 5
ACCURACY = 0.01
REACH = 3.0
#: Documents that a group needs for fences of its own.
LEAST_DOCS = 100
#: Measure: (SQL expression over the counted columns, least interquartile range,
#: whether low values fail too).  Where most values are equal, the least
#: range keeps the fences from closing on them.
MEASURES = {
    "word_length": ("word_chars / n_words", 1.0, True),
    "symbols": ("n_symbols / n_words", 0.05, False),
    "dup_lines": ("n_dup_lines / n_lines", 0.15, False),
    "repeats": ("n_repeat_words / n_words", 0.06, False),
}
_GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
#: Values under this are taken as zero.
_TINY = 1e-6
_ZERO_BIN = -(1 << 20)


def count_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_words, word_chars, n_symbols,
    n_lines, n_dup_lines and n_repeat_words (null text: all 0; columns with
    these names are replaced).

    Whole texts are worked on inside their row: no shuffle, and a repeated
    window is found by sorting the hashes of the document's own windows.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    out = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    d = without(docs, *out, "_h", "_g", "_s", "_p", "_l")
    rest = [F.col(f"`{c}`") for c in d.columns if c != text]
    lines = F.filter(F.split(t, "\n"), lambda x: F.regexp_replace(x, WORD_GAP, "") != "")
    d = d.select(*rest, F.transform(words(t), lambda w: F.xxhash64(w)).alias("_h"), lines.alias("_l"),
                 F.length(F.regexp_replace(t, WORD_GAP, "")).cast("long").alias("word_chars"),
                 (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"))
    keep = [F.col(c) if isinstance(c, str) else c for c in (*rest, "word_chars", "n_symbols")]
    gram = F.transform(F.sequence(F.lit(0), F.size("_h") - WINDOW),
                       lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(WINDOW)]))
    d = d.select(*keep, F.size("_h").cast("long").alias("n_words"), F.size("_l").cast("long").alias("n_lines"),
                 (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                 F.when(F.size("_h") >= WINDOW, gram).alias("_g"))
    keep += [F.col(c) for c in ("n_words", "n_lines", "n_dup_lines")]
    repeated = F.size(F.array_distinct("_g")) < F.size("_g")
    d = d.select(*keep, F.when(repeated, F.array_sort(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
                 .alias("_s"))
    twice = F.filter("_s", lambda x, i: (F.get("_s", i - 1)["g"] == x["g"]) | (F.get("_s", i + 1)["g"] == x["g"]))
    d = d.select(*keep, F.array_sort(F.transform(twice, lambda x: x["i"])).alias("_p"))
    covered = F.aggregate(F.zip_with("_p", F.slice("_p", 2, F.size("_p")),
                                     lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
                          F.lit(0).cast("long"), lambda s, x: s + x)
    return d.select(*keep, F.coalesce(covered, F.lit(0)).alias("n_repeat_words"))


def _bin(v: Column) -> Column:
    return F.when(v <= _TINY, F.lit(_ZERO_BIN)).otherwise(F.ceil(F.log(v) / math.log(_GAMMA)).cast("int"))


def _value(b: Column) -> Column:
    return F.when(b == _ZERO_BIN, F.lit(0.0)).otherwise(F.pow(F.lit(_GAMMA), b) * (2 / (_GAMMA + 1)))


def sketches(counted: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, measure, bin, n) of the documents with a word."""
    each = F.array(*[F.struct(F.lit(k).alias("measure"), _bin(F.expr(e)).alias("bin")) for k, (e, _, _) in MEASURES.items()])
    return (counted.where("n_words > 0").select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(each).alias("x"))
            .groupBy("lang", "source", "x.measure", "x.bin").agg(F.count("*").alias("n")))


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, one struct(lo, hi) for each measure): a row for each
    group of ``sketch``; its own fences or those of the merged sketches."""
    low = {k: (v[1], v[2]) for k, v in MEASURES.items()}
    least = F.create_map(*[x for k, v in low.items() for x in (F.lit(k), F.lit(v[0]))])
    both = F.create_map(*[x for k, v in low.items() for x in (F.lit(k), F.lit(v[1]))])

    def quartiles(by: list[str], name: str) -> DataFrame:
        w = Window.partitionBy(*by, "measure")
        merged = sketch.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))
        ranked = merged.select("*", F.sum("n").over(w.orderBy("bin")).alias("upto"), F.sum("n").over(w).alias("docs"))
        q = [F.min(F.when(F.col("upto") > (F.col("docs") - 1) * p, F.col("bin"))).alias(c) for p, c in ((0.25, "a"), (0.75, "b"))]
        q1, q3 = _value(F.col("a")), _value(F.col("b"))
        spread = REACH * F.greatest(q3 - q1, least[F.col("measure")])
        fence = F.struct(F.when(both[F.col("measure")], q1 - spread).alias("lo"), (q3 + spread).alias("hi"))
        return (ranked.groupBy(*by, "measure", "docs").agg(*q)
                .select(*by, "measure", F.when(F.col("docs") >= LEAST_DOCS, fence).alias(name)) if by else
                ranked.groupBy("measure", "docs").agg(*q).select("measure", fence.alias(name)))

    own = quartiles(["lang", "source"], "own").alias("o")
    mid = quartiles(["lang"], "mid").alias("m")
    top = quartiles([], "top").alias("t")
    joined = (own.join(mid, F.col("o.lang").eqNullSafe(F.col("m.lang")) & (F.col("o.measure") == F.col("m.measure")))
              .join(top, F.col("o.measure") == F.col("t.measure"))
              .select("o.lang", "o.source", "o.measure", F.coalesce("own", "mid", "top").alias("fence")))
    return joined.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("measure") == k, F.col("fence"))).alias(f"_fence_{k}") for k in MEASURES])


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``docs`` without its text, with the counted columns, ``base_failed``
    (under 10 words, or over a fifth of the words in repeated windows),
    ``failed`` (names of the measures beyond their fences) and ``kept``.

    Null languages and sources are groups of their own.  A document without a
    word fails the base rules.  An empty table gives an empty result.
    """
    counted = stage(count_measures(docs, text), "measures")
    f = fences(sketches(counted, lang, source)).withColumnsRenamed({"lang": "_f_lang", "source": "_f_source"})
    d = counted.join(f, F.col(lang).eqNullSafe(F.col("_f_lang")) & F.col(source).eqNullSafe(F.col("_f_source")), "left")
    value = {k: F.when(F.col("n_words") > 0, F.expr(e)) for k, (e, _, _) in MEASURES.items()}
    beyond = [F.when((v > F.col(f"_fence_{k}.hi")) | (v < F.col(f"_fence_{k}.lo")), F.lit(k)) for k, v in value.items()]
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    d = d.withColumns({"base_failed": base, "failed": F.array_compact(F.array(*beyond))})
    return d.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)).drop(
        "_f_lang", "_f_source", *[f"_fence_{k}" for k in MEASURES])
