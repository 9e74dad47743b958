import re
from collections import Counter

from pyspark.sql import functions as F

from bankscope.llm import rules

from . import fixtures as B


def counts(text):
    w = B.words(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(grams)
    covered = {k for i, g in enumerate(grams) if n[g] > 1 for k in range(i, i + 5)}
    seen, dup, total = set(), 0, 0
    for x in (text or "").split("\n"):
        if B.words(x):
            total += 1
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), total, dup, len(covered)


def test_counts_like_brute_force(docs, given):
    out = rules.count_measures(docs)
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) for r in out.collect()]
    assert sorted(got, key=str) == sorted(((r[0], *counts(r[1])) for r in given), key=str)
    assert "text" not in out.columns and out.columns.count("n_lines") == 1


def test_quantiles_are_within_the_accuracy(spark):
    df = spark.range(5000).select((F.pow(F.col("id") / 50, 2) + 1).alias("v"))
    bins = df.select(rules._value(rules._bin(F.col("v"))).alias("b"), "v").where("abs(b - v) > 0.011 * v")
    assert bins.count() == 0


def test_outliers_fail_and_clean_documents_stay(spark):
    import random

    rng = random.Random(1)
    vocab = ["the", "of", "river", "mountain", "walks", "under", "green", "and", "stones"]
    clean = [(i, " ".join(rng.choice(vocab) + str(rng.randrange(99)) for _ in range(80)), "en", "a" if i % 3 else None) for i in range(600)]
    junk = [(1000 + i, " ".join("w%d ## $$ %%" % rng.randrange(9999) for _ in range(40)), "en", "a") for i in range(6)]
    lang = [(2000, " ".join(f"x{rng.randrange(999)}" for _ in range(60)), "xx", "new")]  # a group of one: the fences of all
    short = [(3000, "too short", "en", "a"), (3001, None, None, None), (3002, "", "en", "a")]
    out = {r.doc_id: r for r in rules.judge(spark.createDataFrame(clean + junk + lang + short, "doc_id long, text string, lang string, source string")).collect()}
    assert all(out[d[0]].kept for d in clean + lang)
    assert not any(out[d[0]].kept for d in junk + short)
    assert all("symbols" in out[d[0]].failed and not out[d[0]].base_failed for d in junk) and all(out[d[0]].base_failed for d in short)


def test_merged_sketches_are_those_of_all(docs):
    counted = rules.count_measures(docs)
    one = rules.sketches(counted).groupBy("measure", "bin").agg(F.sum("n").alias("n"))
    all_ = rules.sketches(counted.withColumns({"lang": F.lit("x"), "source": F.lit("y")})).select("measure", "bin", "n")
    assert one.exceptAll(all_).count() == 0 == all_.exceptAll(one).count()


def test_edges_of_the_table(docs, empty, given):
    out = rules.judge(docs)
    assert out.count() == len(given) and out.where("kept is null or base_failed is null").count() == 0
    assert rules.judge(empty).collect() == []
