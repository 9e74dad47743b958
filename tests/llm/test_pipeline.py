import zlib

import numpy as np

import corpus_pipeline
from bankscope.llm import langid, pii
from bankscope.llm.queries import tokenizer_json

from . import fixtures as B


def test_like_brute_force(spark, docs, given, tmp_path):
    """Every stage by its brute-force version; which languages are sure comes
    from the operator, whose accuracy has a test of its own."""
    unique = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    unique.write.parquet(f"file://{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()

    sure = {r.doc_id for r in langid.keep_sure(spark.read.parquet(f"file://{tmp_path}/documents.parquet")).collect()}
    texts = {r[0]: r[1] for r in given if r[0] in sure}
    assert len(texts) > 80 and all(t is not None for t in texts.values())
    lines = B.dedup_lines(texts)
    texts = {i: t for i, (t, _, n) in lines.items() if n == 0 or any(B.line_words(x) for x in t.split("\n"))}
    keep = B.jaccard(texts, 5, 80, 100)
    texts = {i: t for i, t in texts.items() if keep[i][1] == i}
    replace = pii.replacer(pii.DEMO_KEY)
    texts = {i: replace(t)[0] for i, t in texts.items()}

    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(tokenizer_json())
    ids = {i: np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
    seen = dict.fromkeys(ids, 0)
    for r in sorted(out, key=lambda r: (r.doc_id, r.start)):
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.start == seen[r.doc_id] and zlib.crc32(part.tobytes()) == r.ids_crc32 and len(part) == r.length
        seen[r.doc_id] += r.length
    assert seen == {i: len(x) for i, x in ids.items()}


def test_stages_return_the_columns_of_documents(spark, docs):
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, "")
        assert out.columns == docs.columns
    empty = docs.where("false")
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, "").collect() == []


def test_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14)) and "pipeline" in names


def test_steps_leave_one_stage_behind(spark):
    """What line_dedup and ngram_join wrote on the way to their removals is gone when they return."""
    import os

    from bankscope.llm.common import shared_dir
    folder = shared_dir(spark).removeprefix("file:")
    docs = [(i, f"alpha beta gamma delta epsilon zeta {i % 3}\nonly of number {i} with words w{i} v{i} u{i}\nalpha beta gamma delta epsilon eta theta iota {i % 2}") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for step, name in ((corpus_pipeline.line_dedup, "llm-line-removals"), (corpus_pipeline.ngram_join, "llm-spare")):
        before = set(os.listdir(folder))
        out = step(spark, df, "")
        assert [n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before] == [name]
        assert 0 < out.count() <= 40
