"""Registered queries of this subpackage: each takes (spark, sf_dir) and
applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches
from . import contamination, divergence, hpylm, jaccard, knn, langid, lines, negatives, packing, pii, rules, suffix, wordtable


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_json(path: str | None = None) -> str:
    """The JSON of a public tokenizer; the driver reads it, tasks get its text."""
    import public_tokenizers

    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def op1_simhash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(_table(spark, sf_dir, "documents"))


def op3_word_table_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordtable.digests(_table(spark, sf_dir, "documents"), tokenizer_json())


def op4_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(_table(spark, sf_dir, "documents"))


def op5_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpylm.score(_table(spark, sf_dir, "documents"))


def op6_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = knn.integers(_table(spark, sf_dir, "embeddings"))
    return (knn.top_k(vectors, vectors.where(F.col("id") % 50 == 0), 5)
            .select("query_id", "rank", F.col("id").alias("vec_id"), "score"))


def op7_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return rules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                    "base_failed", "kept", "failed")


def op8_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_json())


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op10_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(_table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_suffix_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end")
    rows = negatives.labelled(_table(spark, sf_dir, "embeddings"), label)
    return negatives.mine(rows, rows.where(F.col("id") % 100 == 0))


def _bounded(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {f.__name__: _bounded(f) for f in (op1_simhash_lines, op2_partenum_join, op3_word_table_bpe, op4_suffix_family, op5_pitman_yor_scores, op6_voronoi_top_k, op7_adaptive_rules, op8_histogram_packing, op9_language_mixture, op10_feistel_pseudonyms,
                                            op11_source_divergence, op12_suffix_contamination, op13_angular_negatives)}

#: DuckDB SQL by query, where SQL can express it.
SQL: dict[str, str] = {
    "op6_voronoi_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select q.vec_id as query_id, d.vec_id,
                     list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * d.v[i]))::bigint as score
              from v q join v d on q.vec_id <> d.vec_id where q.vec_id % 50 = 0)
        select query_id, cast(row_number() over w as int) as "rank", vec_id, score from s
        window w as (partition by query_id order by score desc, vec_id)
        qualify row_number() over w <= 5""",
    "op11_source_divergence": r"""
        with d as (select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
        o as (select doc, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
        kept as (select lang, term from o group by all having count(distinct doc) >= 30),
        c as (select lang, source, term, count(*)::hugeint as n from o semi join kept using (lang, term) group by all),
        g as (select distinct lang, source from d),
        v as (select lang, count(term)::hugeint as v from (select distinct lang from d) left join kept using (lang) group by lang),
        s as (select g.lang, g.source, v.v, coalesce(sum(c.n), 0)::hugeint as total from g join v using (lang) left join c using (lang, source) group by all),
        l as (select lang, any_value(v) as v, sum(total)::hugeint as total from s group by lang),
        p as (select s.lang, s.source, kept.term, coalesce(c.n, 0) as n, 1 + 1000000000 * (coalesce(c.n, 0) + 5) // (s.total + 5 * s.v) as p
              from s join kept using (lang) left join c using (lang, source, term)),
        q as (select l.lang, kept.term, 1 + 1000000000 * (coalesce(x.n, 0) + 5) // (l.total + 5 * l.v) as q
              from l join kept using (lang) left join (select lang, term, sum(n) as n from c group by all) x using (lang, term)),
        pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0) as value
                  from g a join g b on a.lang = b.lang and a.source <> b.source
                  left join (select x.lang, x.source, y.source as other, sum(abs(x.p - y.p)) as value
                             from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all) f
                  on f.lang = a.lang and f.source = a.source and f.other = b.source),
        terms as (select lang, source, 'term' as part, term as item, p - q as value from p join q using (lang, term) where n > 0 and p > q),
        r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as r from (select * from pairs union all select * from terms))
        select lang, source, part, item, value::bigint as value, r::int as "rank" from r where part = 'pair' or r <= 50""",
    "op12_suffix_contamination": r"""
        with b as (select row_number() over () as i, item_id, w from (
                     select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark) where len(w) > 0),
        bw as (select distinct item_id, least(len(w), 10) as m, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') as g
               from b, unnest(range(1, len(w) - least(len(w), 10) + 2)) as u(k)),
        d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
        dw as (select r, k, m, array_to_string(w[k:k + m - 1], ' ') as g
               from d, (select distinct m from bw) as ms, unnest(range(1, len(w) - m + 2)) as u(k)),
        hit as (select dw.r, dw.k, dw.m, bw.item_id from dw join bw on dw.m = bw.m and dw.g = bw.g),
        words as (select r, count(distinct k + j) as n_hit from (select distinct r, k, m from hit), unnest(range(0, m)) as u(j) group by r),
        items as (select r, count(*) as n_items, string_agg(i, ',' order by i) as ids from (select distinct r, item_id::varchar as i from hit where item_id is not null) group by r),
        longest as (select r, max(n) as n from (
            select r, m + count(*) - 1 as n from (
                select r, k, m, item_id, pos, pos - k as diagonal, row_number() over (partition by r, m, i, pos - k order by k) - k as run, i
                from (select dw.r, dw.k, dw.m, x.item_id, x.pos, x.i from dw join (
                        select i, item_id, least(len(w), 10) as m, k as pos, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') as g
                        from b, unnest(range(1, len(w) - least(len(w), 10) + 2)) as u(k)) x on dw.m = x.m and dw.g = x.g))
            group by r, m, i, diagonal, run) group by r)
        select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
               sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, coalesce(longest.n, 0)::bigint as longest_match
        from d left join words using (r) left join items using (r) left join longest using (r)""",
    "op13_angular_negatives": """
        with v as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
            where vec_id is not null and label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select a.vec_id as anchor_id, d.vec_id, d.label = a.label as same,
                     list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * d.v[i]))::bigint as score
              from v a join v d on a.vec_id <> d.vec_id where a.vec_id % 100 = 0),
        p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
              qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
        select anchor_id, positive_id, cast(row_number() over w as int) as "rank", vec_id as negative_id, positive_score, score as negative_score
        from p join s using (anchor_id) where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
        window w as (partition by anchor_id, positive_id order by score desc, vec_id)
        qualify row_number() over w <= 5""",
}
