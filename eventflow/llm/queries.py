"""Registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.llm.common import read_table
from eventflow.llm.exact_dedup import exact_duplicates
from eventflow.llm.html_extract import extract_pages
from eventflow.llm.lexical_search import search
from eventflow.llm.minhash import near_duplicates
from eventflow.llm.mixing import mix_sources
from eventflow.llm.packing import pack_documents
from eventflow.llm.quality import fit_quality, quality_verdicts
from eventflow.llm.quality_embeddings import fit_quality_embeddings, quality_scores
from eventflow.llm.spelling_variants import letter_runs, variant_groups, word_counts
from eventflow.llm.suffix_dedup import remove_repeats
from eventflow.llm.token_count import token_counts
from eventflow.llm.toxicity import fit_toxicity, toxicity_scores
from eventflow.llm.url_filter import mine_block_rules, url_verdicts


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"), keep="max").withColumnRenamed("id", "doc_id")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(docs, path, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(read_table(spark, sf_dir, "documents"), stable=True)
    return rows.select(
        F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def _held_out(col):
    return F.coalesce(F.crc32(col.cast("string")) % 5 == 0, F.lit(False))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels.filter(~_held_out(F.col("doc_id"))))
    return toxicity_scores(docs, model).select(
        F.col("id").alias("doc_id"), _held_out(F.col("id")).alias("held_out"), "score", "predicted")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return near_duplicates(docs, width=3, least_pct=85).withColumnRenamed("id", "doc_id")


URL_RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    # the labels carry the number of the page they were given for
    labels = read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("blocked"))
    rules = mine_block_rules(pages.select("page_id", "url").join(labels, "page_id"))
    return url_verdicts(pages, URL_RULES, rules).withColumnRenamed("id", "page_id")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "n_copies", "copy", "order_key")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    trees = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality_verdicts(docs, trees).withColumnRenamed("id", "doc_id")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = fit_quality_embeddings(docs, labels.filter(~_held_out(F.col("doc_id"))))
    return quality_scores(docs, model).select(
        F.col("id").alias("doc_id"), _held_out(F.col("id")).alias("held_out"), "score", "predicted")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = letter_runs(read_table(spark, sf_dir, "documents"), slip_every=31)
    return variant_groups(word_counts(words)).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_packing": op3_packing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_url_filter": op7_url_filter,
    "op8_source_mixing": op8_source_mixing,
    "op9_quality_rules": op9_quality_rules,
    "op10_html_extraction": op10_html_extraction,
    "op11_lexical_search": op11_lexical_search,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY text) AS keep_id,
               count(*) OVER (PARTITION BY text) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY text) AS kept,
               sha256(text) AS text_sha256
        FROM t
    """,
    "op11_lexical_search": r"""
        WITH d AS (
            SELECT doc_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents),
        q AS (
            SELECT item_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        qn AS (SELECT item_id, term, count(*) AS repeats FROM q GROUP BY item_id, term),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
        len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
        col AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM len),
        w AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM tf, col WHERE term IN (SELECT term FROM qn) GROUP BY term, n_docs),
        part AS (
            SELECT tf.doc_id, tf.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))) AS gain
            FROM tf JOIN w USING (term) JOIN len USING (doc_id), col),
        s AS (
            SELECT item_id, doc_id, sum(repeats * gain)::BIGINT AS score
            FROM qn JOIN part USING (term) GROUP BY item_id, doc_id),
        r AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
            FROM s WHERE score > 0)
        SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 20
    """,
    "op13_spelling_variants": """
        WITH RECURSIVE step(i, k, c) AS (
            SELECT i, 0, i FROM range(256) AS g(i)
            UNION ALL
            SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8),
        crc_table AS (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
        runs AS (
            SELECT doc_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zA-ZÀ-ÿ]{7,}')) AS run
            FROM documents),
        per_doc AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
        hexed AS (SELECT *, hex(encode(doc_id || ':' || run)) AS x FROM per_doc),
        hashed AS (
            SELECT run, n, xor(list_reduce(
                [('0x' || substr(x, 2 * j + 1, 2))::BIGINT FOR j IN range(length(x) // 2)],
                lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295) AS h
            FROM hexed, crc_table),
        slipped AS (
            SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
        vocabulary AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        cut AS (
            SELECT word, n, p, substr(word, 1, p) || substr(word, p + 2) AS rest
            FROM vocabulary, unnest(range(length(word))) AS g(p)),
        pairs AS (
            SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
            UNION
            SELECT a.word, b.word, b.n FROM cut a JOIN vocabulary b ON a.rest = b.word
            UNION
            SELECT b.word, a.word, a.n FROM cut a JOIN vocabulary b ON a.rest = b.word),
        best AS (SELECT word, count(*) AS n_near, min((-near_n, near)) AS b FROM pairs GROUP BY word),
        judged AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN -b[1] >= 10 * n THEN b[2] END AS form, CASE WHEN -b[1] >= 10 * n THEN -b[1] END AS form_n
            FROM vocabulary LEFT JOIN best USING (word)),
        chain(word, root, depth) AS (
            SELECT word, word, 0 FROM judged
            UNION ALL
            SELECT c.word, j.form, depth + 1 FROM chain c JOIN judged j ON c.root = j.word WHERE j.form IS NOT NULL)
        SELECT word, form, arg_max(root, depth) AS root, any_value(n) AS n, any_value(n_near) AS n_near, any_value(form_n) AS form_n
        FROM judged JOIN chain USING (word) GROUP BY word, form
    """,
    "op8_source_mixing": """
        WITH RECURSIVE d AS (SELECT doc_id, source, length(text) AS n FROM documents),
        s AS (SELECT source, coalesce(sum(n), 0)::BIGINT AS chars FROM d GROUP BY source),
        w AS (SELECT source, chars, CASE WHEN chars > 0 THEN pow(chars::DOUBLE, 0.5) ELSE 0 END AS raw FROM s),
        r AS (
            SELECT source,
                   CASE WHEN chars > 0 THEN (raw / sum(raw) OVER ()) * 1.0::DOUBLE * (sum(chars) OVER ())::DOUBLE / chars::DOUBLE
                        ELSE 0 END AS rate
            FROM w),
        p AS (SELECT source, rate, greatest(1, ceil(rate / 32.0::DOUBLE))::INT AS parts FROM r),
        cdf AS (
            SELECT source, parts, rate / parts AS mean, 0 AS k, exp(-(rate / parts)) AS p, exp(-(rate / parts)) AS c FROM p
            UNION ALL
            SELECT source, parts, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k < 159),
        steps AS (SELECT source, any_value(parts) AS parts, list(c ORDER BY k) AS cs FROM cdf GROUP BY source),
        u AS (
            SELECT d.doc_id, d.source, cs,
                   (('0x' || substr(md5('42|' || d.doc_id || '|' || part), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
            FROM d JOIN steps ON d.source IS NOT DISTINCT FROM steps.source, unnest(generate_series(1, steps.parts)) AS g(part)),
        n AS (SELECT doc_id, source, sum(len(list_filter(cs, lambda c: c <= u)))::INT AS n_copies FROM u GROUP BY doc_id, source)
        SELECT doc_id, source, n_copies, copy::INT AS copy,
               ('0x' || substr(md5('42:order|' || doc_id || '|' || copy), 1, 15))::BIGINT AS order_key
        FROM n, unnest(generate_series(0, n_copies - 1)) AS g(copy)
    """,
}
