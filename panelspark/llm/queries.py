"""Registered queries of the training-data operators, one for each, and their SQL where it can be said."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import (
    bpe, decontaminate, fingerprints, html_text, language, lines, near_dup, phrases, repeats, search, token_files, toxicity, whitening,
)
from panelspark.llm.common import fold, table
from panelspark.session import shared_folder

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document with the least id of its class."""
    return near_dup.classes(table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.main_text(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.bpe_encode(docs, WORD_BPE))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    samples = language.learn(docs, fold("doc_id", 5) != 0)
    predicted = language.identify(docs.select("doc_id", "text"), samples)
    return predicted.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, BYTE_BPE)
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document: lines that count, lines deleted, and a digest of the text that stays."""
    found = lines.remove_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counted = F.filter(F.split("text", "\n"), lambda x: F.octet_length(F.btrim(x, F.lit(" \t\r"))) > 0)
    return found.select(
        "doc_id", F.coalesce(F.size(counted), F.lit(0)).cast("long").alias("n_lines"), F.size("removed_lines").cast("long").alias("n_removed"),
        F.sha2(F.encode(F.coalesce("kept_text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    scored = toxicity.score_texts(docs, model)
    return scored.select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = search.quantise(table(spark, sf_dir, "embeddings"))
    return search.top_k(vectors, F.col("vec_id") % 20 == 0)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.next_compared(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_html_text": op3_html_text,
    "op4_bpe": op4_bpe,
    "op5_language_id": op5_language_id,
    "op6_token_files": op6_token_files,
    "op7_repeats": op7_repeats,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_top_k": op10_top_k,
    "op11_whitening": op11_whitening,
    "op12_fingerprints": op12_fingerprints,
    "op13_collocations": op13_collocations,
}

ORACLES = {
    "op1_decontamination": r"""
WITH words AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', CAST(item_id AS VARCHAR), NULL, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), items AS (
  SELECT id AS item, least(len(w), 10) AS n, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM words WHERE kind = 'b' AND len(w) > 0
), windows AS (
  SELECT DISTINCT item, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS win FROM items
), lengths AS (SELECT DISTINCT n FROM windows),
scan AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p, w FROM words, lengths WHERE kind = 'd' AND len(w) >= n
), keyed AS (
  SELECT doc_id, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS win FROM scan
), met AS (SELECT k.doc_id, k.n, k.p, v.item FROM keyed k JOIN windows v ON k.n = v.n AND k.win = v.win),
covered AS (SELECT doc_id, count(DISTINCT c) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS c FROM met) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id) WHERE d.kind = 'd'
""",
    "op8_line_dedup": r"""
WITH cut AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents
), counted AS (
  SELECT doc_id, pos, raw, trim(raw, ' ' || chr(9) || chr(13)) AS line, len(regexp_extract_all(raw, '[^ \t\r]+')) AS words FROM cut WHERE trim(raw, ' ' || chr(9) || chr(13)) <> ''
), near AS (
  SELECT doc_id, pos, row_number() OVER o AS i, line AS a, words AS wa, lead(line) OVER o AS b, lead(words) OVER o AS wb, lead(line, 2) OVER o AS c
  FROM counted WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
), windows AS (
  SELECT doc_id, i, CASE WHEN wa >= 40 THEN 1 WHEN b IS NOT NULL AND wa + wb >= 40 THEN 2 WHEN c IS NOT NULL THEN 3 END AS n, a, b, c FROM near
), keyed AS (
  SELECT doc_id, i, n, a || CASE WHEN n > 1 THEN chr(10) || b ELSE '' END || CASE WHEN n > 2 THEN chr(10) || c ELSE '' END AS content FROM windows WHERE n IS NOT NULL
), later AS (
  SELECT doc_id, i, n FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) AS k FROM keyed) WHERE k > 1
), gone AS (SELECT DISTINCT l.doc_id, m.pos FROM (SELECT doc_id, unnest(range(i, i + n)) AS i FROM later) l JOIN near m USING (doc_id, i)),
kept AS (
  SELECT c.doc_id, string_agg(c.raw, chr(10) ORDER BY c.pos) FILTER (WHERE g.pos IS NULL) AS kept, count(g.pos) AS n_removed
  FROM cut c LEFT JOIN gone g USING (doc_id, pos) GROUP BY c.doc_id
), sizes AS (SELECT doc_id, count(*) AS n_lines FROM counted GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN sizes USING (doc_id)
""",
    "op10_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda t: t[1] * t[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), runs AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM words, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size
), f AS (SELECT lang, size, phrase, count(*) AS n FROM runs GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:size], ' ') AS rest
  FROM candidates, (SELECT unnest([1, 2]) AS k) WHERE k < size
), scored AS (
  SELECT c.lang, c.phrase, a, k, p.n AS l, q.n AS r, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(p.n AS HUGEINT) * q.n) AS BIGINT) AS score
  FROM cuts c JOIN f p ON p.lang = c.lang AND p.phrase = c.first AND p.size = k JOIN f q ON q.lang = c.lang AND q.phrase = c.rest
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM candidates WHERE size = 3) GROUP BY ALL
), ranked AS (
  SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.phrase) AS rank, c.phrase, a, l, r, score
  FROM lowest c LEFT JOIN longer g ON g.lang = c.lang AND g.phrase = c.phrase WHERE most IS NULL OR 100 * most < 50 * a
)
SELECT lang, rank, phrase, a, l, r, t.n, score FROM ranked JOIN totals t USING (lang) WHERE rank <= 2000
""",
}
