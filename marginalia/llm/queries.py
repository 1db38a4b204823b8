"""One query for each operator of this subpackage, over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import (
    bpe, exact_dedup, fingerprints, hard_negatives, html_extract, jaccard_join, langid, line_dedup, lm_score,
    packing, quality, token_align, url_filter,
)
from marginalia.llm.common import fold_remainder, table

URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def _documents(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return table(spark, folder, "documents", "doc_id", "text", *more)


def _held_out(remainder: int):
    return F.coalesce(fold_remainder(F.col("doc_id")) == remainder, F.lit(False))


def word_vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def byte_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_vocabulary() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_classifier(spark, folder):
    labels = table(spark, folder, "labels", "doc_id", "quality").filter(~_held_out(0))
    return quality.scores(_documents(spark, folder), labels, extra=(_held_out(0).alias("held_out"),))


def op2_url_filters(spark, folder):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judged(table(spark, folder, "pages", "page_id", "url"), rules)


def op3_line_dedup(spark, folder):
    found = line_dedup.deduplicated(_documents(spark, folder))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_exact_dedup(spark, folder):
    return exact_dedup.exact_groups(_documents(spark, folder))


def op5_lm_scoring(spark, folder):
    return lm_score.scores(_documents(spark, folder), ~_held_out(1), extra=(_held_out(1).alias("held_out"),))


def op6_ngram_jaccard_join(spark, folder):
    return jaccard_join.near_groups(_documents(spark, folder))


def op7_best_fit_packing(spark, folder):
    return packing.packed(_documents(spark, folder), word_vocabulary())


def op8_language_id(spark, folder):
    docs = _documents(spark, folder, "lang")
    return langid.languages(
        docs, docs.filter(~_held_out(0)), piece_vocabulary(), extra=(_held_out(0).alias("held_out"),)
    )


def op9_document_fingerprints(spark, folder):
    return fingerprints.edit_likeness(_documents(spark, folder))


def op10_bpe(spark, folder):
    return bpe.digests(_documents(spark, folder), word_vocabulary())


def op11_token_alignment(spark, folder):
    return token_align.link_counts(_documents(spark, folder), byte_vocabulary(), piece_vocabulary())


def op12_hard_negatives(spark, folder):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings", "vec_id", "label", "embedding").withColumn("label", moved)
    return hard_negatives.mined(rows, F.col("vec_id") % 100 == 0)


def op13_html_extraction(spark, folder):
    return html_extract.extracted(table(spark, folder, "pages", "page_id", "url", "html"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        q.__name__: q for q in (
            op1_quality_classifier, op2_url_filters, op3_line_dedup, op4_exact_dedup, op5_lm_scoring,
            op6_ngram_jaccard_join, op7_best_fit_packing, op8_language_id, op9_document_fingerprints, op10_bpe,
            op11_token_alignment, op12_hard_negatives, op13_html_extraction,
        )
    }


_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

URL_SQL = f"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), cut AS (
  SELECT page_id, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw_host, coalesce(rest, '') AS rest FROM parts
), urls AS (
  SELECT page_id, {_FOLD.format('raw_host')} AS host,
         coalesce(regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*'), '') AS path FROM cut
), rules(rule_host, rule_path, verdict) AS (
  VALUES {", ".join(str(r) for r in URL_RULES)}
), best AS (
  SELECT page_id, host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM urls JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id, host, path
)
SELECT u.page_id, u.host, u.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN best b USING (page_id)
"""

LINE_SQL = f"""
WITH rows AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, {_FOLD.format(f'trim(line, {_BLANKS})')} AS key FROM rows
), firsts AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10 GROUP BY key
), judged AS (
  SELECT k.*, coalesce(k.doc_id > f.first_id, false) AS dropped FROM keyed k LEFT JOIN firsts f USING (key)
)
SELECT doc_id, count(*) AS n_lines, sum(CASE WHEN dropped THEN 1 ELSE 0 END)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

EXACT_SQL = r"""
WITH rows AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), groups AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM rows JOIN groups USING (body)
"""

NEGATIVE_SQL = """
WITH usable AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         list_dot_product(a.v, r.v)::BIGINT AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER best::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER best <= 5
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators it can express. The others are tested against brute force, the library or held-out rows."""
    return {"op2_url_filters": URL_SQL, "op3_line_dedup": LINE_SQL, "op4_exact_dedup": EXACT_SQL, "op12_hard_negatives": NEGATIVE_SQL}
