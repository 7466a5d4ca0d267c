"""One query per operator over its whole table, and the SQL twins of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pagemill.llm.conversations import damage, repair_conversations
from pagemill.llm.exact_dedup import dedup_exact
from pagemill.llm.licenses import scan_licenses
from pagemill.llm.line_dedup import drop_repeated_lines
from pagemill.llm.main_text import extract_main_text
from pagemill.llm.mixing import mix_sources
from pagemill.llm.near_dedup import near_duplicates
from pagemill.llm.packing import pack_documents
from pagemill.llm.pii import replace_entities
from pagemill.llm.quality import judge_quality
from pagemill.llm.ranking import rank_documents
from pagemill.llm.substring_dedup import remove_repeats
from pagemill.llm.url_rules import RULE_SCHEMA, judge_urls
from pagemill.session import table

# Characters for the SQL twins, spelled as in the contracts.
SQL_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SQL_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeated_lines(table(spark, folder, "documents")).select(
        "input.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


LINE_DEDUP_SQL = f"""
WITH numbered AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, {SQL_WHITE}), {SQL_LOWER}) AS line_key FROM numbered
), repeated AS (
    SELECT line_key, max(doc_id) AS keeper FROM keyed WHERE length(line_key) >= 40
    GROUP BY line_key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
    SELECT k.*, keeper IS NOT NULL AND keeper <> doc_id AS dropped
    FROM keyed k LEFT JOIN repeated USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "input.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_exact(table(spark, folder, "documents"))


EXACT_DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# The rules of the query, host and path.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), spark.createDataFrame(URL_RULES, RULE_SCHEMA))


URL_RULES_SQL = """
WITH rules(host, path, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), parts AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
    FROM pages
), fits AS (
    SELECT p.*, r.host || r.path AS rule, r.verdict,
           row_number() OVER (PARTITION BY page_id ORDER BY length(r.host) DESC, length(r.path) DESC) AS n
    FROM parts p LEFT JOIN rules r
      ON ('.' || p.host) LIKE ('%.' || r.host) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM fits WHERE n = 1
"""


def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents")).select(
        "input.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


# The key of this query's surrogates; a corpus of real persons needs one that is kept secret.
PII_KEY = "change-this-key"


def pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    replaced = replace_entities(table(spark, folder, "documents"), PII_KEY)
    return replaced.select(
        "input.doc_id",
        F.size("entities").cast("long").alias("n_entities"),
        F.array_join(F.array_sort(F.array_distinct(F.col("entities.kind"))), ",").alias("kinds"),
        "text",
    )


def source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents")).drop("row")


def ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


RANKED_SEARCH_SQL = rf"""
WITH terms AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {SQL_LOWER}), '{SQL_TERM}') AS terms FROM documents
), total AS (
    SELECT count(*) FILTER (len(terms) > 0) AS n_documents, sum(len(terms))::BIGINT AS n_terms FROM terms
), weighted AS (
    SELECT doc_id, 25 + (75 * len(terms) * n_documents) // n_terms AS m, terms FROM terms, total WHERE len(terms) > 0
), postings AS (
    SELECT doc_id, m, term, count(*) AS tf FROM (SELECT doc_id, m, unnest(terms) AS term FROM weighted) GROUP BY ALL
), rarity AS (
    SELECT term, floor(1000 * ln((2.0::DOUBLE * n_documents + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM postings, total GROUP BY term, n_documents
), asked AS (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {SQL_LOWER}), '{SQL_TERM}')) AS term
    FROM benchmark
), scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN postings USING (term) JOIN rarity USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""


def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main_text(table(spark, folder, "pages"))


def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair_conversations(damage(table(spark, folder, "conversations")))


QUERIES = {
    "op1_line_dedup": line_dedup,
    "op2_best_fit_packing": best_fit_packing,
    "op3_pii_surrogates": pii_surrogates,
    "op4_quality_rules": quality_rules,
    "op5_url_rules": url_rules,
    "op6_near_dedup": near_dedup,
    "op7_source_mixing": source_mixing,
    "op8_suffix_array_dedup": suffix_array_dedup,
    "op9_license_scan": license_scan,
    "op10_exact_dedup": exact_dedup,
    "op11_ranked_search": ranked_search,
    "op12_html_extraction": html_extraction,
    "op13_conversation_repair": conversation_repair,
}

ORACLES = {
    "op1_line_dedup": LINE_DEDUP_SQL,
    "op5_url_rules": URL_RULES_SQL,
    "op10_exact_dedup": EXACT_DEDUP_SQL,
    "op11_ranked_search": RANKED_SEARCH_SQL,
}
