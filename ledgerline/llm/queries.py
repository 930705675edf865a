"""The registered queries of this folder and their DuckDB SQL.

Each query reads its whole table and calls its operator with production
parameters.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir

from . import alignment, bpe, lexical_search, line_dedup, nearest, packing, quality_rules, sharding, simhash, token_counts, toxicity, url_filter, warc
from .common import read

URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that many sources share: LONG_SITES for
    a longer line, MIN_SITES for any."""
    return line_dedup.remove_boilerplate(read(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(read(spark, sf_dir, "embeddings"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), fixed_order=True)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back: payload sizes and digests as the reader found them.

    Responses and revisits are read apart, each by a predicate on the record
    type that the source takes over; only responses' payloads are hashed."""
    path = f"{ensure_checkpoint_dir(spark)}/warc/{uuid.uuid4().hex}"
    warc.write(read(spark, sf_dir, "pages"), path)
    found = (warc.read(spark, path, payload="digest").where("warc_type = 'response'")
             .unionByName(warc.read(spark, path, payload="skip").where("warc_type = 'revisit'")))
    return found.select(
        warc.page_number(F.col("record_id")).alias("page_id"), "payload_bytes",
        F.coalesce("computed_digest", "payload_digest").alias("payload_digest"), F.col("warc_type").alias("record_type"),
        warc.page_number(F.col("refers_to")).alias("refers_to"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards by its id; ``grown_shard`` with a 25th."""
    dealt = sharding.assign(sharding.measured(read(spark, sf_dir, "documents")), 24)
    return dealt.withColumn("law", F.lit("key"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_token_counts, op3_packing, op4_nearest, op5_toxicity, op6_quality_rules, op7_bpe, op8_warc,
                            op9_simhash, op10_url_filter, op11_sharding, op12_alignment, op13_lexical_search)}

# op2, op3, op7 and op12 need the tokenizer libraries, op5 a trained model, op9
# and op11 XXH64 (and op11's slots depend on the tasks): their tests compare
# them with brute force instead.
_SPACE = r"\x20\x09-\x0D"
_QUOTED_CLOSING = "".join(c.replace("'", "''") for c in quality_rules.CLOSING)
_QUOTED_SENTENCE = quality_rules.SENTENCE_PATTERN.replace("'", "''")
_NOTICES = "|".join([quality_rules.RIGHTS_PATTERN, *quality_rules.BOILERPLATE]).replace("'", "''")

ORACLE_SQL: dict[str, str] = {
    "op6_quality_rules": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
        ), words AS (
            SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS p
            FROM (SELECT r, regexp_extract_all(t, '[^{_SPACE}]+') AS ws FROM d)
        ), windows AS (
            SELECT r, p, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS k FROM words WINDOW o AS (PARTITION BY r ORDER BY p)
        ), twice AS (
            SELECT r, p FROM (SELECT *, count(*) OVER (PARTITION BY r, k) AS c FROM windows WHERE k IS NOT NULL) WHERE c > 1
        ), covered AS (
            SELECT r, count(DISTINCT p + i) AS n_repeat FROM twice, (VALUES (0), (1), (2)) AS v(i) GROUP BY r
        ), lines AS (
            SELECT r, line, len(regexp_extract_all(line, '[^{_SPACE}]+')) AS n,
                   regexp_replace(line, '[{_SPACE}]+$', '') AS finish,
                   len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
                   row_number() OVER (PARTITION BY r, line) - 1 AS earlier
            FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
        ), judged AS (
            SELECT *, (n >= 8 AND NOT regexp_matches(line, '{_QUOTED_SENTENCE}') AND NOT contains('{_QUOTED_CLOSING}', right(finish, 1)))
                   OR (n >= 5 AND 2 * len(regexp_extract_all(line, '!')) >= n)
                   OR (n >= 2 AND symbols > CAST(0.2 AS DOUBLE) * n)
                   OR (len(regexp_extract_all(line, '[|>»›•·]')) >= 2
                       AND len(list_filter(regexp_split_to_array(line, '[|>»›•·]'), lambda x: regexp_matches(x, '[^{_SPACE}]'))) >= 3)
                   OR (n <= 30 AND (earlier >= 2 OR regexp_matches(lower(line), '{_NOTICES}')
                                    OR (n <= 3 AND regexp_matches(lower(line), '{quality_rules.ADDRESS_PATTERN}')))) AS failed
            FROM lines WHERE n > 0
        ), per AS (
            SELECT r, sum(n) AS n_words, count(*) - count(DISTINCT line) AS n_dup, coalesce(sum(n) FILTER (failed), 0) AS lost,
                   count(*) FILTER (failed) AS n_removed
            FROM judged GROUP BY r
        ), base AS (
            SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
                   CAST(length(regexp_replace(t, '[{_SPACE}]+', '', 'g')) AS BIGINT) AS word_chars,
                   CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words, coalesce(lost, 0) AS lost,
                   CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed_lines
            FROM d LEFT JOIN per USING (r) LEFT JOIN covered USING (r)
        ), verdict AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND lost <= 0.5 * n_words AS kept, n_removed_lines
        FROM verdict
    """,
    "op1_line_dedup": rf"""
        WITH l AS (
            SELECT d.doc_id, d.source, u.pos, u.line, regexp_replace(u.line, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g') AS stripped
            FROM documents d, LATERAL (SELECT unnest(string_split(d.text, chr(10))) AS line,
                                              generate_subscripts(string_split(d.text, chr(10)), 1) AS pos) u
        ), common AS (
            SELECT stripped, min(doc_id) AS keeper FROM l WHERE stripped <> '' GROUP BY stripped
            HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}
                OR (count(DISTINCT source) >= {line_dedup.LONG_SITES}
                    AND (length(stripped) >= {line_dedup.LONG_CHARS}
                         OR len(regexp_extract_all(stripped, '[^{_SPACE}]+')) >= {line_dedup.LONG_WORDS}))
        ), judged AS (
            SELECT l.doc_id, l.pos, l.line, (c.stripped IS NOT NULL AND c.keeper <> l.doc_id) AS removed
            FROM l LEFT JOIN common c ON c.stripped = l.stripped
        ), grouped AS (
            SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
                   string_agg(line, chr(10) ORDER BY pos) FILTER (NOT removed) AS text
            FROM judged GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(g.n_lines, 0) AS n_lines, coalesce(g.n_removed, 0) AS n_removed,
               CASE WHEN d.text IS NOT NULL THEN coalesce(g.text, '') END AS text
        FROM documents d LEFT JOIN grouped g USING (doc_id)
    """,
    "op4_nearest": """
        WITH v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_dot_product(q.e, c.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
            FROM pairs
        )
        SELECT * FROM ranked WHERE rank <= 5
    """,
    "op8_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html FROM pages
        ), sized AS (
            SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest FROM p
        ), named AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response_id FROM sized
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> response_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> response_id THEN response_id END AS refers_to
        FROM named
    """,
    "op10_url_filter": """
        WITH a AS (
            SELECT page_id,
                   coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ), rules(verdict, rule, r_host, r_path) AS (
            VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
                   ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
        ), fits AS (
            SELECT a.page_id, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
            FROM a JOIN rules r ON (a.host = r.r_host OR suffix(a.host, '.' || r.r_host)) AND starts_with(a.path, r.r_path)
            GROUP BY a.page_id
        )
        SELECT a.page_id, a.host, a.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM a LEFT JOIN fits f USING (page_id)
    """,
    "op13_lexical_search": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(text, '{lexical_search.UPPER}', '{lexical_search.LOWER}'), '{lexical_search.TERM}') AS ws
            FROM documents
        ), whole AS (
            SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(ws)) AS BIGINT) AS terms FROM d WHERE len(ws) > 0
        ), item_terms AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{lexical_search.UPPER}', '{lexical_search.LOWER}'),
                                                               '{lexical_search.TERM}')) AS w
            FROM benchmark
        ), tf AS (
            SELECT r, w, count(*) AS tf FROM (SELECT r, unnest(ws) AS w FROM d) WHERE w IN (SELECT w FROM item_terms) GROUP BY r, w
        ), weight AS (
            SELECT w, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
            FROM tf, whole GROUP BY w
        ), part AS (
            SELECT r, w, weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(ws) * docs) // terms))) AS part
            FROM tf JOIN weight USING (w) JOIN d USING (r), whole
        ), scored AS (
            SELECT item_id, r, sum(part) AS score FROM part JOIN item_terms USING (w) GROUP BY item_id, r HAVING sum(part) > 0
        ), ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                   doc_id, CAST(score AS BIGINT) AS score
            FROM scored JOIN d USING (r)
        )
        SELECT * FROM ranked WHERE rank <= 10
    """,
}
