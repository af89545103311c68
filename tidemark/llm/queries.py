"""The query of each operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, curves, html_text, language_id, packing, preference_chat, quality, secret_scan, simhash, token_planes
from .common import read


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality.apply_policy(quality.ledger(read(spark, sf_dir, "documents")), "strict-1")
    base = ledger.failures.bitwiseAND(quality.mask("base-1")) != 0
    return ledger.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failures")


OP2_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t WHERE len(w) >= 8)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM again, range(0, 8) AS r(k) GROUP BY doc_id),
same AS (
  SELECT doc_id, count(*) AS n_same_next FROM (SELECT doc_id, w, unnest(range(2, len(w) + 1)) AS i FROM t) WHERE w[i] = w[i - 1] GROUP BY doc_id),
m AS (
  SELECT t.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower,
    length(regexp_replace(text, '[^!]', '', 'g')) AS n_bangs,
    coalesce(n_same_next, 0) AS n_same_next
  FROM t LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN same USING (doc_id)),
f AS (
  SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT + 4 * (100 * n_symbols > 30 * n_words)::BIGINT
    + 8 * (100 * n_dup_lines > 40 * n_lines)::BIGINT
    + 16 * (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words))::BIGINT
    + 32 * (100 * n_upper > 50 * (n_upper + n_lower))::BIGINT + 64 * (100 * n_bangs > 30 * n_words)::BIGINT
    + 128 * (100 * n_same_next > 30 * n_words)::BIGINT AS failures FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures FROM f
"""


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"))


def op5_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.nearest_neighbours(read(spark, sf_dir, "embeddings"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(read(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op9_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_planes.round_trip(read(spark, sf_dir, "documents"))


def op10_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of the pairs made from all conversations; texts as digests."""
    segments = preference_chat.format_sides(preference_chat.last_reply_sides(read(spark, sf_dir, "conversations")))
    text = F.sha2("text", 256).alias("text_sha256")
    return segments.select("pair_id", "part", F.col("place").cast("long").alias("place"), "piece", "role", text, F.col("start").cast("long").alias("start"), F.length("text").cast("long").alias("n_chars"), "loss")


OP10_SQL = r"""
WITH t AS (SELECT conv_id AS pair_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
e AS (
  SELECT pair_id, max(CASE WHEN role = 'assistant' THEN turn END) AS last, min(CASE WHEN role = 'assistant' AND turn IS NOT NULL THEN {'turn': turn, 'text': text} END) AS early,
    min(CASE WHEN turn IS NOT NULL THEN {'turn': turn, 'text': text} END) AS start
  FROM t GROUP BY pair_id),
k AS (SELECT t.*, last, CASE WHEN early.turn < last THEN early.text ELSE start.text END AS stale FROM t JOIN e USING (pair_id)),
c AS (SELECT pair_id, turn, role, text, row_number() OVER (PARTITION BY pair_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM k),
r AS (
  SELECT pair_id, turn, role, text, row_number() OVER (PARTITION BY pair_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
  FROM (SELECT pair_id, turn, role, CASE WHEN turn = last AND role = 'assistant' THEN stale ELSE text END AS text FROM k)),
p AS (
  SELECT coalesce(c.pair_id, r.pair_id) AS pair_id,
    coalesce(min(CASE WHEN c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text THEN coalesce(c.place, r.place) END), max(coalesce(c.place, r.place)) + 1) AS common
  FROM c FULL JOIN r ON c.pair_id = r.pair_id AND c.place = r.place GROUP BY ALL),
s AS (
  SELECT c.pair_id, CASE WHEN place < common THEN 'prompt' ELSE 'chosen' END AS part, place, role, text FROM c JOIN p ON p.pair_id = c.pair_id
  UNION ALL SELECT r.pair_id, 'rejected', place, role, text FROM r JOIN p ON p.pair_id = r.pair_id WHERE place >= common),
h AS (SELECT *, '<|' || role || '|>' || chr(10) AS head, text || '<|end|>' || chr(10) AS body FROM s),
o AS (SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY pair_id, part ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_ FROM h)
SELECT pair_id, part, place::BIGINT AS place, 0 AS piece, role, sha256(head) AS text_sha256, at_::BIGINT AS start, length(head)::BIGINT AS n_chars, false AS loss FROM o
UNION ALL SELECT pair_id, part, place::BIGINT, 1, role, sha256(body), (at_ + length(head))::BIGINT, length(body)::BIGINT, part <> 'prompt' AND role = 'assistant' FROM o
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_quality_rules, op3_html_text, op4_bpe, op5_curves, op6_secret_scan, op7_simhash, op8_language_id, op9_token_planes, op10_preferences)
}
ORACLES: dict[str, str] = {"op2_quality_rules": OP2_SQL, "op10_preferences": OP10_SQL}
