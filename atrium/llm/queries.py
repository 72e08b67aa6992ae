"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atrium.llm.best_fit_packing import packed
from atrium.llm.bpe_lexicon import bpe_round_trip
from atrium.llm.embedding_dedup import near_vectors
from atrium.llm.language_id import language_id
from atrium.llm.minhash_dedup import near_duplicates
from atrium.llm.phrase_fingerprints import compared
from atrium.llm.ppm_scoring import scored
from atrium.llm.quality_classifier import quality
from atrium.llm.slot_sharding import sharded
from atrium.llm.source_divergence import divergences
from atrium.llm.tool_calls import CHAT_TOOLS, from_conversations, linked
from atrium.llm.url_rules import judged
from atrium.llm.whitening import whitened


#: In the conversations' own adapter each system or user message is a call and depends on the one two turns before, if that is one.
CALLS_SQL = """
WITH RECURSIVE m AS (SELECT *, role IN ('system', 'user') AS is_call, role = 'assistant' AS is_result,
  CASE WHEN role IN ('system', 'user') THEN turn WHEN role = 'assistant' THEN turn - 1 END AS key,
  CASE WHEN role IN ('system', 'user') AND turn >= 2 THEN turn - 2 END AS after FROM conversations),
c AS (SELECT conv_id, key, turn, after FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, key ORDER BY turn) AS rn FROM m WHERE is_call) WHERE rn = 1),
r AS (SELECT conv_id, key, min(turn) AS turn FROM m WHERE is_result GROUP BY ALL),
d AS (SELECT c.conv_id, c.key, 0 AS depth FROM c WHERE NOT EXISTS (SELECT 1 FROM c u WHERE u.conv_id = c.conv_id AND u.key = c.after)
  UNION ALL SELECT c.conv_id, c.key, d.depth + 1 FROM d JOIN c ON c.conv_id = d.conv_id AND c.after = d.key),
s AS (SELECT m.conv_id, m.turn, m.role, CASE WHEN m.is_call THEN 'call' WHEN m.is_result THEN 'result' ELSE 'other' END AS kind,
  CASE WHEN m.key IS NOT NULL THEN 'call_' || m.conv_id || '_' || m.key END AS call_id, m.is_call, m.is_result, m.text,
  CASE WHEN m.key IS NULL THEN 'message' WHEN m.is_result AND c.key IS NULL THEN 'orphan' WHEN coalesce(r.turn > c.turn, false) THEN 'linked' WHEN m.is_call THEN 'unanswered' ELSE 'early' END AS status, d.depth AS d0
  FROM m LEFT JOIN c ON c.conv_id = m.conv_id AND c.key = m.key LEFT JOIN r ON r.conv_id = m.conv_id AND r.key = m.key LEFT JOIN d ON d.conv_id = m.conv_id AND d.key = m.key),
e AS (SELECT *, CASE WHEN status IN ('linked', 'unanswered') THEN CAST(d0 AS BIGINT) END AS depth FROM s)
SELECT conv_id, turn, role, kind, call_id, status, depth,
  row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(2 * depth + CASE WHEN kind = 'result' THEN 1 ELSE 0 END, 4611686018427387904), turn, kind) - 1 AS position, CASE WHEN is_call THEN true END AS valid, CASE WHEN is_call THEN '' END AS errors,
  '{' || concat_ws(',', CASE WHEN is_call THEN '"arguments":{' || concat_ws(',', CASE WHEN role = 'user' AND turn >= 2 THEN '"after":"call_' || conv_id || '_' || (turn - 2) || '"' END,
    CASE WHEN text IS NOT NULL THEN CASE role WHEN 'system' THEN '"instruction":' ELSE '"prompt":' END || CAST(to_json(text) AS VARCHAR) END, '"turn":' || turn) || '}' END,
    '"call_id":"' || call_id || '"', CASE WHEN NOT coalesce(is_call, false) THEN '"content":' || CAST(to_json(text) AS VARCHAR) END, '"depth":' || depth, CASE WHEN is_call THEN CASE role WHEN 'system' THEN '"name":"configure"' ELSE '"name":"ask"' END END,
    '"role":"' || role || '"', '"status":"' || status || '"', '"turn":' || turn) || '}' AS json FROM e
"""


#: Every kept term meets every source of its language.
DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*) AS kinds, sum(n) AS total FROM k GROUP BY ALL),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON k.lang = w.lang AND k.term = w.term GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
g AS (SELECT d.lang, d.source, coalesce(any_value(v.kinds), 0) AS kinds, coalesce(any_value(s.total), 0) AS total, coalesce(any_value(v.total), 0) AS lang_total FROM d LEFT JOIN v ON v.lang = d.lang LEFT JOIN s ON s.lang = d.lang AND s.source = d.source GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 1)::HUGEINT) // (g.total + g.kinds) AS p, 1 + (1000000000 * (k.n + 1)::HUGEINT) // (g.lang_total + g.kinds) AS q
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0)::BIGINT AS value FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every) WHERE part = 'pair' OR rank <= 200
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(_table(spark, sf_dir, "documents"), shards=8)


def op2_quality_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op5_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(_table(spark, sf_dir, "documents"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(_table(spark, sf_dir, "pages"))


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linked(from_conversations(_table(spark, sf_dir, "conversations")), CHAT_TOOLS)
    return rows.withColumn("errors", F.array_join("errors", "; "))


def op11_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(_table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_slot_sharding": op1_slot_sharding,
    "op2_quality_weak_labels": op2_quality_weak_labels,
    "op3_language_id": op3_language_id,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_phrase_fingerprints": op5_phrase_fingerprints,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_bpe_transducer": op8_bpe_transducer,
    "op9_url_rules": op9_url_rules,
    "op10_tool_calls": op10_tool_calls,
    "op11_ppm_scores": op11_ppm_scores,
    "op12_whitening": op12_whitening,
    "op13_source_divergence": op13_source_divergence,
}

#: Classifier, language model, signatures, tokenizers and 64-bit hashes have no SQL form: tests hold those against plain Python.
ORACLE_SQL: dict[str, str] = {"op10_tool_calls": CALLS_SQL, "op13_source_divergence": DIVERGENCE_SQL}
