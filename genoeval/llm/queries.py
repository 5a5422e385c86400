"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontamination, jaccard, language, licenses, media, merkle, periodic, pieces, sharding, suffix_dedup, token_counts, toxicity
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_contiguous(table(spark, sf_dir, "documents"), shards=40)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digest(spark, table(spark, sf_dir, "conversations"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents"))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digest(table(spark, sf_dir, "documents"))


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digest(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), passage=suffix_dedup.PASSAGE)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_languages(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), planted=True)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_digest(table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_sharding, op2_chat_formatting, op3_benchmark_decontamination, op4_ngram_jaccard_join, op5_license_scans, op6_sentencepiece, op7_media_columns, op8_token_counts, op9_suffix_array_dedup, op10_language_id, op11_periodic_runs, op12_merkle_manifest, op13_toxicity)}

#: DuckDB SQL where whole tables allow it.
ORACLE_SQL: dict[str, str] = {
    "op2_chat_formatting": """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, replace(text, chr(92), repeat(chr(92), 2)) AS x FROM c
), f AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(x, '<|turn|>', '<' || chr(92) || '|turn|>'), '<|end|>', '<' || chr(92) || '|end|>'),
    '<s>', '<' || chr(92) || 's>'), '</s>', '<' || chr(92) || '/s>'), '[INST]', '[' || chr(92) || 'INST]'), '[/INST]', '[' || chr(92) || '/INST]'),
    '<<SYS>>', '<' || chr(92) || '<SYS>>'), '<</SYS>>', '<' || chr(92) || '</SYS>>') AS body FROM e
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|turn|>') + length(role) + 1 + length(body) + length('<|end|>')) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
""",
    "op3_benchmark_decontamination": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win
), pos AS (
  SELECT doc_id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n
), hit AS (
  SELECT doc_id, p.n, i, item_id FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM pos) p JOIN win ON win.n = p.n AND win.g = p.g
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS place FROM hit) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    "op4_ngram_jaccard_join": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE c * 10 >= 8 * (x.n + y.n - c)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b
)
SELECT d.doc_id, class_id, coalesce(n_links, 0) AS n_links FROM d JOIN (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a) USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM edges GROUP BY a) USING (doc_id)
""",
    "op12_merkle_manifest": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, lower(sha256(concat(e[1], e[2], e[3], e[4], e[5]))) AS leaf,
    lower(sha256(concat(e[1], e[2], e[3], e[4], CASE WHEN text IS NULL THEN '-' ELSE CAST(strlen(text) AS VARCHAR) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END))) AS lowered,
    xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: ord(substr(CAST(doc_id AS VARCHAR), CAST(i AS INT), 1))::UBIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda a, z: xor(a >> 1, 3988292384::UBIGINT * (a & 1)))), 4294967295::UBIGINT) % 3 = 0 AS chosen
  FROM (SELECT *, list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text], lambda v: CASE WHEN v IS NULL THEN '-' ELSE CAST(strlen(v) AS VARCHAR) || ':' || v END) AS e FROM documents)
), ordered AS (
  SELECT *, CASE WHEN chosen THEN lowered ELSE leaf END AS claimed, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM d
), nodes AS (
  SELECT t, 0 AS level, i, leaf AS digest, count(*) OVER (PARTITION BY t) AS n FROM ordered
  UNION ALL
  SELECT t, level, i, digest, count(*) OVER (PARTITION BY t) FROM (SELECT t, level + 1 AS level, i // 8 AS i, sha256(string_agg(digest, '' ORDER BY i)) AS digest FROM nodes WHERE n > 1 GROUP BY t, level, i // 8)
), subroots AS (
  SELECT t, digest, level AS height FROM nodes WHERE n = 1
), top AS (
  SELECT 0 AS level, t AS i, digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level, i, digest, count(*) OVER () FROM (SELECT level + 1 AS level, i // 8 AS i, sha256(string_agg(digest, '' ORDER BY i)) AS digest FROM top WHERE n > 1 GROUP BY level, i // 8)
), whole AS (
  SELECT digest AS root, level AS height FROM top WHERE n = 1
), steps AS (
  SELECT t, level, i, coalesce((SELECT string_agg(s.digest, '' ORDER BY s.i) FROM nodes s WHERE s.t = x.t AND s.level = x.level AND s.i // 8 = x.i // 8 AND s.i < x.i), '') AS l,
    coalesce((SELECT string_agg(s.digest, '' ORDER BY s.i) FROM nodes s WHERE s.t = x.t AND s.level = x.level AND s.i // 8 = x.i // 8 AND s.i > x.i), '') AS r FROM nodes x WHERE n > 1
), top_steps AS (
  SELECT level, i, coalesce((SELECT string_agg(s.digest, '' ORDER BY s.i) FROM top s WHERE s.level = x.level AND s.i // 8 = x.i // 8 AND s.i < x.i), '') AS l,
    coalesce((SELECT string_agg(s.digest, '' ORDER BY s.i) FROM top s WHERE s.level = x.level AND s.i // 8 = x.i // 8 AND s.i > x.i), '') AS r FROM top x WHERE n > 1
), path AS (
  SELECT o.t, o.i, list({'l': s.l, 'r': s.r} ORDER BY s.level) AS p FROM ordered o JOIN steps s ON s.t = o.t AND s.i = o.i // CAST(pow(8, s.level) AS BIGINT) GROUP BY o.t, o.i
), top_path AS (
  SELECT b.t, list({'l': s.l, 'r': s.r} ORDER BY s.level) AS p FROM subroots b JOIN top_steps s ON s.i = b.t // CAST(pow(8, s.level) AS BIGINT) GROUP BY b.t
), full_path AS (
  SELECT o.doc_id, o.leaf, o.claimed, b.digest AS subroot, whole.root, list_concat(coalesce(path.p, []), coalesce(top_path.p, [])) AS p
  FROM ordered o JOIN subroots b USING (t) CROSS JOIN whole LEFT JOIN path USING (t, i) LEFT JOIN top_path USING (t)
)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_concat([''], list_transform(p, lambda s: s.l || s.r)), 'string_agg', '')) AS proof_sha256,
  list_reduce(list_concat([{'l': claimed, 'r': ''}], p), lambda a, s: {'l': sha256(s.l || a.l || s.r), 'r': ''}).l AS folded_root, folded_root = root AS verified FROM full_path
""",
}
