"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.llm import (collocations, decontaminate, language_id, line_dedup, multi_index, packing, quality_rules, secrets,
                             sharding, simhash, tool_calls, url_filter, whitening)
from recordforge.llm.common import table

URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]

#: tools whose arguments are checked
TOOL_SCHEMAS = {
    "search": {"properties": {"query": {"type": "string"}, "limit": {"type": "integer"}}, "required": ["query"]},
    "calculate": {"properties": {"expression": {"type": "string"}}, "required": ["expression"]},
    "weather": {"properties": {"place": {"type": "string"}, "unit": {"type": "string", "enum": ["celsius", "fahrenheit"]}},
                "required": ["place"]},
}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return clean.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(secrets.span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        secrets.span_text(F.col("spans")).alias("spans"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.link_tool_calls(table(spark, sf_dir, "conversations"), TOOL_SCHEMAS).drop("n_duplicate")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest_neighbours(table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 20 == 0)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root not in sys.path:
        sys.path.insert(0, root)
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_line_dedup": op2_line_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_simhash_dedup": op4_simhash_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_quality_rules": op6_quality_rules,
    "op7_language_id": op7_language_id,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_tool_call_linking": op9_tool_call_linking,
    "op10_sharding": op10_sharding,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_embedding_whitening": op13_embedding_whitening,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {
    "op2_line_dedup": r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS arr FROM documents),
lines AS (
  SELECT doc_id, pos, arr[pos] AS line,
         translate(trim(arr[pos], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, arr, unnest(range(1, len(arr) + 1)) AS pos FROM split)),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.doc_id, l.pos, l.line, f.keeper IS NOT NULL AND f.keeper <> l.doc_id AS gone
  FROM lines l LEFT JOIN frequent f ON f.key = l.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op5_url_filter": r"""
WITH RECURSIVE parts AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
law AS (SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                              ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) v(verdict, h, p)),
judged AS (
  SELECT page_id, host, path, html,
         (SELECT max_by(struct_pack(rule := h || p, verdict := verdict), length(h || p)) FROM law
          WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS fit
  FROM parts),
seen AS (SELECT if(fit.verdict = 'allow', 'trust', 'distrust') AS kind, host, count(*) AS n
         FROM judged WHERE fit IS NOT NULL AND host <> '' GROUP BY ALL),
seed AS (SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS seed FROM seen),
found AS (SELECT host AS src, unnest(regexp_extract_all(html, '(?i)\b(?:href|src)\s*=\s*["'']?\s*([^"''\s>]+)', 1)) AS link FROM parts),
aim AS (
  SELECT src, translate(regexp_extract(link, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM found),
edge AS (SELECT src, dst, count(*) AS n FROM aim WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
walk AS (
  SELECT 'trust' AS kind, src AS a, dst AS b, n / sum(n) OVER (PARTITION BY src) AS share FROM edge
  UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM edge),
flow AS (
  SELECT 0 AS round, kind, host, seed AS rank FROM seed
  UNION ALL
  SELECT round, kind, host, sum(rank) AS rank FROM (
    SELECT f.round + 1 AS round, w.kind, w.b AS host, 0.85::DOUBLE * f.rank * w.share AS rank
    FROM flow f JOIN walk w ON w.kind = f.kind AND w.a = f.host WHERE f.round < 200
    UNION ALL
    SELECT r.round, s.kind, s.host, (1 - 0.85::DOUBLE) * s.seed FROM seed s, (SELECT max(round) + 1 AS round FROM flow) r WHERE r.round <= 200)
  GROUP BY round, kind, host),
ended AS (SELECT kind, host, rank FROM flow WHERE round = 200),
share AS (
  SELECT host, coalesce(sum(rank) FILTER (WHERE kind = 'distrust'), 0.0)
               / (coalesce(sum(rank) FILTER (WHERE kind = 'trust'), 0.0) + coalesce(sum(rank) FILTER (WHERE kind = 'distrust'), 0.0)) AS distrust
  FROM ended GROUP BY host)
SELECT j.page_id, j.host, j.path, j.fit.rule AS rule,
       coalesce(j.fit.verdict, if(s.distrust > 0.5, 'block', 'allow')) AS verdict, s.distrust
FROM judged j LEFT JOIN share s ON s.host = j.host""",
    "op6_quality_rules": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
window3 AS (
  SELECT doc_id, i, x || ' ' || lead(x, 1) OVER following || ' ' || lead(x, 2) OVER following AS g
  FROM word WINDOW following AS (PARTITION BY doc_id ORDER BY i) QUALIFY g IS NOT NULL),
twice AS (SELECT doc_id, i FROM window3 QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, host, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n_words,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, host, unnest(string_split(t, chr(10))) AS line FROM d)),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE n_words > 0 GROUP BY doc_id),
boilerplate AS (SELECT host, key FROM lines WHERE length(key) >= 20 GROUP BY host, key HAVING count(DISTINCT doc_id) > 10),
lost AS (SELECT doc_id, sum(n_words) AS n FROM lines SEMI JOIN boilerplate USING (host, key) GROUP BY doc_id),
measured AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(lost.n, 0) AS BIGINT) AS n_boilerplate_words
  FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN lost USING (doc_id)),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND n_words - n_boilerplate_words >= 0.5 * n_words AS kept FROM base""",
    "op11_phrase_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
spans AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS k)),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM spans GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidate AS (SELECT * FROM f WHERE k > 1 AND f >= 30),
alone AS (
  SELECT * FROM candidate c WHERE NOT EXISTS (
    SELECT 1 FROM candidate d WHERE d.lang = c.lang AND d.k > c.k AND CAST(d.f AS HUGEINT) * 100 >= CAST(c.f AS HUGEINT) * 80
      AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))),
cut AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS pos FROM alone),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.pos, x.f AS l, y.f AS r, (CAST(c.a AS HUGEINT) * 2000000) // (x.f + y.f) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.pos], ' ')
             JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.pos + 1:], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, pos) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, CAST(r.score AS BIGINT) AS score
FROM ranked r JOIN total t ON t.lang = r.lang WHERE r.rank <= 2000""",
}
