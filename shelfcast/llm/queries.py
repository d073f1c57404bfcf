"""The queries of this package, one for each operator, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bloom_dedup, bpe_trie, filter_audit, jaccard_join, kd_search, lang_fusion, packing, ranking, source_divergence, suffix_dedup, token_files,
    toxicity, weak_rules,
)
from .common import documents, fold, stage

#: The vocabulary files; their folder is not part of this repository.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(documents(spark, sf_dir), BYTE_BPE)


def op2_kd_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_search.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, k=20)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = fold("doc_id", 3) == 1
    net = toxicity.fit_from_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out)
    return toxicity.score_documents(docs, net).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stage(weak_rules.document_stats(documents(spark, sf_dir)), "rule-stats")
    return weak_rules.judge(stats).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = lang_fusion.fit_text_model(documents(spark, sf_dir))
    return lang_fusion.identify_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), model)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = fold("doc_id", 5) == 0
    ranker = ranking.fit_from_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out)
    return ranking.score_documents(docs, ranker).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(documents(spark, sf_dir))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.encode_decode(documents(spark, sf_dir), WORD_BPE)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), WORD_BPE)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergences(documents(spark, sf_dir))


def op12_bloom_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bloom_dedup.exact_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_kd_top_k": op2_kd_top_k,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_quality_rules": op5_quality_rules,
    "op6_language_id": op6_language_id,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_bpe_codec": op9_bpe_codec,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_source_divergence": op11_source_divergence,
    "op12_bloom_dedup": op12_bloom_dedup,
    "op13_filter_audit": op13_filter_audit,
}

#: Models, token ids and file formats are beyond SQL; those queries are tested
#: against the tokenizers library, brute force or held-out labels.
ORACLE: dict[str, str] = {
    "op2_kd_top_k": """
WITH v AS (
  SELECT vec_id, min(embedding) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
w AS (SELECT vec_id, list_transform(e, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM v),
s AS (
  SELECT q.vec_id AS query_id, b.vec_id AS vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.e, b.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM w q, w b WHERE q.vec_id % 20 = 0 AND q.vec_id <> b.vec_id AND len(q.e) = len(b.e)),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op3_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT doc_id, h, CAST(len(h) // 2 AS BIGINT) AS n_bytes FROM d),
w AS (SELECT doc_id, h, unnest(range(0, greatest(n_bytes - 99, 0))) AS i FROM n),
k AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS k FROM w),
f AS (SELECT doc_id, i FROM k QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS starts FROM f),
r AS (SELECT doc_id, i, SUM(starts) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
s AS (SELECT doc_id, run, min(i) AS lo, max(i) + 100 AS hi FROM r GROUP BY doc_id, run),
p AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM s),
a AS (
  SELECT p.doc_id, string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS kept, max(hi) AS last,
    CAST(SUM(hi - lo) AS BIGINT) AS n_removed, COUNT(*) AS n_spans FROM p JOIN n ON n.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT n.doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM n LEFT JOIN a ON a.doc_id = n.doc_id
""",
    "op8_ngram_jaccard": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS tokens
  FROM w),
t AS (SELECT doc_id, len(tokens) AS n, unnest(tokens) AS token FROM s),
o AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, COUNT(*) AS shared
  FROM t a JOIN t b ON a.token = b.token AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM o WHERE 100 * shared >= 85 * (nx + ny - shared)),
r AS (
  SELECT doc_id, doc_id AS root FROM s
  UNION
  SELECT l.x, r.root FROM r JOIN l ON l.y = r.doc_id WHERE r.root < l.x)
SELECT s.doc_id, CAST(len(s.tokens) AS BIGINT) AS n_shingles, m.component_id
FROM s JOIN (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id) m ON m.doc_id = s.doc_id
""",
    "op11_source_divergence": """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
w AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING COUNT(DISTINCT r) >= 30),
v AS (SELECT lang, COUNT(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT lang, source, term, COUNT(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
c AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
p AS (
  SELECT c.lang, source, term, n,
    1 + (1000000000 * (n::HUGEINT + 5)) // (SUM(n) OVER (PARTITION BY c.lang, source) + 5 * v) AS p FROM c JOIN v ON v.lang = c.lang),
q AS (
  SELECT l.lang, term, 1 + (1000000000 * (n::HUGEINT + 5)) // (SUM(n) OVER (PARTITION BY l.lang) + 5 * v) AS q
  FROM (SELECT lang, term, SUM(n) AS n FROM c GROUP BY lang, term) l JOIN v ON v.lang = l.lang),
s AS (
  SELECT a.lang, a.source, b.source AS item, SUM(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM f QUALIFY part = 'pair' OR rank <= 50
""",
    "op12_bloom_dedup": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, COUNT(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, row_number() OVER (PARTITION BY d.t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON g.t = d.t
""",
    "op13_filter_audit": """
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CAST(len(words) < 200 AS INTEGER) + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INTEGER)
    + 4 * CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS INTEGER)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER) + 16 * CAST(coalesce(w.doc_id > first, false) AS INTEGER) AS m
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
x AS (SELECT CAST(unnest(range(5)) AS INTEGER) AS i),
o AS (
  SELECT list_transform([a.i, b.i, c.i, d.i, e.i], lambda k: 'ABCDE'[k + 1]) AS letters, [a.i, b.i, c.i, d.i, e.i] AS bits
  FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT array_to_string(letters, '') AS filter_order, bits, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM o),
b AS (
  SELECT filter_order, step, bits[step] AS i,
    CAST(coalesce(list_sum(list_transform(bits[1:step - 1], lambda k: 1 << k)), 0) AS INTEGER) AS before FROM s),
r AS (
  SELECT part, filter_order, step, i,
    COUNT(*) FILTER ((m & (before | (1 << i))) = 0) AS kept,
    COUNT(*) FILTER ((m & before) = 0 AND (m >> i) & 1 = 1) AS removed,
    COUNT(*) FILTER ((m & before) <> 0 AND (m >> i) & 1 = 1) AS redundant,
    COUNT(*) FILTER (m = 1 << i) AS unique_fails,
    COUNT(*) FILTER (good AND (m & before) = 0 AND (m >> i) & 1 = 1) AS good_lost,
    COUNT(*) FILTER (toxic AND (m & before) = 0 AND (m >> i) & 1 = 1) AS toxic_lost
  FROM f, b GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(SUM(removed) OVER (PARTITION BY part, i) AS BIGINT) AS shapley
FROM r
""",
}
