"""The registered queries opN of this package and their SQL twins, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, classlm, html, jaccard, licenses, linededup, mixing, pieces, quality, sketch, toxicity, trie, whitening
from .common import crc_fold, table


def _sha(column: str):
    return F.sha2(F.encode(column, "UTF-8"), 256)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.sampling_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.decode(bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ids"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), _sha("decoded").alias("decoded_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs, quality.bucket_ratios(docs, table(spark, sf_dir, "labels"))).drop("text")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes_of(table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", _sha("text").alias("kept_sha256"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classlm.score(docs, *classlm.fit(docs))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).drop("html")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = pieces.decode(pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ids"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), _sha("decoded").alias("decoded_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(table(spark, sf_dir, "embeddings"))


LLM_QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_bpe, op3_toxicity, op4_quality, op5_ngram_jaccard, op6_fingerprints, op7_line_dedup, op8_licenses, op9_class_lm, op10_html,
                                       op11_sentencepiece, op12_prefix_trie, op13_whitening)}

_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_MIX_SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORDS})) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1] AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
f AS (SELECT *, cap / weight AS fills_at FROM w),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER below, 0.0::DOUBLE))
  / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0.0::DOUBLE)) AS level
  FROM f WINDOW below AS (ORDER BY fills_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM l),
p AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS ratio,
  row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS FIRST) - 1 AS position,
  ('0x' || substr(md5(coalesce('1:s:' || d.source, '1:null')), 1, 12))::UBIGINT::DOUBLE / 281474976710656.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  ((floor((position + 1) * ratio + u) - floor(position * ratio + u)) * size)::BIGINT AS taken FROM p"""

_LINES_SQL = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, i, lines[i] AS line, translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LOWER}) AS key
  FROM d, unnest(range(1, len(lines) + 1)) AS r(i)),
bad AS (SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.*, coalesce(keeper <> doc_id, false) AS gone FROM l LEFT JOIN bad USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id"""

_JACCARD_SQL = rf"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORDS}) AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS grams FROM w),
g AS MATERIALIZED (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n_a, any_value(b.n) AS n_b, count(*) AS c FROM g AS a JOIN g AS b USING (gram) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM common WHERE 100 * c >= 80 * (n_a + n_b - c)),
both_ways AS MATERIALIZED (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach AS r JOIN both_ways AS e ON r.b = e.a)
SELECT s.doc_id, len(grams)::BIGINT AS n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id
FROM s LEFT JOIN reach AS r ON r.a = s.doc_id GROUP BY s.doc_id, grams"""

# The first step of CRC-32 for each byte, from its polynomial.
_CRC_STEP = "CASE WHEN {c} & 1 = 1 THEN xor({c} >> 1, 3988292384) ELSE {c} >> 1 END"


def _crc_table() -> str:
    steps = ", ".join(f"s{i} AS (SELECT b, {_CRC_STEP.format(c='c')} AS c FROM s{i - 1})" for i in range(1, 9))
    return f"s0 AS (SELECT b, b AS c FROM range(256) AS r(b)), {steps}, crc AS (SELECT list(c ORDER BY b) AS step FROM s8)"


_TRIE_SQL = rf"""
WITH {_crc_table()},
t AS (SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS size, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS key
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS pos FROM t),
i AS (SELECT DISTINCT conv_id, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT) AS digits FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS head, xor(list_reduce(digits, lambda acc, b: xor(acc >> 8, step[(xor(acc, b) & 255) + 1]), 4294967295), 4294967295) % 9 AS h FROM i, crc),
r AS (SELECT c.conv_id, pos, key, size FROM c JOIN n ON n.conv_id = c.head AND pos <= h UNION ALL SELECT c.conv_id, pos, key, size FROM c JOIN n ON n.conv_id = c.conv_id AND pos > h),
s AS (SELECT conv_id, row_number() OVER w AS depth, size, string_agg(key, '') OVER w AS path FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
p AS (SELECT * FROM s UNION ALL SELECT conv_id, 0, 0, '' FROM c),
ends AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM (SELECT conv_id, arg_max(path, depth) AS path FROM p GROUP BY conv_id) GROUP BY path),
node AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size FROM p GROUP BY path, depth),
kids AS (SELECT left(path, 32 * (depth - 1)::INT) AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
below AS (SELECT left(path, 32 * k::INT) AS path, sum(leaf)::BIGINT AS n_leaves, sum((n_convs - 1) * size)::BIGINT AS saved_tokens
  FROM (SELECT node.*, CASE WHEN kids.path IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(0, depth + 1)) AS k FROM node LEFT JOIN kids USING (path)) GROUP BY 1)
SELECT node.conv_id, node.depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM node JOIN below USING (path) LEFT JOIN kids USING (path) LEFT JOIN ends USING (path) LEFT JOIN node AS up ON node.depth > 0 AND up.path = left(node.path, 32 * (node.depth - 1)::INT)"""

LLM_ORACLES = {"op12_prefix_trie": _TRIE_SQL, "op1_mix_sources": _MIX_SQL, "op5_ngram_jaccard": _JACCARD_SQL, "op7_line_dedup": _LINES_SQL}
