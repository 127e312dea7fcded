"""Registered queries of this folder: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontamination, exact_dedup, hard_negatives, language_id, line_dedup, lm_scoring, near_dedup, pii, prefix_trie,
               quality_model, quality_rules, token_count)
from ._base import bucket, documents

PIECES = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(documents(spark, sf_dir), bucket(F.col("doc_id"), 5) == 1)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(documents(spark, sf_dir), PIECES)


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.learn_and_identify(documents(spark, sf_dir), bucket(F.col("doc_id"), 3) == 1)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(documents(spark, sf_dir), WORD_BPE)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(documents(spark, sf_dir), words=4)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.leaks(documents(spark, sf_dir), benchmark).drop("distance")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), vec_id, moved,
                                         F.col("embedding"), F.col("id") % 100 == 0)


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Every conversation c with the first crc32(c) % 9 turns of conversation c - c % 5 in place of as many of its own."""
    base, h = F.col("conv_id") - F.col("conv_id") % 5, (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    heads = sequences.filter("conv_id % 5 = 0").select(
        F.col("conv_id").alias("base"), *[F.slice(c, 1, 8).alias(f"h_{c}") for c in ("path", "sizes")])
    both = sequences.withColumn("base", base).join(heads, "base", "left")
    return both.select("conv_id", *[
        F.concat(F.when(F.col(f"h_{c}").isNull(), F.slice(c, 1, 0)).otherwise(F.slice(f"h_{c}", F.lit(1), h)),
                 F.slice(c, h + 1, F.greatest(F.size(c), F.lit(1)))).alias(c) for c in ("path", "sizes")])


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie.prefix_trie(rebuilt(prefix_trie.sequences(conversations)))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_lm_scoring, op2_token_counts, op3_quality_model, op4_line_dedup, op5_language_id, op6_bpe, op7_pii,
    op8_quality_rules, op9_near_dedup, op10_decontamination, op11_hard_negatives,
    op12_prefix_trie, op13_exact_dedup)}

# Trained models, hashes that SQL engines do not share, vocabularies and iterative estimates have no form in SQL; those
# queries are tested against brute-force versions in tests/llm.
_WORDS = """list_filter(string_split_regex(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"""

_NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
             ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh
      FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, UNNEST(sh) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
t AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS c FROM n UNION SELECT t.b, r.c FROM r JOIN t ON t.a = r.node)
SELECT n.doc_id, n.n AS n_shingles, MIN(r.c) AS component_id, n.doc_id = MIN(r.c) AS kept
FROM n JOIN r ON r.node = n.doc_id GROUP BY n.doc_id, n.n"""

_LEAKS = f"""
WITH i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
iw AS (SELECT item_id, ws, LEAST(len(ws), 5) AS k FROM i WHERE len(ws) > 0),
ig AS (SELECT item_id, k, UNNEST(list_transform(range(1, len(ws) - k + 2), lambda j: array_to_string(ws[j:j + k - 1], ' '))) AS g
       FROM iw),
ic AS (SELECT item_id, k, g, COUNT(*) AS c FROM ig GROUP BY ALL),
im AS (SELECT item_id, k, COUNT(*) AS m FROM ig GROUP BY ALL),
d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
dk AS (SELECT doc_id, ws, k, len(ws) - k + 1 AS size FROM d, (SELECT DISTINCT k FROM iw) WHERE len(ws) >= k),
dg AS (SELECT doc_id, k, size, UNNEST(range(0, size)) AS pos,
              UNNEST(list_transform(range(1, size + 1), lambda j: array_to_string(ws[j:j + k - 1], ' '))) AS g FROM dk),
h AS (SELECT doc_id, item_id, dg.k, size, m, pos, dg.g, c FROM dg JOIN ic ON ic.g = dg.g AND ic.k = dg.k JOIN im USING (item_id)),
w AS (SELECT DISTINCT doc_id, item_id, k, size, m, GREATEST(0, LEAST(pos, size - m)) AS start FROM h),
x AS (SELECT w.doc_id, w.item_id, w.k, w.size, w.m, start, h.g, LEAST(COUNT(*), MIN(c)) AS shared
      FROM w JOIN h ON h.doc_id = w.doc_id AND h.item_id = w.item_id AND pos >= start AND pos < start + w.m
      GROUP BY ALL),
z AS (SELECT doc_id, item_id, k, start, LEAST(size, m) AS n, m, SUM(shared) AS shared FROM x GROUP BY ALL),
q AS (SELECT *, shared / (n + m - shared) AS similarity FROM z WHERE 100 * shared >= 80 * (n + m - shared))
SELECT doc_id, item_id, similarity, start AS first_word, n + k - 1 AS n_words FROM q
QUALIFY ROW_NUMBER() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1"""

_NEGATIVES = """
WITH u AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: COALESCE(isfinite(x), FALSE))) = len(embedding)),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, a.id = b.id AS itself,
             CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM u a, u b WHERE a.id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same AND NOT itself
      QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
             ROW_NUMBER() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS k
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 10"""

# the checksum bit by bit: SQL has no crc32
_CRC = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
  string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384)))"""

_TRIE = f"""
WITH t AS (SELECT conv_id, list({{'r': COALESCE(role, ''), 'x': COALESCE(text, '')}} ORDER BY turn NULLS FIRST) AS ts
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, ts, {_CRC} % 9 AS h FROM t),
r AS (SELECT h.conv_id, list_concat(COALESCE(b.ts, [])[1:h.h], h.ts[h.h + 1:]) AS p
      FROM h LEFT JOIN t b ON b.conv_id = h.conv_id - h.conv_id % 5),
m AS (SELECT conv_id, d, p[1:d] AS node, d = len(p) AS ends FROM (SELECT *, UNNEST(range(0, len(p) + 1)) AS d FROM r)),
n AS (SELECT node, d, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs,
             sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
      FROM m GROUP BY node, d),
c AS (SELECT node[1:d - 1] AS parent, COUNT(*) AS k FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, COALESCE(k, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(node[d].x) END AS own
      FROM n LEFT JOIN c ON c.parent = n.node),
a AS (SELECT node[1:u] AS top, own, n_children = 0 AS leaf FROM (SELECT *, UNNEST(range(0, d + 1)) AS u FROM f)),
s AS (SELECT top, COUNT(*) FILTER (leaf) AS n_leaves, CAST(SUM(own) AS BIGINT) AS saved_tokens FROM a GROUP BY top)
SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM f JOIN s ON s.top = f.node LEFT JOIN f q ON f.d > 0 AND q.node = f.node[1:f.d - 1] AND q.d = f.d - 1"""

_COPIES = """
SELECT doc_id, MAX(doc_id) OVER g AS keep_id, COUNT(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM MAX(doc_id) OVER g AS kept, sha256(COALESCE(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY COALESCE(text, ''))"""

ORACLES: dict[str, str] = {"op9_near_dedup": _NEAR, "op10_decontamination": _LEAKS,
                           "op11_hard_negatives": _NEGATIVES, "op12_prefix_trie": _TRIE,
                           "op13_exact_dedup": _COPIES}
