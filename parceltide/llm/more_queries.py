"""Registered queries of the classifier, the hard-negative search and the prefix trie, with their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide.llm import hard_negatives, prefix_trie, quality_gam
from registry.common import register


@register("op11_quality_gam")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = quality_gam.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return quality_gam.scores(docs, model).select(
        F.col("id").alias("doc_id"), quality_gam.held_out("id").alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


OP12_SQL = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbered AS (SELECT *, row_number() OVER () AS row FROM usable),
scores AS (
    SELECT a.row AS anchor_row, a.vec_id AS anchor_id, b.row, b.vec_id, a.label = b.label AS same,
           coalesce(list_sum(list_transform(list_zip(a.v, b.v, true), lambda p: p[1] * p[2])), 0)::BIGINT AS score
    FROM numbered a JOIN numbered b ON a.row <> b.row WHERE a.vec_id % 50 = 0),
positives AS (
    SELECT * FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_row ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_row, p.row ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n
  ON n.anchor_row = p.anchor_row AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3"""


@register("op12_hard_negatives", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(
        spark.read.parquet(f"{folder}/embeddings.parquet"), anchor=F.col("vec_id") % 50 == 0, label=moved
    )


OP13_SQL = r"""
WITH turns AS (
    SELECT conv_id::BIGINT AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                              md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
heads AS (
    SELECT c, c - c % 20 AS base, (xor(list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda crc, byte: list_reduce(
            list_concat([xor(crc, byte)], list_transform(range(8), lambda x: x::BIGINT)),
            lambda v, bit: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295)) % 4 AS h
    FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
    SELECT h.c, t.pos AS place, t.role, t.text FROM heads h JOIN turns t ON t.c = h.base AND t.pos < h.h
    UNION ALL
    SELECT h.c, t.pos + 1000000 AS place, t.role, t.text FROM heads h JOIN turns t ON t.c = h.c AND t.pos >= h.h),
paths AS (
    SELECT c, list({'r': role, 't': text} ORDER BY place) AS path FROM rebuilt GROUP BY c
    UNION ALL SELECT c, [] FROM heads WHERE c NOT IN (SELECT c FROM rebuilt)),
prefixes AS (
    SELECT c, d, path[1:d] AS node, d = len(path) AS ends
    FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM paths)),
nodes AS (
    SELECT node, d, min(c) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256,
           CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(node[d].t, '[^\x20\x09-\x0D]+')) END AS saved
    FROM prefixes GROUP BY node, d),
family AS (
    SELECT n.node, n.d, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k WHERE k.d = n.d + 1 AND k.node[1:n.d] = n.node) AS n_children
    FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.node = n.node[1:n.d - 1]),
subtrees AS (
    SELECT n.node, n.d, sum(k.saved) AS saved_tokens, count(*) FILTER (f.n_children = 0) AS n_leaves
    FROM nodes n JOIN nodes k ON k.d >= n.d AND k.node[1:n.d] = n.node JOIN family f ON f.node = k.node AND f.d = k.d
    GROUP BY n.node, n.d)
SELECT n.conv_id, n.d::BIGINT AS depth, f.parent_conv_id, n.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN family f ON f.node = n.node AND f.d = n.d JOIN subtrees s ON s.node = n.node AND s.d = n.d"""


@register("op13_prefix_trie", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefix_trie.turns_of(spark.read.parquet(f"{folder}/conversations.parquet"))
    return prefix_trie.prefix_trie(*prefix_trie.with_shared_heads(turns))
