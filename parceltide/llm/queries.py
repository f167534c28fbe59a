"""Registered queries of the text operators and their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide.llm import (
    decontaminate, html_text, line_dedup, mixing, quality_rules, secrets, simhash, suffix_dedup, toxicity, url_filters,
)
from parceltide.llm import more_queries  # noqa: F401
from registry.common import register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@register("op1_suffix_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.without_repeats(_table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.octet_length("text").cast("long").alias("n_bytes"),
        (F.octet_length("text") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("span_starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


# The shares of the sources are flattened to at least 97 % of the largest entropy, no source is read more than
# four times, and the budget is the tokens there are.
MIX = mixing.Mix(entropy=0.97, most_repeats=4.0)


@register("op2_temperature_mixing")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """One row per reading of a document: doc_id, source, mix_round, mix_block, mix_weight."""
    docs = _table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.mixed_rows(docs, MIX).select("doc_id", "source", "mix_round", "mix_block", "mix_weight")


OP3_SQL = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
common AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
    SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone
    FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


@register("op3_line_dedup", OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    kept = line_dedup.with_bitmaps(docs)
    return kept.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2(line_dedup.kept_text("text", "_keep"), 256).alias("kept_sha256"),
    )


def _op4_sql() -> str:
    paths = ", ".join(f"('{r.host}', '{r.path}', '{r.text}', '{r.verdict}')" for r in url_filters.PATH_RULES)
    patterns = ", ".join(f"('{r.expression}', '{r.name}')" for r in url_filters.PATTERN_RULES)
    return f"""
WITH paths(rhost, rpath, rule, verdict) AS (VALUES {paths}),
patterns(expression, name) AS (VALUES {patterns}),
parts AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts),
by_path AS (
    SELECT s.page_id, arg_max(p.rule, length(p.rule)) AS rule, arg_max(p.verdict, length(p.rule)) AS verdict
    FROM split s JOIN paths p ON (s.host = p.rhost OR ends_with(s.host, '.' || p.rhost)) AND starts_with(s.path, p.rpath)
    GROUP BY s.page_id),
by_pattern AS (
    SELECT s.page_id, max(p.name) AS name FROM split s JOIN patterns p ON regexp_matches(s.host || s.path, p.expression)
    GROUP BY s.page_id)
SELECT s.page_id, s.host, s.path, b.rule, coalesce(b.verdict, CASE WHEN n.name IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       n.name AS pattern
FROM split s LEFT JOIN by_path b ON s.page_id = b.page_id LEFT JOIN by_pattern n ON s.page_id = n.page_id"""


@register("op4_url_filters", _op4_sql())
def op4(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filters.filter_pages(_table(spark, folder, "pages").select("page_id", "url"))
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "pattern")


OP5_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)),
hits AS (SELECT p.doc_id, p.n, p.i, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.win = x.win),
hit_words AS (
    SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
hit_items AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit_words h ON w.doc_id = h.doc_id LEFT JOIN hit_items i ON w.doc_id = i.doc_id"""


@register("op5_decontamination", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    hit = decontaminate.n_hit_words()
    return found.select(
        F.col("id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


@register("op6_toxicity")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, folder, "labels"))
    return toxicity.scores(docs, model).select(
        F.col("id").alias("doc_id"), toxicity.held_out("id").alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@register("op7_secret_scan")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.secret_spans(_table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.listed(F.col("assign"), F.col("access"), F.col("hex")), 256).alias("base_sha256"),
        secrets.listed(F.col("assign"), F.col("access"), F.col("hex"), F.col("entropy")).alias("spans"),
    )


@register("op8_simhash")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@register("op9_quality_rules")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.quality_verdicts(_table(spark, folder, "documents"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("band_ok")).alias("kept"),
        "ratio", "worst_low", "worst_high", "n_chunks", "n_bad_chunks",
    )


@register("op10_html_text")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract_pages(_table(spark, folder, "pages"))
    return found.select(
        F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


@register("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline  # at the repository top; it imports the operators of this subpackage

    return corpus_pipeline.run(spark, folder)
