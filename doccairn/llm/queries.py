"""Registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from doccairn.catalog.registry import Query, table
from doccairn.llm import (
    decontaminate, filter_audit, infill, language_id, near_duplicates, neighbours, personal_data, pieces, quality_rules, quality_score,
    repeats, secret_scan, shards,
)

#: SentencePiece model of the encoding queries; another file may be named in the environment.
MODEL_FILE = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def remainder(column: str, divisor: int):
    """crc32 of a number's text, modulo; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


CRC_TABLE = """list_transform(range(0, 256), lambda n: list_reduce(range(0, 8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, n))"""
SHARDS_SQL = f"""
WITH crc_table AS (SELECT {CRC_TABLE} AS steps),
sized AS (
  SELECT doc_id, text, md5(coalesce(text, '')) AS digest, coalesce(strlen(text), 0) + 1 AS size FROM documents
), keyed AS (
  SELECT *, CASE WHEN text IS NULL THEN '' ELSE digest END AS key FROM sized
), placed AS (
  SELECT *, sum(size) OVER (ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM keyed
), dealt AS (
  SELECT *, CAST(least(15, floor((upto - size / 2.0::DOUBLE) * 16 / CAST(total AS DOUBLE))) AS INTEGER) AS shard FROM placed
)
SELECT doc_id, CAST(size AS BIGINT) AS size,
  CASE WHEN text IS NULL THEN NULL ELSE CAST(xor(4294967295, list_reduce(
    list_transform(range(0, CAST(strlen(text) AS BIGINT)), lambda i: CAST(('0x' || substr(hex(encode(text)), 2 * i + 1, 2)) AS BIGINT)),
    lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c // 256), 4294967295)) AS BIGINT) END AS text_crc32,
  'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY key, doc_id) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM dealt, crc_table
"""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
CONTAMINATION_SQL = rf"""
WITH worded AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
               FROM benchmark WHERE item_id IS NOT NULL),
item_starts AS (SELECT item, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS piece FROM item_starts),
sizes AS (SELECT DISTINCT size FROM item_windows),
starts AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM worded, sizes WHERE len(w) >= size),
windows AS (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS piece FROM starts),
hits AS (SELECT doc_id, i, size, item FROM windows JOIN item_windows USING (piece, size)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM worded LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
COPIES_SQL = rf"""
WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, least(5, len(w)) AS size, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM worded WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + size - 1], ' ') AS shingle FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y USING (shingle) WHERE x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * common >= 85 * (s.n + t.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT a AS doc_id, b AS other FROM edges UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.other),
least_of AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id,
       doc_id <= coalesce(other, doc_id) AS kept
FROM worded LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of USING (doc_id)
"""

BLANK_RUNS = r"[^\x20\x09-\x0D]+"
INFILL_SQL = rf"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
    list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), i, 8) AS BIGINT)) AS h
  FROM documents
), ranked AS (
  SELECT *, len(w) AS n, least(h[1] % (len(w) + 1), h[2] % (len(w) + 1)) AS a, greatest(h[1] % (len(w) + 1), h[2] % (len(w) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
         WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), cut AS (
  SELECT *, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:], '') AS s FROM ranked
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""
AUDIT_SQL = rf"""
WITH worded AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{BLANK_RUNS}') AS w FROM documents
), firsts AS (SELECT t, min(doc_id) AS first FROM worded GROUP BY t),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
    regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > first, false)] AS f, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM worded JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)
), masks AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY part, f
), letters AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), steps AS (SELECT o, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, unnest(range(1, 6)) AS step FROM orders),
outcomes AS (
  SELECT part, filter_order, step, o[step] AS letter, n, good, toxic, f[o[step]] AS fails,
    len(list_filter(o[1:step - 1], lambda i: f[i])) > 0 AS gone, len(list_filter(f, lambda x: x)) = 1 AS one FROM masks, steps
), counted AS (
  SELECT part, filter_order, step, letter, coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept,
    coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS removed, coalesce(sum(n) FILTER (gone AND fails), 0) AS redundant,
    coalesce(sum(n) FILTER (fails AND one), 0) AS unique_fails, coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS toxic_lost
  FROM outcomes GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""


@query(SHARDS_SQL)
def op1_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard_by_bytes(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query()
def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query(CONTAMINATION_SQL)
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query(COPIES_SQL)
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = language_id.fit(documents.where(~held_out).select(F.col("doc_id").alias("id"), "text", "lang"))
    return documents.select(
        "doc_id", held_out.alias("held_out"), language_id.language(model, F.col("text")).alias("found"),
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")


@query()
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(table(spark, sf_dir, "documents").select("doc_id", "text"), output="pii").select("doc_id", "pii")

    def counted(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [counted(kind) for kind in personal_data.BASE]
    base = F.filter("pii", lambda s: s["rank"] < len(personal_data.BASE))
    return found.select(
        "doc_id", *counts, F.sha2(personal_data.listed(base).cast("binary"), 256).alias("base_sha256"),
        personal_data.listed(F.col("pii")).alias("spans"),
        F.coalesce(F.array_max(F.transform("pii", lambda s: s["score"])), F.lit(0.0)).alias("top_score"))


@query()
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.load(MODEL_FILE)
    coded = table(spark, sf_dir, "documents").select("doc_id", pieces.encoded(model, F.col("text")).alias("coded"))
    return coded.select("doc_id", "coded.*")


@query()
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    ranks = secret_scan.word_ranks(documents)
    found = documents.select("doc_id", secret_scan.digest(F.col("text"), ranks).alias("found"))
    return found.select("doc_id", "found.*")


@query()
def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(True))
    labels = table(spark, sf_dir, "labels").where(~held_out).select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    model = quality_score.fit(documents.select(F.col("doc_id").alias("id"), "text"), labels)
    scored = documents.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                              quality_score.quality(model, F.col("text")).alias("score"))
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@query()
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(True))
    labels = table(spark, sf_dir, "labels").where(~held_out).select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    model = quality_rules.fit(documents.select(F.col("doc_id").alias("id"), "text"), labels)
    return documents.select("doc_id", quality_rules.judged(model, F.col("text")).alias("judged")).select("doc_id", "judged.*")


@query(INFILL_SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = documents.select("doc_id", infill.infilled(F.col("text"), F.col("doc_id")).alias("made")).select("doc_id", "made.*")
    text = infill.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(text.cast("binary"), 256).alias("restored_sha256"))


@query(AUDIT_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", F.col("source").alias("part"))
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    return filter_audit.audit(filter_audit.mask_rows(documents, labels))
