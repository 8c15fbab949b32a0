"""The engine's tables, derived from the driver's test tables (and the same as SQL for the oracle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _base_plus(unit: str, n) -> F.Column:
    return F.timestamp_add(unit, n.cast("int"), F.expr(f"timestamp_ntz'{BASE}'"))


def memories(spark: SparkSession, sf_dir: str, embedding: bool = False, metadata: bool = False) -> DataFrame:
    """The fact table; what a query does not read (vectors, metadata) is not joined, since a left join is never dropped."""
    d = table(spark, sf_dir, "documents")
    if embedding:
        d = d.join(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id", "left")
    if metadata:
        d = d.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    created = _base_plus("MINUTE", F.col("doc_id"))
    more = [F.when(F.col("quality").isNull(), "null").otherwise(F.concat(F.lit('{"quality":'), F.col("quality").cast("string"), F.lit("}"))).alias("metadata")] if metadata else []
    return d.select(
        F.col("doc_id").cast("string").alias("memory_id"),
        F.col("text").alias("fact"),
        F.concat(F.lit('{"user_id":"'), F.col("source"), F.lit('","agent_name":"'), F.col("lang"), F.lit('"}')).alias("scope"),
        F.col("source").alias("user_id"),
        F.col("lang").alias("agent_name"),
        *(["embedding"] if embedding else []),
        *more,
        F.when(F.col("doc_id") % 3 == 0, "session").otherwise("direct").alias("source"),
        created.alias("created_at"),
        created.alias("updated_at"),
        F.timestamp_add("DAY", F.lit(365), created).alias("expires_at"),
    )


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("engines/e1/sessions/"), F.col("conv_id").cast("string")).alias("session_name"),
        F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string")).alias("user_id"),
        "turn",
        "role",
        "text",
        _base_plus("HOUR", F.col("conv_id")).alias("created_at"),
    )


def raw_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as notes; every 7th has front matter, every 11th lies in a marked folder."""
    d = table(spark, sf_dir, "documents")
    vault = F.concat(F.lit("/v/"), F.col("lang"))
    folder = F.when(F.col("doc_id") % 11 == 0, F.lit(".trash/")).otherwise(F.lit(""))
    rel = F.concat(folder, F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md"))
    body = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("---\nkind: note\n---\n\n"), F.col("text"))).otherwise(F.col("text"))
    return d.select("doc_id", F.concat(vault, F.lit("/"), rel).alias("path"), vault.alias("vault"), rel.alias("rel"), body.alias("text"))


def plain_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md"))
    vault = F.concat(F.lit("/v/"), F.col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(vault, F.lit("/"), rel).alias("path"), vault.alias("vault"), rel.alias("rel"), F.sha2("text", 256).alias("hash"), F.col("text").alias("body"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes with an even id, one in five of them with another hash."""
    n = plain_notes(spark, sf_dir).filter(F.col("doc_id") % 2 == 0)
    return n.select("path", F.when(F.col("doc_id") % 10 == 0, F.lit("changed")).otherwise(F.col("hash")).alias("hash"))


def seed_candidates(spark: SparkSession, sf_dir: str, user_id: str) -> DataFrame:
    """Facts of a user, half of them known in other case and padding, half of them new."""
    d = table(spark, sf_dir, "documents").filter(F.col("source") == user_id)
    known = d.filter(F.col("doc_id") % 4 < 2).select("doc_id", F.concat(F.lit("\t "), F.upper("text"), F.lit(" \n")).alias("fact"))
    new = d.filter(F.col("doc_id") % 4 >= 2).select("doc_id", F.concat("text", F.lit(" (new)")).alias("fact"))
    return known.unionByName(new)


def writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("write_id"),
        F.when(kind == "click", "add").when(kind == "view", "replace").otherwise("remove").alias("action"),
        F.when(F.col("user_id") % 2 == 0, "user").otherwise("memory").alias("target"),
        F.col("props").alias("content"),
        F.when(F.col("event_id") % 3 == 0, "primary").when(F.col("event_id") % 3 == 1, "subagent").alias("context"),
    )


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("rev/"), F.col("event_id").cast("string")).alias("revision_name"), F.col("user_id").cast("string").alias("memory_id"), F.col("event_type").alias("fact"), F.col("ts").alias("created_at")
    )


#: The same tables in DuckDB SQL.
MEMORIES = f"""memories AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS memory_id, d.text AS fact,
         concat('{{"user_id":"', d.source, '","agent_name":"', d.lang, '"}}') AS scope, d.source AS user_id, d.lang AS agent_name,
         e.embedding, CASE WHEN l.quality IS NULL THEN 'null' ELSE concat('{{"quality":', l.quality, '}}') END AS metadata,
         CASE WHEN d.doc_id % 3 = 0 THEN 'session' ELSE 'direct' END AS source,
         TIMESTAMP '{BASE}' + to_minutes(d.doc_id) AS created_at, TIMESTAMP '{BASE}' + to_minutes(d.doc_id) AS updated_at,
         TIMESTAMP '{BASE}' + to_minutes(d.doc_id) + INTERVAL 365 DAY AS expires_at
  FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
SESSIONS = f"""sessions AS (
  SELECT 'engines/e1/sessions/' || conv_id AS session_name, CAST(conv_id AS VARCHAR) AS session_id, 'src' || (conv_id % 20) AS user_id,
         CAST(to_json(list({{'role': role, 'text': text}} ORDER BY turn)) AS VARCHAR) AS events, count(*) AS event_count,
         TIMESTAMP '{BASE}' + to_hours(conv_id) AS created_at, TIMESTAMP '{BASE}' + to_hours(conv_id) AS updated_at
  FROM conversations GROUP BY conv_id)"""
NOTES = """notes AS (
  SELECT doc_id, '/v/' || lang || '/' || source || '/' || doc_id || '.md' AS path, '/v/' || lang AS vault,
         source || '/' || doc_id || '.md' AS rel, sha256(text) AS hash, text AS body FROM documents)"""
MANIFEST = """manifest AS (
  SELECT path, CASE WHEN doc_id % 10 = 0 THEN 'changed' ELSE hash END AS hash FROM notes WHERE doc_id % 2 = 0)"""
