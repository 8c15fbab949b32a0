"""Rows to write: facts, sessions, notes, turns, and what is new among them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import session
from ..functions import text

Extractor = Callable[[DataFrame], DataFrame]
TURN_CHARS, LEAST_TURN = 2000, 8
MARKERS = (".obsidian", ".trash", ".git")


def remember_rows(rows: DataFrame, now: Column, ttl_days: int = 365, source: str = "direct") -> DataFrame:
    """Rows for the fact table from (memory_id, fact, user_id, agent_name, metadata).

    A missing user or agent is the empty string in the columns and absent from the scope; missing or empty
    metadata is the JSON null, as text.
    """
    own = F.to_json(F.struct("user_id", "agent_name"))
    metadata = F.coalesce(F.when(F.trim("metadata") == "{}", None).otherwise(F.nullif("metadata", F.lit(""))), F.lit("null"))
    return rows.select(
        "memory_id",
        "fact",
        own.alias("scope"),
        F.coalesce("user_id", F.lit("")).alias("user_id"),
        F.coalesce("agent_name", F.lit("")).alias("agent_name"),
        metadata.alias("metadata"),
        F.lit(source).alias("source"),
        now.alias("created_at"),
        now.alias("updated_at"),
        F.timestamp_add("DAY", F.lit(ttl_days), now).alias("expires_at"),
    )


def session_rows(events: DataFrame) -> DataFrame:
    """One row per session from events (session_name, user_id, turn, role, text, created_at)."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    out = events.groupBy("session_name", "user_id").agg(
        F.to_json(F.transform(ordered, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))).alias("events"),
        F.count("*").alias("event_count"),
        F.min("created_at").alias("created_at"),
    )
    return out.select("session_name", text.last_segment(F.col("session_name")).alias("session_id"), "user_id", "events", "event_count", "created_at", F.col("created_at").alias("updated_at"))


def identity_extractor(texts: DataFrame) -> DataFrame:
    """One fact for each text: the default where a language model would be asked."""
    return texts.withColumn("fact", F.col("text"))


def extract_facts(texts: DataFrame, extractor: Extractor = identity_extractor) -> DataFrame:
    """Facts of event texts: each text is one event ``{content: {role, parts: [{text}]}}`` for the extractor."""
    return extractor(texts.filter(F.coalesce("text", F.lit("")) != ""))


def turn_facts(turns: DataFrame) -> DataFrame:
    """A fact for each user turn that an assistant turn follows at once (conv_id, turn, role, text)."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    pairs = turns.withColumn("next_role", F.lead("role").over(w)).withColumn("reply", F.lead("text").over(w))
    pairs = pairs.filter((F.col("role") == "user") & (F.col("next_role") == "assistant") & (F.length(text.strip(F.col("text"))) >= LEAST_TURN))
    part = lambda c: text.strip(text.head(F.coalesce(F.col(c), F.lit("")), TURN_CHARS))
    return pairs.select("conv_id", "turn", F.concat(F.lit("User: "), part("text"), F.lit("\nAssistant: "), part("reply")).alias("fact"))


def memory_write_facts(writes: DataFrame) -> DataFrame:
    """Facts of add and replace actions with content (write_id, action, target, content)."""
    kept = writes.filter(F.col("action").isin("add", "replace") & (F.coalesce("content", F.lit("")) != ""))
    label = F.when(F.col("target") == "user", "User profile").otherwise("Agent memory")
    return kept.select("write_id", F.concat(F.lit("["), label, F.lit("] "), "content").alias("fact"))


def context_gate(rows: DataFrame) -> DataFrame:
    """Rows of contexts that may write: primary, empty or none."""
    return rows.filter(F.col("context").isNull() | F.col("context").isin("primary", ""))


def seed_new_facts(candidates: DataFrame, memories: DataFrame, user_id: str, limit: int = 1000) -> DataFrame:
    """Candidates whose stripped, lower-cased fact is none of the user's latest ``limit`` facts; repeats inside stay."""
    latest = memories.filter(F.col("user_id") == user_id).orderBy(F.desc("created_at"), "memory_id").limit(limit)
    known = latest.select(F.lower(text.strip(F.col("fact"))).alias("_key")).distinct()
    return candidates.withColumn("_key", F.lower(text.strip(F.col("fact")))).join(F.broadcast(known), "_key", "left_anti").drop("_key")


def note_rows(raw: DataFrame, min_chars: int = 200) -> DataFrame:
    """Notes (path, vault, rel, hash, body) from (path, vault, rel, text): marked paths and short bodies go."""
    body = text.strip(text.without_front_matter(F.col("text")))
    rows = raw.filter(~text.has_marker(F.col("path"), MARKERS)).withColumn("body", body).filter(F.length("body") >= min_chars)
    return rows.select("path", "vault", "rel", F.sha2("text", 256).alias("hash"), "body")


def note_diff(notes: DataFrame, manifest: DataFrame) -> DataFrame:
    """Notes that are new or changed against the manifest (path, hash)."""
    return notes.join(manifest.select("path", "hash"), ["path", "hash"], "left_anti").select(*notes.columns)


def note_batches(notes: DataFrame, budget: int = 6000) -> DataFrame:
    """(vault, path, batch): notes of a vault in path order, cut greedily into batches of ``budget`` characters.

    A batch closes when it is not empty and the next note would pass the budget.  The cut depends on all notes
    before, so a vault is one ordered stream: its notes are sorted in Spark, which spills, and folded row by row
    with one number of state; only their sizes travel, and nothing is gathered.
    """
    session.ship(notes.sparkSession)
    size = F.length("rel") + F.length("vault") + F.length("body") + 32
    rows = notes.select("vault", "path", size.cast("long").alias("size")).repartition("vault").sortWithinPartitions("vault", "path")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vault, number, held = None, 0, 0
        for batch in batches:
            out = []
            for v, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if v != vault:
                    vault, number, held = v, 0, 0
                elif held + n > budget:
                    number, held = number + 1, 0
                held += n
                out.append(number)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.int64())], ["vault", "path", "batch"])

    return rows.mapInArrow(fold, "vault string, path string, batch long")


def note_render(notes: DataFrame) -> DataFrame:
    """The text that a note is ingested as."""
    return notes.select("path", F.concat(F.lit("## "), "rel", F.lit(" (vault: "), text.last_segment(F.col("vault")), F.lit(")\n\n"), "body").alias("rendered"))


def manifest_upsert(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """The manifest (path, hash) with the entries of ``done`` put in; deleted notes stay."""
    every = manifest.select("path", "hash", F.lit(0).alias("_n")).unionByName(done.select("path", "hash", F.lit(1).alias("_n")))
    return every.groupBy("path").agg(F.max_by("hash", F.struct("_n", "hash")).alias("hash"))


def summary(rows: DataFrame, new: DataFrame) -> DataFrame:
    """found, new, already."""
    return rows.agg(F.count("*").alias("found")).join(F.broadcast(new.agg(F.count("*").alias("new"))), how="cross").select("found", "new", (F.col("found") - F.col("new")).alias("already"))
