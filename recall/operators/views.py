"""Views over the fact and session tables, and recency queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scope


def recent_memories(memories: DataFrame) -> DataFrame:
    return memories.select("memory_id", "fact", scope.field(F.col("scope"), "user_id").alias("user_id"), "agent_name", "created_at", "expires_at").orderBy(F.desc("created_at"), "memory_id")


def memory_stats(memories: DataFrame) -> DataFrame:
    """Count, first and last time by the user of the scope (grouped by the expression, not the column)."""
    user = scope.field(F.col("scope"), "user_id").alias("user_id")
    return memories.select(user, "created_at").groupBy("user_id").agg(F.count("*").alias("memory_count"), F.min("created_at").alias("first_memory_at"), F.max("created_at").alias("last_memory_at"))


def user_timeline(sessions: DataFrame, memories: DataFrame) -> DataFrame:
    one = sessions.select("user_id", "session_name", F.col("event_count").cast("long").alias("event_count"), "created_at")
    two = memories.select(scope.field(F.col("scope"), "user_id").alias("user_id"), F.col("memory_id").alias("session_name"), F.lit(1).cast("long").alias("event_count"), "created_at")
    return one.unionByName(two).orderBy(F.desc("created_at"), "session_name")


def live(memories: DataFrame, at=None) -> DataFrame:
    """Facts that have not expired at ``at`` (an extension; reads include expired facts by default)."""
    return memories.filter(F.col("expires_at").isNull() | (F.col("expires_at") > (at if at is not None else F.localtimestamp())))


def recent_for_user(memories: DataFrame, user_id: str, limit: int = 20) -> DataFrame:
    """The latest facts of a user, by column; ties go to the smaller memory_id."""
    return memories.filter(F.col("user_id") == user_id).select("memory_id", "fact", "created_at").orderBy(F.desc("created_at"), "memory_id").limit(limit)


def stats(memories: DataFrame, user_id: str | None = None) -> DataFrame:
    out = memory_stats(memories)
    return out.filter(F.col("user_id") == user_id) if user_id else out


def list_by_scope(memories: DataFrame, wanted: dict[str, str] | None = None) -> DataFrame:
    return memories.filter(scope.includes(F.col("scope"), wanted or {}))


def exact_scope(memories: DataFrame, wanted: dict[str, str]) -> DataFrame:
    return memories.filter(scope.exact(F.col("scope"), wanted))
