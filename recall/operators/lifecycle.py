"""Expiry, purge and revisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ttl_stamp(rows: DataFrame, ttl_days: int = 365) -> DataFrame:
    return rows.withColumn("expires_at", F.timestamp_add("DAY", F.lit(ttl_days), F.col("created_at")))


def expired(memories: DataFrame, at: Column) -> DataFrame:
    return memories.filter(F.col("expires_at") <= at)


def purge_preview(memories: DataFrame, condition: Column) -> DataFrame:
    """What an unforced purge reports."""
    return memories.agg(F.count_if(condition).alias("purge_count"))


def purge_survivors(memories: DataFrame, condition: Column) -> DataFrame:
    """What a forced purge leaves; a null condition keeps the row."""
    return memories.filter(~F.coalesce(condition, F.lit(False)))


def revision_latest(revisions: DataFrame) -> DataFrame:
    """The last revision of each memory, by a mergeable maximum."""
    last = F.max_by(F.struct("revision_name", "fact", "created_at"), F.struct("created_at", "revision_name"))
    return revisions.groupBy("memory_id").agg(last.alias("r")).select("memory_id", "r.revision_name", "r.fact", "r.created_at")
