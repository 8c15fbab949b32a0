"""The warehouse: three Parquet tables, three views, appends and rewrites."""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema
from .config import Settings
from .operators import ingest, lifecycle, views


@dataclass(frozen=True)
class BankConfig:
    """What a semantic bank is made with: models, metric, time to live, revisions, topics."""

    generation_model: str = ""
    embedding_model: str = ""
    metric: str = "cosine"
    ttl_seconds: int = 365 * 86400
    revisions: bool = True
    topics: list[str] = field(default_factory=lambda: ["USER_PERSONAL_INFO", "USER_PREFERENCES", "KEY_CONVERSATION_DETAILS", "EXPLICIT_INSTRUCTIONS"])

    @classmethod
    def of(cls, settings: Settings) -> BankConfig:
        return cls(settings.generation_model_path, settings.embedding_model_path, ttl_seconds=settings.revision_ttl_seconds)


class Store:
    """Tables of one database.  Parquet has no UPDATE or DELETE: ``purge`` rewrites the table under a new name."""

    def __init__(self, spark: SparkSession, settings: Settings | None = None):
        self.spark, self.settings = spark, settings or Settings()

    def name(self, table: str) -> str:
        return f"{self.settings.database}.{table}"

    def init(self) -> None:
        """Create database, tables and views; safe to repeat."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.settings.database}")
        for table, fields in schema.TABLES.items():
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet")
        self.views()

    def create_bank(self, config: BankConfig | None = None) -> str:
        """Keep the bank's configuration with the database, over any that it has; the bank's name."""
        text = json.dumps(asdict(config or BankConfig.of(self.settings))).replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"ALTER DATABASE {self.settings.database} SET DBPROPERTIES ('recall.bank' = '{text}')")
        return self.settings.engine_name or f"local://{self.settings.database}"

    def bank(self) -> BankConfig:
        """The configuration of ``create_bank``, or that of the settings."""
        described = {r[0]: r[1] for r in self.spark.sql(f"DESCRIBE DATABASE EXTENDED {self.settings.database}").collect()}
        found = re.search(r"\(recall\.bank,(\{.*?\})\)", described.get("Properties", ""))
        return BankConfig(**json.loads(found[1])) if found else BankConfig.of(self.settings)

    def views(self) -> None:
        views.recent_memories(self.table("memories")).createOrReplaceTempView("recent_memories")
        views.memory_stats(self.table("memories")).createOrReplaceTempView("memory_stats")
        views.user_timeline(self.table("sessions"), self.table("memories")).createOrReplaceTempView("user_timeline")

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def append(self, table: str, rows: DataFrame) -> None:
        """Append rows in one batch; a null in a required column fails the write."""
        fields = schema.TABLES[table]
        schema.validate(schema.conform(rows, fields), fields).write.mode("append").insertInto(self.name(table))
        self.spark.catalog.refreshTable(self.name(table))  # the rows may come from a stream, whose session is another

    def remember(self, facts: DataFrame, now: Column | None = None) -> DataFrame:
        """Write facts (fact[, memory_id, user_id, agent_name, metadata]); the rows written."""
        have = set(facts.columns)
        rows = facts.select(
            (F.col("memory_id") if "memory_id" in have else F.uuid()).alias("memory_id"), "fact", *((F.col(c) if c in have else F.lit(None).cast("string")).alias(c) for c in ("user_id", "agent_name", "metadata"))
        )
        out = ingest.remember_rows(rows, now if now is not None else F.localtimestamp(), self.settings.ttl_days)
        self.append("memories", out)
        return out

    def sync_sessions(self, events: DataFrame) -> DataFrame:
        out = ingest.session_rows(events)
        self.append("sessions", out)
        return out

    def memories(self) -> DataFrame:
        rows = self.table("memories")
        return rows if self.settings.include_expired else views.live(rows)

    def purge(self, condition: Column, force: bool = False) -> int:
        """Number of facts under ``condition``; they are removed only with ``force``."""
        count = lifecycle.purge_preview(self.table("memories"), condition).first()[0]
        if force and count:
            fresh = f"memories_{uuid.uuid4().hex[:8]}"
            lifecycle.purge_survivors(self.table("memories"), condition).write.format("parquet").saveAsTable(self.name(fresh))
            self.spark.sql(f"DROP TABLE {self.name('memories')}")
            self.spark.sql(f"ALTER TABLE {self.name(fresh)} RENAME TO {self.name('memories')}")
            self.views()
        return count
