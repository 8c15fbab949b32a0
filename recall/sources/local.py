"""Facts in a local SQLite file, as a Spark data source."""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from .. import session

#: Files that are looked for, and tables that are preferred, in order; a host's own names come first (see ``own``).
FILES = ("memory.db", "agent.db")
TABLES = ("memories", "memory", "agent_memory")


def own(kind: str) -> tuple[str, ...]:
    """Further names of a host application, from RECALL_LOCAL_FILES or RECALL_LOCAL_TABLES (comma-separated)."""
    return tuple(x for x in os.environ.get(f"RECALL_LOCAL_{kind}", "").split(",") if x)


def find_file(home: str) -> str | None:
    return next((p for p in (os.path.join(home, f) for f in (*own("FILES"), *FILES)) if os.path.exists(p)), None)


def _connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def find_table(path: str) -> tuple[str, list[str]] | None:
    """The preferred table, else the first, and its columns."""
    with _connect(path) as db:
        names = [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table'")]
        table = next((t for t in (*TABLES, *own("TABLES")) if t in names), names[0] if names else None)
        if table is None:
            return None
        return table, [r[1] for r in db.execute(f'PRAGMA table_info("{table}")')]


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.table, self.limit = options["path"], options["table"], int(options.get("limit", 50))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with _connect(self.path) as db:
            for row in db.execute(f'SELECT * FROM "{self.table}" LIMIT ?', (self.limit,)):
                yield tuple(None if x is None else str(x) for x in row)


class SqliteSource(DataSource):
    """``spark.read.format("recall_sqlite")`` with options path, table and limit; all columns are strings."""

    @classmethod
    def name(cls) -> str:
        return "recall_sqlite"

    def schema(self) -> StructType:
        with _connect(self.options["path"]) as db:
            return StructType([StructField(r[1], StringType()) for r in db.execute(f'PRAGMA table_info("{self.options["table"]}")')])

    def reader(self, schema: StructType) -> DataSourceReader:
        return SqliteReader(dict(self.options))


def read_local(spark: SparkSession, home: str, limit: int = 50) -> DataFrame:
    """Up to ``limit`` rows of the local store in ``home``, whatever columns it has; no store, or a broken one: no rows."""
    session.ship(spark)
    none = spark.createDataFrame([], "fact string")
    path = find_file(os.path.expanduser(home))
    try:
        found = find_table(path) if path else None
    except sqlite3.Error:
        found = None
    if not found:
        return none
    spark.dataSource.register(SqliteSource)
    return spark.read.format("recall_sqlite").option("table", found[0]).option("limit", str(limit)).load(path)


def facts_of(rows: DataFrame) -> DataFrame:
    """(fact, at): the first of fact, content and text that has something, and the row's place in the store.

    The store is read by one task, so row numbers follow its order.
    """
    from ..functions.text import first_truthy

    have = [F.col(c) for c in ("fact", "content", "text") if c in rows.columns]
    return rows.select((first_truthy(*have) if have else F.lit(None).cast("string")).alias("fact"), F.monotonically_increasing_id().alias("at"))
