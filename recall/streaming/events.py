"""Session events as a stream: files in, appended tables out, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENT_SCHEMA = "conv_id long, turn long, role string, text string"


def read_events(spark: SparkSession, folder: str, schema: str = EVENT_SCHEMA, files: int | None = 100, base: str | None = None) -> DataFrame:
    """Events of the files in ``folder``, ``files`` in a micro-batch at most; without a number, all that are there in one.

    ``base`` is the folder below which names like ``role=user`` are columns; a pattern needs it, a plain folder is its own.
    """
    stream = spark.readStream.schema(schema)
    stream = stream if base is None else stream.option("basePath", base)
    return (stream if files is None else stream.option("maxFilesPerTrigger", files)).parquet(folder)


def read_table(spark: SparkSession, path: str, files: int | None = 100) -> DataFrame:
    """Events of a table that is one file or a folder of files, which may lie in folders by column.

    The stream gets a pattern that only this path matches: a plain path must be a folder, and a filter of names looks at
    the files inside.  The base is the folder above, as a file can't be one.
    """
    path = path.rstrip("/")
    return read_events(spark, f"{path[:-1]}[{path[-1]}]", files=files, base=path[: path.rfind("/") + 1] or ".")


def append_events(events: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Every event, stamped with its processing time, appended to Parquet files; restarts write nothing twice."""
    stamped = events.withColumn("received_at", F.current_timestamp())
    return stamped.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def session_counts(events: DataFrame) -> DataFrame:
    """Events by session: the key is the session itself, there are no gaps or windows."""
    return events.groupBy("conv_id").agg(F.count("*").alias("event_count"))


def for_each_batch(events: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, continuous: bool = False) -> StreamingQuery:
    """Hand each micro-batch to ``write``; with a checkpoint a batch is repeated only with the same number.

    ``continuous`` keeps the query running; ``drain`` then waits for what has arrived.
    """
    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime="1 second") if continuous else writer.trigger(availableNow=True)).start()


def append_once(folder: str) -> Callable[[DataFrame, int], None]:
    """A writer that puts batch n into ``folder/batch=n``, replacing it: repeated batches don't double rows."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return write


def drain(query: StreamingQuery) -> None:
    query.processAllAvailable()
    query.stop()
