"""Markdown notes in folders, and the manifest of those already ingested."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .. import session
from ..operators import ingest

SCHEMA = "path string, vault string, rel string, text string"


def list_notes(vaults: list[str]) -> list[tuple[str, str, str]]:
    """(path, vault, relative path) of all Markdown files; Spark's own listing would skip names with ``.`` and ``_``."""
    out = []
    for vault in vaults:
        vault = os.path.expanduser(vault)
        for folder, inner, names in os.walk(vault):
            inner[:] = sorted(x for x in inner if x not in ingest.MARKERS)
            out += [(os.path.join(folder, n), vault, os.path.relpath(os.path.join(folder, n), vault)) for n in sorted(names) if n.endswith(".md")]
    return out


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files of one task, one at a time; invalid UTF-8 is dropped, an unreadable file is left out."""
    for batch in batches:
        for row in batch.to_pylist():
            try:
                with open(row["path"], "rb") as f:
                    body = f.read().decode("utf-8", "ignore")
            except OSError:
                continue
            yield pa.RecordBatch.from_pylist([row | {"text": body}], pa.schema([(c, pa.string()) for c in ("path", "vault", "rel", "text")]))


def discover_notes(spark: SparkSession, vaults: list[str], min_chars: int = 200) -> DataFrame:
    """Notes (path, vault, rel, hash, body) under ``vaults``; missing folders are skipped, bad bytes dropped.

    The folders must be mounted where tasks run.  Spark's file sources can't be used: they pass over every name that
    begins with ``_`` or ``.``, even one given by its path.
    """
    found = list_notes(vaults)
    if not found:
        return ingest.note_rows(spark.createDataFrame([], SCHEMA), min_chars)
    session.ship(spark)
    names = spark.createDataFrame(found, "path string, vault string, rel string")
    rows = names.repartition(min(len(found), 8 * spark.sparkContext.defaultParallelism)).mapInArrow(_read, SCHEMA)
    return ingest.note_rows(rows, min_chars)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest (path, hash); one that is missing or unreadable is empty."""
    empty = spark.createDataFrame([], "path string, hash string")
    if not os.path.isdir(path):
        return empty
    newest = max((x for x in os.listdir(path) if x.startswith("v-") and os.path.exists(os.path.join(path, x, "_SUCCESS"))), default=None)
    return spark.read.schema("path string, hash string").parquet(f"file://{path}/{newest}") if newest else empty


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Write a whole new version beside the old one; readers take the newest complete one."""
    number = max((int(x.split("-")[1]) for x in os.listdir(path) if x.startswith("v-")), default=0) + 1 if os.path.isdir(path) else 1
    manifest.write.parquet(f"file://{path}/v-{number:08d}-{uuid.uuid4().hex[:8]}")
