"""Curated fact files: chunks parted by a section sign."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

#: File names and the kind of their facts, in order.
FILES = (("MEMORY.md", "memory"), ("USER.md", "user_profile"))


def split_facts(rows: DataFrame) -> DataFrame:
    """Non-empty stripped chunks of column ``value``, with their place ``pos``."""
    parts = rows.select(*(c for c in rows.columns if c != "value"), F.posexplode(F.split("value", "§")).alias("pos", "chunk"))
    return parts.withColumn("fact", text.strip(F.col("chunk"))).filter(F.col("fact") != "").drop("chunk")


def read_curated(spark: SparkSession, folder: str) -> DataFrame:
    """(fact, source_file, kind) of the fact files in ``folder``; missing files are skipped."""
    out = spark.createDataFrame([], "fact string, source_file string, kind string")
    for number, (name, kind) in enumerate(FILES):
        path = os.path.join(folder, name)
        if os.path.exists(path):
            rows = spark.read.text(path, wholetext=True).select("value", F.lit(name).alias("source_file"), F.lit(kind).alias("kind"), F.lit(number).alias("_n"))
            out = out.unionByName(split_facts(rows).orderBy("_n", "pos").select("fact", "source_file", "kind"))
    return out
