"""Retrieval that merges three sources, drops repeated facts and renders a prompt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def dedupe_facts(rows: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The first row, by ``order``, of each non-empty key."""
    first = Window.partitionBy("_key").orderBy(*order)
    out = rows.withColumn("_key", key).filter(F.col("_key") != "")
    return out.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") == 1).drop("_n", "_key")


def leg(rows: DataFrame, origin: str, rank: int, *order: Column, top_k: int) -> DataFrame:
    """The first ``top_k`` rows of one source as (origin, src_rank, rn, fact)."""
    few = rows.orderBy(*order).limit(top_k)
    numbered = few.withColumn("rn", F.row_number().over(Window.orderBy(*order)).cast("long"))  # at most top_k rows
    return numbered.select(F.lit(origin).alias("origin"), F.lit(rank).cast("long").alias("src_rank"), "rn", "fact")


def merge(bank: DataFrame, warehouse: DataFrame, local: DataFrame, top_k: int) -> DataFrame:
    """(rank, origin, fact): bank and warehouse rows by source and rank, first of each key; then local rows.

    Keys are compared on 500 characters but whole facts returned; local facts are cut to 500, dropped if their
    key was seen, and never compared with each other.
    """
    key = text.dedupe_key(F.coalesce("fact", F.lit("")))
    seen = dedupe_facts(bank.unionByName(warehouse), key, F.col("src_rank"), F.col("rn"))
    known = seen.select(key.alias("_key"))
    cut = local.withColumn("fact", text.head(F.coalesce("fact", F.lit("")), text.KEY_CHARS)).filter(F.col("fact") != "")
    new = cut.withColumn("_key", text.dedupe_key(F.col("fact"))).join(known, "_key", "left_anti").drop("_key")
    every = seen.unionByName(new).orderBy("src_rank", "rn").limit(top_k)
    ranked = every.withColumn("rank", F.row_number().over(Window.orderBy("src_rank", "rn")).cast("long"))  # at most top_k rows
    return ranked.select("rank", "origin", "fact")


def prompt_context(hits: DataFrame, *by: str, top_k: int | None = None) -> DataFrame:
    """One text per group of ``by``: a bullet for each fact, in order of ``rank``; with ``top_k`` of the first so many ranks.

    The rank limit (a window that Spark cuts down before the shuffle) bounds what is gathered for one group.
    """
    if top_k is not None:
        place = F.row_number().over(Window.partitionBy(*by).orderBy("rank"))
        hits = hits.withColumn("_n", place).filter(F.col("_n") <= top_k).drop("_n")
    lines = F.array_sort(F.collect_list(F.when(F.coalesce("fact", F.lit("")) != "", F.struct("rank", F.concat(F.lit("- "), "fact").alias("line")))))
    joined = F.concat_ws("\n", F.transform(lines, lambda x: x["line"])).alias("prompt_context")
    return hits.groupBy(*by).agg(joined)


def recall_status(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count("*").alias("recalled"))
