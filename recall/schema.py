"""Schemas of the three tables, and the NOT NULL check that Parquet tables do not make."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    kinds = {"string": T.StringType(), "long": T.LongType(), "time": T.TimestampNTZType(), "vector": T.ArrayType(T.DoubleType())}
    fields = [x.split(":") for x in spec.split()]
    return T.StructType([T.StructField(name, kinds[kind.rstrip("!")], not kind.endswith("!")) for name, kind in fields])


MEMORIES = _struct(
    "memory_id:string! fact:string! scope:string user_id:string agent_name:string embedding:vector metadata:string "
    "source:string session_name:string created_at:time! updated_at:time! expires_at:time revision_id:string"
)
SESSIONS = _struct("session_name:string! session_id:string! user_id:string! agent_name:string events:string event_count:long created_at:time! updated_at:time!")
REVISIONS = _struct("revision_name:string! memory_id:string! fact:string! extracted_memories:string scope:string created_at:time! ttl_expires_at:time")
TABLES = {"memories": MEMORIES, "sessions": SESSIONS, "memory_revisions": REVISIONS}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns and types of ``schema``; missing columns are null."""
    have = set(df.columns)
    return df.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows that have a null where ``schema`` allows none."""
    required = [F.col(f.name).isNull() for f in schema if not f.nullable]
    return df.filter(reduce(or_, required))


def validate(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df``, whose evaluation fails at the first row with a null in a required column."""
    checked = [F.when(F.col(f.name).isNull(), F.raise_error(F.lit(f"{f.name} must not be null")).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if not f.nullable else F.col(f.name) for f in schema]
    return df.select(*checked)
