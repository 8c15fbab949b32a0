"""Exact nearest neighbours by cosine distance."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .. import session
from ..functions import scope, vector


def _vectors(memories: DataFrame, width: int | None = None) -> DataFrame:
    """Rows with a usable vector: not null, of the right width, of a length above 0."""
    v = F.col("embedding").cast("array<double>")
    rows = memories.filter(F.col("embedding").isNotNull())
    if width is not None:
        rows = rows.filter(F.size("embedding") == width)
    return rows.withColumn("embedding", v).withColumn("_norm", vector.norm(F.col("embedding"))).filter(F.col("_norm") > 0)


def nearest(memories: DataFrame, query: list[float], top_k: int = 8, user_id: str | None = None) -> DataFrame:
    """memory_id, fact, scope, distance of the ``top_k`` nearest facts; the user filter comes before the search.

    Each task keeps its own ``top_k`` rows (TakeOrderedAndProject), so nothing is shuffled but those.
    """
    rows = memories.filter(scope.field(F.col("scope"), "user_id") == user_id) if user_id else memories
    q = F.lit([float(x) for x in query])
    size = sum(float(x) ** 2 for x in query) ** 0.5
    found = _vectors(rows, len(query)).withColumn("distance", 1 - F.try_divide(vector.dot(F.col("embedding"), q), F.col("_norm") * F.lit(size)))
    return found.filter(F.col("distance").isNotNull()).select("memory_id", "fact", "scope", "distance").orderBy("distance", "memory_id").limit(top_k)


def nearest_many(memories: DataFrame, queries: DataFrame, top_k: int = 8, block: int = 4096) -> DataFrame:
    """query_id, memory_id, distance, rank for every row of ``queries`` (query_id, embedding), in blocks.

    The query set is stated and met by all rows; blocks of ``block`` queries are broadcast one after another.  A task
    multiplies its batches of facts with the block and keeps for each query its ``top_k`` nearest (and those as near as
    the last of them), so only these are shuffled; they are ranked by query.
    """
    spark = memories.sparkSession
    session.ship(spark)
    rows = memories.select(F.col("memory_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter(F.col("embedding").isNotNull())
    q = queries.select("query_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(F.col("embedding").isNotNull())
    count = q.count()
    schema = StructType([StructField("query_id", queries.schema["query_id"].dataType), StructField("memory_id", memories.schema["memory_id"].dataType), StructField("distance", DoubleType())])
    out = None
    for i in range(max(1, -(-count // block))):
        part = (q if count <= block else q.filter(F.pmod(F.xxhash64("query_id"), F.lit(-(-count // block))) == i)).toArrow()
        held = spark.sparkContext.broadcast({n: (ids.to_pylist(), v) for n, ids, v in _matrices(part.column(0), part.column(1))})
        near = rows.mapInArrow(_nearest(held, top_k), schema)
        ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "memory_id")).cast("long"))
        best = ranked.filter(F.col("rank") <= top_k)
        out = best if out is None else out.union(best)
    return out


def _matrices(ids: pa.Array | pa.ChunkedArray, vectors: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """Width, ids and unit vectors of the rows of each width that have a length above 0."""
    if isinstance(ids, pa.ChunkedArray):
        ids, vectors = (x.combine_chunks() if x.num_chunks != 1 else x.chunk(0) for x in (ids, vectors))
    width = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for n in np.unique(width[width > 0]).tolist():
        at = np.flatnonzero(width == n)
        own = vectors.take(pa.array(at)).flatten()
        v = own.to_numpy(zero_copy_only=False).reshape(-1, n)  # nulls inside a vector become NaN
        norm = np.sqrt((v * v).sum(1))
        good = norm > 0
        yield n, ids.take(pa.array(at[good])), v[good] / norm[good, None]


def _nearest(held, top_k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], tuple[list, np.ndarray]] = {}
        for batch in batches:
            for n, ids, v in _matrices(batch.column(0), batch.column(1)):
                if n not in held.value:
                    continue
                distance = 1 - v @ held.value[n][1].T
                for j in range(distance.shape[1]):
                    own, names = distance[:, j], ids
                    if len(own) > top_k:
                        take = np.flatnonzero(own <= np.partition(own, top_k - 1)[top_k - 1])
                        own, names = own[take], ids.take(pa.array(take))
                    have = best.get((n, j))
                    names = names.to_pylist()
                    if have is not None:
                        names, own = have[0] + names, np.concatenate([have[1], own])
                        if len(own) > top_k:
                            take = np.flatnonzero(own <= np.partition(own, top_k - 1)[top_k - 1])
                            names, own = [names[t] for t in take], own[take]
                    best[n, j] = names, own
        for (n, j), (names, own) in best.items():
            query = held.value[n][0][j]
            yield pa.RecordBatch.from_pydict({"query_id": [query] * len(names), "memory_id": names, "distance": own})

    return run


def bank_retrieve(memories: DataFrame, wanted: dict[str, str], query: list[float], top_k: int = 8) -> DataFrame:
    """Semantic retrieval under an exact scope: fact, distance, memory_name."""
    own = memories.filter(scope.exact(F.col("scope"), wanted))
    return nearest(own, query, top_k).select(F.coalesce("fact", "memory_id").alias("fact"), "distance", F.col("memory_id").alias("memory_name"))


def mock_hits(spark, top_k: int, query: str = "") -> DataFrame:
    """Placeholder rows for an engine without a semantic store."""
    return spark.range(min(top_k, 3)).select(F.concat(F.lit(f"[mock] {query} #"), F.col("id").cast("string")).alias("fact"), F.round(0.9 - 0.1 * F.col("id"), 1).alias("score"))
