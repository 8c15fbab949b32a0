"""Tables in the folder that driver and executors share, and connected components over them.

Intermediate results are written here instead of being kept on executors: a lost executor then costs a
read, not a recomputation of everything before.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import session
from . import arrays

#: Least and largest number of 64-bit words of the filters of ``bloom``; between them they have 16 bits for each id.
BLOOM_WORDS = 1 << 12, 1 << 22

#: Edges up to which one task finds the components (16 bytes each); those of more are found by steps over all tasks.
EDGES = 1 << 18

_own: dict[str, str] = {}
_scopes: list[list[DataFrame]] = []


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.  Where that is unset a local session (as in tests) gets a temporary folder;
    on a cluster that would be a folder of one machine, so there it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if "dir" not in _own:
        made = tempfile.mkdtemp(prefix="recall-shared-")
        atexit.register(shutil.rmtree, made, True)
        _own["dir"] = f"file://{made}"
    return _own["dir"]


def save(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under a fresh name and read back: its lineage ends here."""
    path = f"{folder(df.sparkSession)}/recall-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._recall_path = path
    if _scopes:
        _scopes[-1].append(out)
    return out


@contextlib.contextmanager
def scope() -> Iterator[None]:
    """Tables that are saved inside are deleted at the end: what is made of them must be written by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for table in _scopes.pop():
            forget(table)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def forget(df: DataFrame) -> None:
    """Delete a table of ``save`` that nothing reads any more."""
    path = getattr(df, "_recall_path", None)
    if path:
        delete(df.sparkSession, path)


#: Bytes of an Arrow batch that go to a Python worker at a time (a longer row is a batch of its own).
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Make the package importable on executors, and bound batches by bytes: rows here hold whole texts."""
    session.ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _least(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges ``a``-``b`` and the least node that each can reach."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    low = np.arange(len(nodes))
    while True:
        one, two = low[x], low[y]
        if (one == two).all():
            return nodes, nodes[low]
        np.minimum.at(low, np.maximum(one, two), np.minimum(one, two))
        while (low[low] != low).any():
            low = low[low]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph with columns ``a``, ``b``; the component is its least node.

    Up to ``EDGES`` distinct edges are read by one task.  More take alternating large-star and small-star steps: every step
    replaces edges by edges to a smaller neighbour, so a path of length n takes O(log n) steps and a star one.  A step is a min per node and a
    join; no node's neighbourhood is ever gathered.  Edges with a null or equal ends are ignored.
    """
    def step(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.union(pairs.select("b", "a")) if large else pairs
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        met = both.join(least, both["a"] == least["u"])
        if large:
            out = met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.filter(F.col("a") != F.col("b")).distinct()

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[x.to_numpy() for x in batch.columns] for batch in batches]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _least(*map(np.concatenate, zip(*held, strict=True)))], ["node", "component"])

    now = save(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if now.count() <= EDGES:
        ship(now.sparkSession)
        return now.coalesce(1).mapInArrow(arrays.lean(together), "node long, component long")
    mark = None
    while True:
        nxt = save(step(step(now, True), False), "edges")
        forget(now)
        now = nxt
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b"), F.col("b")).distinct())


class Bloom:
    """A broadcast Bloom filter; a false hit only costs time."""

    def __init__(self, bits: Broadcast, words: int):
        self.bits, self.words = bits, words

    def destroy(self) -> None:
        self.bits.destroy()


def _bits(column: str, words: int) -> list:
    return [F.pmod(F.xxhash64(column, F.lit(s)), F.lit(words * 64)) for s in (1, 2)]


def bloom(ids: DataFrame) -> Bloom:
    """A filter over column ``id``, of a size that follows their number up to 32 MiB."""
    least, most = BLOOM_WORDS
    words = min(most, max(least, 1 << (max(1, ids.count() // 4) - 1).bit_length()))
    bit = ids.select(F.explode(F.array(*_bits("id", words))).alias("bit"))
    rows = bit.groupBy((F.col("bit") / 64).cast("long").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("v")).toArrow()
    bits = np.zeros(words, np.int64)
    bits[rows["w"].to_numpy()] = rows["v"].to_numpy()
    return Bloom(ids.sparkSession.sparkContext.broadcast(bits), words)


def maybe(docs: DataFrame, held: Bloom, wanted: bool = True, columns: list[str] | tuple = (), run=None, schema: StructType | str | None = None, key: str = "doc_id") -> DataFrame:
    """(doc_id, text) and ``columns`` of the rows whose ``key`` the filter may hold, or surely does not hold; texts pass as they are.

    With ``run`` its result (of ``schema``) for the batches of these rows, in the same Python worker.
    """

    def has(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            hit = np.ones(batch.num_rows, bool)
            for i in (-2, -1):
                at = batch.column(batch.num_columns + i).to_numpy(zero_copy_only=False)
                hit &= (bits[at >> 6] >> (at & 63)) & 1 == 1
            hit = hit if wanted else ~hit
            if hit.all():
                yield batch.select(names)
            elif hit.any():
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(hit)) for c in batch.columns[:-2]], names)

    names = ["doc_id", "text", *columns]
    sent = held.bits
    one, two = _bits(key, held.words)
    rows = docs.select(*names, one.alias("_one"), two.alias("_two"))
    if run is None:
        return rows.mapInArrow(has, docs.select(*names).schema)
    return rows.mapInArrow(lambda batches: run(has(batches)), schema)
