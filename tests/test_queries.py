"""Every registered query of the library against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from recall.plans import registry

DATA = "/root/testdata/sf0.001"


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("" if r[i] is None else f"{r[i] + 0.0:.6f}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in values)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    got = df.collect()
    if name not in registry.ORACLES:
        assert got
        return
    want = duck.execute(registry.ORACLES[name])
    names = [x[0] for x in want.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, got) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", ["stream_append", "stream_session_counts", "stream_to_memory"])
def test_stream_of_many_files(spark, tmp_path, name):
    """The table is a folder of more files than a micro-batch takes, and the turns of a session lie in several."""
    spark.read.parquet(f"{DATA}/conversations.parquet").repartition(120, "conv_id", "turn").write.option("maxRecordsPerFile", 1).parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    df = registry.QUERIES[name](spark, str(tmp_path))
    got = df.collect()
    want = con.execute(registry.ORACLES[name])
    names = [x[0] for x in want.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, got) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", ["stream_append", "stream_session_counts", "stream_to_memory"])
def test_stream_of_folders_by_column(spark, tmp_path, name):
    """The table's files lie in folders by role, more than a micro-batch takes, so a micro-batch has not all roles."""
    spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").repartition(120, "conv_id", "turn").write.partitionBy("role").parquet(str(tmp_path / "conversations.parquet"))
    assert len(glob.glob(f"{tmp_path}/conversations.parquet/role=*/*.parquet")) > 100
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*/*.parquet', hive_partitioning = true)")
    df = registry.QUERIES[name](spark, str(tmp_path))
    got = df.collect()
    want = con.execute(registry.ORACLES[name])
    names = [x[0] for x in want.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, got) == rows(names, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
