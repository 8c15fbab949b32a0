"""Store, sources, SQL guard, provider, command line and streams on temporary folders."""

import json
import sqlite3
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from recall import cli, config
from recall.bridge import Bridge, errors
from recall.provider import MemoryProvider, register
from recall.sources import curated, local, notes
from recall.sqltool import REFUSED, is_read_only, run_sql
from recall.store import BankConfig, Store
from recall.streaming import events


@pytest.fixture
def store(spark, request):
    name = "t_" + request.node.name.replace("[", "_").replace("]", "_")[:40]
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    out = Store(spark, config.Settings(database=name, user_id="u", home="/nowhere", engine_id="7", prefetch_seconds=60))
    out.init()
    yield out
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_settings(monkeypatch):
    monkeypatch.setenv("RECALL_TOP_K", "3")
    assert config.load(user_id="").top_k == 3
    assert config.load(top_k=5).top_k == 5
    assert config.load().revision_ttl_seconds == 365 * 86400


def test_store_round_trip(spark, store):
    store.init()
    store.remember(spark.createDataFrame([("likes tea", "u", "agent"), ("it's\n'quoted'", "w", "agent")], "fact string, user_id string, agent_name string"))
    assert store.table("memories").count() == 2
    assert store.purge(F.col("user_id") == "w") == 1
    assert store.table("memories").count() == 2
    assert store.purge(F.col("user_id") == "w", force=True) == 1
    assert [r["fact"] for r in store.table("memories").collect()] == ["likes tea"]
    assert spark.table("memory_stats").count() == 1


def test_provider(spark, store):
    p = MemoryProvider(store, trivial=lambda q: q == "hi")
    assert p.is_available()
    assert p.sync_turn("short", "x") == 0
    assert p.sync_turn("I prefer green tea", "Noted") == 1
    assert p.on_memory_write("add", "user", "speaks French") == 1
    assert p.on_memory_write("remove", "user", "x") == 0
    assert p.prefetch("hi") == ""
    got = p.prefetch("tea")
    assert got.startswith("## Memory\n") and "[User profile] speaks French" in got
    assert p.recalled == 2
    assert MemoryProvider(store, context="subagent").sync_turn("I prefer green tea", "Noted") == 0


@pytest.mark.parametrize(
    ("sql", "ok"),
    [
        ("SELECT 1 AS a", True),
        ("WITH x AS (SELECT 1 a) SELECT * FROM x", True),
        ("SHOW TABLES", True),
        ("INSERT INTO t VALUES (1)", False),
        ("WITH x AS (SELECT 1 a) INSERT INTO t SELECT * FROM x", False),
        ("DROP TABLE t", False),
        ("CREATE TABLE t AS SELECT 1", False),
        ("SET a = 1", False),
    ],
)
def test_read_only(spark, sql, ok):
    assert is_read_only(spark, sql) is ok


def test_sql_text(spark):
    assert run_sql(spark, "DROP TABLE t") == REFUSED
    assert run_sql(spark, "SELECT 1 AS a") == "{'a': 1}"
    assert run_sql(spark, "SELECT 1 AS a WHERE false") == "No results."
    assert run_sql(spark, "SELECT * FROM missing_table").startswith("SQL error")
    assert len(run_sql(spark, "SELECT id FROM range(100)").splitlines()) == 20


def test_local_source(spark, tmp_path):
    assert local.read_local(spark, str(tmp_path)).count() == 0
    (tmp_path / "agent.db").write_text("not a database")
    assert local.read_local(spark, str(tmp_path)).count() == 0
    with sqlite3.connect(tmp_path / "memory.db") as db:
        db.execute("CREATE TABLE zzz (a)")
        db.execute("CREATE TABLE memory (id, content)")
        db.executemany("INSERT INTO memory VALUES (?, ?)", [(i, f"f{i}") for i in range(60)])
    rows = local.read_local(spark, str(tmp_path))
    assert rows.columns == ["id", "content"] and rows.count() == 50
    assert local.facts_of(rows).filter(F.col("fact").startswith("f")).count() == 50


def test_curated(spark, tmp_path):
    (tmp_path / "MEMORY.md").write_text("a\n§\n b §§")
    (tmp_path / "USER.md").write_text("c")
    assert [tuple(r) for r in curated.read_curated(spark, str(tmp_path)).collect()] == [("a", "MEMORY.md", "memory"), ("b", "MEMORY.md", "memory"), ("c", "USER.md", "user_profile")]


def test_notes_and_manifest(spark, tmp_path):
    vault = tmp_path / "vault one"
    for name, body in (("_u.md", b"x" * 10), (".foo/x.md", b"y" * 10), (".obsidian/h.md", b"z" * 10), ("s.md", b"short"), ("bad.md", b"\xff" + b"w" * 10), ("a.txt", b"n" * 10)):
        (vault / name).parent.mkdir(parents=True, exist_ok=True)
        (vault / name).write_bytes(body)
    got = notes.discover_notes(spark, [str(vault), str(tmp_path / "missing")], 10)
    assert sorted(r["rel"] for r in got.collect()) == [".foo/x.md", "_u.md", "bad.md"]
    assert {r["body"] for r in got.filter("rel = 'bad.md'").collect()} == {"w" * 10}
    where = str(tmp_path / "manifest")
    assert notes.read_manifest(spark, where).count() == 0
    notes.write_manifest(got.select("path", "hash"), where)
    notes.write_manifest(got.select("path", "hash").limit(2), where)
    assert notes.read_manifest(spark, where).count() == 2


def test_cli(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setenv("RECALL_DATABASE", "t_cli")
    spark.sql("DROP DATABASE IF EXISTS t_cli CASCADE")
    home = ["--user", "u", "--home", str(tmp_path)]
    (tmp_path / "MEMORY.md").write_text("one§two")
    vault = tmp_path / "v"
    vault.mkdir()
    (vault / "n.md").write_text("note " * 60)
    for args in (["init"], ["remember", "likes tea"], ["seed"], ["ingest-notes", str(vault)]):
        assert cli.main([*home, *args], spark) == 0
    capsys.readouterr()
    cli.main([*home, "stats"], spark)
    assert json.loads(capsys.readouterr().out)[0]["memory_count"] == 4
    cli.main([*home, "ingest-notes", "--dry-run", str(vault)], spark)
    assert json.loads(capsys.readouterr().out)[0] == {"found": 1, "new": 0, "already": 1}
    cli.main([*home, "search", "tea"], spark)
    found, text = capsys.readouterr().out.split("\n--- Prompt context ---\n")
    assert any(r["fact"] == "likes tea" for r in json.loads(found)["merged"])
    assert "- likes tea\n" in text
    (tmp_path / "USER.md").write_text("three")
    assert cli.main([*home, "--agent", "other", "seed"], spark) == 0
    assert "[OK] three" in (said := capsys.readouterr().out) and "Seeded 1/1" in said
    spark.sql("DROP DATABASE t_cli CASCADE")


def test_notes_batch_by_batch(spark, tmp_path, capsys, monkeypatch):
    """A batch that fails leaves the others written and in the manifest; the next run does what is left, once."""
    monkeypatch.setenv("RECALL_DATABASE", "t_batches")
    monkeypatch.setenv("RECALL_VAULTS", str(tmp_path / "v"))
    spark.sql("DROP DATABASE IF EXISTS t_batches CASCADE")
    (tmp_path / "v").mkdir()
    for i in range(3):
        (tmp_path / "v" / f"n{i}.md").write_text(f"note {i} " * 60)
    args = ["--user", "u", "--home", str(tmp_path), "ingest-notes", "--batch-chars", "500"]
    cli.main([*args[:4], "init"], spark)
    generate = cli.Bridge.generate
    calls = []

    def broken(self, texts, scope):
        calls.append(1)
        if len(calls) == 2:
            raise ValueError("no answer")
        return generate(self, texts, scope)

    monkeypatch.setattr(cli.Bridge, "generate", broken)
    assert cli.main(args, spark) == 1
    assert "[FAIL] batch 2/3: no answer" in (said := capsys.readouterr().out) and "Ingested 2 notes in 2/3 batches" in said
    assert cli.main(args, spark) == 0
    assert "Ingested 1 notes in 1/1 batches" in capsys.readouterr().out
    assert spark.table("t_batches.memories").count() == 3
    spark.sql("DROP DATABASE t_batches CASCADE")


def test_bridge(spark, store, tmp_path):
    b = Bridge(Store(spark, replace(store.settings, engine_id="")))
    found = b.retrieve_context("hello", 3)
    assert {"query", "scope", "bank_hits", "warehouse_hits", "local_hits", "merged", "prompt_context"} <= set(found)
    assert found["bank_hits"][0] == "[mock] hello #0" and len(found["merged"]) == 3
    done = b.explicit_remember("likes tea", {"kind": "x"})
    assert done["warehouse"] == 1 and errors(done) == {}

    def fails(texts):
        raise ValueError("no model")

    done = Bridge(store, extractor=fails).explicit_remember("likes coffee")
    assert errors(done) == {"bank_error": "no model"} and done["warehouse"] == 1
    done = Bridge(store, extractor=lambda t: t.withColumn("fact", F.upper("text"))).sync_session("s/1", [{"role": "user", "text": "hi"}, {"role": "model", "text": "yes"}])
    assert (done["session"], done["bank"]) == (1, 2)
    assert {r["fact"] for r in store.table("memories").collect()} == {"likes tea", "likes coffee", "HI", "YES"}
    spark.sql(f"DROP TABLE {store.name('memories')}")
    assert "warehouse_error" in b.retrieve_context("x") and "warehouse_error" in b.explicit_remember("y")
    assert MemoryProvider(store).is_available()  # makes what is missing


def test_local_facts_in_store_order(spark, tmp_path):
    with sqlite3.connect(tmp_path / "memory.db") as db:
        db.execute("CREATE TABLE memories (content)")
        db.executemany("INSERT INTO memories VALUES (?)", [(x,) for x in ("zebra", "ant", "mole")])
    rows = local.facts_of(local.read_local(spark, str(tmp_path))).orderBy("at").collect()
    assert [r["fact"] for r in rows] == ["zebra", "ant", "mole"]


def test_bank_config(spark, store):
    assert store.bank() == BankConfig.of(store.settings)
    mine = BankConfig(metric="dot", ttl_seconds=60, topics=["IT'S"])
    assert store.create_bank(mine) == store.settings.engine_name
    assert store.bank() == mine
    cfg = config.load(project="p1", engine_id="7", generation_model="m")
    assert cfg.engine_name == "projects/p1/locations/us-central1/reasoningEngines/7"
    assert cfg.generation_model_path == "projects/p1/locations/us-central1/publishers/google/models/m"
    assert config.load().engine_name is None
    assert Store(spark, replace(store.settings, engine_id="")).create_bank().startswith("local://")


def test_provider_in_background(spark, store, tmp_path):
    p = MemoryProvider(store, background=True)
    assert p.sync_turn("I prefer green tea", "Noted") == 0
    p.on_memory_write("add", "user", "speaks French")
    p.shutdown(60)
    assert store.table("memories").count() == 2
    assert {x["key"] for x in p.get_config_schema()} >= {"user_id", "top_k"}
    (tmp_path / "memory.json").write_text('{"other": 1}')
    assert p.save_config({"top_k": 3}, str(tmp_path))
    assert json.loads((tmp_path / "memory.json").read_text()) == {"other": 1, "recall": {"top_k": 3}}
    assert not p.save_config({}, "/nowhere/at/all")
    host = type("Host", (), {"register_memory_provider": lambda self, x: setattr(self, "got", x)})()
    register(host, p)
    assert host.got is p


def test_session_to_memory_stream(spark, store, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"a longer text {c} {t}") for c in range(3) for t in range(4)]
    spark.createDataFrame(rows, events.EVENT_SCHEMA).write.parquet(str(tmp_path / "in"))
    events.for_each_batch(events.read_events(spark, str(tmp_path / "in")), Bridge(store).session_to_memory, str(tmp_path / "cp")).awaitTermination()
    assert store.table("memories").count() == 6


def test_streams_equal_batch(spark, tmp_path):
    rows = [(c, t, "user", f"t{t}") for c in range(3) for t in range(4)]
    df = spark.createDataFrame(rows, events.EVENT_SCHEMA)
    src = str(tmp_path / "in")
    df.repartition(3).write.parquet(src)
    q = events.append_events(events.read_events(spark, src, files=1), str(tmp_path / "out"), str(tmp_path / "cp1"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("received_at")
    assert sorted(map(tuple, got.collect())) == sorted(rows)
    q = events.for_each_batch(events.read_events(spark, src, files=1), events.append_once(str(tmp_path / "each")), str(tmp_path / "cp2"))
    q.awaitTermination()
    back = spark.read.parquet(str(tmp_path / "each"))
    assert {tuple(r) for r in events.session_counts(back).collect()} == {tuple(r) for r in events.session_counts(df).collect()}
    q = events.for_each_batch(events.read_events(spark, src), events.append_once(str(tmp_path / "live")), str(tmp_path / "cp3"), continuous=True)
    events.drain(q)
    assert spark.read.parquet(str(tmp_path / "live")).count() == 12
