"""Named queries of the engine and the SQL that says what each one returns."""

from __future__ import annotations

import sqlite3
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..bridge import Bridge
from ..config import Settings
from ..functions import text
from ..operators import ingest, lifecycle, retrieve, search, views
from ..sources import curated, local
from ..sqltool import read_only
from ..store import Store
from ..streaming import events
from . import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

USER, SCOPE = "src3", {"user_id": "src3", "agent_name": "de"}
NOW = "timestamp_ntz'2024-06-01 12:00:00'"
STRIP = "(" + " || ".join(f"chr({ord(c)})" for c in text.WHITESPACE) + ")"
FIRST = "(SELECT embedding FROM embeddings WHERE vec_id = 0)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def _cosine(a: str, b: str) -> str:
    return f"1 - list_dot_product({a}::DOUBLE[], {b}::DOUBLE[]) / (sqrt(list_dot_product({a}::DOUBLE[], {a}::DOUBLE[])) * sqrt(list_dot_product({b}::DOUBLE[], {b}::DOUBLE[])))"


def _vector(spark: SparkSession, sf_dir: str, vec_id: int = 0) -> list[float]:
    """One stated query vector."""
    return X.table(spark, sf_dir, "embeddings").filter(F.col("vec_id") == vec_id).select("embedding").first()[0]


@query("recent_memories", f"WITH {X.MEMORIES} SELECT memory_id, fact, json_extract_string(scope, '$.user_id') AS user_id, agent_name, created_at, expires_at FROM memories")
def _(spark, d):
    return views.recent_memories(X.memories(spark, d))


_STATS = f"WITH {X.MEMORIES} SELECT json_extract_string(scope, '$.user_id') AS user_id, count(*) AS memory_count, min(created_at) AS first_memory_at, max(created_at) AS last_memory_at FROM memories GROUP BY 1"


@query("memory_stats", _STATS)
def _(spark, d):
    return views.memory_stats(X.memories(spark, d))


@query("stats_all", _STATS)
def _(spark, d):
    return views.stats(X.memories(spark, d))


@query("stats_for_user", f"SELECT * FROM ({_STATS}) WHERE user_id = '{USER}'")
def _(spark, d):
    return views.stats(X.memories(spark, d), USER)


def _sessions(spark, d):
    return ingest.session_rows(X.session_events(spark, d))


@query(
    "user_timeline",
    f"WITH {X.MEMORIES}, {X.SESSIONS} SELECT user_id, session_name, event_count, created_at FROM sessions UNION ALL SELECT json_extract_string(scope, '$.user_id'), memory_id, 1, created_at FROM memories",
)
def _(spark, d):
    return views.user_timeline(_sessions(spark, d), X.memories(spark, d))


@query("recent_for_user", f"WITH {X.MEMORIES} SELECT memory_id, fact, created_at FROM memories WHERE user_id = '{USER}' ORDER BY created_at DESC, memory_id LIMIT 20")
def _(spark, d):
    return views.recent_for_user(X.memories(spark, d), USER)


@query("session_rows", f"WITH {X.SESSIONS} SELECT session_name, session_id, user_id, md5(events) AS events_md5, event_count, created_at, updated_at FROM sessions")
def _(spark, d):
    return _sessions(spark, d).select("session_name", "session_id", "user_id", F.md5("events").alias("events_md5"), "event_count", "created_at", "updated_at")


_SCOPED = f"json_extract_string(scope, '$.user_id') = '{USER}' AND json_extract_string(scope, '$.agent_name') = 'de'"


@query("list_by_scope", f"WITH {X.MEMORIES} SELECT memory_id, fact, scope FROM memories WHERE {_SCOPED}")
def _(spark, d):
    return views.list_by_scope(X.memories(spark, d), SCOPE).select("memory_id", "fact", "scope")


@query("exact_scope", f"WITH {X.MEMORIES} SELECT memory_id, fact, scope FROM memories WHERE {_SCOPED} AND len(json_keys(scope)) = 2")
def _(spark, d):
    return views.exact_scope(X.memories(spark, d), SCOPE).select("memory_id", "fact", "scope")


def _nearest_sql(where: str) -> str:
    return f"WITH {X.MEMORIES} SELECT memory_id, fact, scope, round({_cosine('embedding', FIRST)}, 6) + 0.0::DOUBLE AS distance FROM memories WHERE embedding IS NOT NULL {where} ORDER BY {_cosine('embedding', FIRST)}, memory_id LIMIT 8"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("distance", F.round("distance", 6) + F.lit(0.0))


@query("vector_topk", _nearest_sql(f"AND json_extract_string(scope, '$.user_id') = '{USER}'"))
def _(spark, d):
    return _rounded(search.nearest(X.memories(spark, d, embedding=True), _vector(spark, d), 8, USER))


@query("vector_unscoped", _nearest_sql(""))
def _(spark, d):
    return _rounded(search.nearest(X.memories(spark, d, embedding=True), _vector(spark, d), 8))


@query(
    "vector_multi",
    f"""WITH met AS (SELECT q.vec_id AS query_id, CAST(b.vec_id AS VARCHAR) AS memory_id, {_cosine("b.embedding", "q.embedding")} AS distance
        FROM embeddings b JOIN embeddings q ON q.vec_id % 100 = 0)
        SELECT query_id, memory_id, round(distance, 6) + 0.0::DOUBLE AS distance, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, memory_id) AS rank FROM met) WHERE rank <= 8""",
)
def _(spark, d):
    e = X.table(spark, d, "embeddings")
    queries = e.filter(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    return _rounded(search.nearest_many(e.select(F.col("vec_id").cast("string").alias("memory_id"), "embedding"), queries, 8))


@query(
    "bank_retrieve",
    f"WITH {X.MEMORIES} SELECT fact, round({_cosine('embedding', FIRST)}, 6) + 0.0::DOUBLE AS distance, memory_id AS memory_name FROM memories WHERE embedding IS NOT NULL AND {_SCOPED} AND len(json_keys(scope)) = 2 ORDER BY {_cosine('embedding', FIRST)}, memory_id LIMIT 8",
)
def _(spark, d):
    return _rounded(search.bank_retrieve(X.memories(spark, d, embedding=True), SCOPE, _vector(spark, d), 8))


K = 60
_KEY = f"trim(lower(substr(coalesce(fact, ''), 1, 500)), {STRIP})"
_DUAL = f"""WITH {X.MEMORIES},
  bank AS (SELECT 0 AS src_rank, row_number() OVER (ORDER BY {_cosine("embedding", FIRST)}, memory_id) AS rn, fact FROM memories
           WHERE embedding IS NOT NULL AND {_SCOPED} QUALIFY rn <= {K}),
  wh AS (SELECT 1 AS src_rank, row_number() OVER (ORDER BY created_at DESC, memory_id) AS rn, fact FROM memories WHERE user_id = '{USER}' QUALIFY rn <= {K}),
  loc AS (SELECT 2 AS src_rank, row_number() OVER (ORDER BY doc_id) AS rn, substr(text, 1, 500) AS fact FROM documents WHERE source IN ('src3', 'src4') QUALIFY rn <= {K}),
  two AS (SELECT *, {_KEY} AS k FROM (SELECT * FROM bank UNION ALL SELECT * FROM wh)),
  seen AS (SELECT src_rank, rn, fact, k FROM two WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY k ORDER BY src_rank, rn) = 1),
  new AS (SELECT src_rank, rn, fact, {_KEY} AS k FROM loc WHERE fact <> '' AND {_KEY} NOT IN (SELECT k FROM seen)),
  ranked AS (SELECT row_number() OVER (ORDER BY src_rank, rn) AS rank, CASE src_rank WHEN 0 THEN 'bank' WHEN 1 THEN 'warehouse' ELSE 'local' END AS origin, fact
             FROM (SELECT * FROM seen UNION ALL SELECT * FROM new) QUALIFY rank <= {K})"""


def _dual(spark: SparkSession, d: str) -> DataFrame:
    m = X.memories(spark, d)
    bank = search.bank_retrieve(X.memories(spark, d, embedding=True), SCOPE, _vector(spark, d), K)
    one = retrieve.leg(bank, "bank", 0, F.col("distance"), F.col("memory_name"), top_k=K)
    two = retrieve.leg(views.recent_for_user(m, USER, K), "warehouse", 1, F.desc("created_at"), F.col("memory_id"), top_k=K)
    docs = X.table(spark, d, "documents").filter(F.col("source").isin("src3", "src4")).select("doc_id", F.col("text").alias("fact"))
    three = retrieve.leg(docs, "local", 2, F.col("doc_id"), top_k=K)
    return retrieve.merge(one, two, three, K)


@query("dual_retrieval", f"{_DUAL} SELECT rank, origin, fact FROM ranked")
def _(spark, d):
    return _dual(spark, d)


@query("recall_status", f"{_DUAL} SELECT count(*) AS recalled FROM ranked")
def _(spark, d):
    return retrieve.recall_status(_dual(spark, d))


@query("dedupe_facts", f"WITH {X.MEMORIES}, k AS (SELECT *, {_KEY} AS k FROM memories) SELECT memory_id, fact FROM k WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY k ORDER BY created_at, memory_id) = 1")
def _(spark, d):
    m = X.memories(spark, d).select("memory_id", "fact", "created_at")
    return retrieve.dedupe_facts(m, text.dedupe_key(F.col("fact")), F.col("created_at"), F.col("memory_id")).select("memory_id", "fact")


@query("prompt_context", f"WITH {X.MEMORIES} SELECT user_id, md5(string_agg('- ' || fact, chr(10) ORDER BY rank) FILTER (fact <> '')) AS context_md5 FROM (SELECT user_id, fact, CAST(memory_id AS BIGINT) AS rank FROM memories QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rank) <= 20) GROUP BY user_id")
def _(spark, d):
    hits = X.memories(spark, d).select("user_id", F.col("memory_id").cast("long").alias("rank"), "fact")
    return retrieve.prompt_context(hits, "user_id", top_k=20).select("user_id", F.md5("prompt_context").alias("context_md5"))


@query("truthy_coalesce", "SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN NULL ELSE lang END, ''), nullif(CASE WHEN doc_id % 2 = 0 THEN '' ELSE source END, ''), 'none') AS value FROM documents")
def _(spark, d):
    a = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, None).otherwise(F.col("lang"))
    b = F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("source"))
    return X.table(spark, d, "documents").select("doc_id", text.first_truthy(a, b, F.lit("none")).alias("value"))


_SEED = f"""WITH {X.MEMORIES},
  candidates AS (SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN chr(9) || ' ' || upper(text) || ' ' || chr(10) ELSE text || ' (new)' END AS fact FROM documents WHERE source = '{USER}'),
  known AS (SELECT lower(trim(fact, {STRIP})) AS k FROM (SELECT fact FROM memories WHERE user_id = '{USER}' ORDER BY created_at DESC, memory_id LIMIT 1000)),
  fresh AS (SELECT * FROM candidates WHERE lower(trim(fact, {STRIP})) NOT IN (SELECT k FROM known))"""


def _seed(spark, d):
    rows = X.seed_candidates(spark, d, USER)
    return rows, ingest.seed_new_facts(rows, X.memories(spark, d), USER)


@query("seed_new_facts", f"{_SEED} SELECT doc_id, fact FROM fresh")
def _(spark, d):
    return _seed(spark, d)[1].select("doc_id", "fact")


@query("seed_summary", f"{_SEED} SELECT (SELECT count(*) FROM candidates) AS found, (SELECT count(*) FROM fresh) AS new, (SELECT count(*) FROM candidates) - (SELECT count(*) FROM fresh) AS already")
def _(spark, d):
    return ingest.summary(*_seed(spark, d))


_DIFF = f"WITH {X.NOTES}, {X.MANIFEST}, fresh AS (SELECT n.* FROM notes n LEFT JOIN manifest m ON m.path = n.path AND m.hash = n.hash WHERE m.path IS NULL)"


def _fresh(spark, d):
    return ingest.note_diff(X.plain_notes(spark, d), X.manifest(spark, d))


@query("note_diff", f"{_DIFF} SELECT path, hash FROM fresh")
def _(spark, d):
    return _fresh(spark, d).select("path", "hash")


@query("ingest_summary", f"{_DIFF} SELECT (SELECT count(*) FROM notes) AS found, (SELECT count(*) FROM fresh) AS new, (SELECT count(*) FROM notes) - (SELECT count(*) FROM fresh) AS already")
def _(spark, d):
    return ingest.summary(X.plain_notes(spark, d), _fresh(spark, d))


@query(
    "note_batches",
    f"""WITH RECURSIVE {X.NOTES},
      o AS (SELECT vault, path, length(rel) + length(vault) + length(body) + 32 AS size, row_number() OVER (PARTITION BY vault ORDER BY path) AS i FROM notes),
      walk AS (SELECT vault, path, i, CAST(0 AS BIGINT) AS batch, CAST(size AS BIGINT) AS held FROM o WHERE i = 1
               UNION ALL SELECT o.vault, o.path, o.i, CASE WHEN w.held + o.size > 6000 THEN w.batch + 1 ELSE w.batch END, CASE WHEN w.held + o.size > 6000 THEN o.size ELSE w.held + o.size END
               FROM walk w JOIN o ON o.vault = w.vault AND o.i = w.i + 1)
      SELECT vault, path, batch FROM walk""",
)
def _(spark, d):
    return ingest.note_batches(X.plain_notes(spark, d))


_RAW = """raw AS (SELECT doc_id, '/v/' || lang AS vault, CASE WHEN doc_id % 11 = 0 THEN '.trash/' ELSE '' END || source || '/' || doc_id || '.md' AS rel,
                  CASE WHEN doc_id % 7 = 0 THEN '---' || chr(10) || 'kind: note' || chr(10) || '---' || chr(10) || chr(10) || text ELSE text END AS raw_text, text FROM documents)"""


@query(
    "note_discovery",
    f"WITH {_RAW} SELECT vault || '/' || rel AS path, vault, rel, sha256(raw_text) AS hash, md5(trim(text, {STRIP})) AS body_md5 FROM raw WHERE doc_id % 11 <> 0 AND length(trim(text, {STRIP})) >= 200",
)
def _(spark, d):
    return ingest.note_rows(X.raw_notes(spark, d)).select("path", "vault", "rel", "hash", F.md5("body").alias("body_md5"))


@query("path_filter", f"WITH {_RAW} SELECT vault || '/' || rel AS path FROM raw WHERE doc_id % 11 <> 0")
def _(spark, d):
    return X.raw_notes(spark, d).filter(~text.has_marker(F.col("path"), ingest.MARKERS)).select("path")


@query("note_render", f"WITH {X.NOTES} SELECT path, md5('## ' || rel || ' (vault: ' || substr(vault, 4) || ')' || chr(10) || chr(10) || body) AS rendered_md5 FROM notes")
def _(spark, d):
    return ingest.note_render(X.plain_notes(spark, d)).select("path", F.md5("rendered").alias("rendered_md5"))


@query("manifest_upsert", f"WITH {X.NOTES}, {X.MANIFEST} SELECT coalesce(n.path, m.path) AS path, coalesce(n.hash, m.hash) AS hash FROM manifest m FULL JOIN (SELECT * FROM notes WHERE doc_id % 5 = 0) n ON n.path = m.path")
def _(spark, d):
    return ingest.manifest_upsert(X.manifest(spark, d), X.plain_notes(spark, d).filter(F.col("doc_id") % 5 == 0))


_TURNS = f"""t AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS reply FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
  facts AS (SELECT conv_id, turn, 'User: ' || trim(substr(text, 1, 2000), {STRIP}) || chr(10) || 'Assistant: ' || trim(substr(coalesce(reply, ''), 1, 2000), {STRIP}) AS fact
            FROM t WHERE role = 'user' AND next_role = 'assistant' AND length(trim(text, {STRIP})) >= 8)"""


@query("turn_facts", f"WITH {_TURNS} SELECT conv_id, turn, fact FROM facts")
def _(spark, d):
    return ingest.turn_facts(X.table(spark, d, "conversations"))


_WRITES = """writes AS (SELECT event_id AS write_id, CASE event_type WHEN 'click' THEN 'add' WHEN 'view' THEN 'replace' ELSE 'remove' END AS action,
  CASE WHEN user_id % 2 = 0 THEN 'user' ELSE 'memory' END AS target, props AS content, CASE event_id % 3 WHEN 0 THEN 'primary' WHEN 1 THEN 'subagent' END AS context FROM events)"""


@query("memory_write_facts", f"WITH {_WRITES} SELECT write_id, '[' || CASE target WHEN 'user' THEN 'User profile' ELSE 'Agent memory' END || '] ' || content AS fact FROM writes WHERE action IN ('add', 'replace') AND content <> ''")
def _(spark, d):
    return ingest.memory_write_facts(X.writes(spark, d))


@query("context_gate", f"WITH {_WRITES} SELECT write_id, context FROM writes WHERE context IS NULL OR context IN ('primary', '')")
def _(spark, d):
    return ingest.context_gate(X.writes(spark, d)).select("write_id", "context")


@query(
    "remember_rows",
    f"""WITH {_TURNS} SELECT conv_id || '/' || turn AS memory_id, fact, '{{' || CASE WHEN conv_id % 4 = 0 THEN '' ELSE '"user_id":"src' || (conv_id % 20) || '",' END || '"agent_name":"agent"}}' AS scope,
        CASE WHEN conv_id % 4 = 0 THEN '' ELSE 'src' || (conv_id % 20) END AS user_id, 'agent' AS agent_name, CASE WHEN turn % 2 = 0 THEN 'null' ELSE '{{"turn":' || turn || '}}' END AS metadata, 'direct' AS source,
        TIMESTAMP '2024-06-01 12:00:00' AS created_at, TIMESTAMP '2024-06-01 12:00:00' AS updated_at, TIMESTAMP '2025-06-01 12:00:00' AS expires_at FROM facts""",
)
def _(spark, d):
    f = ingest.turn_facts(X.table(spark, d, "conversations"))
    rows = f.select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("memory_id"),
        "fact",
        F.when(F.col("conv_id") % 4 != 0, F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string"))).alias("user_id"),
        F.lit("agent").alias("agent_name"),
        F.when(F.col("turn") % 2 == 0, "{}").otherwise(F.concat(F.lit('{"turn":'), F.col("turn").cast("string"), F.lit("}"))).alias("metadata"),
    )
    return ingest.remember_rows(rows, F.expr(NOW))


@query("extract_facts", "SELECT conv_id, turn, text AS fact FROM conversations WHERE coalesce(text, '') <> ''")
def _(spark, d):
    return ingest.extract_facts(X.table(spark, d, "conversations")).select("conv_id", "turn", "fact")


@query(
    "curated_split",
    f"""WITH c AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS chunk, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)
        SELECT doc_id, pos, trim(chunk, {STRIP}) AS fact FROM c WHERE trim(chunk, {STRIP}) <> ''""",
)
def _(spark, d):
    rows = X.table(spark, d, "documents").select("doc_id", F.translate("text", "\n", "§").alias("value"))
    return curated.split_facts(rows).select("doc_id", F.col("pos").cast("long").alias("pos"), "fact")


@query("ttl_stamp", f"WITH {X.MEMORIES} SELECT memory_id, created_at, created_at + INTERVAL 30 DAY AS expires_at FROM memories")
def _(spark, d):
    return lifecycle.ttl_stamp(X.memories(spark, d).select("memory_id", "created_at"), 30)


@query("expired_memories", f"WITH {X.MEMORIES} SELECT memory_id, expires_at FROM memories WHERE expires_at <= TIMESTAMP '2024-12-31 05:00:00'")
def _(spark, d):
    return lifecycle.expired(X.memories(spark, d), F.expr("timestamp_ntz'2024-12-31 05:00:00'")).select("memory_id", "expires_at")


@query("purge_preview", f"WITH {X.MEMORIES} SELECT count(*) FILTER (user_id = '{USER}') AS purge_count FROM memories")
def _(spark, d):
    return lifecycle.purge_preview(X.memories(spark, d), F.col("user_id") == USER)


@query("purge_survivors", f"WITH {X.MEMORIES} SELECT memory_id, user_id FROM memories WHERE user_id IS DISTINCT FROM '{USER}'")
def _(spark, d):
    return lifecycle.purge_survivors(X.memories(spark, d), F.col("user_id") == USER).select("memory_id", "user_id")


@query("revision_latest", "SELECT CAST(user_id AS VARCHAR) AS memory_id, 'rev/' || event_id AS revision_name, event_type AS fact, ts AS created_at FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, 'rev/' || event_id DESC) = 1")
def _(spark, d):
    return lifecycle.revision_latest(X.revisions(spark, d))


@query("metadata_null", f"WITH {X.MEMORIES} SELECT count(*) FILTER (metadata IS NULL) AS sql_null, count(*) FILTER (metadata = 'null') AS json_null, count(*) AS total FROM memories")
def _(spark, d):
    return X.memories(spark, d, metadata=True).agg(F.count_if(F.col("metadata").isNull()).alias("sql_null"), F.count_if(F.col("metadata") == "null").alias("json_null"), F.count("*").alias("total"))


@query("mock_hits", "SELECT '[mock] query #' || i AS fact, CAST(round(0.9 - 0.1 * i, 1) AS DOUBLE) AS score FROM range(3) t(i)")
def _(spark, d):
    return search.mock_hits(spark, 8, "query")


@query("rows_as_json", f"WITH {X.MEMORIES} SELECT memory_id, CAST(to_json({{'memory_id': memory_id, 'user_id': user_id, 'source': source}}) AS VARCHAR) AS json FROM memories")
def _(spark, d):
    return X.memories(spark, d).select("memory_id", F.to_json(F.struct("memory_id", "user_id", "source")).alias("json"))


@query("readonly_sql", f"WITH {X.MEMORIES} SELECT user_id, count(*) AS n FROM memories GROUP BY user_id ORDER BY n DESC, user_id LIMIT 50")
def _(spark, d):
    X.memories(spark, d).createOrReplaceTempView("recall_memories")
    return read_only(spark, "SELECT user_id, count(*) AS n FROM recall_memories GROUP BY user_id ORDER BY n DESC, user_id").limit(50)


def _folder(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share; a local session's own where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{named.rstrip('/') if named else 'file://' + tempfile.mkdtemp(prefix='recall-stream-')}/stream-{uuid.uuid4().hex}"


def _streamed(spark: SparkSession, d: str) -> DataFrame:
    out = _folder(spark)
    source = events.read_table(spark, f"{d}/conversations.parquet")
    events.append_events(source, f"{out}/events", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/events")


@query("stream_append", "SELECT conv_id, turn, role, text FROM conversations")
def _(spark, d):
    """Every event once, through the append stream."""
    return _streamed(spark, d).drop("received_at")


@query("stream_session_counts", "SELECT conv_id, count(*) AS event_count FROM conversations GROUP BY conv_id")
def _(spark, d):
    return events.session_counts(_streamed(spark, d))


@query("stream_to_memory", f"WITH {_TURNS} SELECT fact, 'src0' AS user_id FROM facts")
def _(spark, d):
    """Facts of the turns, written to the store by the stage behind the stream.

    The stage pairs turns of one micro-batch, and the turns of a session may lie in any files, so all files are one batch.
    """
    store = _store(spark, "recall_stream_query")
    source = events.read_table(spark, f"{d}/conversations.parquet", files=None)
    events.for_each_batch(source, Bridge(store).session_to_memory, f"{_folder(spark)}/checkpoint").awaitTermination()
    return store.table("memories").select("fact", "user_id")


def _store(spark: SparkSession, database: str) -> Store:
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    store = Store(spark, Settings(database=database, user_id="src0"))
    store.init()
    return store


@query("store_facts", f"WITH {_TURNS} SELECT fact, 'src' || (conv_id % 20) AS user_id, 'agent' AS agent_name, 'null' AS metadata, 'direct' AS source, TIMESTAMP '2025-06-01 12:00:00' AS expires_at FROM facts")
def _(spark, d):
    """Facts that were written to a new store, read back from its table."""
    store = _store(spark, "recall_store_query")
    f = ingest.turn_facts(X.table(spark, d, "conversations"))
    rows = f.select("fact", F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string")).alias("user_id"), F.lit("agent").alias("agent_name"))
    store.remember(rows, F.expr(NOW))
    return store.table("memories").select("fact", "user_id", "agent_name", "metadata", "source", "expires_at")


@query("local_scan", "SELECT CAST(doc_id AS VARCHAR) AS id, text AS content FROM documents ORDER BY doc_id LIMIT 50")
def _(spark, d):
    """The first 50 rows of a SQLite store that is made here, from as many rows."""
    rows = X.table(spark, d, "documents").select("doc_id", "text").orderBy("doc_id").limit(50).collect()
    with tempfile.TemporaryDirectory(prefix="recall-local-") as home:
        with sqlite3.connect(f"{home}/memory.db") as db:
            db.execute("CREATE TABLE memories (id INTEGER, content TEXT)")
            db.executemany("INSERT INTO memories VALUES (?, ?)", map(tuple, rows))
        return spark.createDataFrame(local.read_local(spark, home, 50).collect(), "id string, content string")
