"""Retrieval and writing over all legs; a leg that fails is reported and stops no other."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import ingest, retrieve, search, views
from .sources import local
from .store import Store


def errors(result: dict) -> dict[str, str]:
    """The legs of a result that failed."""
    return {k: v for k, v in result.items() if k.endswith("_error")}


class Bridge:
    """One user's reads and writes over a ``Store``.

    ``embed`` makes the vector of a query (without it, and without the name of an engine, the bank answers with placeholder
    rows), ``extractor`` the facts of texts (without it nothing is extracted).
    """

    def __init__(self, store: Store, embed: Callable[[str], list[float]] | None = None, extractor: ingest.Extractor | None = None):
        self.store, self.embed, self.extractor = store, embed, extractor
        self.settings, self.spark = store.settings, store.spark

    def scope(self, user_id: str | None = None, agent_name: str | None = None) -> dict[str, str]:
        return {"user_id": user_id or self.settings.user_id, "agent_name": agent_name or self.settings.agent_name}

    def _legs(self, query: str, k: int, scope: dict[str, str], failed: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
        def leg(name: str, make: Callable[[], DataFrame]) -> DataFrame:
            try:
                out = make()
                out.schema  # noqa: B018
                return out
            except Exception as e:
                failed[f"{name}_error"] = str(e).splitlines()[0]
                return self.spark.createDataFrame([], "origin string, src_rank long, rn long, fact string")

        def bank() -> DataFrame:
            if self.embed is None:
                if self.settings.engine_name:
                    raise ValueError("no function for the vector of a query")
                return retrieve.leg(search.mock_hits(self.spark, k, query), "bank", 0, F.desc("score"), top_k=k)
            found = search.bank_retrieve(self.store.memories(), scope, self.embed(query), k)
            return retrieve.leg(found, "bank", 0, F.col("distance"), F.col("memory_name"), top_k=k)

        recent = lambda: retrieve.leg(views.recent_for_user(self.store.memories(), scope["user_id"], k), "warehouse", 1, F.desc("created_at"), F.col("memory_id"), top_k=k)
        near = lambda: retrieve.leg(local.facts_of(local.read_local(self.spark, self.settings.home, k)), "local", 2, F.col("at"), top_k=k)
        return leg("bank", bank), leg("warehouse", recent), leg("local", near)

    def retrieve(self, query: str, top_k: int | None = None, failed: dict | None = None, **scope: str) -> DataFrame:
        """Merged hits (rank, origin, fact) of the semantic, the recent and the local source."""
        k = top_k or self.settings.top_k
        return retrieve.merge(*self._legs(query, k, self.scope(**scope), {} if failed is None else failed), k)

    def retrieve_context(self, query: str, top_k: int | None = None, **scope: str) -> dict:
        """Hits of each leg, the merged ones, and the text for a prompt; failed legs under ``<leg>_error``."""
        k, failed = top_k or self.settings.top_k, {}
        legs = self._legs(query, k, self.scope(**scope), failed)
        few = [[r["fact"] for r in leg.orderBy("rn").collect()] for leg in legs]  # top_k rows each
        merged = [r.asDict() for r in retrieve.merge(*legs, k).orderBy("rank").collect()]
        text = "\n".join(f"- {r['fact']}" for r in merged if r["fact"])
        return {"query": query, "scope": self.scope(**scope), "bank_hits": few[0], "warehouse_hits": few[1], "local_hits": few[2], "merged": merged, "prompt_context": text, **failed}

    def explicit_remember(self, fact: str, metadata: dict | None = None, **scope: str) -> dict:
        """Write a fact: what is extracted from it, if there is an extractor, and the fact itself; errors by leg."""
        own = self.scope(**scope)
        out: dict = {"scope": own, "fact": fact}
        row = self.spark.createDataFrame([(fact, own["user_id"], own["agent_name"], json.dumps(metadata) if metadata else None)], "fact string, user_id string, agent_name string, metadata string")
        if self.extractor is not None:
            self._write(out, "bank", lambda: self.generate(row.select(F.col("fact").alias("text")), own))
        self._write(out, "warehouse", lambda: self.store.remember(row).count())
        return out

    def sync_session(self, session_name: str, events: list[dict], **scope: str) -> dict:
        """Write a session, then the facts that are extracted from its events; errors by leg."""
        own = self.scope(**scope)
        out: dict = {"session_name": session_name, "user_id": own["user_id"]}
        rows = [(session_name, own["user_id"], i, e.get("role"), e.get("text")) for i, e in enumerate(events)]
        turns = self.spark.createDataFrame(rows, "session_name string, user_id string, turn long, role string, text string")
        self._write(out, "session", lambda: self.store.sync_sessions(turns.withColumn("created_at", F.localtimestamp())).count())
        if self.extractor is not None:
            self._write(out, "bank", lambda: self.generate(turns.select("text"), own))
        return out

    def generate(self, texts: DataFrame, scope: dict[str, str]) -> int:
        """Write the facts extracted from ``texts`` (text) under a scope; how many."""
        facts = ingest.extract_facts(texts, self.extractor or ingest.identity_extractor)
        return self.store.remember(facts.select("fact", *(F.lit(scope[c]).alias(c) for c in ("user_id", "agent_name")))).count()

    @staticmethod
    def _write(out: dict, leg: str, write: Callable[[], int]) -> None:
        try:
            out[leg] = write()
        except Exception as e:
            out[f"{leg}_error"] = str(e).splitlines()[0]

    def session_to_memory(self, batch: DataFrame, number: int) -> None:
        """A stage for ``streaming.for_each_batch``: facts of the turns of each micro-batch (conv_id, turn, role, text)."""
        facts = ingest.turn_facts(batch)
        own = self.scope()
        self.store.remember(facts.select("fact", F.lit(own["user_id"]).alias("user_id"), F.lit(own["agent_name"]).alias("agent_name"), F.to_json(F.struct(F.lit(number).alias("batch"))).alias("metadata")))
