"""Hooks for an agent host: prefetch before a turn, write after it."""

from __future__ import annotations

import json
import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame

from .bridge import Bridge
from .operators import ingest
from .store import Store

WRITING = (None, "", "primary")


class MemoryProvider:
    """Memory of one user over a ``Store``; a source that fails gives no rows and no error.

    With ``background`` writes return at once and run in threads that ``shutdown`` waits for.
    """

    name = "recall"

    def __init__(
        self, store: Store, embed: Callable[[str], list[float]] | None = None, trivial: Callable[[str], bool] | None = None, context: str | None = None, background: bool = False
    ):
        self.store, self.trivial, self.context, self.background = store, trivial or (lambda _: False), context, background
        self.settings, self.spark = store.settings, store.spark
        self.bridge = Bridge(store, embed)
        self.recalled = 0
        self.failed: dict[str, str] = {}
        self._pending: list[threading.Thread] = []

    def is_available(self) -> bool:
        """Whether the tables can be read; tables that are not there are made once."""
        if self.unavailable_reason() is not None:
            try:
                self.store.init()
            except Exception:
                return False
        return self.unavailable_reason() is None

    def unavailable_reason(self) -> str | None:
        try:
            self.store.table("memories").schema  # noqa: B018
        except Exception as e:
            return str(e).splitlines()[0]
        return None

    def initialize(self) -> None:
        self.store.init()

    def system_prompt_block(self) -> str:
        return f"{self.settings.heading}\nFacts remembered about the user are listed before each turn."

    def get_tool_schemas(self) -> list:
        return []

    def queue_prefetch(self, query: str) -> None:
        """Nothing is fetched ahead."""

    def retrieve(self, query: str, top_k: int | None = None) -> DataFrame:
        """Merged hits (rank, origin, fact) of the semantic, the recent and the local source."""
        self.failed = {}
        return self.bridge.retrieve(query, top_k, self.failed)

    def prefetch(self, query: str) -> str:
        """A heading and a bullet for each fact; empty if there is none, the prompt is trivial, or time runs out."""
        self.recalled = 0
        if self.trivial(query):
            return ""
        tag = f"recall-prefetch-{id(self)}"
        found: list = []

        def work() -> None:
            self.spark.addTag(tag)
            found.extend(self.retrieve(query).orderBy("rank").collect())

        thread = threading.Thread(target=work, daemon=True)
        thread.start()
        thread.join(self.settings.prefetch_seconds)
        if thread.is_alive():
            self.spark.interruptTag(tag)
            return ""
        self.recalled = len(found)
        lines = [f"- {r['fact']}" for r in found if r["fact"]]
        return "\n".join([self.settings.heading, *lines]) if lines else ""

    def recall_status(self) -> str:
        return f"{self.recalled} memories recalled"

    def _run(self, work: Callable[[], int]) -> int:
        """Facts written, or 0 if they are written in the background."""
        if not self.background:
            return work()

        def quiet() -> None:
            try:
                work()
            except Exception as e:
                self.failed["write_error"] = str(e).splitlines()[0]

        thread = threading.Thread(target=quiet, daemon=True)
        thread.start()
        self._pending = [t for t in self._pending if t.is_alive()] + [thread]
        return 0

    def sync_turn(self, user: str, assistant: str) -> int:
        """Remember a turn, unless the user said almost nothing or the context may not write; facts written."""
        if self.context not in WRITING:
            return 0

        def work() -> int:
            rows = self.spark.createDataFrame([(0, 0, "user", user), (0, 1, "assistant", assistant)], "conv_id long, turn long, role string, text string")
            return self.remember([r["fact"] for r in ingest.turn_facts(rows).select("fact").collect()])

        return self._run(work)

    def on_memory_write(self, action: str, target: str, content: str) -> int:
        if self.context not in WRITING:
            return 0

        def work() -> int:
            rows = self.spark.createDataFrame([(0, action, target, content)], "write_id long, action string, target string, content string")
            return self.remember([r["fact"] for r in ingest.memory_write_facts(rows).collect()])

        return self._run(work)

    def remember(self, facts: list[str], metadata: str | None = None) -> int:
        if facts:
            rows = [(f, self.settings.user_id, self.settings.agent_name, metadata) for f in facts]
            self.store.remember(self.spark.createDataFrame(rows, "fact string, user_id string, agent_name string, metadata string"))
        return len(facts)

    def shutdown(self, seconds: float = 10.0) -> None:
        """Wait for each write in the background, up to ``seconds`` for one."""
        pending, self._pending = self._pending, []
        for thread in pending:
            thread.join(seconds)

    def get_config_schema(self) -> list[dict[str, str]]:
        """What a host may ask its user for."""
        s = self.settings
        return [
            {"key": "user_id", "description": "user of the scope", "default": s.user_id},
            {"key": "agent_name", "description": "agent of the scope", "default": s.agent_name},
            {"key": "top_k", "description": "facts to retrieve for a turn", "default": str(s.top_k)},
            {"key": "prefetch_seconds", "description": "longest wait for retrieval before a turn", "default": f"{s.prefetch_seconds:g}"},
        ]

    def save_config(self, values: dict[str, object], home: str) -> bool:
        """Put ``values`` under this provider's name into ``memory.json`` of the host's home; other entries stay."""
        path = os.path.join(os.path.expanduser(home), "memory.json")
        try:
            have = {}
            if os.path.exists(path):
                with open(path, encoding="utf-8") as f:
                    have = json.load(f)
            with open(path, "w", encoding="utf-8") as f:
                json.dump(have | {self.name: values}, f, indent=2)
        except (OSError, ValueError):
            return False
        return True


def register(host, provider: MemoryProvider) -> None:
    """Hand a provider to a host that takes one."""
    host.register_memory_provider(provider)
