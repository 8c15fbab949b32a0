"""Engine settings: explicit value, then environment, then default; empty values fall through."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    warehouse: str = "recall_warehouse"
    database: str = "recall"
    agent_name: str = "agent"
    user_id: str = "default"
    home: str = "~/.recall"
    ttl_days: int = 365
    top_k: int = 8
    recent_limit: int = 20
    batch_chars: int = 6000
    min_chars: int = 200
    seed_limit: int = 1000
    include_expired: bool = True
    prefetch_seconds: float = 8.0
    heading: str = "## Memory"
    vaults: str = "~/Notes,~/Documents/Notes"
    project: str = "local"
    location: str = "us-central1"
    engine_id: str = ""
    generation_model: str = "identity"
    embedding_model: str = "none"

    @property
    def note_roots(self) -> list[str]:
        """Folders of notes that are read when none are named."""
        return [x.strip() for x in self.vaults.split(",") if x.strip()]

    # Formats of resource names.
    @property
    def generation_model_path(self) -> str:
        return f"projects/{self.project}/locations/{self.location}/publishers/google/models/{self.generation_model}"

    @property
    def embedding_model_path(self) -> str:
        return f"projects/{self.project}/locations/{self.location}/publishers/google/models/{self.embedding_model}"

    @property
    def engine_name(self) -> str | None:
        return f"projects/{self.project}/locations/{self.location}/reasoningEngines/{self.engine_id}" if self.engine_id else None

    @property
    def revision_ttl_seconds(self) -> int:
        return self.ttl_days * 86400


def load(**given: object) -> Settings:
    """Settings from keyword arguments, then ``RECALL_<NAME>`` variables, then defaults."""
    out: dict[str, object] = {}
    for f in fields(Settings):
        value = given.get(f.name) or os.environ.get(f"RECALL_{f.name.upper()}")
        if value:
            kind = type(f.default)
            out[f.name] = str(value).lower() in ("1", "true", "yes") if kind is bool else kind(value)
    return Settings(**out)
