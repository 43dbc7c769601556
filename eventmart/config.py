"""Table names and storage locations.

Every path is derived from one state directory so schema store, stream
checkpoints and scratch tables can never drift apart.  Values come from the
constructor or from ``EVENTMART_*`` environment variables; an unset or empty
variable keeps the default.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

ENV_PREFIX = "EVENTMART_"


def _env(name: str, default: str) -> str:
    value = os.environ.get(ENV_PREFIX + name)
    return default if value is None or value == "" else value


@dataclass(frozen=True)
class MartConfig:
    # Catalog of all tables; empty means the session's current one.
    catalog: str = ""
    bronze_db: str = "bronze"
    silver_db: str = "silver"
    gold_db: str = "gold"
    bronze_table: str = "raw_events"
    silver_table: str = "events"
    raw_events_path: str = ""
    # Shared (cluster-visible) folder for schema store and stream checkpoints.
    # Empty means: use the session's spark.checkpoint.dir (see session.state_root).
    state_dir: str = ""

    def namespace(self, db: str) -> str:
        return f"{self.catalog}.{db}" if self.catalog else db

    @property
    def bronze_fqn(self) -> str:
        return f"{self.namespace(self.bronze_db)}.{self.bronze_table}"

    @property
    def silver_fqn(self) -> str:
        return f"{self.namespace(self.silver_db)}.{self.silver_table}"

    @property
    def quarantine_fqn(self) -> str:
        return f"{self.namespace(self.bronze_db)}.quarantine"

    @property
    def lag_fqn(self) -> str:
        return f"{self.namespace(self.bronze_db)}.ingest_lag"

    def gold_fqn(self, name: str) -> str:
        return f"{self.namespace(self.gold_db)}.{name}"

    def schema_store_path(self, state_dir: str) -> str:
        return f"{state_dir.rstrip('/')}/schemas/{self.bronze_table}"

    def checkpoint_path(self, state_dir: str) -> str:
        return f"{state_dir.rstrip('/')}/checkpoints/{self.bronze_table}"

    @classmethod
    def from_env(cls) -> "MartConfig":
        d = cls()
        return cls(
            catalog=_env("CATALOG", d.catalog),
            bronze_db=_env("BRONZE_DB", d.bronze_db),
            silver_db=_env("SILVER_DB", d.silver_db),
            gold_db=_env("GOLD_DB", d.gold_db),
            bronze_table=_env("BRONZE_TABLE", d.bronze_table),
            silver_table=_env("SILVER_TABLE", d.silver_table),
            raw_events_path=_env("RAW_EVENTS_PATH", d.raw_events_path),
            state_dir=_env("STATE_DIR", d.state_dir),
        )
