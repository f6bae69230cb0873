"""Settings of the streaming job, read from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

# Setting names, their defaults, and the spellings of a flag.
PRODUCTION_JDBC_URL = "jdbc:mysql://localhost:3306/bigdata_ana"
PRODUCTION_TABLE = "realtime_stats"
DEFAULTS = {
    "KAFKA_TOPIC": "ratings",
    "KAFKA_BOOTSTRAP_SERVERS": "localhost:9092",
    "STREAMING_OUTPUT_PATH": "output/realtime_stats",
    "MYSQL_JDBC_URL": PRODUCTION_JDBC_URL,
    "MYSQL_USER": "root",
    "MYSQL_TABLE": PRODUCTION_TABLE,
}
FLAGS = {"true": True, "1": True, "yes": True, "false": False, "0": False, "no": False}


@dataclass(frozen=True)
class StreamConfig:
    kafka_topic: str
    kafka_servers: str
    checkpoint_path: str | None
    output_path: str
    jdbc_url: str
    jdbc_user: str
    jdbc_password: str
    jdbc_table: str
    jdbc_enabled: bool

    @classmethod
    def from_environment(
        cls, env: Mapping[str, str] | None = None, test_mode_name: str = "STREAMING_TEST_MODE"
    ) -> StreamConfig:
        """Settings with defaults; in test mode the production database is refused.

        An unset checkpoint path is None: the job then keeps its progress beside the output.
        """
        env = os.environ if env is None else env

        def text(name: str) -> str | None:
            return env.get(name, "").strip() or DEFAULTS.get(name)

        jdbc_enabled = _flag(env, "MYSQL_ENABLED", default=True)
        url, table = text("MYSQL_JDBC_URL"), text("MYSQL_TABLE")
        production = url == PRODUCTION_JDBC_URL or table == PRODUCTION_TABLE
        if _flag(env, test_mode_name, default=False) and jdbc_enabled and production:
            raise ValueError(f"{test_mode_name} is on: production MySQL URL or table refused")
        return cls(
            kafka_topic=text("KAFKA_TOPIC"),
            kafka_servers=text("KAFKA_BOOTSTRAP_SERVERS"),
            checkpoint_path=text("STREAMING_CHECKPOINT_PATH"),
            output_path=text("STREAMING_OUTPUT_PATH"),
            jdbc_url=url,
            jdbc_user=text("MYSQL_USER"),
            jdbc_password=env.get("MYSQL_PASSWORD", ""),
            jdbc_table=table,
            jdbc_enabled=jdbc_enabled,
        )


def _flag(env: Mapping[str, str], name: str, default: bool) -> bool:
    if name not in env:
        return default
    spelling = env[name].strip().lower()
    if spelling not in FLAGS:
        raise ValueError(f"{name} takes {', '.join(FLAGS)}; got {spelling!r}")
    return FLAGS[spelling]
