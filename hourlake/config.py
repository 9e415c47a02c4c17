"""Settings from the environment, and logging."""

from __future__ import annotations

import logging
import os
import sys
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from hourlake.functions.projects import DEFAULT_CODES


def csv(text: str) -> list[str]:
    """The parts of a comma-separated text, trimmed, without empty ones."""
    return [p for p in map(str.strip, text.split(",")) if p]


@dataclass(frozen=True)
class Settings:
    env: str
    start_date: date
    end_date: date
    source_projects: tuple[str, ...]
    raw_dir: str
    silver_dir: str
    gold_dir: str
    serving_db: str
    kafka_servers: str
    kafka_topic: str

    @classmethod
    def load(cls, env: Mapping[str, str] = os.environ) -> Settings:
        """HOURLAKE_* variables over defaults; ValueError if the end precedes the start."""
        get = lambda name, default: env.get(f"HOURLAKE_{name}", default)
        start, end = date.fromisoformat(get("START_DATE", "2026-01-01")), date.fromisoformat(get("END_DATE", "2026-01-03"))
        if end < start:
            raise ValueError("the end date precedes the start date")
        codes = tuple(csv(get("SOURCE_PROJECTS", ",".join(DEFAULT_CODES))))
        return cls(
            get("ENV", "local"), start, end, codes, get("RAW_DIR", "data/bronze"), get("SILVER_DIR", "data/silver"), get("GOLD_DIR", "data/gold"),
            get("SERVING_DB", "data/serving.duckdb"), get("KAFKA_SERVERS", "localhost:9092"), get("KAFKA_TOPIC", "pageviews"),
        )


def configure_logging(level: int = logging.INFO) -> None:
    logging.basicConfig(level=level, stream=sys.stdout, format="%(asctime)s %(levelname)s %(name)s %(message)s")
