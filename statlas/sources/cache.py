"""Responses kept on disk, and run settings: driver-side helpers of the sources."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from statlas.sources.sinks import atomic_text

ATTEMPTS = 2


def cached_json(path: str, fetch: Callable[[], str], force: bool = False, attempts: int = ATTEMPTS, wait: float = 1.0) -> Any:
    """The JSON kept at path; fetched and kept if there is none, it does not parse, or force. Connection errors are tried again."""
    kept = Path(path)
    if kept.exists() and not force:
        try:
            return json.loads(kept.read_text(encoding="utf-8"))
        except ValueError:
            pass
    for n in range(attempts):
        try:
            text = fetch()
            break
        except OSError:
            if n + 1 == attempts:
                raise
            time.sleep(wait)
    found = json.loads(text)
    atomic_text(path, text)
    return found


@dataclass(frozen=True)
class RunConfig:
    """Where a run reads and writes, and its years."""

    lake: str
    output: str
    target_year: int = 2023
    years: tuple[int, ...] = ()
    countries: tuple[str, ...] = ()
    options: dict[str, Any] = field(default_factory=dict)


def load_config(path: str) -> RunConfig:
    """A run's settings from JSON; unknown keys are an error."""
    raw = json.loads(Path(path).read_text(encoding="utf-8"))
    unknown = set(raw) - set(RunConfig.__dataclass_fields__)
    if unknown:
        raise ValueError(f"unknown settings {sorted(unknown)}")
    return RunConfig(**{k: tuple(v) if k in ("years", "countries") else v for k, v in raw.items()})
