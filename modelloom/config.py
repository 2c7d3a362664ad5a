"""Settings of a model: project defaults, overridden per model."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from typing import Any

from modelloom.errors import ConfigError

MATERIALIZATIONS = ("view", "table", "incremental")


@dataclass(frozen=True)
class ModelConfig:
    """What a model may set.

    ``workers`` caps how many tasks of a ``parallel_map`` run at once and is
    meant for outside services with a rate limit. Unset means no cap: the map
    runs in the partitions its input already has, without a shuffle. Tables are
    stored by the columns of ``partition_by``: a list, or names with commas.
    """

    materialized: str = "table"
    workers: int | None = None
    cpus_per_worker: int = 1
    ram_per_worker: int | None = None
    timeout_s: float | None = None
    batch_size: int | None = None
    partition_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.materialized not in MATERIALIZATIONS:
            raise ConfigError(
                f"materialized={self.materialized!r}, expected one of {MATERIALIZATIONS}"
            )
        for name in ("workers", "cpus_per_worker", "ram_per_worker", "timeout_s", "batch_size"):
            value = getattr(self, name)
            if value is not None and value <= 0:
                raise ConfigError(f"{name} must be positive, got {value}")

    def override(self, settings: Mapping[str, Any] | None) -> ModelConfig:
        """These settings on top of the present ones; numbers may come as text."""
        changes = dict(settings or {})
        unknown = changes.keys() - {f.name for f in fields(self)}
        if unknown:
            raise ConfigError(f"unknown settings: {', '.join(sorted(unknown))}")
        for name, value in changes.items():
            if name == "partition_by":
                names = value.split(",") if isinstance(value, str) else value or ()
                changes[name] = tuple(n.strip() for n in names)
                continue
            if value is None or name == "materialized":
                continue
            try:
                changes[name] = float(value) if name == "timeout_s" else int(value)
            except (TypeError, ValueError) as exc:
                raise ConfigError(f"{name}={value!r} is not a number") from exc
        return replace(self, **changes)
