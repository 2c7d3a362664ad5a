"""Names of catalog relations, and reading them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from modelloom.errors import ConfigError

# one name part: "quoted", `quoted` or bare, up to a dot or the end
_PART = re.compile(r'\s*(?:"((?:[^"]|"")+)"|`((?:[^`]|``)+)`|([^.\s"`][^."`]*?))\s*(\.|$)')


@dataclass(frozen=True)
class RelationName:
    """One to three name parts: catalog, schema and table, of which the last is required."""

    parts: tuple[str, ...]

    @classmethod
    def parse(cls, text: str) -> RelationName:
        """Split at dots; those inside quotes belong to the part."""
        parts: list[str] = []
        at, more = 0, True
        while more:
            match = _PART.match(text, at)
            if match is None:
                raise ConfigError(f"not a relation name: {text!r}")
            double, tick, bare, more = match.groups()
            parts.append(bare or (double or "").replace('""', '"') or tick.replace("``", "`"))
            at = match.end()
        if len(parts) > 3:
            raise ConfigError(f"more than three parts in relation name: {text!r}")
        return cls(tuple(parts))

    @property
    def table(self) -> str:
        return self.parts[-1]

    @property
    def schema(self) -> RelationName | None:
        """The name of the schema the relation lies in, if it is given."""
        return RelationName(self.parts[:-1]) if len(self.parts) > 1 else None

    def within_catalog(self) -> RelationName:
        return RelationName(self.parts[-2:])

    def sibling(self, suffix: str) -> RelationName:
        """Another relation next to this one."""
        return RelationName((*self.parts[:-1], self.table + suffix))

    def sql(self, quote: str = "`") -> str:
        """As SQL text, every part in quotes."""
        return ".".join(f"{quote}{part.replace(quote, quote * 2)}{quote}" for part in self.parts)

    def dotted(self) -> str:
        """Without quotes, for messages."""
        return ".".join(self.parts)


def relation_name(name: str | RelationName) -> RelationName:
    return name if isinstance(name, RelationName) else RelationName.parse(name)


def read_relation(spark: SparkSession, name: str | RelationName) -> DataFrame:
    """The whole relation, lazily: later filters and column choices reach the scan."""
    return spark.table(relation_name(name).sql())
