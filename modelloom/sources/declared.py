"""Outside data a project declares: a catalog relation or files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from modelloom.errors import ConfigError
from modelloom.sources.relation import read_relation, relation_name


@dataclass(frozen=True)
class Source:
    """One table of a source group; give either ``relation`` or ``path``."""

    group: str
    table: str
    relation: str | None = None
    path: str | None = None
    format: str = "parquet"
    schema: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if (self.relation is None) == (self.path is None):
            raise ConfigError(f"source {self.group}.{self.table}: give relation or path, not both")

    def read(self, spark: SparkSession) -> DataFrame:
        if self.relation is not None:
            return read_relation(spark, self.relation)
        reader = spark.read.format(self.format).options(**self.options)
        if self.schema:
            reader = reader.schema(self.schema)
        return reader.load(self.path)

    def sql_name(self) -> str:
        """How SQL text names this source."""
        if self.relation is not None:
            return relation_name(self.relation).sql()
        if self.schema or self.options:
            raise ConfigError(
                f"source {self.group}.{self.table} has reader options; "
                "register it as a relation to use it in SQL"
            )
        path = self.path.replace("`", "``")
        return f"{self.format}.`{path}`"
