"""Exact distinct aggregates that a hot group cannot stall."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelloom.errors import ConfigError


def distinct_aggregates(
    df: DataFrame, by: str | Sequence[str], measures: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Per group, ``count`` or ``sum`` of the distinct non-null values of columns.

    ``measures`` maps a name to (function, column). In a first phase rows are dealt by group *and*
    value, so the values of a group that holds a third of all rows are spread over all tasks and
    each is left once; the second counts them with map-side combine. Several columns share both
    phases. A null key is a group; without values a count is 0 and a sum null.
    """
    by = [by] if isinstance(by, str) else list(by)
    if not measures or any(f not in ("count", "sum") for f, _ in measures.values()):
        raise ConfigError("measures are count or sum of a column")
    columns = sorted({c for _, c in measures.values()})
    kinds = {c: df.schema[c].dataType for c in columns}
    slot = {c: f"_v{i}" for i, c in enumerate(columns)}

    def one(c: str):
        value = F.col(f"`{c}`")
        if kinds[c].simpleString() in ("double", "float"):
            value = value + F.lit(0).cast(kinds[c])  # -0.0 and 0.0 are one value
        fields = [(value if o == c else F.lit(None).cast(kinds[o])).alias(slot[o]) for o in columns]
        return F.struct(F.lit(columns.index(c)).alias("_which"), *fields)

    apart = df.select(*[F.col(f"`{c}`") for c in by], F.explode(F.array(*map(one, columns))).alias("_one")).select(*by, "_one.*")
    values = apart.groupBy(*by, "_which", *slot.values()).agg(F.lit(1).alias("_once"))  # each value of a group once
    made = []
    for name, (function, c) in measures.items():
        mine = F.when(F.col("_which") == columns.index(c), F.col(slot[c]))
        made.append((F.count(mine) if function == "count" else F.sum(mine)).alias(name))
    return values.groupBy(*by).agg(*made)
