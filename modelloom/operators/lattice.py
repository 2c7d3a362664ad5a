"""Grouping sets from a lattice: each level from the smallest finished one above it, kept up to date by increments.

The rows are aggregated once, by all dimensions. Every other set of dimensions comes from a
finished level with one more, the one with the fewest groups, so the work is that of the groups
and not of the rows times the sets. Counts, sums, minima and maxima add up; a stored lattice takes
new rows by merging in theirs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelloom.errors import ConfigError
from modelloom.shared import Scratch

_MERGED = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def lattice(
    df: DataFrame, dimensions: Sequence[str], measures: Mapping[str, tuple[str, str]], *, scratch: Scratch,
    sets: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """All sets of ``dimensions`` (or those given), with ``grouping`` as SQL's grouping_id.

    ``measures`` maps a name to (function, column): ``count`` (of non-null values, or of rows for
    ``*``), ``sum``, ``min`` or ``max``. A dimension that is not grouped by is null and its bit in
    ``grouping`` is set (the last dimension has bit 0), which tells it from a null value, a group
    like any other. The empty set has one row, also of an empty frame if it is asked for.
    """
    dimensions = list(dimensions)
    wanted = _sets(dimensions, sets)
    lacking = [c for c in dimensions if c not in df.columns]
    if lacking or any(f not in _MERGED for f, _ in measures.values()):
        raise ConfigError(f"there is no column {lacking}" if lacking else f"measures are {sorted(_MERGED)}")
    calls = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    made = [calls[f](F.lit(1) if c == "*" else F.col(f"`{c}`")).alias(name) for name, (f, c) in measures.items()]
    every = frozenset(dimensions)
    finished = {every: scratch.keep(df.groupBy(*dimensions).agg(*made), "level")}
    sizes = {every: finished[every].count()}
    # sets that no asked one comes from need not be built
    for size in range(len(dimensions) - 1, -1, -1):
        for names in map(frozenset, combinations(dimensions, size)):
            if not any(w <= names for w in wanted):
                continue
            above = min((s for s in finished if names < s and len(s) == size + 1), key=lambda s: (sizes[s], sorted(s)))
            merged = [_MERGED[f](name).alias(name) for name, (f, _) in measures.items()]
            merged = [F.coalesce(m, F.lit(0)).alias(n) if measures[n][0] == "count" else m for m, n in zip(merged, measures)]
            finished[names] = scratch.keep(finished[above].groupBy(*[d for d in dimensions if d in names]).agg(*merged), "level")
            sizes[names] = finished[names].count()
    parts = []
    for names in sorted(wanted, key=lambda s: [d not in s for d in dimensions]):
        columns: list[Column] = [
            F.col(f"`{d}`") if d in names else F.lit(None).cast(df.schema[d].dataType).alias(d) for d in dimensions
        ]
        number = sum(1 << i for i, d in enumerate(reversed(dimensions)) if d not in names)
        parts.append(finished[names].select(*columns, F.lit(number).cast("bigint").alias("grouping"), *measures))
    return reduce(DataFrame.unionAll, parts)


def merge_lattice(
    stored: DataFrame, more: DataFrame, dimensions: Sequence[str], measures: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """The lattice of all rows, from that of the rows so far and that of new ones; no row is read again."""
    keys = [*dimensions, "grouping"]
    return stored.unionByName(more).groupBy(*keys).agg(*[_MERGED[f](name).alias(name) for name, (f, _) in measures.items()])


def _sets(dimensions: list[str], sets: Sequence[Sequence[str]] | None) -> set[frozenset]:
    if sets is None:
        return {frozenset(c) for n in range(len(dimensions) + 1) for c in combinations(dimensions, n)}
    unknown = {d for s in sets for d in s} - set(dimensions)
    if unknown:
        raise ConfigError(f"sets of {sorted(unknown)}, which are no dimensions")
    return {frozenset(s) for s in sets}
