"""Merging two frames on key columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelloom.errors import ConfigError


def merge(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    *,
    null_safe: bool = False,
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Inner equi-join with one copy of each key column in the result.

    Null keys match nothing, as in SQL; with ``null_safe`` they match each
    other, as in a frame library: then all null-key rows of both sides meet.
    Other columns of the same name get the suffixes. The strategy (broadcast,
    sort-merge, skew splitting) is left to the optimizer.
    """
    keys = [on] if isinstance(on, str) else list(on)
    for side, df in (("left", left), ("right", right)):
        missing = [k for k in keys if k not in df.columns]
        if missing:
            raise ConfigError(f"{side} side has no column {', '.join(missing)}")
    both = (set(left.columns) & set(right.columns)) - set(keys)

    a, b = left.alias("l"), right.alias("r")

    def equal(k: str):
        lk, rk = F.col(f"l.`{k}`"), F.col(f"r.`{k}`")
        return lk.eqNullSafe(rk) if null_safe else lk == rk

    def out(side: str, c: str, suffix: str):
        return F.col(f"{side}.`{c}`").alias(c + suffix if c in both else c)

    return a.join(b, reduce(and_, map(equal, keys))).select(
        *[out("l", c, suffixes[0]) for c in left.columns],
        *[out("r", c, suffixes[1]) for c in right.columns if c not in keys],
    )
