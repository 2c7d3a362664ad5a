"""Exact difference of two tables as multisets of rows, reading closely only where they differ.

Keys are dealt to ranges of their hash. A scan of each side gives a count and sums of row hashes
per range, combined map-side, so next to nothing is shuffled. Ranges that differ are cut into
finer ones and compared again, and only rows of fine ranges that differ are shuffled and compared
row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelloom.errors import ConfigError, ResultError
from modelloom.functions import free_name
from modelloom.shared import Scratch

#: Ranges of the top level, and finer ranges in each.
TOP, FINER = 1024, 64
_NUMBERS = ("n", "h0", "h1", "h2", "h3")


def table_difference(
    old: DataFrame, new: DataFrame, key: str | Sequence[str], *, scratch: Scratch, top: int = TOP, finer: int = FINER,
) -> DataFrame:
    """Rows that one side has more often than the other: their columns, ``change`` and ``copies``.

    ``change`` is ``removed`` (``copies`` more in ``old``) or ``added``; a row that changed is
    removed and added. Nulls are equal, columns are matched by name. Two ranges are taken for
    equal if their counts and 128 bits of hash sums agree. If half of the top ranges differ they
    are not cut further. Reads a table of ``scratch``, which holds the numbers of the ranges
    that differ, ``top * finer`` at most; only those are broadcast.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if set(old.columns) != set(new.columns):
        raise ResultError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    if any(k not in old.columns for k in keys) or {"change", "copies"} & set(old.columns):
        raise ConfigError("the key must be columns of both, and change and copies must not be columns")
    columns, slot = old.columns, free_name(old, "_range")
    place = F.xxhash64(*[F.col(f"`{k}`") for k in keys])

    def dealt(df: DataFrame, ranges: int) -> DataFrame:
        return df.select(*columns).withColumn(slot, F.pmod(place, F.lit(ranges).cast("bigint")))

    differ = scratch.keep(_unequal(dealt(old, top), dealt(new, top), slot, columns), "ranges")
    sides, found = [dealt(df, top) for df in (old, new)], differ.count()
    if finer > 1 and found <= top // 2:
        # x % top is known from x % (top * finer), so the fine ranges lie within the top ones
        above = F.broadcast(differ.withColumnRenamed(slot, "_top"))
        sides = [dealt(df, top * finer) for df in (old, new)]
        within = [df.join(above, F.pmod(F.col(slot), F.lit(top).cast("bigint")) == F.col("_top"), "left_semi") for df in sides]
        differ = scratch.keep(_unequal(*within, slot, columns), "ranges")
    few = F.broadcast(differ)
    counted = [df.join(few, slot, "left_semi").select(*columns, F.lit(sign).alias(slot)) for df, sign in zip(sides, (-1, 1))]
    both = counted[0].unionAll(counted[1]).groupBy(*columns).agg(F.sum(slot).cast("bigint").alias(slot)).where(F.col(slot) != 0)
    return both.select(
        *columns, F.when(F.col(slot) > 0, "added").otherwise("removed").alias("change"), F.abs(slot).alias("copies")
    )


def _unequal(old: DataFrame, new: DataFrame, slot: str, columns: Sequence[str]) -> DataFrame:
    """The ranges whose counts or hash sums differ."""
    def digest(df: DataFrame, sign: int) -> DataFrame:
        fields = [F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in columns]
        hashes = [F.xxhash64(F.lit(seed), *fields) for seed in (0, 1)]
        halves = [h for x in hashes for h in (x.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(x, 32))]
        sums: list[Column] = [F.count("*"), *map(F.sum, halves)]
        return df.groupBy(slot).agg(*[(sign * s).alias(n) for s, n in zip(sums, _NUMBERS)])

    both = digest(old, 1).unionAll(digest(new, -1)).groupBy(slot).agg(*[F.sum(n).alias(n) for n in _NUMBERS])
    return both.where(" or ".join(f"{n} <> 0" for n in _NUMBERS)).select(slot)


def multiset_intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows both have, each as often as the one that has it less often; with ``copies`` instead of repeated rows.

    Copies are counted per side before the rows meet, so a row that fills a third of a table is one.
    """
    if set(left.columns) != set(right.columns) or "copies" in left.columns:
        raise ResultError("both sides need the same columns, none of them copies")
    a, b = free_name(left, "_a"), free_name(left, "_b")
    one, other = left.withColumns({a: F.lit(1), b: F.lit(0)}), right.select(*left.columns).withColumns({a: F.lit(0), b: F.lit(1)})
    both = one.unionAll(other).groupBy(*left.columns).agg(F.sum(a).alias(a), F.sum(b).alias(b))
    return both.where((F.col(a) > 0) & (F.col(b) > 0)).select(*left.columns, F.least(a, b).alias("copies"))
