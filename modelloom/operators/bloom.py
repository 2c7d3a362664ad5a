"""Semi and anti joins with a Bloom filter in front of the large side's shuffle.

The filter is a table: a block number and 64 bits. Built from the keys of the small side by an
aggregation, its size is known before it is broadcast, and it is applied as an equi-join on the
block with a test of the bits, so it stays in the JVM. What passes is joined exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelloom.errors import ConfigError
from modelloom.functions import free_name
from modelloom.shared import Scratch

#: Keys to a block of 64 bits, and bits set for each: about one foreign key in 30 passes.
KEYS_PER_BLOCK, PROBES = 8, 4


def semi_join(
    large: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    *,
    scratch: Scratch,
    anti: bool = False,
    most_blocks: int = 1 << 20,
    least_dropped: float = 0.3,
    sample: int = 20_000,
) -> DataFrame:
    """The rows of ``large`` that have (``anti``: have no) match in ``small`` on the columns ``on``.

    The small side's distinct keys are written and counted first. The filter is left out where it
    would have more than ``most_blocks`` blocks (16 bytes each, so the broadcast is bounded), or
    where it would drop less than ``least_dropped`` of ``sample`` rows of ``large``; the result is
    the same. Null keys match nothing; repeated rows of ``large`` stay. Reads tables of ``scratch``.
    """
    on = [on] if isinstance(on, str) else list(on)
    missing = [c for c in on if c not in large.columns or c not in small.columns]
    if not on or missing:
        raise ConfigError(f"both sides need the columns {missing or 'to join on'}")
    present = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in on])
    keys = scratch.keep(small.select(*on).where(present).distinct(), "keys")
    for c in on:
        if large.schema[c].dataType != keys.schema[c].dataType:
            raise ConfigError(f"column {c} has two types")
    how = "left_anti" if anti else "left_semi"
    bloom = bloom_filter(keys, on, scratch, most_blocks)
    if bloom is None or not _pays(large, bloom, on, least_dropped, sample):
        return large.join(keys, on, how).select(*large.columns)
    passing = _passing(large, bloom, on).select(*large.columns)
    if not anti:
        return passing.join(keys, on, "left_semi").select(*large.columns)
    sure = large.where(~present).unionAll(_passing(large.where(present), bloom, on, "left_anti").select(*large.columns))
    return sure.unionAll(passing.join(keys, on, "left_anti").select(*large.columns))


def bloom_filter(keys: DataFrame, on: Sequence[str], scratch: Scratch, most_blocks: int) -> DataFrame | None:
    """(block, bits, blocks) of distinct keys; None where it would have more than ``most_blocks`` blocks."""
    blocks = max(1, -(-keys.count() // KEYS_PER_BLOCK))
    if blocks > most_blocks:
        return None
    marked = keys.select(_block(on, F.lit(blocks)).alias("block"), _bits(on).alias("bits"))
    filled = marked.groupBy("block").agg(F.bit_or("bits").alias("bits"))
    return scratch.keep(filled.withColumn("blocks", F.lit(blocks).cast("bigint")), "bloom")


def _block(on: Sequence[str], blocks: Column) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in on]), blocks.cast("bigint"))


def _bits(on: Sequence[str]) -> Column:
    other = F.xxhash64(F.lit(7), *[F.col(f"`{c}`") for c in on])
    places = [F.shiftrightunsigned(other, 6 * i).bitwiseAND(63).cast("int") for i in range(PROBES)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in places])


def _passing(large: DataFrame, bloom: DataFrame, on: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose key the filter holds (``left_anti``: does not hold)."""
    blocks = bloom.first()
    if blocks is None:  # no key at all
        return large.limit(0) if how == "left_semi" else large
    block, bits, at, mask = (free_name(large, n) for n in ("_block", "_bits", "_at", "_mask"))
    probed = large.withColumns({block: _block(on, F.lit(blocks["blocks"])), bits: _bits(on)})
    held = F.broadcast(bloom.select(F.col("block").alias(at), F.col("bits").alias(mask)))
    return probed.join(held, (F.col(block) == F.col(at)) & (F.col(bits).bitwiseAND(F.col(mask)) == F.col(bits)), how)


def _pays(large: DataFrame, bloom: DataFrame, on: Sequence[str], least_dropped: float, sample: int) -> bool:
    """Whether enough of the first rows at hand are dropped; only the plan depends on it."""
    some = large.select(*on).limit(sample)
    n = some.count()
    return n == 0 or _passing(some, bloom, on).count() <= (1 - least_dropped) * n
