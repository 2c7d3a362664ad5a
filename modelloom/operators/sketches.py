"""Approximate aggregates that add up: sketches stored per group, merged for any set of groups without the rows.

Distinct counts are HyperLogLog sketches, quantiles KLL sketches and frequent values top-k
accumulators, all built in the JVM with map-side combine; a sketch is a few kilobytes whatever the
rows behind it, so a hot group costs no task more than another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelloom.errors import ConfigError

#: Relative standard error of a distinct count (2 ** 12 registers), and rank error of a quantile, at about 99 %.
DISTINCT_ERROR, RANK_ERROR = 1.04 / 64, 0.0133
#: Values an accumulator of frequent values keeps track of: one of share 1 / 10,000 or more is never lost.
TRACKED = 10_000


def sketch(
    df: DataFrame, by: str | Sequence[str], *, distinct: Sequence[str] = (), quantiles: Sequence[str] = (), frequent: Sequence[str] = (),
) -> DataFrame:
    """One row per group: its keys, ``rows`` and a sketch per named column, to be stored and merged later.

    The columns are ``distinct_x``, ``quantiles_x`` (numbers, as double) and ``frequent_x``. Nulls
    enter no sketch; of a group with nulls only, sketches are empty or null. A null key is a
    group. Repeated rows count each time, in ``rows``, quantiles and frequencies.
    """
    by = [by] if isinstance(by, str) else list(by)
    made = [F.count("*").alias("rows")]
    made += [F.hll_sketch_agg(_hashable(df, c), 12).alias(f"distinct_{c}") for c in distinct]
    made += [F.kll_sketch_agg_double(F.col(f"`{c}`").cast("double"), 200).alias(f"quantiles_{c}") for c in quantiles]
    made += [F.expr(f"approx_top_k_accumulate(`{c}`, {TRACKED})").alias(f"frequent_{c}") for c in frequent]
    return df.groupBy(*by).agg(*made)


def merge_sketches(stored: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups, from stored ones: the same columns, one row per value of ``by``."""
    by = [by] if isinstance(by, str) else list(by)
    made: list[Column] = []
    for c in stored.columns:
        if c == "rows":
            made.append(F.sum("rows").alias("rows"))
        elif c.startswith("distinct_"):
            made.append(F.hll_union_agg(F.col(f"`{c}`")).alias(c))
        elif c.startswith("quantiles_"):
            made.append(F.kll_merge_agg_double(F.col(f"`{c}`")).alias(c))
        elif c.startswith("frequent_"):
            made.append(F.expr(f"approx_top_k_combine(`{c}`, {TRACKED})").alias(c))
    if not made:
        raise ConfigError("these are no stored sketches")
    return stored.groupBy(*by).agg(*made)


def distinct_estimate(column: str) -> Column:
    """About how many values, from a sketch ``distinct_x``; the relative error is ``DISTINCT_ERROR`` (one sigma)."""
    return F.hll_sketch_estimate(F.col(f"`distinct_{column}`"))


def quantile_estimate(column: str, fraction: float) -> Column:
    """A value whose rank is within ``RANK_ERROR`` of the fraction, from a sketch ``quantiles_x``."""
    return F.kll_sketch_get_quantile_double(F.col(f"`quantiles_{column}`"), F.lit(float(fraction)))


def frequent_estimate(column: str, k: int) -> Column:
    """The ``k`` most frequent values as structs (item, count), from ``frequent_x``; exact below ``TRACKED`` values."""
    return F.expr(f"approx_top_k_estimate(`frequent_{column}`, {int(k)})")


def _hashable(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType.simpleString()
    return F.col(f"`{c}`") if kind in ("int", "bigint", "string", "binary") else F.col(f"`{c}`").cast("string")
