"""Spreading the inner work of heavy rows over many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelloom.functions import free_name
from modelloom.shared import task_count

# fixed values of the low-discrepancy points
STEP_X, STEP_Y = 0.7548776662466927, 0.5698402909980532
SEED_X, SEED_Y = 0.6180339887498949, 0.4142135623730951


def fan_out(
    df: DataFrame,
    key: str,
    n: str,
    *,
    into: str = "k",
    chunk: int = 100_000,
    workers: int | None = None,
) -> DataFrame:
    """One row per step ``1..n`` of every input row.

    Each row is first cut into chunks, which are shuffled by (key, chunk), and
    only then expanded: a row with a huge ``n`` is shared by many tasks and no
    array is longer than a chunk. A row without steps stays, with a null step.
    """
    steps, start = F.col(n).cast("bigint"), free_name(df, "_start")
    starts = F.when(
        steps > 0, F.sequence(F.lit(1).cast("bigint"), steps, F.lit(chunk).cast("bigint"))
    )
    last = F.least(F.col(start) + F.lit(chunk - 1), steps)
    return (
        df.withColumn(start, F.explode_outer(starts))
        .repartition(workers or task_count(df.sparkSession), key, start)
        .withColumn(
            into, F.explode_outer(F.when(F.col(start).isNotNull(), F.sequence(start, last)))
        )
        .drop(start)
    )


def _fraction(x: Column) -> Column:
    return x - F.floor(x)


def monte_carlo_pi(
    df: DataFrame, key: str, n: str, *, chunk: int = 100_000, workers: int | None = None
) -> DataFrame:
    """Estimate pi for every row from ``n`` evenly spread points of its own.

    All columns stay, and rows that repeat a key are computed each for itself.
    """
    uid, row = free_name(df, "_uid"), free_name(df, "_row")
    k, seed = F.col("k").cast("double"), F.col(key).cast("double")
    x = _fraction(seed * SEED_X + k * STEP_X)
    y = _fraction(seed * SEED_Y + k * STEP_Y)
    rows = df.select(
        F.monotonically_increasing_id().alias(uid), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(row), key, n
    )
    points = fan_out(rows, uid, n, into="k", chunk=chunk, workers=workers)
    tried = F.greatest(F.coalesce(F.max(n), F.lit(1)), F.lit(1))
    kept = [c for c in df.columns if c not in ("pi_estimate", "error")]
    return (
        points.groupBy(uid)
        .agg(F.any_value(row).alias(row), (4.0 * F.count_if(x * x + y * y <= 1.0) / tried).alias("pi_estimate"))
        .select(
            *[F.col(row).getField(c).alias(c) for c in kept], "pi_estimate", F.lit(None).cast("string").alias("error")
        )
    )
