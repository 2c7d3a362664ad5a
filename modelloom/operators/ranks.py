"""Positions, ranks, quantiles and top rows in a global order, without a one-task window.

Rows are dealt to tasks by ranges of the order, sorted there and written; each task numbers its
own rows. What the tasks before hold of a group is a sum over one small row per task and group,
so a group that fills the whole table is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from modelloom.errors import ConfigError
from modelloom.functions import free_name
from modelloom.shared import Scratch, task_count

RANKS = ("position", "rank", "dense_rank")


def add_ranks(
    df: DataFrame,
    order: str | Sequence[str],
    *,
    scratch: Scratch,
    by: str | Sequence[str] = (),
    names: Sequence[str] = RANKS,
    tasks: int | None = None,
) -> DataFrame:
    """Add the position (from 1), rank and dense rank of each row in its group.

    ``order`` holds column names, each perhaps followed by ``desc``; nulls are smallest. Rows
    equal in ``order`` are ties: they share rank and dense rank, and their positions are dealt
    by the hash of the whole row, so only equal rows may change places. Null group values form
    a group. Columns with the names of ``names`` are replaced. The result reads a table of
    ``scratch``; an empty frame gives no rows.
    """
    by, order = _list(by), _list(order)
    terms = [(o.split()[0], o.split()[1:]) for o in order]
    if not terms or any(rest not in ([], ["asc"], ["desc"]) for _, rest in terms):
        raise ConfigError(f"cannot order by {order}")
    lacking = [c for c in [*by, *(c for c, _ in terms)] if c not in df.columns]
    if lacking:
        raise ConfigError(f"there is no column {', '.join(lacking)} to rank by")
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in names}]
    spark = df.sparkSession
    task, local, start, dense = (free_name(df, n) for n in ("_task", "_local", "_start", "_dense"))
    spread = free_name(df, "_spread")
    rows = df.withColumn(spread, F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) if _is_map(df, c) else F.col(f"`{c}`") for c in df.columns]))
    keys = [_plain(rows, c).asc() for c in by]
    keys += [_plain(rows, c).desc() if rest == ["desc"] else _plain(rows, c).asc() for c, rest in terms]
    dealt = rows.repartitionByRange(tasks or task_count(spark), *keys, F.col(spread)).sortWithinPartitions(*keys, F.col(spread))
    marked = dealt.withColumn(task, F.spark_partition_id().cast("bigint"))
    counters = [StructField(n, LongType()) for n in (local, start, dense)]
    numbered = marked.mapInArrow(_numbering(by, [c for c, _ in terms], [local, start, dense]), StructType([*marked.schema.fields, *counters]))
    stored = scratch.keep(numbered.drop(spread), "ranked")

    # one row per task and group: what it holds, and its ends
    ends = F.struct(*[_plain(stored, c).alias(f"k{i}") for i, (c, _) in enumerate(terms)])
    held = stored.groupBy(task, *by).agg(
        F.count("*").alias("n"), F.max(dense).alias("kinds"),
        F.min_by(ends, local).alias("first"), F.max_by(ends, local).alias("last"), F.max(start).alias("last_start"),
    )
    earlier = Window.partitionBy(*[F.col(f"`{c}`") for c in by]).orderBy(task) if by else Window.partitionBy(F.lit(0)).orderBy(task)
    until = earlier.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce(F.col("first").eqNullSafe(F.lag("last").over(earlier)) & F.lag("n").over(earlier).isNotNull(), F.lit(False))
    held = held.withColumn("before", F.coalesce(F.sum("n").over(until), F.lit(0))).withColumn("goes_on", goes_on)
    held = held.withColumn("kinds_before", F.coalesce(F.sum(F.col("kinds") - F.col("goes_on").cast("int")).over(until), F.lit(0)) - F.col("goes_on").cast("int"))
    # where a run of ties starts that reaches into the next task: in this one, unless all of it goes on
    whole = F.col("goes_on") & (F.col("kinds") == 1)
    held = held.withColumn("run", F.last(F.when(~whole, F.col("before") + F.col("last_start")), ignorenulls=True).over(earlier.rowsBetween(Window.unboundedPreceding, 0)))
    held = held.withColumn("run_before", F.lag("run").over(earlier))
    offsets = held.select(
        F.col(task).alias("_t"), *[F.col(f"`{c}`").alias(f"_by{i}") for i, c in enumerate(by)], "before", "kinds_before", "goes_on", "run_before",
    )
    same = F.col(task) == F.col("_t")
    for i, c in enumerate(by):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_by{i}"))
    found = stored.join(offsets, same)
    position, rank, dense_rank = names
    return found.select(
        *[F.col(f"`{c}`") for c in kept],
        (F.col("before") + F.col(local)).alias(position),
        F.when(F.col("goes_on") & (F.col(dense) == 1), F.col("run_before")).otherwise(F.col("before") + F.col(start)).alias(rank),
        (F.col("kinds_before") + F.col(dense)).alias(dense_rank),
    )


def exact_quantiles(
    df: DataFrame, column: str, fractions: Sequence[float], *, scratch: Scratch, by: str | Sequence[str] = (), tasks: int | None = None,
) -> DataFrame:
    """(by, fraction, value): the value of rank ceil(fraction * n) among the non-null values of each group, 1 at least.

    Exact at any size; a group without values has no row.
    """
    if not fractions or any(not 0 <= f <= 1 for f in fractions):
        raise ConfigError("fractions must lie between 0 and 1")
    by = _list(by)
    values = df.where(F.col(f"`{column}`").isNotNull()).select(*by, column)
    position = free_name(values, "position")
    ranked = add_ranks(values, column, by=by, scratch=scratch, names=(position, f"{position}_r", f"{position}_d"), tasks=tasks)
    sizes = values.groupBy(*by).agg(F.count("*").alias("_n")) if by else values.agg(F.count("*").alias("_n"))
    wanted = sizes.select(
        *[F.col(f"`{c}`").alias(f"_by{i}") for i, c in enumerate(by)],
        F.explode(F.array(*[
            F.struct(F.lit(float(f)).alias("fraction"), F.greatest(F.ceil(F.lit(float(f)) * F.col("_n")), F.lit(1)).cast("bigint").alias("at"))
            for f in sorted(set(fractions))
        ])).alias("_w"),
    )
    same = F.col(position) == F.col("_w.at")
    for i, c in enumerate(by):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_by{i}"))
    return ranked.join(wanted, same).select(*by, F.col("_w.fraction").alias("fraction"), F.col(f"`{column}`").alias("value"))


def top_k(
    df: DataFrame, order: str | Sequence[str], k: int, *, scratch: Scratch, by: str | Sequence[str] = (), ties: bool = True, tasks: int | None = None,
) -> DataFrame:
    """The first ``k`` rows of each group, with their ``rank``; with ``ties`` also those equal to the last of them."""
    if k < 1:
        raise ConfigError("k must be 1 or more")
    position, dense = free_name(df, "_position"), free_name(df, "_dense_rank")
    ranked = add_ranks(df, order, by=by, scratch=scratch, names=(position, "rank", dense), tasks=tasks)
    return ranked.where(F.col("rank" if ties else position) <= k).drop(position, dense)


def _list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _is_map(df: DataFrame, c: str) -> bool:
    return "map<" in df.schema[c].dataType.simpleString()


def _plain(df: DataFrame, c: str) -> Column:
    """The column, with one zero: -0.0 and 0.0 are the same value."""
    kind = df.schema[c].dataType.simpleString()
    return F.col(f"`{c}`") + F.lit(0).cast(kind) if kind in ("double", "float") else F.col(f"`{c}`")


def run_starts(batch: pa.RecordBatch, before: pa.RecordBatch | None, names: Sequence[str]) -> np.ndarray:
    """Which rows of a sorted batch differ in these columns from the row before them.

    ``before`` is the last row of the batch before. Nulls are equal, and so is NaN.
    """
    n = batch.num_rows
    changed = np.zeros(n, bool)
    changed[0] = before is None
    for name in names:
        at = batch.schema.get_field_index(name)
        values = batch.column(at)
        if before is not None:
            values = pa.concat_arrays([before.column(at), values])
        now, was = values.slice(1), values.slice(0, len(values) - 1)
        differ = pc.fill_null(pc.not_equal(now, was), False)
        if pa.types.is_floating(values.type):
            differ = pc.and_(differ, pc.invert(pc.fill_null(pc.and_(pc.is_nan(now), pc.is_nan(was)), False)))
        nulls = pc.not_equal(pc.is_null(now), pc.is_null(was))
        found = pc.or_(differ, nulls).to_numpy(zero_copy_only=False)
        changed[n - len(found):] |= found
    return changed


def _numbering(by: list[str], order: list[str], counters: list[str]):
    """Number sorted rows of one task: position in the group, where its run of ties began, runs so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, position, start, kinds = None, 0, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            group = run_starts(batch, before, by)
            tie = run_starts(batch, before, order) | group
            index = np.arange(n)
            origin = np.maximum.accumulate(np.where(group, index, -1))  # first row of the group in this batch
            positions = np.where(origin >= 0, index - origin + 1, position + index + 1)
            last = np.maximum.accumulate(np.where(tie, index, -1))
            starts = np.where(last >= 0, positions[np.maximum(last, 0)], start)
            runs = np.cumsum(tie)
            base = np.where(origin >= 0, runs[np.maximum(origin, 0)] - 1, -kinds)
            dense = runs - base
            before, position, start, kinds = batch.slice(n - 1), int(positions[-1]), int(starts[-1]), int(dense[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(positions, pa.int64()), pa.array(starts, pa.int64()), pa.array(dense, pa.int64())],
                names=[*batch.schema.names, *counters],
            )

    return run
