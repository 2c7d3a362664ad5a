"""As-of join: for every row the nearest earlier (or later) row of another frame with the same key.

Both sides go into one sequence, dealt to tasks by ranges of key and time and sorted there, so a
key that fills a third of the rows is spread over many tasks. A task carries the last row seen of
the other side. Only rows before the first such row of a task's first key lack a match that may
lie in tasks before; they get it from a table of at most two rows a task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from modelloom.errors import ConfigError
from modelloom.operators.ranks import run_starts
from modelloom.shared import Scratch, task_count


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str | tuple[str, str],
    *,
    scratch: Scratch,
    by: str | Sequence[str | tuple[str, str]] = (),
    direction: str = "backward",
    exact: bool = True,
    tolerance: Column | None = None,
    prefer: str | Sequence[str] = (),
    suffix: str = "_right",
    tasks: int | None = None,
) -> DataFrame:
    """Every row of ``left`` with the row of ``right`` nearest in time, of those with equal keys.

    ``on`` and ``by`` name the time and the keys, as pairs where the sides differ. ``backward``
    takes the latest row not after (with ``exact=False``: before) the left one's time, ``forward``
    the earliest not before. Of rows at the same time the one greatest in ``prefer`` counts, then
    one by the hash of the row. A match further away than ``tolerance`` (an interval, or a
    number) is none. Rows without a match have nulls on the right, as have those with a null
    key or time; such rows of ``right`` match nothing. Repeated left rows stay. Right columns
    whose names the left has get the suffix. The result reads tables of ``scratch``.
    """
    at_left, at_right = (on, on) if isinstance(on, str) else on
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in ([by] if isinstance(by, str) else by)]
    prefer = [prefer] if isinstance(prefer, str) else list(prefer)
    if direction not in ("backward", "forward"):
        raise ConfigError(f"direction={direction!r}, expected backward or forward")
    for side, df, names in (("left", left, [at_left, *(a for a, _ in pairs)]), ("right", right, [at_right, *(b for _, b in pairs), *prefer])):
        missing = [n for n in names if n not in df.columns]
        if missing:
            raise ConfigError(f"{side} side has no column {', '.join(missing)}")
    if left.schema[at_left].dataType != right.schema[at_right].dataType:
        raise ConfigError("both times must have one type")
    spark = left.sparkSession
    keys = [f"k{i}" for i in range(len(pairs))]

    def side(df: DataFrame, time: str, names: list[str], place: int, mine: bool) -> DataFrame:
        whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        empty = F.lit(None).cast((right if mine else left).schema)
        liked = F.struct(*[F.col(f"`{c}`") for c in prefer]) if prefer else F.lit(0)
        nothing = F.lit(None).cast(StructType([right.schema[c] for c in prefer])) if prefer else F.lit(0)
        return df.select(
            *[F.col(f"`{n}`").alias(k) for n, k in zip(names, keys)], F.col(f"`{time}`").alias("t"), F.lit(place).alias("side"),
            (nothing if mine else liked).alias("liked"), F.xxhash64(F.to_json(whole) if "map<" in df.schema.simpleString() else whole).alias("spread"),
            (whole if mine else empty).alias("l"), (empty if mine else whole).alias("r"),
        )

    # at equal times a match must come before the rows that may take it
    mine = side(left, at_left, [a for a, _ in pairs], 1 if exact else 0, True)
    theirs = side(right, at_right, [b for _, b in pairs], 0 if exact else 1, False)
    usable = F.lit(True)
    for name in [*keys, "t"]:
        usable = usable & F.col(name).isNotNull()
    time = F.col("t").desc() if direction == "forward" else F.col("t").asc()
    order = [*keys, time, F.col("side"), F.col("liked"), F.col("spread")]
    rows = mine.where(usable).unionByName(theirs.where(usable))
    rows = rows.repartitionByRange(tasks or task_count(spark), *order).sortWithinPartitions(*order)
    rows = rows.select(*keys, (F.col("l").isNotNull()).alias("mine"), "l", "r", F.spark_partition_id().cast("bigint").alias("task"))
    marks = [StructField("open", BooleanType()), StructField("edge", LongType())]
    matched = scratch.keep(rows.mapInArrow(_carry(keys), StructType([*rows.schema.fields, *marks])), "asof")

    edges = matched.where("edge > 0")
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("task", "edge").rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.withColumn("before", F.last("r", ignorenulls=True).over(earlier)).where("edge = 1 and before is not null")
    carried = carried.select(F.col("task").alias("at"), "before")
    found = matched.where("edge = 0")
    found = found.join(carried, F.col("open") & (F.col("task") == F.col("at")), "left").select("l", F.coalesce("r", "before").alias("r"))
    if tolerance is not None:
        mine_at, their_at = F.col("l").getField(at_left), F.col("r").getField(at_right)
        near = their_at >= mine_at - tolerance if direction == "backward" else their_at <= mine_at + tolerance
        found = found.select("l", F.when(near, F.col("r")).alias("r"))
    lost = mine.where(~usable).select("l", "r")
    taken = {c.lower() for c in left.columns}
    return found.unionByName(lost).select(
        *[F.col("l").getField(c).alias(c) for c in left.columns],
        *[F.col("r").getField(c).alias(c + suffix if c.lower() in taken else c) for c in right.columns],
    )


def _carry(keys: list[str]):
    """Left rows with the last right row before them in their group, and the edges of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = held = first_row = first_held = None  # held: the last right row of the present group
        groups = 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            start = run_starts(batch, before, keys)
            index, mine = np.arange(n), column["mine"].to_numpy(zero_copy_only=False)
            origin = np.maximum.accumulate(np.where(start, index, -1))
            last = np.maximum.accumulate(np.where(mine, -1, index))
            inside = (last >= 0) & (last >= origin)
            at = np.where(inside, last + 1, np.where((origin < 0) & (held is not None), 0, -1))
            pool = pa.concat_arrays([held if held is not None else pa.nulls(1, column["r"].type), column["r"]])
            number = groups + np.cumsum(start)
            if first_row is None:
                first_row = batch.slice(0, 1)
            if number[-1] > 1 and groups <= 1:  # the first group ends in this batch, or ended with the last
                own = np.flatnonzero(number == 1)
                place = at[own[-1]] if len(own) else (0 if held is not None else -1)
                first_held = pool.slice(place, 1) if place >= 0 else None
            matches = pool.take(pa.array(at, pa.int64(), mask=at < 0))
            out = {**column, "r": matches, "open": pa.array((number == 1) & (at < 0)), "edge": pa.array(np.zeros(n, np.int64))}
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out)).filter(column["mine"])
            before, groups = batch.slice(n - 1), int(number[-1])
            held = pool.slice(at[-1], 1) if at[-1] >= 0 else None
        if before is not None:
            if groups == 1:
                first_held = held
            for edge, row, value in ((1, first_row, first_held), (2, before, held))[:2 if groups > 1 else 1]:
                out = {name: row.column(i) for i, name in enumerate(row.schema.names)}
                out |= {"l": pa.nulls(1, out["l"].type), "r": value if value is not None else pa.nulls(1, out["r"].type)}
                out |= {"open": pa.array([False]), "edge": pa.array([edge], pa.int64())}
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return run
