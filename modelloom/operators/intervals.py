"""Interval join: pairs of rows with equal keys whose intervals overlap.

The rows of a key are put in the order of their starts, and every ``per_bin`` of them make a bin,
so bins are as wide as the data asks and no key is too large for a task. A pair belongs to the bin
of the row that comes later; a row is copied only to later bins that start before it ends. Within a
bin a sweep compares each row with those still open.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from modelloom.errors import ConfigError
from modelloom.operators.asof import asof_join
from modelloom.operators.ranks import add_ranks, run_starts
from modelloom.shared import Scratch, task_count

#: Bins whose open rows meet a bin in one piece of work.
BLOCK = 16
#: Groups up to this size are compared many at a time, row against the row so many places before.
SMALL = 64


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_range: tuple[str, str],
    right_range: tuple[str, str],
    *,
    scratch: Scratch,
    by: str | Sequence[str | tuple[str, str]] = (),
    closed: bool = False,
    per_bin: int = 10_000,
    suffix: str = "_right",
    tasks: int | None = None,
) -> DataFrame:
    """Pairs of a left and a right row whose keys are equal and whose ranges overlap.

    Ranges are (start, end) columns of one type. They hold their start but not their end, and
    with ``closed`` their end, too. Empty ranges and those with a null, like null keys, meet
    nothing; repeated rows pair each time. Right columns whose names the left has get the
    suffix. A piece of work holds ``per_bin`` rows and at most sixteen times as many open ones;
    a row is copied once per bin it reaches into, where it meets the rows of the other side
    that start there. The result reads tables of ``scratch``.
    """
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in ([by] if isinstance(by, str) else by)]
    for side, df, names in (("left", left, [*left_range, *(a for a, _ in pairs)]), ("right", right, [*right_range, *(b for _, b in pairs)])):
        missing = [n for n in names if n not in df.columns]
        if missing:
            raise ConfigError(f"{side} side has no column {', '.join(missing)}")
    kinds = {df.schema[c].dataType for df, c in [*((left, c) for c in left_range), *((right, c) for c in right_range)]}
    if len(kinds) > 1:
        raise ConfigError("starts and ends must have one type")
    keys = [f"k{i}" for i in range(len(pairs))]

    def side(df: DataFrame, names: list[str], ends: tuple[str, str], mine: bool) -> DataFrame:
        whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        empty = F.lit(None).cast((right if mine else left).schema)
        rows = df.select(
            *[F.col(f"`{n}`").alias(k) for n, k in zip(names, keys)], F.col(f"`{ends[0]}`").alias("s"), F.col(f"`{ends[1]}`").alias("e"),
            F.lit(mine).alias("mine"), (whole if mine else empty).alias("l"), (empty if mine else whole).alias("r"),
        )
        usable = F.col("s") <= F.col("e") if closed else F.col("s") < F.col("e")
        for k in keys:
            usable = usable & F.col(k).isNotNull()
        return rows.where(usable)

    both = side(left, [a for a, _ in pairs], left_range, True).unionByName(side(right, [b for _, b in pairs], right_range, False))
    placed = add_ranks(both, "s", by=keys, scratch=scratch, names=("p", "_rank", "_dense"), tasks=tasks).drop("_rank", "_dense")
    placed = scratch.keep(placed.withColumn("bin", F.floor((F.col("p") - 1) / per_bin).cast("bigint")), "placed")
    # where bins start; keys of one bin, nearly all, need no more
    starts = scratch.keep(placed.groupBy(*keys, "bin").agg(F.min("s").alias("from")), "starts")
    last_bins = starts.groupBy(*keys).agg(F.max("bin").alias("bins")) if keys else starts.agg(F.max("bin").alias("bins"))
    wide = last_bins.where("bins > 0").select(*[F.col(k).alias(f"w{k}") for k in keys], "bins")
    among = F.lit(True)
    for k in keys:
        among = among & (F.col(k) == F.col(f"w{k}"))
    many = placed.join(wide, among, "left_semi")
    reach = asof_join(
        many, starts.withColumnRenamed("bin", "last"), ("e", "from"), by=keys, exact=closed, prefer="last", scratch=scratch, tasks=tasks,
    ).select(*placed.columns, "last")
    open_rows = scratch.keep(reach.where("last > bin").select(
        *keys, F.explode(F.sequence(F.col("bin") + 1, F.col("last"))).alias("b"), F.floor(F.col("bin") / BLOCK).cast("bigint").alias("piece"),
        "p", "s", "e", "mine", F.lit(False).alias("later"), "l", "r",
    ), "open")
    own = placed.select(*keys, F.col("bin").alias("b"), F.lit(-1).cast("bigint").alias("piece"), "p", "s", "e", "mine", F.lit(True).alias("later"), "l", "r")
    pieces = open_rows.select(*keys, "b", "piece").distinct()
    again = own.drop("piece").join(pieces, [*keys, "b"]).select(*own.columns)
    work = own.unionByName(again).unionByName(open_rows)
    group = [*keys, "b", "piece"]
    dealt = work.repartition(tasks or task_count(left.sparkSession), *group).sortWithinPartitions(*group, "p")
    out = StructType([StructField("l", left.schema), StructField("r", right.schema)])
    met = dealt.mapInArrow(_sweep(group, closed), out)
    taken = {c.lower() for c in left.columns}
    return met.select(
        *[F.col("l").getField(c).alias(c) for c in left.columns],
        *[F.col("r").getField(c).alias(c + suffix if c.lower() in taken else c) for c in right.columns],
    )


def _sweep(group: list[str], closed: bool):
    """Pairs within groups of sorted rows."""

    def pairs(table: pa.Table, start: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Of whole groups: those of many rows one by one, all small ones at once."""
        n = table.num_rows
        mine, later = (table.column(c).to_numpy() for c in ("mine", "later"))
        s, e = (_numbers(table.column(c)) for c in ("s", "e"))
        alone = _numbers(table.column("piece")) < 0
        l, r = (table.column(c).combine_chunks() for c in ("l", "r"))  # noqa: E741
        first = np.flatnonzero(start)
        sizes = np.diff(np.append(first, n))
        begins = np.repeat(first, sizes)
        small = np.repeat(sizes <= SMALL, sizes)

        def meets(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            """Rows i start within rows j, which come before them."""
            fits = later[i] & (mine[i] != mine[j]) & (alone[i] | ~later[j])
            return fits & ((e[j] >= s[i]) if closed else (e[j] > s[i]))

        def rows(i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(i), 50_000):
                a, b = i[at:at + 50_000], j[at:at + 50_000]
                here, there = np.where(mine[a], a, b), np.where(mine[a], b, a)
                yield pa.RecordBatch.from_arrays([l.take(pa.array(here)), r.take(pa.array(there))], names=["l", "r"])

        index = np.flatnonzero(small)
        for back in range(1, SMALL):
            index = index[index - back >= begins[index]]
            if not len(index):
                break
            keep = meets(index, index - back)
            yield from rows(index[keep], index[keep] - back)
        for begin, size in zip(first[sizes > SMALL], sizes[sizes > SMALL]):
            active = np.zeros(0, np.int64)  # rows before the present ones that are open still
            for at in range(begin, begin + size, 256):
                i = np.arange(at, min(at + 256, begin + size))
                active = active[(e[active] >= s[at]) if closed else (e[active] > s[at])]
                for part in range(0, len(active), 16_384):
                    j = active[part:part + 16_384]
                    a, b = np.nonzero(meets(i[:, None], j[None, :]))
                    yield from rows(i[a], j[b])
                a, b = np.nonzero(meets(i[:, None], i[None, :]) & (i[None, :] < i[:, None]))
                yield from rows(i[a], i[b])
                active = np.concatenate([active, i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        marks: list[np.ndarray] = []
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            start = run_starts(batch, before, group)
            before = batch.slice(batch.num_rows - 1)
            edge = np.flatnonzero(start)
            if held and len(edge):  # all groups but the last are whole
                cut = int(edge[-1])
                yield from pairs(pa.Table.from_batches([*held, batch.slice(0, cut)]), np.concatenate([*marks, start[:cut]]))
                held, marks = [batch.slice(cut)], [start[cut:]]
            else:
                held.append(batch)
                marks.append(start)
        if held:
            yield from pairs(pa.Table.from_batches(held), np.concatenate(marks))

    return run


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    if pa.types.is_decimal(column.type):
        return np.array(column.to_pylist(), dtype=object)
    values = column.to_numpy()
    return values.astype(np.int64) if values.dtype.kind == "M" else values
