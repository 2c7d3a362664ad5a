"""Event-time windows and sessions over a stream whose rows come late.

Two queries in a row. The first splits the stream: rows that come when the watermark has passed
them go to a table of their own, all others to a table of rows in time; both get every row once.
The second reads that table's files as a stream, keeps open windows or sessions in Spark's state
store and adds each to the result when the watermark closes it. Its watermark never runs ahead of
the first one's, so it drops nothing, and the result equals that of a batch query over the rows in
time, after any number of restarts.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

from modelloom.errors import ConfigError
from modelloom.functions import empty_like
from modelloom.operators.materialize import _micros, append_table, kind_of
from modelloom.sources import RelationName, relation_name
from modelloom.streaming.incremental import FileTable, append_stream

Name = str | RelationName


@dataclass(frozen=True)
class EventTime:
    """The time column of a stream, and how many seconds behind the newest row its watermark is."""

    column: str
    delay_s: float

    def __post_init__(self) -> None:
        if self.delay_s < 0:
            raise ConfigError("the delay must not be negative")


def split_late(
    stream: DataFrame, time: EventTime, expires: Column, in_time: Name, late: Name, checkpoint: str,
) -> StreamingQuery:
    """Put the rows of a stream whose time ``expires`` is not after the watermark into ``late``, others into ``in_time``.

    The watermark of a micro-batch is the newest time of all batches before it, less the delay,
    as in a streaming aggregation; it is noted in the checkpoint, so a repeated batch meets the
    same. Rows without a time are late. Stops when all that is there has been read.
    """
    spark = stream.sparkSession
    tables = []
    for name in map(relation_name, (in_time, late)):
        if kind_of(spark, name) is None:
            append_table(empty_like(spark.createDataFrame([], stream.schema)), name)
        tables.append(FileTable(spark, name))
    kind = stream.schema[time.column].dataType
    at = _micros(F.col(f"`{time.column}`"), kind)
    started = threading.Event()
    query: StreamingQuery | None = None

    def write(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        newest = _noted(spark, checkpoint, batch_id - 1)
        batch.persist()
        try:
            top = batch.agg(F.max(at)).first()[0]
            _note(spark, checkpoint, batch_id, max((x for x in (newest, top) if x is not None), default=None))
            timed, untimed = batch.where(at.isNotNull()), batch.where(at.isNull())  # a window drops the latter
            if newest is None:
                parts = (timed, untimed)
            else:
                passed = _micros(expires, kind) <= newest - round(time.delay_s * 1_000_000)
                parts = (timed.where(~passed).select(*batch.columns), timed.where(passed).select(*batch.columns).unionAll(untimed))
            for table, rows, notes in zip(tables, parts, ("in_time", "late")):
                table.add_once(rows, str(query.id), batch_id, f"{checkpoint}/{notes}")
        finally:
            batch.unpersist()

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.set()
    query.awaitTermination()
    return query


def window_stream(
    stream: DataFrame, time: EventTime, width: str, aggregates: Sequence[Column], target: Name, late: Name, checkpoint: str,
    *, by: Sequence[str] = (),
) -> StreamingQuery:
    """Aggregates per tumbling window and keys, added to ``target`` when the watermark passes the window's end.

    ``target`` has ``window_start``, ``window_end``, the keys and the aggregates (which see a time
    without zone as an instant in UTC). Rows whose
    window was closed before they came are in ``late`` and in no window. Windows still open when
    the stream has been read stay in the state until a later run closes them.
    """
    def windows(rows: DataFrame) -> DataFrame:
        grouped = rows.groupBy(F.window(time.column, width).alias("window"), *by).agg(*aggregates)
        return grouped.select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *grouped.columns[1:]
        )

    return _closed(stream, time, F.window(time.column, width).getField("end"), windows, target, late, checkpoint)


def session_stream(
    stream: DataFrame, time: EventTime, gap: str, aggregates: Sequence[Column], target: Name, late: Name, checkpoint: str,
    *, by: Sequence[str],
) -> StreamingQuery:
    """Sessions per keys: rows less than ``gap`` apart, added to ``target`` when the watermark passes their end.

    Rows that come in any order extend or join open sessions. ``target`` has ``session_start``,
    ``session_end`` (the last row's time and the gap), the keys and the aggregates. Rows not
    after the watermark are in ``late`` and in no session.
    """
    def sessions(rows: DataFrame) -> DataFrame:
        grouped = rows.groupBy(F.session_window(time.column, gap).alias("session"), *by).agg(*aggregates)
        return grouped.select(
            F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), *grouped.columns[1:]
        )

    return _closed(stream, time, F.col(time.column), sessions, target, late, checkpoint)


def _closed(
    stream: DataFrame, time: EventTime, expires: Column, aggregate: Callable[[DataFrame], DataFrame], target: Name,
    late: Name, checkpoint: str,
) -> StreamingQuery:
    spark = stream.sparkSession
    name = relation_name(target)
    in_time = name.sibling("__in_time")
    split_late(stream, time, expires, in_time, late, f"{checkpoint}/split")
    files = FileTable(spark, in_time)
    rows = spark.readStream.format(files.format).schema(spark.table(in_time.sql()).schema).load(files.location)
    plain = isinstance(rows.schema[time.column].dataType, TimestampNTZType)
    if plain:  # a watermark needs instants: those of the same reading in UTC
        rows = rows.withColumn(time.column, F.timestamp_micros(_micros(F.col(f"`{time.column}`"), rows.schema[time.column].dataType)))
    marked = rows.withWatermark(time.column, f"{round(time.delay_s * 1000)} milliseconds")
    closed = aggregate(marked)
    if plain:
        start, end = closed.columns[:2]
        closed = closed.withColumns({c: _reading(F.col(c)) for c in (start, end)})
    return append_stream(closed, name, f"{checkpoint}/aggregate")


def _reading(instant: Column) -> Column:
    """What a clock in UTC shows, as a time without zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01").cast("timestamp_ntz"))


def _note_path(spark: SparkSession, checkpoint: str, batch_id: int):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/newest/{batch_id}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _noted(spark: SparkSession, checkpoint: str, batch_id: int) -> int | None:
    """The newest time, in microseconds, up to a batch; its note is a file's name, which appears at once or not at all."""
    fs, folder = _note_path(spark, checkpoint, batch_id)
    if not fs.exists(folder):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return next((int(n) for n in names if n != "none"), None)


def _note(spark: SparkSession, checkpoint: str, batch_id: int, newest: int | None) -> None:
    fs, folder = _note_path(spark, checkpoint, batch_id)
    if not fs.exists(folder):
        fs.create(spark._jvm.org.apache.hadoop.fs.Path(folder, "none" if newest is None else str(newest)), True).close()
    fs, old = _note_path(spark, checkpoint, batch_id - 3)
    fs.delete(old, True)
