"""Incremental tables fed by a stream: only new input, appended once."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from modelloom.errors import ConfigError
from modelloom.functions import empty_like
from modelloom.operators.materialize import TRANSACTIONAL, append_table, kind_of, partition_columns
from modelloom.sources import RelationName, relation_name


def stream_files(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    *,
    format: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """Files of a folder (or glob) as a stream; every file is read once per checkpoint."""
    reader = spark.readStream.format(format).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def append_stream(
    stream: DataFrame,
    name: str | RelationName,
    checkpoint: str,
    *,
    format: str = "parquet",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append everything new since the last run to a table, then stop.

    The table holds the stream's columns and no others, partitioned as it is or, if it is made
    here, by ``partition_by``; rows may be added to it by other means, too. A micro-batch is
    written to a folder beside the table's files first and its files are then moved among them,
    so a batch repeated after a failure moves what is left or, if the checkpoint says that all
    of it was moved, nothing. The checkpoint keeps what has been read and must lie on storage
    that outlives the session. For tables of files only.
    """
    spark = stream.sparkSession
    target = relation_name(name)
    if format in TRANSACTIONAL:
        raise ConfigError(f"append_stream adds files to a table; {format} tables commit their own")
    if kind_of(spark, target) is None:
        append_table(empty_like(spark.createDataFrame([], stream.schema)), target, format=format, partition_by=partition_by)
    sink = FileTable(spark, target)
    started = threading.Event()
    query: StreamingQuery | None = None

    def write(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        sink.add_once(batch, str(query.id), batch_id, checkpoint)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.set()
    query.awaitTermination()
    return query


class FileTable:
    """A stored table of files to which the batches of a stream are added exactly once."""

    def __init__(self, spark: SparkSession, name: RelationName):
        self.spark, self.name = spark, name
        told = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe table extended {name.sql()}").collect()}
        self.location, self.format = told["Location"], told["Provider"]
        self.columns, self.parts = spark.table(name.sql()).columns, partition_columns(spark, name)

    def add_once(self, batch: DataFrame, query: str, batch_id: int, checkpoint: str) -> None:
        paths = self.spark._jvm.org.apache.hadoop.fs.Path
        conf = self.spark._jsc.hadoopConfiguration()
        notes = paths(f"{checkpoint}/published")
        notes_fs = notes.getFileSystem(conf)
        noted = paths(notes, f"{batch_id}")
        staged = paths(f"{self.location}/_batch_{query}_{batch_id}")  # readers skip names with _ in front
        fs = staged.getFileSystem(conf)
        if not notes_fs.exists(noted):
            whole = paths(staged, "_whole")
            if not fs.exists(whole):
                rows = batch.select(*[F.col(f"`{c}`") for c in self.columns])
                rows.write.format(self.format).mode("overwrite").partitionBy(*self.parts).save(str(staged))
                fs.create(whole, True).close()
            self._move(fs, paths, staged, f"{query}-{batch_id}")
            notes_fs.mkdirs(notes)
            notes_fs.create(noted, True).close()
            notes_fs.delete(paths(notes, f"{batch_id - 2}"), False)
        fs.delete(staged, True)
        self.spark.catalog.refreshTable(self.name.sql())

    def _move(self, fs, paths, staged, stamp: str) -> None:
        root = fs.getFileStatus(staged).getPath().toString()
        found, files = fs.listFiles(staged, True), []
        while found.hasNext():
            files.append(found.next().getPath())
        for file in files:
            if file.getName()[0] in "_.":
                continue
            folder = file.getParent().toString()[len(root):].strip("/")
            home = paths(f"{self.location}/{folder}") if folder else paths(self.location)
            fs.mkdirs(home)
            if not fs.rename(file, paths(home, f"{stamp}-{file.getName()}")):
                raise OSError(f"cannot move {file.toString()} to {home.toString()}")
        if self.parts:
            self.spark.sql(f"alter table {self.name.sql()} recover partitions")
