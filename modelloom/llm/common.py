"""Helpers shared by the operators of this subpackage: written cuts, graph components, array passing."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelloom.shared import scratch_path

#: Rows of an Arrow batch of whole texts or sets, which are kilobytes each.
WHOLE_ROWS = 1000


@contextmanager
def whole_rows(spark: SparkSession, rows: int = WHOLE_ROWS) -> Iterator[None]:
    """Jobs started in this block send Python batches of at most ``rows`` rows.

    Spark's 10,000 rows of whole texts are tens of megabytes a column, twice in the JVM's native
    memory and twice in the worker's, for each running task.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Workspace:
    """Tables written below the shared folder, dropped again when the block ends.

    ``keep`` writes a frame and returns it read back, which cuts its lineage and makes
    every later use read the same rows. What must outlive the block is written with
    ``result``; all else goes when the block ends, shuffle files and the driver's garbage, too.
    Native memory that the driver has freed goes back to the system after each written table.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self._paths = spark, label, []

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        for path in self._paths:
            _delete(self.spark, path)
        self.release()

    def path(self, name: str) -> str:
        """A fresh path that goes away with the workspace."""
        path = scratch_path(self.spark, f"{self.label}_{name}")
        self._paths.append(path)
        return path

    def keep(self, df: DataFrame, name: str, by: str | None = None, whole: bool = False) -> DataFrame:
        """Write and read back; a column ``by`` (the last) splits the files, so that filters on it read fewer.

        ``whole``: Python functions of ``df`` are given whole texts or sets, so few rows at once.
        """
        path = self.path(name)
        with whole_rows(self.spark) if whole else nullcontext():
            df.write.option("compression", "zstd").parquet(path, partitionBy=by)
        return_freed(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Let Spark drop the shuffle files of frames that nothing refers to any more.

        It does so when the driver collects its garbage, by default every half hour; a job of
        many written steps would hold the files of all of them until then.
        """
        gc.collect()
        self.spark._jvm.System.gc()
        return_freed(self.spark)

    def drop(self, *names: str) -> None:
        """Drop kept tables that later steps need no more."""
        for path in [p for p in self._paths if any(f"/{self.label}_{n}_" in p for n in names)]:
            self._paths.remove(path)
            _delete(self.spark, path)

    def result(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, f"{self.label}_result")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def return_freed(spark: SparkSession) -> bool:
    """Have the driver's JVM give native memory it has freed back to the system; False where it has no such command.

    Each job's planning, compilation and threads take memory of the C library, which keeps what they free in a pool
    per thread group; over hundreds of jobs the pools grow to hundreds of megabytes. HotSpot from 17.0.9 on returns
    them on this command on Linux; nothing that is in use is touched.
    """
    jvm, new_array = spark._jvm, spark.sparkContext._gateway.new_array
    arguments = new_array(jvm.Object, 4)
    try:
        arguments[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        arguments[1], arguments[2], arguments[3] = "systemTrimNativeHeap", new_array(jvm.Object, 0), new_array(jvm.String, 0)
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        # the server's class is not public to Py4J, its interface is
        invoke = next(m for m in jvm.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        invoke.invoke(server, arguments)
    except (Py4JError, PySparkException):
        return False
    return True


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def worker_state(token: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, once per Python worker process; later tasks of the same use share it.

    A worker holds one such state, that of its present use, so memories of words do not add up.
    """
    home = sys.modules.setdefault("_modelloom_llm_worker", types.ModuleType("_modelloom_llm_worker"))
    states = home.__dict__.setdefault("states", {})
    if token not in states:
        states.clear()
        states[token] = make()
    return states[token]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the like of it that no column of ``df`` has, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def portions(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()  # idle workers keep no buffers


def column_values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def with_arrays(batch: pa.RecordBatch, keep: list[str], added: dict[str, pa.Array]) -> pa.RecordBatch:
    """The columns ``keep`` of a batch, and new ones."""
    columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
    return pa.RecordBatch.from_arrays([*columns, *added.values()], names=[*keep, *added])


def add_columns(df: DataFrame, text: str, make: Callable[[], Callable[[list], dict[str, pa.Array]]], adds: str) -> DataFrame:
    """Add to ``df`` what a function computes from lists of one column's values, batch by batch.

    ``make()`` runs once per task and gives that function, so that it may hold a model or a
    cache. Columns of ``df`` with the names of ``adds`` are replaced.
    """
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(adds)
    taken = {f.name.lower() for f in new}
    keep = [c for c in df.columns if c.lower() not in taken]
    if text in keep:  # goes to Python once
        source, rows = text, df.select(*keep)
    else:
        source = free_name(df, "value")
        rows = df.select(*keep, F.col(f"`{text}`").alias(source))
    schema = StructType([*(df.schema[c] for c in keep), *new])
    names = [f.name for f in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = None
        for batch in portions(batches):
            compute = compute or make()
            added = compute(column_values(batch, source))
            yield with_arrays(batch, keep, {n: added[n] for n in names})

    return rows.mapInArrow(run, schema)


def components(spark: SparkSession, links: DataFrame, work: Workspace, name: str = "links") -> DataFrame:
    """(node, component) of every node that a link touches; component is the smallest node reachable.

    ``links`` has columns a and b (long). Alternates the large-star and small-star steps, each
    a minimum per node joined back to the edges, until nothing changes; a node of any degree
    is an aggregation with map-side combine, never a gathered group.
    """
    edges = work.keep(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{name}0",
    )
    step, before = 0, None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        step += 1
        edges = work.keep(small, f"{name}{step}")
        work.drop(f"{name}{step - 1}")
        now = tuple(edges.agg(F.count("*"), F.sum(F.hash("u", "v")), F.sum(F.xxhash64("u", "v").bitwiseAND(0xFFFFFFFF))).first())
        if now == before:
            break
        before = now
    # every edge leads to a root now; the root itself is a node as well
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    ).distinct()
