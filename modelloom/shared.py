"""Where written intermediate data goes, and short-lived schemas inside it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from modelloom.errors import ConfigError

_local_folder: tempfile.TemporaryDirectory | None = None


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a single-machine session may do without the setting; it gets a
    temporary folder that goes away with the process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not is_local(spark):
        raise ConfigError("set spark.checkpoint.dir to a folder all executors share")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="modelloom-", ignore_cleanup_errors=True)
    return _local_folder.name


def task_count(spark: SparkSession) -> int:
    """How many tasks to spread work over whose weight does not show in its bytes.

    Adaptive coalescing would put such rows into a few tasks; a repartition to
    a given number is left alone.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def scratch_path(spark: SparkSession, label: str = "scratch") -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}_{uuid.uuid4().hex[:12]}"


def scratch_schema(spark: SparkSession, label: str = "scratch") -> str:
    """Create a uniquely named schema whose tables live in the shared folder."""
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[1]
    spark.sql(f"create schema `{name}` location '{path}'")
    return name


class Scratch:
    """Tables written below the shared folder between jobs, dropped when their owner ends.

    ``keep`` writes a frame and reads it back, which cuts its lineage and makes every later use
    read the same rows. Used with ``with``, all tables go at its end; else ``close`` drops them.
    """

    def __init__(self, spark: SparkSession, label: str = "scratch"):
        self.spark, self.label, self.paths = spark, label, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def path(self, name: str) -> str:
        self.paths.append(scratch_path(self.spark, f"{self.label}_{name}"))
        return self.paths[-1]

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def size(self) -> int:
        """Bytes of all tables."""
        return sum(fs.getContentSummary(place).getLength() for fs, place in map(self._place, self.paths))

    def close(self) -> None:
        for path in self.paths:
            fs, place = self._place(path)
            fs.delete(place, True)
        self.paths.clear()

    def _place(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place
