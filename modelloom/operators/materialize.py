"""Storing a model: view, replaced table, appended table, history table."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

from modelloom.errors import ConfigError, ModelTimeout, ResultError
from modelloom.shared import Scratch
from modelloom.sources import RelationName, relation_name

Name = str | RelationName

# table formats whose catalogs replace a table in one transaction
TRANSACTIONAL = ("delta", "iceberg")
HISTORY_PART = "history_part"
# properties by which a backup, and a snapshot's prepared parts, are known
BACKUP_OF, BACKUP_AT = "modelloom.backup_of", "modelloom.backup_at"
PREPARED_AS_OF, PREPARED_PARTS = "modelloom.prepared_as_of", "modelloom.prepared_parts"
#: Bytes of open rows that a part of a new history table is meant to hold, and most parts.
PART_BYTES, MOST_PARTS = 32 << 20, 4096


def kind_of(spark: SparkSession, name: Name) -> str | None:
    """``"table"``, ``"view"`` or None for a name the catalog does not know."""
    text = relation_name(name).sql()
    if not spark.catalog.tableExists(text):
        return None
    return "view" if spark.catalog.getTable(text).tableType in ("VIEW", "TEMPORARY") else "table"


def create_schema(spark: SparkSession, name: Name) -> None:
    """Make the schema a relation lives in, if it has one and it is missing."""
    target = relation_name(name)
    if target.schema:
        spark.sql(f"create schema if not exists {target.schema.sql()}")


def drop(spark: SparkSession, name: Name) -> None:
    """Drop a table or view; a missing one is fine."""
    kind = kind_of(spark, name)
    if kind:
        spark.sql(f"drop {kind} if exists {relation_name(name).sql()}")


def create_view(spark: SparkSession, name: Name, query: str) -> None:
    """Store a query text as a view, in place of whatever had the name."""
    create_schema(spark, name)
    if kind_of(spark, name) == "table":
        drop(spark, name)
    spark.sql(f"create or replace view {relation_name(name).sql()} as {query}")


def recover(spark: SparkSession, name: Name) -> None:
    """Give a table its name back if a run died between the two renames that replace it.

    Only tables that ``replace_table`` has marked as backups of this one are touched, whatever
    others are called. If the table is missing the newest of them becomes it; the rest are
    what earlier runs left behind, and dropped.
    """
    target = relation_name(name)
    if target.schema and not spark.catalog.databaseExists(target.schema.sql()):
        return
    start = f"{target.table}__bak_"
    listed = spark.catalog.listTables(target.schema.sql() if target.schema else None, f"{target.table}__bak_*")
    marked = []
    for t in listed:
        if t.isTemporary or not t.name.lower().startswith(start.lower()):
            continue
        kept = target.sibling(t.name[len(target.table):])
        told = {r["key"]: r["value"] for r in spark.sql(f"show tblproperties {kept.sql()}").collect()}
        if told.get(BACKUP_OF) == target.table:
            marked.append((int(told[BACKUP_AT]), t.name, kept))
    for _, _, kept in sorted(marked, reverse=True):
        if kind_of(spark, target) is None:
            kind = kind_of(spark, kept)
            _rename(spark, kind, kept, target)
            _unmark(spark, kind, target)
        else:
            drop(spark, kept)


def _mark(spark: SparkSession, kind: str, target: RelationName) -> None:
    """Note on a table or view that it is about to become a backup, and when."""
    name = target.table.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"alter {kind} {target.sql()} set tblproperties ('{BACKUP_OF}' = '{name}', '{BACKUP_AT}' = '{time.time_ns()}')")


def _unmark(spark: SparkSession, kind: str, target: RelationName) -> None:
    spark.sql(f"alter {kind} {target.sql()} unset tblproperties if exists ('{BACKUP_OF}', '{BACKUP_AT}')")


def partition_columns(spark: SparkSession, name: Name) -> list[str]:
    """The columns a stored table is partitioned by."""
    return [c.name for c in spark.catalog.listColumns(relation_name(name).sql()) if c.isPartition]


def replace_table(
    df: DataFrame,
    name: Name,
    *,
    format: str = "parquet",
    partition_by: Sequence[str] | None = None,
    timeout_s: float | None = None,
) -> int:
    """Store ``df`` as the table, whatever the table held before; returns the row count.

    Unless ``partition_by`` is given, the table stays partitioned by those of its
    partition columns that ``df`` has, too.

    The new table is written next to the old one (or view), which stays
    readable, also for ``df`` itself, until the write is done. Then they change
    names; if that fails the old one gets its name back. The two renames are not
    one step for readers, since the session catalog has no transactions; a
    transactional table format replaces the table in one commit instead.
    """
    spark = df.sparkSession
    target = relation_name(name)
    create_schema(spark, target)
    recover(spark, target)
    before = kind_of(spark, target)
    if partition_by is None:
        partition_by = [c for c in partition_columns(spark, target) if c in df.columns] if before == "table" else []
    if format in TRANSACTIONAL:
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = counted.writeTo(target.sql()).using(format)
        if partition_by:
            writer = writer.partitionedBy(*map(F.col, partition_by))
        with time_limit(spark, timeout_s, target.table):
            writer.createOrReplace()
        return int(seen.get.get("rows", 0))
    mark = uuid.uuid4().hex[:8]
    staging, backup = target.sibling(f"__stg_{mark}"), target.sibling(f"__bak_{mark}")
    try:
        with time_limit(spark, timeout_s, target.table):
            rows = _save(df, staging, "error", format, partition_by)
        if before:
            _mark(spark, before, target)
            _rename(spark, before, target, backup)
        try:
            _rename(spark, "table", staging, target)
        except Exception:
            if before:
                _rename(spark, before, backup, target)
                _unmark(spark, before, target)
            raise
        drop(spark, backup)
    finally:
        drop(spark, staging)
    return rows


def append_table(
    df: DataFrame,
    name: Name,
    *,
    format: str = "parquet",
    partition_by: Sequence[str] = (),
    timeout_s: float | None = None,
) -> int:
    """Add the rows to the table, matching columns by name; a missing table is created.

    A table that is there keeps its partition columns.
    """
    spark = df.sparkSession
    target = relation_name(name)
    create_schema(spark, target)
    if kind_of(spark, target) is not None:
        have = spark.table(target.sql()).columns
        if set(have) != set(df.columns):
            raise ResultError(
                f"columns differ from table {target.dotted()}: "
                f"missing {sorted(set(have) - set(df.columns))}, "
                f"not in the table {sorted(set(df.columns) - set(have))}"
            )
        df = df.select(*[F.col(f"`{c}`") for c in have])
        partition_by = partition_columns(spark, target)
    with time_limit(spark, timeout_s, target.table):
        return _save(df, target, "append", format, partition_by)


def overwrite_partitions(spark: SparkSession, rows: Name, name: Name) -> None:
    """Replace just those partitions of a table that the stored ``rows`` hold.

    A table insert takes the mode from its session and would otherwise empty the
    whole table, so it runs in a session of its own: the caller's settings are
    never touched, and concurrent writers do not see each other's.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.catalog.setCurrentCatalog(spark.catalog.currentCatalog())
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    gathered = own.table(relation_name(rows).sql()).hint("rebalance", *partition_columns(own, name))  # few files a part
    gathered.write.insertInto(relation_name(name).sql(), overwrite=True)
    spark.catalog.refreshTable(relation_name(name).sql())  # this session may remember the old files


def _save(
    df: DataFrame, target: RelationName, mode: str, format: str, partition_by: Sequence[str] = ()
) -> int:
    """Write and count in one pass."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(format).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(target.sql())
    return int(seen.get.get("rows", 0))


def _rename(spark: SparkSession, kind: str, old: RelationName, new: RelationName) -> None:
    spark.sql(f"alter {kind} {old.sql()} rename to {new.within_catalog().sql()}")
    if kind == "table" and partition_columns(spark, new):
        # the files have moved, the catalog's list of partitions has not
        spark.sql(f"alter table {new.sql()} recover partitions")
        spark.catalog.refreshTable(new.sql())


@contextmanager
def time_limit(spark: SparkSession, seconds: float | None, label: str) -> Iterator[None]:
    """Cancel the Spark jobs started inside the block once the time is over."""
    if seconds is None:
        yield
        return
    sc = spark.sparkContext
    tag = f"limit-{uuid.uuid4().hex}"
    done, late = threading.Event(), threading.Event()

    def watch() -> None:
        wait = seconds
        while not done.wait(wait):
            late.set()
            sc.cancelJobsWithTag(tag)
            wait = 0.5  # an action may start further jobs

    watcher = threading.Thread(target=watch, daemon=True)
    sc.addJobTag(tag)
    watcher.start()
    try:
        yield
    except Exception as exc:
        if late.is_set():
            raise ModelTimeout(label, seconds) from exc
        raise
    finally:
        done.set()
        watcher.join()
        sc.removeJobTag(tag)


def _micros(at: Column, kind: DataType) -> Column:
    """Microseconds since 1970, whatever the session's time zone."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(at)
    return F.unix_micros(F.concat(at.cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp"))


def snapshot(
    df: DataFrame,
    name: Name,
    key: str,
    as_of: Column,
    *,
    buckets: int | None = None,
    timeout_s: float | None = None,
) -> int:
    """Keep the history of a table: one row per state of a key, open while it lasts.

    Rows that changed or vanished get their ``valid_to``, changed and new ones a
    row with ``valid_from``. ``as_of``, a date or timestamp, is the time of this
    run; unless it is later than that of the last, a ConfigError says so and
    nothing is written. A key that ``df`` repeats fails the job.

    The table is partitioned by ``history_part``: open rows lie in ``buckets``
    parts by key (by default as many as the first state's size asks for, later as
    many as there are), the rows a run closed in a part of that run. A run first
    prepares all parts that change in a table of its own and then replaces them
    one by one. If it dies in between, the next run finishes that first, whatever
    its ``as_of``; repeated with the same one, it has nothing left to do. Returns
    the rows written. Known keys stay in their part if ``buckets`` changes.
    """
    spark = df.sparkSession
    target = relation_name(name)
    reserved = {"valid_from", "valid_to", HISTORY_PART} & set(df.columns)
    if reserved:
        raise ConfigError(f"snapshot needs the names {sorted(reserved)} for itself")
    # one row per key, or an error, in the job that uses it
    once = df.groupBy(F.col(key).alias("_is_key")).agg(
        F.count("*").alias("_n"), F.any_value(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("_is")
    )
    twice = F.raise_error(F.concat(F.lit("snapshot: repeated key "), F.coalesce(F.col("_is_key").cast("string"), F.lit("null"))))
    once = once.select("_is_key", F.when(F.col("_n") > 1, twice).otherwise(F.col("_is")).alias("_is"))

    def home(parts: int) -> Column:
        return F.concat(F.lit("open-"), F.pmod(F.xxhash64("_is_key"), F.lit(parts)).cast("string"))

    if kind_of(spark, target) is None:
        first = once.select("_is_key", "_is", as_of.alias("valid_from"))
        kind = first.schema["valid_from"].dataType
        if not isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
            raise ConfigError("as_of must be a date or a timestamp")
        with Scratch(spark, "snapshot") as scratch, time_limit(spark, timeout_s, target.table):
            if buckets is None:  # the size is known once the rows are written
                first = scratch.keep(first, "first")
                buckets = min(max(1, -(-scratch.size() // PART_BYTES)), MOST_PARTS)
            rows = first.select("_is.*", "valid_from", F.lit(None).cast(kind).alias("valid_to"), home(buckets).alias(HISTORY_PART))
            return append_table(rows.hint("rebalance", HISTORY_PART), target, partition_by=[HISTORY_PART])

    history = spark.table(target.sql())
    columns = [c for c in history.columns if c not in ("valid_from", "valid_to", HISTORY_PART)]
    if set(columns) != set(df.columns) or HISTORY_PART not in history.columns:
        raise ResultError(f"columns differ from those of the history {target.dotted()}")
    time_type = history.schema["valid_from"].dataType
    now, still_open = as_of.cast(time_type), F.lit(None).cast(time_type)
    asked = spark.range(1).select(_micros(now, time_type).alias("at"), now.cast("string").alias("text")).first()
    prepared = target.sibling("__snapshot")
    with time_limit(spark, timeout_s, target.table):
        finished = _finish(spark, prepared, target)
    if finished is not None and finished[0] == asked["at"]:
        return finished[1]
    history = spark.table(target.sql())
    current = history.where(F.col(HISTORY_PART).startswith("open-"))

    # the last run's time is the newest of the open rows' and of the closed parts' names
    parts = [r["partition"].split("=", 1)[1] for r in spark.sql(f"show partitions {target.sql()}").collect()]
    ended = [int(p.removeprefix("closed-")) for p in parts if p.startswith("closed-")]
    latest = current.agg(F.max("valid_from").alias("from")).select(_micros(F.col("from"), time_type)).first()[0]
    last = max([*ended, *([] if latest is None else [latest])], default=None)
    if asked["at"] is None or (last is not None and asked["at"] <= last):
        raise ConfigError(f"as_of {asked['text']} is not later than the last run of {target.dotted()}")
    ending = f"closed-{asked['at']}"
    if buckets is None:
        buckets = max([int(p.removeprefix("open-")) + 1 for p in parts if p.startswith("open-")], default=1)

    was = current.select(
        F.col(key).alias("_was_key"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_was"), "valid_from", HISTORY_PART
    )
    now_is = once.select("_is_key", F.struct(*[F.col("_is").getField(c).alias(c) for c in columns]).alias("_is"))
    both = was.join(now_is, F.col("_was_key").eqNullSafe(F.col("_is_key")), "full_outer")
    place = F.coalesce(F.col(HISTORY_PART), home(buckets))
    same = F.col("_was").eqNullSafe(F.col("_is"))
    versions = F.array_compact(F.array(
        F.when(F.col("_was").isNotNull(), F.struct(
            F.col("_was").alias("row"), F.col("valid_from").alias("since"), now.alias("until"), F.lit(ending).alias("part"),
        )),
        F.when(F.col("_is").isNotNull(), F.struct(
            F.col("_is").alias("row"), now.alias("since"), still_open.alias("until"), place.alias("part"),
        )),
    ))
    # one join gives the changes; they are written down, then the whole rows of the parts they touch
    changed = both.where(~same).select(place.alias("_home"), F.explode(versions).alias("v")).select(
        "v.row.*", F.col("v.since").alias("valid_from"), F.col("v.until").alias("valid_to"),
        F.col("v.part").alias(HISTORY_PART), "_home",
    )
    with Scratch(spark, "snapshot") as scratch, time_limit(spark, timeout_s, target.table):
        new = scratch.keep(changed, "changes")
        touched = sorted(r["_home"] for r in new.select("_home").distinct().collect())  # open parts: few
        if not touched:
            return 0
        gone = new.where(F.col(HISTORY_PART) == ending).select(F.col(key).alias("_gone"))
        left = history.where(F.col(HISTORY_PART).isin(*touched))
        left = left.join(gone, F.col(key).eqNullSafe(F.col("_gone")), "left_anti")
        whole = left.unionByName(new.drop("_home")).select(*history.columns)
        _save(whole, prepared, "error", "parquet")
        spark.sql(
            f"alter table {prepared.sql()} set tblproperties ('{PREPARED_AS_OF}' = '{asked['at']}', '{PREPARED_PARTS}' = '{json.dumps(touched)}')"
        )
        return _finish(spark, prepared, target)[1]


def _finish(spark: SparkSession, prepared: RelationName, target: RelationName) -> tuple[int, int] | None:
    """Replace the parts that a snapshot has prepared; its time and rows, or None if there are none.

    A prepared table without its mark was not written to the end, and nothing was replaced yet.
    """
    if kind_of(spark, prepared) is None:
        return None
    told = {r["key"]: r["value"] for r in spark.sql(f"show tblproperties {prepared.sql()}").collect()}
    if PREPARED_AS_OF not in told:
        drop(spark, prepared)
        return None
    overwrite_partitions(spark, prepared, target)
    filled = spark.table(prepared.sql()).groupBy(HISTORY_PART).count().collect()
    for part in sorted(set(json.loads(told[PREPARED_PARTS])) - {r[0] for r in filled}):  # all keys have vanished
        spark.sql(f"alter table {target.sql()} drop if exists partition ({HISTORY_PART} = '{part}')")
    drop(spark, prepared)
    return int(told[PREPARED_AS_OF]), sum(r["count"] for r in filled)
