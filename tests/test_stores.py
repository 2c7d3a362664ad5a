import tempfile
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from modelloom.errors import ConfigError, ModelError, ModelTimeout, ResultError
from modelloom.functions import cents_truncated, empty_like, fill_template, flag
from modelloom.operators import (
    append_table,
    create_view,
    drop,
    kind_of,
    parallel_map,
    passed,
    replace_table,
    snapshot,
)
from modelloom.plans import Project, only_new, report
from modelloom.shared import scratch_path, shared_dir
from modelloom.operators import materialize
from modelloom.sources import read_relation, relation_name
from modelloom.streaming import append_stream, stream_files


def numbers(spark, *xs):
    return spark.createDataFrame([(x,) for x in xs], "x bigint")


def tables(spark, schema):
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)


# --- tables -----------------------------------------------------------------------


def test_replace_and_append(spark, schema, rows):
    name = f"{schema}.t"
    assert replace_table(numbers(spark, 1, 2), name) == 2
    assert replace_table(numbers(spark, 10).withColumn("y", F.lit("new")), name) == 1
    assert rows(spark.table(name)) == [(10, "new")]
    assert append_table(numbers(spark, 11, 12).select(F.lit("more").alias("y"), "x"), name) == 2
    assert rows(spark.table(name)) == [(10, "new"), (11, "more"), (12, "more")]
    assert tables(spark, schema) == ["t"]


def test_append_creates(spark, schema, rows):
    assert append_table(numbers(spark, 1), f"{schema}.t") == 1
    assert append_table(numbers(spark, 2, 3), f"{schema}.t") == 2
    assert rows(spark.table(f"{schema}.t")) == [(1,), (2,), (3,)]


def test_append_of_other_columns(spark, schema):
    append_table(numbers(spark, 1), f"{schema}.t")
    with pytest.raises(ResultError, match="not in the table"):
        append_table(numbers(spark, 1).withColumn("y", F.lit(1)), f"{schema}.t")


def test_empty_frames(spark, schema):
    name = f"{schema}.t"
    assert replace_table(empty_like(numbers(spark, 1)), name) == 0
    assert append_table(empty_like(numbers(spark, 1)), name) == 0
    assert spark.table(name).columns == ["x"] and spark.table(name).isEmpty()


def test_table_computed_from_itself(spark, schema, rows):
    name = f"{schema}.t"
    replace_table(numbers(spark, 1, 2), name)
    replace_table(spark.table(name).selectExpr("x * 10 as x"), name)
    append_table(spark.table(name).selectExpr("x + 1 as x"), name)
    assert rows(spark.table(name)) == [(10,), (11,), (20,), (21,)]


def test_failed_replacement_leaves_the_old_table(spark, schema, rows):
    name = f"{schema}.t"
    replace_table(numbers(spark, 1, 2), name)
    with pytest.raises(Exception, match="boom"):
        replace_table(numbers(spark, 3).select(F.raise_error(F.lit("boom")).cast("int").alias("x")), name)
    assert rows(spark.table(name)) == [(1,), (2,)]
    assert tables(spark, schema) == ["t"]


def test_table_format_that_is_not_installed(spark, schema, rows):
    name = f"{schema}.t"
    replace_table(numbers(spark, 1), name)
    with pytest.raises(Exception):
        replace_table(numbers(spark, 2), name, format="iceberg")
    assert rows(spark.table(name)) == [(1,)]
    assert tables(spark, schema) == ["t"]


@pytest.mark.parametrize("kind", ["table", "view"])
def test_failed_rename_brings_the_old_relation_back(spark, schema, rows, monkeypatch, kind):
    from modelloom.operators import materialize

    name = f"{schema}.t"
    if kind == "table":
        replace_table(numbers(spark, 1), name)
    else:
        create_view(spark, name, "select 1L as x")
    rename = materialize._rename

    def breaks(spark, kind, old, new):
        if "__stg_" in old.table:
            raise RuntimeError("catalog gone")
        rename(spark, kind, old, new)

    monkeypatch.setattr(materialize, "_rename", breaks)
    with pytest.raises(RuntimeError, match="catalog gone"):
        replace_table(numbers(spark, 2), name)
    assert rows(spark.table(name)) == [(1,)]
    assert kind_of(spark, name) == kind
    assert tables(spark, schema) == ["t"]


def test_views(spark, schema, rows):
    name = f"{schema}.v"
    create_view(spark, name, "select 1 as a")
    create_view(spark, name, "select 2 as b")
    assert kind_of(spark, name) == "view" and rows(spark.table(name)) == [(2,)]
    replace_table(numbers(spark, 5), name)
    assert kind_of(spark, name) == "table"
    create_view(spark, name, "select 3 as c")
    assert kind_of(spark, name) == "view"
    drop(spark, name)
    drop(spark, name)
    assert kind_of(spark, name) is None


def test_missing_schema_is_made(spark, schema):
    name = f"{schema}_new.t"
    spark.sql(f"create schema {schema}_new location '{scratch_path(spark)}'")
    spark.sql(f"drop schema {schema}_new")
    from modelloom.operators import create_schema

    create_schema(spark, name)
    assert spark.catalog.databaseExists(f"{schema}_new")
    create_schema(spark, "just_a_name")
    spark.sql(f"drop schema {schema}_new")


def test_three_part_names(spark, schema, rows):
    name = f"spark_catalog.{schema}.t"
    replace_table(numbers(spark, 1), name)
    replace_table(numbers(spark, 2), name)
    append_table(numbers(spark, 3), name)
    assert rows(read_relation(spark, name)) == [(2,), (3,)]
    assert kind_of(spark, name) == "table"


def test_time_limit(spark, schema):
    def slow(row):
        time.sleep(0.2)
        return row

    start = time.time()
    with pytest.raises(ModelTimeout):
        replace_table(
            parallel_map(spark.range(0, 200, numPartitions=2), slow), f"{schema}.t", timeout_s=2
        )
    assert time.time() - start < 15
    assert tables(spark, schema) == []
    assert replace_table(numbers(spark, 1), f"{schema}.t", timeout_s=60) == 1


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    from modelloom import shared

    assert shared_dir(spark)

    class Cluster:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ConfigError):
        shared.shared_dir(Cluster)
    Cluster.sparkContext.master = "local[2]"
    monkeypatch.setattr(shared, "_local_folder", None)
    assert shared.shared_dir(Cluster).startswith(tempfile.gettempdir())


# --- history ------------------------------------------------------------------------


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def test_snapshot(spark, schema):
    name = f"{schema}.h"
    states = [
        ([(1, "a"), (2, "b"), (3, None)], "2024-01-01"),
        ([(1, "a"), (2, "B"), (4, "d"), (3, None)], "2024-02-01"),
        ([(1, "a"), (2, "B"), (4, "d"), (3, None)], "2024-02-15"),  # nothing new
        ([(1, None), (3, "c")], "2024-03-01"),
        ([], "2024-04-01"),
        ([(2, "b")], "2024-05-01"),
    ]
    for state, time_ in states:
        snapshot(spark.createDataFrame(state, "k int, v string"), name, "k", at(time_))
    got = [(r.k, r.v, r.valid_from.month, r.valid_to and r.valid_to.month)
           for r in spark.table(name).collect()]
    assert sorted(got, key=repr) == sorted([
        (1, "a", 1, 3), (1, None, 3, 4),
        (2, "b", 1, 2), (2, "B", 2, 3), (2, "b", 5, None),
        (3, None, 1, 3), (3, "c", 3, 4),
        (4, "d", 2, 3),
    ], key=repr)


def test_snapshot_rewrites_what_changed(spark, schema):
    name = f"{schema}.h"
    before = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    assert snapshot(before, name, "k", at("2024-01-01"), buckets=50) == 1000
    after = before.withColumn("v", F.when(F.col("k") == 7, "b").otherwise(F.col("v")))
    assert 2 <= snapshot(after, name, "k", at("2024-02-01"), buckets=8) < 60  # its part, and the row it closes
    assert snapshot(after, name, "k", at("2024-03-01")) == 0
    more = after.unionAll(spark.createDataFrame([(5000, "n"), (None, "m")], "k bigint, v string")).where("k is null or k <> 9")
    snapshot(more, name, "k", at("2024-04-01"), buckets=8)
    stored = spark.table(name)
    assert stored.where("valid_to is null").select("k", "v").exceptAll(more).isEmpty()
    assert stored.where("valid_to is null").count() == 1001
    assert sorted((r.k, r.v, r.valid_to.month) for r in stored.where("valid_to is not null").collect()) == [(7, "a", 2), (9, "a", 4)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_snapshot_times_in_other_zones(spark, schema, kind):
    name, zone = f"{schema}.h", "spark.sql.session.timeZone"
    when = spark.conf.get(zone)
    micros = F.unix_micros(F.col("valid_to")) if kind == "timestamp" else F.col("valid_to").cast("string")
    try:
        spark.conf.set(zone, "America/New_York")
        snapshot(spark.createDataFrame([(1, "a")], "k int, v string"), name, "k", F.lit("2024-01-01").cast(kind))
        snapshot(spark.createDataFrame([(1, "b")], "k int, v string"), name, "k", F.lit("2024-02-01").cast(kind))
        first = spark.table(name).where("v = 'a'").select(micros).first()[0]
        spark.conf.set(zone, "Asia/Tokyo")
        assert spark.table(name).where("v = 'a'").select(micros).first()[0] == first
        with pytest.raises(ConfigError):
            snapshot(spark.createDataFrame([(1, "c")], "k int, v string"), name, "k", F.lit("2024-02-01").cast(kind))
    finally:
        spark.conf.set(zone, when)


def test_a_run_that_died_between_renames(spark, schema):
    name = f"{schema}.m"
    project = Project(schema)
    project.sql_model("m", "select 2 as x", materialized="incremental")
    replace_table(spark.sql("select 1 as x"), name)
    materialize._mark(spark, "table", relation_name(name))
    spark.sql(f"alter table {name} rename to {schema}.m__bak_0123abcd")
    project.run(spark)  # adds to what was there
    assert sorted(r.x for r in spark.table(name).collect()) == [1, 2]
    assert tables(spark, schema) == ["m"]


def test_other_tables_with_such_names_stay(spark, schema):
    append_table(numbers(spark, 1, 2, 3, 4, 5), f"{schema}.orders__bak_2024")
    append_table(numbers(spark, *range(7)), f"{schema}.sales__bak_jan")
    replace_table(numbers(spark, 10), f"{schema}.orders")
    replace_table(numbers(spark, 11), f"{schema}.orders")
    project = Project(schema)
    project.sql_model("sales", "select 1L as x", materialized="incremental")
    project.run(spark)
    assert spark.table(f"{schema}.sales").count() == 1 and spark.table(f"{schema}.orders").first()[0] == 11
    assert spark.table(f"{schema}.orders__bak_2024").count() == 5 and spark.table(f"{schema}.sales__bak_jan").count() == 7
    assert tables(spark, schema) == ["orders", "orders__bak_2024", "sales", "sales__bak_jan"]


def test_the_newest_backup_comes_back_and_stale_ones_go(spark, schema):
    target = relation_name(f"{schema}.t")
    for mark, value in (("b_stale", 1), ("a_newest", 3)):
        append_table(numbers(spark, *range(value)), target)
        materialize._mark(spark, "table", target)
        spark.sql(f"alter table {target.sql()} rename to {schema}.t__bak_{mark}")
    materialize.recover(spark, target)
    assert spark.table(f"{schema}.t").count() == 3 and tables(spark, schema) == ["t"]
    # left behind beside a table that is there
    append_table(numbers(spark, 9), f"{schema}.u")
    materialize._mark(spark, "table", relation_name(f"{schema}.u"))
    spark.sql(f"alter table {schema}.u rename to {schema}.u__bak_1")
    append_table(numbers(spark, 8), f"{schema}.u")
    replace_table(numbers(spark, 7), f"{schema}.u")
    assert tables(spark, schema) == ["t", "u"] and spark.table(f"{schema}.u").first()[0] == 7


def test_a_snapshot_that_died_is_finished(spark, schema, monkeypatch):
    name = f"{schema}.h"
    states = [spark.createDataFrame([(i, f"{i % (7 + v)}") for i in range(v, 200)], "k int, v string") for v in range(4)]
    for other in ("h", "whole"):
        snapshot(states[0], f"{schema}.{other}", "k", at("2024-01-01"), buckets=6)
    for state, when in zip(states[1:], ("2024-02-01", "2024-03-01", "2024-04-01")):
        snapshot(state, f"{schema}.whole", "k", at(when))
    swap = materialize.overwrite_partitions

    def half(spark, rows, target):  # dies after some of the parts
        some = relation_name(f"{schema}.some")
        spark.table(rows.sql()).where("history_part in ('open-0', 'open-3')").write.saveAsTable(some.sql())
        swap(spark, some, target)
        drop(spark, some)
        raise OSError("lost")

    for repeated in ("2024-02-01", "2024-02-01"):
        monkeypatch.setattr(materialize, "overwrite_partitions", half)
        with pytest.raises(OSError):
            snapshot(states[1], name, "k", at(repeated))
    monkeypatch.setattr(materialize, "overwrite_partitions", swap)
    assert snapshot(states[1], name, "k", at("2024-02-01")) > 0  # the same run again
    monkeypatch.setattr(materialize, "overwrite_partitions", half)
    with pytest.raises(OSError):
        snapshot(states[2], name, "k", at("2024-03-01"))
    monkeypatch.setattr(materialize, "overwrite_partitions", swap)
    snapshot(states[3], name, "k", at("2024-04-01"))  # finishes the one before, too
    order = ["k", "v", "valid_from", "valid_to"]
    assert spark.table(name).select(order).exceptAll(spark.table(f"{schema}.whole").select(order)).isEmpty()
    assert spark.table(name).count() == spark.table(f"{schema}.whole").count()
    assert tables(spark, schema) == ["h", "whole"]


def test_partitions_stay(spark, schema):
    name = f"{schema}.parts"
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "x int, p string")
    replace_table(df, name, partition_by=["p"])
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (2, "b"), (3, None)]
    replace_table(spark.table(name).withColumn("x", F.col("x") + 10), name)  # reads what it replaces
    assert sorted(r.partition for r in spark.sql(f"show partitions {name}").collect()) == [
        "p=__HIVE_DEFAULT_PARTITION__", "p=a", "p=b"]
    assert sorted(map(tuple, spark.table(name).collect())) == [(11, "a"), (12, "b"), (13, None)]
    append_table(spark.createDataFrame([("c", 9)], "p string, x int"), name)
    assert spark.table(name).where("p = 'c'").count() == 1 and spark.table(name).count() == 4
    replace_table(df.drop("p"), name)
    assert spark.table(name).columns == ["x"] and spark.table(name).count() == 3


def test_models_with_partitions(spark, schema):
    project = Project(schema)
    project.sql_model("m", "{{ config(materialized='incremental', partition_by=['p']) }} select 1 as x, 'a' as p")
    for _ in range(2):
        project.run(spark)
    name = project.relation("m").sql()
    assert [r.partition for r in spark.sql(f"show partitions {name}").collect()] == ["p=a"]
    assert spark.table(name).count() == 2


def test_writers_leave_the_session_alone(spark, schema):
    mode = "spark.sql.sources.partitionOverwriteMode"
    before, seen = spark.conf.get(mode), set()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    with ThreadPoolExecutor(4) as pool:
        for month in (1, 2, 3):
            jobs = [pool.submit(snapshot, df.withColumn("v", F.lit(f"{month}")), f"{schema}.h{i}", "k", at(f"2024-0{month}-01")) for i in range(4)]
            while not all(j.done() for j in jobs):
                seen.add(spark.conf.get(mode))
                time.sleep(0.01)
            [j.result() for j in jobs]
    assert seen <= {before} and spark.conf.get(mode) == before
    assert [spark.table(f"{schema}.h{i}").count() for i in range(4)] == [6] * 4


def test_snapshot_rejects(spark, schema):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ConfigError):
        snapshot(df.withColumn("valid_to", F.lit(1)), f"{schema}.h", "k", at("2024-01-01"))
    snapshot(df, f"{schema}.h", "k", at("2024-01-01"))
    with pytest.raises(ResultError):
        snapshot(df.withColumn("w", F.lit(1)), f"{schema}.h", "k", at("2024-02-01"))
    with pytest.raises(Exception, match="repeated key 1"):
        snapshot(df.unionAll(df), f"{schema}.h", "k", at("2024-02-01"))
    changed = spark.createDataFrame([(1, "b")], "k int, v string")
    snapshot(changed, f"{schema}.h", "k", at("2024-03-01"))
    for repeated in ("2024-03-01", "2024-02-15"):  # the same time, an earlier one
        with pytest.raises(ConfigError):
            snapshot(df, f"{schema}.h", "k", at(repeated))
    assert spark.table(f"{schema}.h").count() == 2


# --- projects -------------------------------------------------------------------------


def small_project(schema, greeting="Hello, {}!"):
    project = Project(schema)
    # fixed values of the golden project
    project.sql_model("stg_orders", """
        select * from values (1, 'alice', 120.50), (2, 'bob', 40.00), (3, 'carol', 500.00), (4, 'dave', 5.00)
        as t(id, customer_name, amount)""")

    @project.model(refs=["stg_orders"], tests={
        "id": ["not_null", "unique"], "customer_name": ["not_null"], "is_large": ["not_null"]})
    def enriched_orders(ctx, spark):
        return ctx.ref("stg_orders").withColumns({
            "amount": F.col("amount").cast("double"),
            "amount_cents": cents_truncated("amount"),
            "is_large": flag(F.col("amount") > 100),
            "greeting": fill_template(greeting, "customer_name"),
        })

    project.sql_model("order_summary", """
        select sum(amount) as total_amount, sum(amount_cents) as total_amount_cents,
            count_if(is_large) as large_order_count, count(*) as row_count
        from {{ ref('enriched_orders') }}""", materialized="table",
        tests={"total_amount": ["not_null"], "row_count": ["not_null"]})
    return project


def test_golden_project(spark, schema, rows):
    project = small_project(schema)
    runs = project.run(spark)
    enriched = rows(spark.table(f"{schema}.enriched_orders"))
    assert enriched[0] == (1, "alice", 120.50, 12050, True, "Hello, alice!")
    assert enriched[3] == (4, "dave", 5.00, 500, False, "Hello, dave!")
    assert rows(spark.table(f"{schema}.order_summary")) == [(665.50, 66550, 2, 4)]  # fixed values
    assert kind_of(spark, f"{schema}.stg_orders") == "view"
    assert [(r.model, r.materialized, r.rows) for r in runs] == [
        ("stg_orders", "view", None), ("enriched_orders", "table", 4), ("order_summary", "table", 1)]
    assert report(spark, runs).columns == ["model", "materialized", "rows", "runtime_s"]

    project.run(spark)
    assert spark.table(f"{schema}.enriched_orders").count() == 4
    results = project.test(spark)
    assert results.count() == 6 and passed(results)

    changed = small_project(schema, "Hi there, {}!")
    assert [r.model for r in changed.run(spark, select=["enriched_orders"])] == ["enriched_orders"]
    assert {r.greeting for r in spark.table(f"{schema}.enriched_orders").collect()} == {
        f"Hi there, {n}!" for n in ("alice", "bob", "carol", "dave")}


def test_incremental_model(spark, schema, rows):
    data = [(1, "2024-01-01"), (2, "2024-01-05")]
    seen = []
    project = Project(schema)

    @project.model()
    def events(ctx, spark):
        return spark.createDataFrame(data, "id int, day string").withColumn("day", F.to_date("day"))

    @project.model(refs=["events"], materialized="incremental")
    def facts(ctx, spark):
        seen.append(ctx.is_incremental)
        df = ctx.ref("events")
        if ctx.is_incremental:
            return only_new(df, ctx.this, newer_by="day", key="id", look_back=F.expr("interval 3 days"))
        return df

    def ids():
        return sorted(r.id for r in spark.table(f"{schema}.facts").collect())

    project.run(spark)
    assert ids() == [1, 2]
    data += [(3, "2024-01-03"), (4, "2024-01-07"), (5, "2023-12-01")]  # 3 is late, 5 too late
    assert [r.rows for r in project.run(spark)] == [5, 2]
    assert ids() == [1, 2, 3, 4]
    assert [r.rows for r in project.run(spark)] == [5, 0]
    assert [r.rows for r in project.run(spark, full_refresh=True)] == [5, 5]
    assert ids() == [1, 2, 3, 4, 5]
    assert seen == [False, True, True, False]


@pytest.mark.parametrize("kind, values", [
    ("int", [1, 2, 3]), ("double", [0.1, 0.2, 0.30000000000000004]), ("string", ["a", "b", "c"]),
    ("timestamp", ["2024-03-10 01:30:00", "2024-03-10 03:30:00.123456", "2024-11-03 01:30:00"]),
    ("timestamp_ntz", ["2024-03-10 01:30:00", "2024-03-10 02:30:00", "2024-03-10 02:30:00.000001"]),
])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_only_new_for_any_order_type(spark, kind, values, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, str(v)) for i, v in enumerate(values)], "i int, v string")
        df = df.withColumn("v", F.col("v").cast(kind))
        for stored in range(4):
            new = only_new(df, df.where(F.col("i") < stored), newer_by="v")
            assert sorted(r.i for r in new.collect()) == list(range(stored, 3))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_only_new_with_nulls_and_ties(spark):
    stored = spark.createDataFrame([(1, 10), (2, 20), (None, 20), (4, None)], "k int, v int")
    df = stored.unionAll(spark.createDataFrame([(5, 20), (6, None), (7, 30), (8, 5)], "k int, v int"))

    def keys(**how):
        return sorted(r.k for r in only_new(df, stored, newer_by="v", **how).collect())

    assert keys(key="k") == [5, 6, 7]
    assert keys(key="k", look_back=F.lit(15)) == [5, 6, 7, 8]
    with pytest.raises(ConfigError, match="need a key"):
        keys()
    assert sorted(r.k for r in only_new(df, stored.limit(0), newer_by="v", key="k").collect() if r.k) == [1, 2, 4, 5, 6, 7, 8]


def test_only_new_in_the_hour_that_comes_twice(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 01:30 in summer time and, an hour later, in winter time
        df = spark.sql("select i, timestamp_seconds(1730611800 + 3600 * i) as v from values (0), (1), (2) as t(i)")
        for i in range(3):
            assert sorted(r.i for r in only_new(df, df.where(F.col("i") <= i), newer_by="v").collect()) == list(range(i + 1, 3))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_only_new_reaches_the_scan(spark, schema):
    replace_table(spark.range(10), f"{schema}.t")
    new = only_new(spark.table(f"{schema}.t"), spark.range(5), newer_by="id")
    assert "GreaterThan(id,4)" in new._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ConfigError):
        only_new(spark.range(5), spark.range(5), newer_by="id", look_back=F.lit(1))


def test_incremental_sql_model(spark, schema, rows):
    project = Project(schema)
    replace_table(spark.range(3), f"{schema}.src")
    project.source("raw", "src", relation=f"{schema}.src")
    project.sql_model(
        "copy", "select id from {{ source('raw', 'src') }}", materialized="incremental",
        incremental_text="""select id from {{ source("raw", "src") }}
            where id > (select max(id) from {{ this }})""",
    )
    project.run(spark)
    append_table(spark.range(3, 5), f"{schema}.src")
    assert project.run(spark)[0].rows == 2
    assert rows(spark.table(f"{schema}.copy")) == [(0,), (1,), (2,), (3,), (4,)]


def test_texts_with_settings_and_comments(spark, schema, rows):
    project = Project(schema)
    project.sql_model("stg", """{{ config(materialized="view") }}
        {# inline rows,
           two of them #}
        select * from (values (1, 100), (2, 200)) as t(id, n_samples)""")
    project.sql_model("kept", """{{ config(materialized='table', timeout_s=60) }}
        select id, n_samples * 2 as n from {{ ref("stg") }} order by id""")
    assert project.models["kept"].config.timeout_s == 60
    assert [(r.model, r.rows) for r in project.run(spark)] == [("stg", None), ("kept", 2)]
    assert rows(spark.table(f"{schema}.kept")) == [(1, 200), (2, 400)]
    with pytest.raises(ConfigError, match="template expression"):
        project.sql_model("loop", "{% for x in y %} select 1 {% endfor %}")
    with pytest.raises(ConfigError, match="unknown settings"):
        project.sql_model("odd", "{{ config(materialised='table') }} select 1")
    for call in ("workers=1+x", "'table'", "workers=[", "**how"):
        with pytest.raises(ConfigError, match="literal values"):
            project.sql_model("odd", "{{ config(" + call + ") }} select 1")
    with pytest.raises(ConfigError, match="positive"):
        project.sql_model("odd", "{{ config(workers=-1) }} select 1")


def test_properties_document(spark, schema, rows):
    replace_table(numbers(spark, 1, 2, 2, None), f"{schema}.raw_numbers")
    project = Project(schema)
    project.sql_model("staged", "select x from {{ source('raw', 'numbers') }}")
    project.model("doubled", refs=["staged"])(lambda ctx, spark: ctx.ref("staged").selectExpr("x * 2 as y"))
    project.declare({
        "version": 2,
        "sources": [{"name": "raw", "schema": schema,
                     "tables": [{"name": "numbers", "identifier": "raw_numbers", "description": "-"}]}],
        "models": [
            {"name": "staged", "columns": [{"name": "x", "tests": ["not_null"]}]},
            {"name": "doubled", "config": {"materialized": "incremental", "workers": "5"},
             "columns": [{"name": "y", "data_tests": ["not_null", "unique"]}, {"name": "z"}]},
        ],
    })
    assert project.models["doubled"].config.workers == 5
    project.run(spark)
    project.run(spark, select=["doubled"])
    assert spark.table(f"{schema}.doubled").count() == 8
    assert rows(project.test(spark)) == [
        ("doubled", "y", "not_null", 2), ("doubled", "y", "unique", 2), ("staged", "x", "not_null", 1)]
    with pytest.raises(ConfigError):
        project.declare({"models": [{"name": "nobody"}]})


def test_order_and_alias(spark, schema):
    project = Project(schema, database="spark_catalog")
    project.sql_model("last", "select * from {{ ref('middle') }}", alias="final")
    project.sql_model("middle", "select * from {{ ref('first') }}")
    project.sql_model("first", "select 1 as a")
    assert project.order() == ["first", "middle", "last"]
    project.run(spark)
    assert spark.table(f"{schema}.final").count() == 1


def test_declarations_are_checked(spark, schema):
    project = Project(schema)
    with pytest.raises(ConfigError, match="cannot be stored as a view"):
        project.model(materialized="view")(lambda ctx, spark: None)
    project.sql_model("a", "select * from {{ ref('b') }}")
    with pytest.raises(ConfigError, match="no model named `b`"):
        project.order()
    project.sql_model("b", "select * from {{ ref('a') }}")
    with pytest.raises(ConfigError, match="circle"):
        project.run(spark)
    project.sql_model("b", "select * from {{ source('raw', 't') }}")
    with pytest.raises(ConfigError, match="undeclared source raw.t"):
        project.run(spark)
    with pytest.raises(ConfigError):
        project.run(spark, select=["zzz"])


@pytest.mark.parametrize("body, text", [
    (lambda ctx, spark: [1], "must return a Spark DataFrame, got list"),
    (lambda ctx, spark: None, "got NoneType"),
    (lambda ctx, spark: ctx.ref("other"), "not among the declared refs"),
    (lambda ctx, spark: ctx.source("raw", "t"), "not among the declared sources"),
    (lambda ctx, spark: 1 / 0, "division by zero"),
    (lambda ctx, spark: parallel_map(spark.range(3), lambda r: {"id": 1 // r["id"]}), "ZeroDivisionError"),
])
def test_failures_name_the_model(spark, schema, rows, body, text):
    project = Project(schema)
    replace_table(numbers(spark, 1), f"{schema}.fragile")
    project.model("fragile")(body)
    with pytest.raises(ModelError, match="model `fragile` failed") as caught:
        project.run(spark)
    assert text in str(caught.value)
    assert rows(spark.table(f"{schema}.fragile")) == [(1,)]


def test_model_time_limit(spark, schema):
    project = Project(schema)

    @project.model(timeout_s=2)
    def sleepy(ctx, spark):
        return ctx.parallel_map(spark.range(0, 100, numPartitions=1), lambda r: time.sleep(0.2) or r)

    with pytest.raises(ModelTimeout, match="`sleepy`"):
        project.run(spark)


def test_time_limit_holds_for_jobs_of_the_body(spark, schema):
    project = Project(schema)

    @project.model(timeout_s=2)
    def counting(ctx, spark):
        slow = ctx.parallel_map(spark.range(0, 100, numPartitions=1), lambda r: time.sleep(0.2) or r)
        return spark.range(slow.count())

    start = time.time()
    with pytest.raises(ModelTimeout, match="`counting`"):
        project.run(spark)
    assert time.time() - start < 15


def test_context_map_takes_the_model_settings(spark, schema):
    project = Project(schema)
    seen = {}

    @project.model(workers=3, batch_size=4, cpus_per_worker=2)
    def mapped(ctx, spark):
        df = ctx.parallel_map(
            spark.range(0, 40, numPartitions=8), lambda rs: [{"n": len(rs)}], schema="n int", mode="list"
        )
        seen["partitions"] = df.rdd.getNumPartitions()
        return df

    project.run(spark)
    assert seen["partitions"] == 3
    assert max(r.n for r in spark.table(f"{schema}.mapped").collect()) == 4


# --- streams ---------------------------------------------------------------------------


def test_stream_appends_only_new_files(spark, schema):
    folder, checkpoint, name = scratch_path(spark), scratch_path(spark), f"{schema}.t"
    spark.range(0, 100, numPartitions=5).write.parquet(folder)

    def run():
        append_stream(stream_files(spark, folder, "id bigint", max_files=2), name, checkpoint)
        return spark.table(name)

    first = run()
    assert sorted(r.id for r in first.collect()) == list(range(100))
    assert first.columns == ["id"]
    append_table(spark.range(500, 502), name)  # the table takes other rows, too
    assert spark.table(name).where("id >= 500").count() == 2
    replace_table(spark.table(name).where("id < 500"), name)
    assert run().count() == 100
    spark.range(100, 110).coalesce(1).write.mode("append").parquet(folder)
    assert sorted(r.id for r in run().collect()) == list(range(110))


def test_repeated_batch_does_not_double(spark, schema):
    """A crash after a batch was written but before it was noted as done."""
    import os
    import re

    folder, checkpoint, name = scratch_path(spark), scratch_path(spark), f"{schema}.t"
    spark.range(0, 30, numPartitions=3).write.parquet(folder)
    stream = lambda: stream_files(spark, folder, "id bigint", max_files=1)
    append_stream(stream(), name, checkpoint)
    commits = os.path.join(re.sub("^file:", "", checkpoint), "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    os.remove(os.path.join(commits, last))
    crc = os.path.join(commits, f".{last}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    append_stream(stream(), name, checkpoint)
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(30))


def test_a_batch_that_died_while_its_files_were_moved(spark, schema, monkeypatch):
    from modelloom.streaming.incremental import FileTable

    folder, checkpoint, name = scratch_path(spark), scratch_path(spark), f"{schema}.t"
    spark.range(0, 40, numPartitions=4).selectExpr("id", "id % 2 as p").write.parquet(folder)
    stream = lambda: stream_files(spark, folder, "id bigint, p bigint", max_files=2)
    move, lost = FileTable._move, []

    def half(self, fs, paths, staged, stamp):
        if not lost:  # the first file only
            one = next(f for f in (found.next().getPath() for found in [fs.listFiles(staged, True)] for _ in range(9) if found.hasNext()) if f.getName()[0] not in "_.")
            home = paths(f"{self.location}/{one.getParent().getName()}")
            fs.mkdirs(home)
            lost.append(fs.rename(one, paths(home, f"{stamp}-{one.getName()}")))
            raise OSError("lost")
        move(self, fs, paths, staged, stamp)

    monkeypatch.setattr(FileTable, "_move", half)
    with pytest.raises(Exception):
        append_stream(stream(), name, checkpoint, partition_by=["p"])
    append_stream(stream(), name, checkpoint)
    assert lost == [True] and sorted(r.id for r in spark.table(name).collect()) == list(range(40))
    assert {r.partition for r in spark.sql(f"show partitions {name}").collect()} == {"p=0", "p=1"}
    spark.range(40, 50, numPartitions=1).selectExpr("id", "id % 3 as p").write.mode("append").parquet(folder)
    append_stream(stream(), name, checkpoint)
    assert sorted(map(tuple, spark.table(name).collect())) == sorted([(i, i % 2) for i in range(40)] + [(i, i % 3) for i in range(40, 50)])
    with pytest.raises(ConfigError):
        append_stream(stream(), f"{schema}.other", checkpoint, format="delta")


def test_two_streams_into_one_table(spark, schema):
    name = f"{schema}.t"
    for start in (0, 10):
        folder = scratch_path(spark)
        spark.range(start, start + 10).write.parquet(folder)
        append_stream(stream_files(spark, folder, "id bigint"), name, scratch_path(spark))
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(20))


def test_map_on_a_stream(spark, schema):
    folder = scratch_path(spark)
    spark.range(0, 20, numPartitions=2).write.parquet(folder)
    for i, how in enumerate([{}, {"input_cols": ["id"]}, {"workers": 3}, {"on_error": "column"}]):
        stream = parallel_map(stream_files(spark, folder, "id bigint"), lambda r: {"y": r["id"] * 2}, adds="y bigint", **how)
        append_stream(stream, f"{schema}.t{i}", scratch_path(spark))
        assert spark.table(f"{schema}.t{i}").where("y = id * 2").count() == 20
