import datetime as dt
import os
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from pyspark.resource import ResourceProfile

from modelloom.errors import ConfigError
from modelloom.operators import parallel_map, worker_resources


def double(row):
    return {**row, "y": row["x"] * 2}


def frame(spark, n=100):
    return spark.range(n).selectExpr("id", "id * 1.5 as z", "cast(id as int) as x").selectExpr(
        "id", "cast(z as double) as z", "x"
    )


def expected(n=100):
    return sorted([(i, i * 1.5, i, i * 2) for i in range(n)], key=repr)


@pytest.mark.parametrize("how", [
    dict(fn=double),
    dict(fn=lambda r: {"y": r["x"] * 2}),
    dict(fn=double, input_cols=["x"]),
    dict(fn=lambda r: {"y": r["x"] * 2}, input_cols=["x"]),
    dict(fn=lambda rs: [double(r) for r in rs], mode="list", batch_size=7),
    dict(fn=lambda p: p.assign(y=p.x * 2), mode="batch", batch_size=7),
    dict(fn=lambda p: p.assign(y=p.x * 2), mode="batch"),
    dict(fn=lambda ps: (p.assign(y=p.x * 2) for p in ps), mode="partition", batch_size=11),
    dict(fn=double, workers=3),
])
def test_every_mode_gives_the_same(spark, rows, how):
    assert rows(parallel_map(frame(spark), adds="y bigint", **how)) == expected()


@pytest.mark.parametrize("how", [
    dict(fn=double),
    dict(fn=double, input_cols=["x"]),
    dict(fn=lambda rs: [double(r) for r in rs], mode="list"),
    dict(fn=lambda p: p.assign(y=p.x * 2), mode="batch"),
    dict(fn=lambda ps: (p.assign(y=p.x * 2) for p in ps), mode="partition"),
])
def test_empty_input_keeps_the_columns(spark, how):
    result = parallel_map(frame(spark, 0), adds="y bigint", **how)
    assert result.columns == ["id", "z", "x", "y"]
    assert result.count() == 0


def test_batch_sizes(spark):
    df = spark.range(0, 25, numPartitions=1)
    sizes = parallel_map(df, lambda p: pd.DataFrame({"n": [len(p)]}), schema="n int", mode="batch", batch_size=10)
    assert sorted(r.n for r in sizes.collect()) == [5, 10, 10]


def test_batches_across_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        df = spark.range(0, 25, numPartitions=1)
        sizes = parallel_map(df, lambda rs: [{"n": len(rs)}], schema="n int", mode="list", batch_size=10)
        assert sorted(r.n for r in sizes.collect()) == [5, 10, 10]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_more_and_fewer_rows(spark, rows):
    df = spark.range(4)
    copies = parallel_map(df, lambda rs: [r for r in rs for _ in range(r["id"])], mode="list")
    assert rows(copies) == [(1,), (2,), (2,), (3,), (3,), (3,)]
    assert parallel_map(df, lambda p: p[p.id > 99], mode="batch").count() == 0


def test_types_survive(spark):
    row = (1, None, 1.5, Decimal("12.34"), "é", True, b"\x00\x01", dt.date(2024, 2, 29),
           dt.datetime(2024, 2, 29, 12, 30, 1, 5), [1, None], {"a": 1}, (7, "s"))
    ddl = ("a bigint, b int, c double, d decimal(9,2), e string, f boolean, g binary, h date, "
           "i timestamp_ntz, j array<int>, k map<string,int>, l struct<p:int,q:string>")
    df = spark.createDataFrame([row], ddl)
    for fn in (lambda r: {**r, "n": 1}, lambda r: {"n": 1}):
        result = parallel_map(df, fn, adds="n int")
        assert result.drop("n").schema.simpleString() == df.schema.simpleString()
        assert result.drop("n").collect() == df.collect()
    listed = parallel_map(df, lambda rs: rs, mode="list")
    assert listed.collect() == df.collect()
    beside = parallel_map(df, lambda r: {"m": r["l"]["p"] + r["j"][0]}, adds="m int", input_cols=["l", "j"])
    assert beside.first().m == 8


cell = st.tuples(
    st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)),
    st.one_of(st.none(), st.floats(allow_nan=True)),
    st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=5)),
    st.one_of(st.none(), st.booleans()),
    st.one_of(st.none(), st.lists(st.one_of(st.none(), st.integers(-9, 9)), max_size=3)),
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(cell, max_size=20))
def test_any_values_go_through_unchanged(spark, data):
    df = spark.createDataFrame(data, "a bigint, b double, c string, d boolean, e array<int>").coalesce(2)
    expected = sorted(map(repr, df.collect()))
    for how in (
        dict(fn=lambda r: r), dict(fn=lambda r: {**r}, workers=2), dict(fn=lambda rs: rs, mode="list", batch_size=3),
        dict(fn=lambda r: dict(r), schema="a bigint, b double, c string, d boolean, e array<int>"),
    ):
        assert sorted(map(repr, parallel_map(df, **how).collect())) == expected


def test_timestamps_keep_their_instant_in_any_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp'2024-07-01 12:00:00' as t, 1 as x")
        result = parallel_map(df, lambda r: {**r, "u": r["t"]}, adds="u timestamp")
        assert result.where("t = u and t = timestamp'2024-07-01 12:00:00'").count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_null_integers_stay_integers(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, 9007199254740993)], "id int, n bigint")
    result = parallel_map(df, lambda r: {"m": r["n"] or 365, "kind": type(r["n"]).__name__}, adds="m bigint, kind string")
    assert {r.id: (r.n, r.m, r.kind) for r in result.collect()} == {
        1: (None, 365, "NoneType"), 2: (0, 365, "int"), 3: (9007199254740993, 9007199254740993, "int"),
    }


def test_changing_an_input_column(spark, rows):
    df = spark.createDataFrame([(1, [1, 2]), (2, [3])], "id int, v array<int>")

    def in_place(row):
        row["id"] += 10
        row["v"].append(0)
        row["n"] = len(row["v"])
        return row

    assert rows(parallel_map(df, in_place, adds="n int")) == [(11, [1, 2, 0], 3), (12, [3, 0], 2)]
    replaced = parallel_map(df, lambda r: {"v": str(r["id"])}, adds="v string")
    assert rows(replaced) == [(1, "1"), (2, "2")]
    beside = parallel_map(df, lambda r: {"v": str(r["id"])}, adds="v string", input_cols=["id"])
    assert beside.columns == ["id", "v"] and rows(beside) == [(1, "1"), (2, "2")]


def test_a_failed_row_shows_what_came_in(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [3])], "id int, v array<int>")

    def spoils(row):
        row["id"] = 99
        row["v"].append(0)
        if row["v"][0] == 3:
            raise ValueError("no")
        return {**row, "n": 1}

    got = parallel_map(df, spoils, adds="n int", on_error="column").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(2, [3], None, "no"), (99, [1, 2, 0], 1, None)]


def test_failed_rows_of_a_full_schema(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")

    def fn(row):
        return {"id": str(1 // (row["id"] - 1)), "v": row["v"]}

    for mode, call in (("row", fn), ("list", lambda rs: [fn(r) for r in rs])):
        result = parallel_map(df, call, schema="id string, v string", mode=mode, on_error="column").orderBy("v")
        first, second = result.collect()
        assert (first.id, first.v) == (None, "a") and "zero" in first.error
        assert tuple(second) == ("1", "b", None)


@pytest.mark.parametrize("mode", ["list", "batch", "partition"])
def test_bundles_are_cut_by_weight(spark, mode, monkeypatch):
    from modelloom.operators import parallel

    monkeypatch.setattr(parallel, "BUNDLE_BYTES", 100)
    df = spark.range(0, 95, numPartitions=1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    fn = {
        "list": lambda rs: [{"n": len(rs), "least": rs[0]["id"]}],
        "batch": lambda p: pd.DataFrame({"n": [len(p)], "least": [p.id[0]]}),
        "partition": lambda ps: (pd.DataFrame({"n": [len(p)], "least": [p.id[0]]}) for p in ps),
    }[mode]
    try:
        got = parallel_map(df, fn, schema="n bigint, least bigint", mode=mode, batch_size=10).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.least, r.n) for r in got) == [(i, 10) for i in range(0, 90, 10)] + [(90, 5)]


def trouble(row):
    if row["id"] % 4 == 0:
        raise ValueError(f"bad id {row['id']}")
    if row["id"] % 4 == 1:
        return {**row, "y": "text"}
    if row["id"] % 4 == 2:
        return {**row}
    return {**row, "y": row["id"]}


@pytest.mark.parametrize("input_cols", [None, ["id"]])
def test_failing_rows_are_kept_and_marked(spark, input_cols):
    df = spark.range(0, 8, numPartitions=2)
    result = parallel_map(df, trouble, adds="y bigint", on_error="column", input_cols=input_cols)
    by_id = {r.id: r for r in result.collect()}
    assert sorted(by_id) == list(range(8))
    assert {i: r.y for i, r in by_id.items() if r.y is not None} == {3: 3, 7: 7}
    assert by_id[4].error == "bad id 4"
    assert "cannot hold 'text'" in by_id[5].error
    assert "missing ['y']" in by_id[6].error
    assert by_id[7].error is None


@pytest.mark.parametrize("mode", ["list", "batch"])
def test_a_bad_row_marks_only_itself(spark, mode):
    def listed(rs):
        return [{**r, "y": 10 // r["id"]} for r in rs]

    def framed(p):
        return pd.DataFrame(listed(p.to_dict("records")))

    df = spark.range(0, 5, numPartitions=1)
    result = parallel_map(df, listed if mode == "list" else framed, adds="y bigint", mode=mode, on_error="column")
    assert sorted((r.id, r.y, r.error is None) for r in result.collect() if r.id) == [
        (1, 10, True), (2, 5, True), (3, 3, True), (4, 2, True)]
    failed = [r for r in result.collect() if r.id == 0]
    assert len(failed) == 1 and failed[0].y is None and "zero" in failed[0].error


@pytest.mark.parametrize("fn, text", [
    (lambda r: {**r, "y": 1, "more": 2}, "not declared"),
    (lambda r: {**r}, "missing"),
    (lambda r: {**r, "y": "text"}, "cannot hold"),
    (lambda r: [r], "must return a dict"),
    (lambda r: 1 // 0, "ZeroDivisionError"),
])
@pytest.mark.parametrize("input_cols", [None, ["id"]])
def test_wrong_results_fail(spark, fn, text, input_cols):
    with pytest.raises(PythonException, match=text):
        parallel_map(spark.range(3), fn, adds="y bigint", input_cols=input_cols).collect()


@pytest.mark.parametrize("fn, mode", [
    (lambda p: p, "batch"),
    (lambda p: p.assign(y=1, more=2), "batch"),
    (lambda p: p.to_dict("records"), "batch"),
    (lambda rs: rs, "list"),
    (lambda rs: {"id": 1, "y": 2}, "list"),
    (lambda ps: ps, "partition"),
])
def test_wrong_batches_fail(spark, fn, mode):
    with pytest.raises(PythonException, match="ResultError"):
        parallel_map(spark.range(3), fn, adds="y bigint", mode=mode).collect()


def test_setup_once_per_worker(spark):
    def connect():
        return {"pid": os.getpid(), "calls": 0}

    def use(row, state):
        state["calls"] += 1
        return {"pid": state["pid"], "calls": state["calls"]}

    df = spark.range(0, 400, numPartitions=40)
    seen = parallel_map(df, use, adds="pid bigint, calls bigint", setup=connect).collect()
    # more tasks than worker processes, and no state starts over within a process
    assert len({r.pid for r in seen}) < 40
    assert len({(r.pid, r.calls) for r in seen}) == 400


def test_setup_is_not_run_for_empty_partitions(spark):
    def fails():
        raise RuntimeError("no client")

    result = parallel_map(spark.range(0), lambda r, s: r, setup=fails)
    assert result.count() == 0
    with pytest.raises(PythonException, match="no client"):
        parallel_map(spark.range(1), lambda r, s: r, setup=fails, on_error="column").collect()


def test_worker_cap_is_the_partition_count(spark):
    wide = spark.range(0, 1000, numPartitions=16)
    assert parallel_map(wide, lambda r: r, workers=3).rdd.getNumPartitions() == 3
    assert parallel_map(wide, lambda r: r).rdd.getNumPartitions() == 16


def test_filter_after_the_map_does_not_run_it_twice(spark):
    df = spark.range(10)
    plan = parallel_map(df, lambda r: {"y": r["id"]}, adds="y bigint", input_cols=["id"]).where("y > 3")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1


def test_only_needed_columns_are_scanned(spark, schema):
    spark.range(5).selectExpr("id", "id as a", "id as b", "id as c").write.saveAsTable(f"{schema}.t")
    mapped = parallel_map(spark.table(f"{schema}.t"), lambda r: {"y": r["a"]}, adds="y bigint", input_cols=["a"])
    text = mapped.select("id", "y")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,a:bigint>" in text


def test_resources():
    assert worker_resources() is None
    profile = worker_resources(4, 8)
    assert isinstance(profile, ResourceProfile)
    assert profile.taskResources["cpus"].amount == 4
    assert profile.executorResources["memory"].amount == 8 * 1024


def test_local_session_ignores_resources(spark, rows):
    result = parallel_map(frame(spark), double, adds="y bigint", resources=worker_resources(2))
    assert rows(result) == expected()


@pytest.mark.parametrize("how", [
    dict(mode="rows"), dict(on_error="skip"), dict(adds="y int", schema="y int"), dict(workers=0),
    dict(mode="partition", on_error="column"), dict(batch_size=0), dict(adds="error string", on_error="column"),
])
def test_wrong_arguments(spark, how):
    with pytest.raises(ConfigError):
        parallel_map(spark.range(1), lambda r: r, **how)


@pytest.mark.parametrize("mode", ["row", "list", "batch", "partition"])
def test_nan_and_null_come_back_as_they_were(spark, mode):
    df = spark.createDataFrame([(1, float("nan"), 1.5), (2, None, None), (3, 0.5, float("nan")), (None, None, 2.0)], "k int, x double, y float").coalesce(1)
    same = {"row": lambda r: r, "list": lambda rows: rows, "batch": lambda frame: frame, "partition": lambda frames: frames}[mode]
    out = parallel_map(df, same, schema=df.schema, mode=mode)
    kinds = lambda d: sorted((r.k or 0, *[None if v is None else "nan" if v != v else v for v in (r.x, r.y)]) for r in d.collect())
    assert kinds(out) == kinds(df)


def test_added_names_are_those_of_the_session(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, net double")
    for how in ({}, {"input_cols": ["net"]}, {"on_error": "column"}):
        out = parallel_map(df, lambda r: {"Net": r["net"] * 2}, adds="Net double", **how)
        assert out.columns[:2] == ["id", "Net"] and out.select("net").first()[0] == 4.0
    try:
        spark.conf.set("spark.sql.caseSensitive", "true")
        assert parallel_map(df, lambda r: {"Net": r["net"] * 2}, adds="Net double").columns == ["id", "net", "Net"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    with pytest.raises(ConfigError):
        parallel_map(df, lambda r: r, adds="a int, A int")
    with pytest.raises(ConfigError):
        parallel_map(df.withColumnRenamed("net", "Error"), lambda r: r, adds="a int", on_error="column")
