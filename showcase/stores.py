"""Materializations, projects, data tests, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelloom.functions import bucketize, cents_rounded, cents_truncated, fill_template, flag
from modelloom.operators import (
    churn_score,
    append_table,
    create_view,
    drop,
    monte_carlo_pi,
    not_null,
    parallel_map,
    replace_table,
    snapshot,
    suite,
    unique,
)
from modelloom.plans import Project, only_new, report
from modelloom.shared import scratch_path, scratch_schema
from modelloom.sources import read_relation
from modelloom.streaming import append_stream, stream_files
from showcase.columns import BUCKET_SQL, EDGES, SIZES
from showcase.maps import (
    CHURN_SQL,
    FANOUT_SQL,
    TICKETS_SQL,
    classified,
    activity,
    sample_counts,
    ticket_columns,
)
from showcase.registry import path, query, read

# --- materializations -----------------------------------------------------------


@query("mat_view", """
    select o_orderkey, o_totalprice from orders where o_orderpriority = '1-URGENT'""")
def mat_view(spark, sf_dir):
    name = f"{scratch_schema(spark)}.urgent"
    create_view(spark, name, f"""
        select o_orderkey, o_totalprice from parquet.`{path(sf_dir, 'orders')}`
        where o_orderpriority = '1-URGENT'""")
    return read_relation(spark, name)


@query("mat_table_replace", """
    select s_suppkey as id, s_name as name from supplier""")
def mat_table_replace(spark, sf_dir):
    """The second write has other rows and other columns."""
    name = f"{scratch_schema(spark)}.t"
    replace_table(read(spark, sf_dir, "customer"), name)
    replace_table(
        read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), name
    )
    return read_relation(spark, name)


@query("mat_table_staged", """
    select o_orderkey, o_totalprice * 2 as o_totalprice, o_orderstatus from orders
    where o_orderstatus <> 'P'""")
def mat_table_staged(spark, sf_dir):
    """The new table is computed from the one it replaces."""
    name = f"{scratch_schema(spark)}.t"
    replace_table(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), name)
    doubled = read_relation(spark, name).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    replace_table(doubled.where("o_orderstatus <> 'P'"), name)
    return read_relation(spark, name)


@query("mat_backup_swap", """
    select c_mktsegment, count(*) as customers from customer group by 1""")
def mat_backup_swap(spark, sf_dir):
    """A SQL model that was a view becomes a table, which is then swapped for a new one."""
    project = Project(scratch_schema(spark))
    project.source("raw", "customer", path=path(sf_dir, "customer"))
    text = "select c_mktsegment, count(*) as customers from {{ source('raw', 'customer') }} group by 1"
    for stored in ("view", "table", "table"):
        project.sql_model("segments", text, materialized=stored)
        project.run(spark)
    return read_relation(spark, project.relation("segments"))


@query("mat_drop", "select p_partkey, p_name from part")
def mat_drop(spark, sf_dir):
    """A view and a table are dropped, a missing one is no error, and the name is free again."""
    name = f"{scratch_schema(spark)}.t"
    create_view(spark, name, f"select * from parquet.`{path(sf_dir, 'supplier')}`")
    drop(spark, name)
    append_table(read(spark, sf_dir, "supplier"), name)
    drop(spark, name)
    drop(spark, name)
    append_table(read(spark, sf_dir, "part").select("p_partkey", "p_name"), name)
    return read_relation(spark, name)


@query("mat_incremental_append", "select o_orderkey, o_orderdate, o_totalprice from orders")
def mat_incremental_append(spark, sf_dir):
    """Two halves by date; the second has its columns in another order."""
    name = f"{scratch_schema(spark)}.t"
    orders = read(spark, sf_dir, "orders")
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    append_table(orders.where(~late).select("o_orderkey", "o_orderdate", "o_totalprice"), name)
    append_table(orders.where(late).select("o_totalprice", "o_orderkey", "o_orderdate"), name)
    return read_relation(spark, name)


def _events_project(spark, sf_dir, until):
    """An incremental model over the events up to a time, which later runs move forward."""
    project = Project(scratch_schema(spark))

    def declare(limit):
        project.sql_model(
            "stg_events", "select event_id, ts, user_id, value from {{ source('raw', 'events') }}" + limit
        )

    project.source("raw", "events", path=path(sf_dir, "events"))
    declare(f" where ts < timestamp_ntz '{until}'")

    @project.model(materialized="incremental", refs=["stg_events"])
    def fct_events(ctx, spark):
        events = ctx.ref("stg_events")
        if ctx.is_incremental:
            return only_new(
                events, ctx.this, newer_by="ts", key="event_id", look_back=F.expr("interval 2 days")
            )
        return events

    return project, declare


@query("mat_is_incremental", "select event_id, ts, user_id, value from events")
def mat_is_incremental(spark, sf_dir):
    """Two runs, the second one adding only what is new, make the same table as one."""
    project, declare = _events_project(spark, sf_dir, "2024-01-15 00:00:00")
    project.run(spark)
    declare("")
    project.run(spark)
    return read_relation(spark, project.relation("fct_events"))


@query("mat_full_refresh", "select event_id, ts, user_id, value from events")
def mat_full_refresh(spark, sf_dir):
    project, declare = _events_project(spark, sf_dir, "2024-01-15 00:00:00")
    project.run(spark)
    declare("")
    project.run(spark, full_refresh=True)
    project.run(spark, full_refresh=True)
    return read_relation(spark, project.relation("fct_events"))


@query("mat_snapshot", """
    with t as (select timestamp '2024-01-01 00:00:00' as t1, timestamp '2024-02-01 00:00:00' as t2)
    -- gone
    select c_custkey, c_acctbal, c_mktsegment, t1 as valid_from, t2 as valid_to from customer, t
        where c_mktsegment = 'MACHINERY'
    -- changed: the old state and the new one
    union all select c_custkey, c_acctbal, c_mktsegment, t1, t2 from customer, t
        where c_mktsegment not in ('MACHINERY', 'FURNITURE') and c_acctbal < 0
    union all select c_custkey, 0.0::double, c_mktsegment, t2, null from customer, t
        where c_mktsegment not in ('MACHINERY', 'FURNITURE') and c_acctbal < 0
    -- the same in both
    union all select c_custkey, c_acctbal, c_mktsegment, t1, null from customer, t
        where c_mktsegment not in ('MACHINERY', 'FURNITURE') and c_acctbal >= 0
    -- new
    union all select c_custkey, greatest(c_acctbal, 0.0::double), c_mktsegment, t2, null from customer, t
        where c_mktsegment = 'FURNITURE'""")
def mat_snapshot(spark, sf_dir):
    """Two states: one segment comes, one goes, debts are cleared."""
    name = f"{scratch_schema(spark)}.history"
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    before = customers.where("c_mktsegment <> 'FURNITURE'")
    after = customers.where("c_mktsegment <> 'MACHINERY'").withColumn(
        "c_acctbal", F.greatest("c_acctbal", F.lit(0.0))
    )
    for state, time in ((before, "2024-01-01"), (after, "2024-02-01")):
        snapshot(state, name, "c_custkey", F.lit(time).cast("timestamp_ntz"))
    return read_relation(spark, name).drop("history_part")


# --- projects -------------------------------------------------------------------


@query("model_python", """
    select o_custkey, count(*) as orders, max(o_totalprice) as largest from orders group by 1""")
def model_python(spark, sf_dir):
    project = Project(scratch_schema(spark))
    project.source("raw", "orders", path=path(sf_dir, "orders"))

    @project.model(sources=[("raw", "orders")], materialized="table")
    def customer_orders(ctx, spark):
        orders = ctx.source("raw", "orders")
        return orders.groupBy("o_custkey").agg(
            F.count("*").alias("orders"), F.max("o_totalprice").alias("largest")
        )

    project.run(spark)
    return read_relation(spark, project.relation("customer_orders"))


@query("model_sql", """
    select c_name, s_name from customer join supplier
    on c_custkey = s_suppkey and c_nationkey <> s_nationkey""")
def model_sql(spark, sf_dir):
    project = Project(scratch_schema(spark))
    for table in ("customer", "supplier"):
        project.source("raw", table, path=path(sf_dir, table))
    project.sql_model("stg_customer", "select * from {{ source('raw', 'customer') }}")
    project.sql_model("namesakes", """
        select c_name, s_name from {{ ref('stg_customer') }}
        join {{ source('raw', 'supplier') }} on c_custkey = s_suppkey and c_nationkey <> s_nationkey""",
        materialized="table")
    project.run(spark)
    return read_relation(spark, project.relation("namesakes"))


def _basic_project(spark, sf_dir):
    """Staging view, Python model, SQL summary, with declared tests."""
    project = Project(scratch_schema(spark))
    for table in ("orders", "customer"):
        project.source("raw", table, path=path(sf_dir, table))
    project.sql_model("stg_orders", """
        select o_orderkey as id, c_name as customer_name, o_totalprice as amount
        from {{ source('raw', 'orders') }} join {{ source('raw', 'customer') }} on o_custkey = c_custkey""")

    @project.model(
        refs=["stg_orders"],
        tests={"id": ["not_null", "unique"], "customer_name": ["not_null"], "is_large": ["not_null"]},
    )
    def enriched_orders(ctx, spark):
        return ctx.ref("stg_orders").withColumns({
            "amount_cents": cents_truncated("amount"),
            "is_large": flag(F.col("amount") > 100_000),
            "greeting": fill_template("Hello, {}!", "customer_name"),
        })

    # fixed values: the columns of this summary and their order
    project.sql_model("order_summary", """
        select round(sum(amount), 2) as total_amount, sum(amount_cents) as total_amount_cents,
            count_if(is_large) as large_order_count, count(*) as row_count
        from {{ ref('enriched_orders') }}""", materialized="table",
        tests={"total_amount": ["not_null"], "row_count": ["not_null"]})
    return project


@query("project_run", """
    select round(sum(o_totalprice), 2) as total_amount,
        cast(sum(cast(trunc(o_totalprice * 100) as bigint)) as bigint) as total_amount_cents,
        cast(sum(case when o_totalprice > 100000 then 1 else 0 end) as bigint) as large_order_count,
        count(*) as row_count from orders join customer on o_custkey = c_custkey""")
def project_run(spark, sf_dir):
    """All models once, then the last two again."""
    project = _basic_project(spark, sf_dir)
    project.run(spark)
    project.run(spark, select=["enriched_orders", "order_summary"])
    return read_relation(spark, project.relation("order_summary"))


@query("run_report", """
    select 'stg_orders' as model, 'view' as materialized, cast(null as bigint) as rows
    union all select 'enriched_orders', 'table', count(*) from orders join customer on o_custkey = c_custkey
    union all select 'order_summary', 'table', 1""")
def run_report(spark, sf_dir):
    return report(spark, _basic_project(spark, sf_dir).run(spark)).drop("runtime_s")


@query("project_quickstart", f"""
    select n_name as country, {BUCKET_SQL} as amount_bucket, count(*) as order_count,
        round(sum(o_totalprice), 2) as total_amount
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    group by 1, 2""")
def project_quickstart(spark, sf_dir):
    """Flagship: orders with customer and country, enriched, summed by country and bucket."""
    project = Project(scratch_schema(spark))
    for table in ("orders", "customer", "nation"):
        project.source("raw", table, path=path(sf_dir, table))
    project.sql_model("stg_orders", """
        select o_orderkey as id, c_name as customer, o_totalprice as amount, n_name as country
        from {{ source('raw', 'orders') }}
            join {{ source('raw', 'customer') }} on o_custkey = c_custkey
            join {{ source('raw', 'nation') }} on c_nationkey = n_nationkey""")

    @project.model(refs=["stg_orders"])
    def enriched_orders(ctx, spark):
        return ctx.ref("stg_orders").withColumns({
            "amount_bucket": bucketize("amount", EDGES, SIZES),
            "amount_cents": cents_rounded("amount"),
            "is_home": flag(F.col("country") == "NATION_0"),
        })

    # fixed values: the columns of this summary and their order
    project.sql_model("order_summary", """
        select country, amount_bucket, count(*) as order_count, round(sum(amount), 2) as total_amount
        from {{ ref('enriched_orders') }} group by country, amount_bucket""", materialized="table")
    project.run(spark)
    return read_relation(spark, project.relation("order_summary")).orderBy("country", "amount_bucket")


@query("project_scoring", CHURN_SQL)
def project_scoring(spark, sf_dir):
    project = Project(scratch_schema(spark))

    for table in ("customer", "orders"):
        project.source("raw", table, path=path(sf_dir, table))

    @project.model(sources=[("raw", "customer"), ("raw", "orders")])
    def stg_customers(ctx, spark):
        return activity(ctx.source("raw", "customer"), ctx.source("raw", "orders"))

    @project.model(refs=["stg_customers"])
    def scored_customers(ctx, spark):
        scored = churn_score("days_since_last_order", "order_count")
        return ctx.ref("stg_customers").withColumn("churn_score", scored)

    project.run(spark)
    return read_relation(spark, project.relation("scored_customers"))


@query("project_enrichment", f"select * from ({TICKETS_SQL}) where error is null")
def project_enrichment(spark, sf_dir):
    project = Project(scratch_schema(spark))
    project.source("raw", "conversations", path=path(sf_dir, "conversations"))

    @project.model(sources=[("raw", "conversations")])
    def stg_support_tickets(ctx, spark):
        return ticket_columns(ctx.source("raw", "conversations"))

    @project.model(refs=["stg_support_tickets"])
    def categorized_tickets(ctx, spark):
        return classified(ctx.ref("stg_support_tickets"))

    project.sql_model("clean_tickets", """
        select conv_id, turn, category, sentiment, error from {{ ref('categorized_tickets') }}
        where error is null""")
    project.run(spark)
    return read_relation(spark, project.relation("clean_tickets"))


@query("project_fanout", FANOUT_SQL)
def project_fanout(spark, sf_dir):
    project = Project(scratch_schema(spark))

    @project.model()
    def stg_inputs(ctx, spark):
        return sample_counts(spark, sf_dir)

    @project.model(refs=["stg_inputs"], workers=16)
    def computed_features(ctx, spark):
        return monte_carlo_pi(ctx.ref("stg_inputs"), "id", "n_samples", workers=ctx.config.workers)

    project.run(spark)
    return read_relation(spark, project.relation("computed_features"))


# --- data tests -----------------------------------------------------------------


@query("test_not_null", """
    select doc_id, quality, toxic from documents left join labels using (doc_id)
    where quality is null or toxic is null""")
def test_not_null(spark, sf_dir):
    """Fails for the documents without a label."""
    documents = read(spark, sf_dir, "documents").select("doc_id")
    labelled = documents.join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return not_null(labelled.select("doc_id", "quality", "toxic"), "quality", "toxic")


@query("test_unique", """
    select l_orderkey, l_linenumber, count(*) as occurrences from lineitem
    group by all having count(*) > 1""")
def test_unique(spark, sf_dir):
    return unique(read(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("test_suite", """
    with l as (select quality from documents left join labels using (doc_id)),
    d as (select l_orderkey, l_linenumber from lineitem group by all having count(*) > 1)
    select 'orders' as model, 'o_orderkey' as column, 'not_null' as test,
        count(*) filter (where o_orderkey is null) as failures from orders
    union all select 'orders', 'o_custkey', 'not_null', count(*) filter (where o_custkey is null) from orders
    union all select 'orders', 'o_orderkey', 'unique', count(*) - count(distinct o_orderkey) from orders
    union all select 'lineitem', 'l_orderkey,l_linenumber', 'unique', count(*) from d
    union all select 'documents', 'quality', 'not_null', count(*) filter (where quality is null) from l""")
def test_suite(spark, sf_dir):
    documents = read(spark, sf_dir, "documents").select("doc_id")
    labelled = documents.join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return suite({
        "orders": (
            read(spark, sf_dir, "orders"),
            {"o_orderkey": ["not_null", "unique"], "o_custkey": ["not_null"]},
        ),
        "lineitem": (read(spark, sf_dir, "lineitem"), {"l_orderkey,l_linenumber": ["unique"]}),
        "documents": (labelled, {"quality": ["not_null"]}),
    })


# --- streams --------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    # a glob, since a stream takes folders or patterns and the table may be one file
    return stream_files(
        spark, path(sf_dir, "event[s]"), read(spark, sf_dir, "events").schema, max_files=100
    )


@query("stream_incremental", "select event_id, ts, user_id, event_type, value from events")
def stream_incremental(spark, sf_dir):
    """A second run finds no new files and adds nothing."""
    name = f"{scratch_schema(spark)}.events"
    checkpoint = scratch_path(spark, "checkpoint")
    for _ in range(2):
        append_stream(_event_stream(spark, sf_dir).drop("props"), name, checkpoint)
    return read_relation(spark, name)


@query("stream_parallel_map", "select event_id, value, value * 2 + user_id as score from events")
def stream_parallel_map(spark, sf_dir):
    name = f"{scratch_schema(spark)}.scores"
    scored = parallel_map(
        _event_stream(spark, sf_dir).select("event_id", "user_id", "value"),
        lambda row: {"score": row["value"] * 2 + row["user_id"]},
        adds="score double", input_cols=["user_id", "value"],
    )
    append_stream(scored.drop("user_id"), name, scratch_path(spark, "checkpoint"))
    return read_relation(spark, name)
