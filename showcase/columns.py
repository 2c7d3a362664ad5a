"""Sources, projections, filters, aggregations, joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from modelloom.functions import (
    as_text,
    bucketize,
    cents_rounded,
    cents_truncated,
    default_if_falsy,
    empty_like,
    fill_template,
    flag,
    json_fields,
)
from modelloom.operators import append_table, create_view, merge, parallel_map, replace_table
from modelloom.plans import Project
from modelloom.shared import scratch_schema
from modelloom.sources import read_relation
from showcase.registry import path, query, read

# bucket edges for order totals, which run up to 500,000
EDGES = [-1, 50_000, 200_000, float("inf")]
SIZES = ["small", "medium", "large"]
BUCKET_SQL = """case when o_totalprice is null or o_totalprice <= -1 then 'nan'
    when o_totalprice <= 50000 then 'small' when o_totalprice <= 200000 then 'medium'
    else 'large' end"""


# --- sources ------------------------------------------------------------------


@query("src_read_relation", "select * from orders")
def src_read_relation(spark, sf_dir):
    name = f"{scratch_schema(spark)}.orders"
    create_view(spark, name, f"select * from parquet.`{path(sf_dir, 'orders')}`")
    return read_relation(spark, name)


@query("src_relation_name", """
    select 1 as parts, * from customer union all
    select 2, * from customer union all select 3, * from customer""")
def src_relation_name(spark, sf_dir):
    schema = scratch_schema(spark)
    create_view(spark, f"{schema}.customer", f"select * from parquet.`{path(sf_dir, 'customer')}`")
    alone = f"customer_{uuid.uuid4().hex[:12]}"
    read(spark, sf_dir, "customer").createOrReplaceTempView(alone)
    names = [f'"{alone}"', f"`{schema}`.customer", f'"spark_catalog".{schema}."customer"']
    one, two, three = [
        read_relation(spark, name).select(F.lit(i + 1).alias("parts"), "*")
        for i, name in enumerate(names)
    ]
    spark.catalog.dropTempView(alone)  # the frame has its plan already
    return one.union(two).union(three)


@query("src_ref", """
    select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'""")
def src_ref(spark, sf_dir):
    project = Project(scratch_schema(spark))
    project.source("raw", "orders", path=path(sf_dir, "orders"))
    project.sql_model(
        "stg_orders", "select o_orderkey, o_totalprice, o_orderstatus from {{ source('raw', 'orders') }}"
    )

    @project.model(refs=["stg_orders"])
    def finished(ctx, spark):
        return ctx.ref("stg_orders").where("o_orderstatus = 'F'").drop("o_orderstatus")

    project.run(spark)
    return read_relation(spark, project.relation("finished"))


@query("src_source", """
    select c_custkey, c_name, c_acctbal from customer where c_acctbal > 0""")
def src_source(spark, sf_dir):
    project = Project(scratch_schema(spark))
    project.source("raw", "customer", path=path(sf_dir, "customer"))

    @project.model(sources=[("raw", "customer")])
    def solvent(ctx, spark):
        return ctx.source("raw", "customer").where("c_acctbal > 0").select("c_custkey", "c_name", "c_acctbal")

    project.run(spark)
    return read_relation(spark, project.relation("solvent"))


@query("src_parquet", "select * from part")
def src_parquet(spark, sf_dir):
    return spark.read.parquet(path(sf_dir, "part"))


@query("src_inline_values", """
    select o_orderkey, o_orderpriority, weight from orders join (values
        ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 2), ('5-LOW', 1)
    ) as t(o_orderpriority, weight) using (o_orderpriority)""")
def src_inline_values(spark, sf_dir):
    weights = spark.sql("""
        select * from values
            ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 2), ('5-LOW', 1)
        as t(o_orderpriority, weight)""")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return merge(orders, weights, "o_orderpriority")


# --- projections ----------------------------------------------------------------


@query("proj_passthrough", "select * from supplier")
def proj_passthrough(spark, sf_dir):
    project = Project(scratch_schema(spark))
    project.source("raw", "supplier", path=path(sf_dir, "supplier"))
    project.sql_model("stg_supplier", "select * from {{ source('raw', 'supplier') }}")
    project.model("same", refs=["stg_supplier"])(lambda ctx, spark: ctx.ref("stg_supplier"))
    project.run(spark)
    return read_relation(spark, project.relation("same"))


@query("proj_select", "select c_custkey, c_name, c_acctbal, c_mktsegment from customer")
def proj_select(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query("proj_assign", """
    select *, cast(trunc(c_acctbal * 100) as bigint) as balance_cents,
        coalesce(c_acctbal > 5000, false) as is_large, 'Hello, ' || c_name || '!' as greeting
    from customer""")
def proj_assign(spark, sf_dir):
    return read(spark, sf_dir, "customer").withColumns({
        "balance_cents": cents_truncated("c_acctbal"),
        "is_large": flag(F.col("c_acctbal") > 5000),
        "greeting": fill_template("Hello, {}!", "c_name"),
    })


@query("proj_cents_trunc", """
    select o_orderkey as id, cast(trunc(o_totalprice * 100) as bigint) as cents from orders
    union all select c_custkey, cast(trunc(c_acctbal * 100) as bigint) from customer""")
def proj_cents_trunc(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), cents_truncated("o_totalprice").alias("cents")
    )
    return orders.union(
        read(spark, sf_dir, "customer").select("c_custkey", cents_truncated("c_acctbal"))
    )


@query("proj_cents_round", """
    select o_orderkey as id, cast(round_even(o_totalprice * 100, 0) as bigint) as cents from orders
    union all select c_custkey, cast(round_even(c_acctbal * 100, 0) as bigint) from customer""")
def proj_cents_round(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), cents_rounded("o_totalprice").alias("cents")
    )
    return orders.union(
        read(spark, sf_dir, "customer").select("c_custkey", cents_rounded("c_acctbal"))
    )


@query("proj_flag_compare", """
    select o_orderkey, coalesce(o_totalprice > 250000, false) as is_large,
        coalesce(o_orderstatus = 'F', false) as is_done from orders""")
def proj_flag_compare(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        flag(F.col("o_totalprice") > 250_000).alias("is_large"),
        flag(F.col("o_orderstatus") == "F").alias("is_done"),
    )


@query("proj_format_string", """
    select c_custkey, 'Hello, ' || c_name || ' of ' || c_mktsegment || '!' as greeting from customer""")
def proj_format_string(spark, sf_dir):
    return read(spark, sf_dir, "customer").select(
        "c_custkey", fill_template("Hello, {} of {}!", "c_name", "c_mktsegment").alias("greeting")
    )


@query("proj_bucketize", f"select o_orderkey, {BUCKET_SQL} as amount_bucket from orders")
def proj_bucketize(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", bucketize("o_totalprice", EDGES, SIZES).alias("amount_bucket")
    )


@query("proj_cast_string", """
    select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey,
        cast(cast(o_orderdate as date) as varchar) as o_orderdate, o_orderstatus from orders""")
def proj_cast_string(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderstatus"
    )
    return as_text(orders, "o_orderkey", "o_custkey", "o_orderdate")


@query("expr_case_when", """
    select o_orderkey, case when o_totalprice > 250000 then 1 else 0 end as large_flag from orders""")
def expr_case_when(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_totalprice") > 250_000, 1).otherwise(0).alias("large_flag")
    )


@query("expr_default_if_falsy", """
    select l_orderkey, l_linenumber, coalesce(nullif(l_discount, 0), 0.5) as discount,
        coalesce(nullif(l_linestatus, 'O'), 'open') as status from lineitem""")
def expr_default_if_falsy(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        default_if_falsy("l_discount", 0.5).alias("discount"),
        default_if_falsy("l_linestatus", "open", falsy="O").alias("status"),
    )


@query("expr_math", """
    select l_orderkey, l_linenumber,
        round(least(1 - exp(-l_quantity / 20.0::double) + l_tax, 1.0::double), 4) as v from lineitem""")
def expr_math(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.round(
            F.least(1.0 - F.exp(-F.col("l_quantity") / 20.0) + F.col("l_tax"), F.lit(1.0)), 4
        ).alias("v"),
    )


@query("expr_json_fields", """
    select event_id, cast(json_extract_string(coalesce(props, '{}'), '$.k') as int) as k,
        json_extract_string(coalesce(props, '{}'), '$.missing') as missing from events""")
def expr_json_fields(spark, sf_dir):
    fields = json_fields("props", "k int, missing string")
    return read(spark, sf_dir, "events").select("event_id", fields.alias("f")).select("event_id", "f.*")


# --- filters --------------------------------------------------------------------


def _doubled(row):
    if row["value"] > 20:
        raise ValueError(f"value {row['value']} is out of range")
    return {"doubled": row["value"] * 2}


def _enriched_events(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", "value")
    return parallel_map(events, _doubled, adds="doubled double", on_error="column", input_cols=["value"])


@query("filter_ok_rows", """
    select event_id, value, value * 2 as doubled from events where value <= 20""")
def filter_ok_rows(spark, sf_dir):
    return _enriched_events(spark, sf_dir).where(F.col("error").isNull()).drop("error")


@query("filter_failed_rows", """
    select event_id, value, 'out of range' as reason from events where value > 20""")
def filter_failed_rows(spark, sf_dir):
    failed = _enriched_events(spark, sf_dir).where(F.col("error").isNotNull())
    return failed.select("event_id", "value", F.substring_index("error", " is ", -1).alias("reason"))


@query("filter_predicate", """
    select 0 as rows_at_creation, * from orders""")
def filter_predicate(spark, sf_dir):
    """An empty table of the same columns, then filled by an append."""
    orders = read(spark, sf_dir, "orders")
    name = f"{scratch_schema(spark)}.orders"
    at_creation = replace_table(empty_like(orders), name)
    append_table(orders, name)
    return spark.table(name).select(F.lit(at_creation).alias("rows_at_creation"), "*")


# --- aggregations, sort, set operations, joins -------------------------------------


@query("agg_group", f"""
    select o_orderstatus, {BUCKET_SQL} as amount_bucket, count(*) as order_count,
        round(sum(o_totalprice), 2) as total_amount from orders group by 1, 2""")
def agg_group(spark, sf_dir):
    bucket = bucketize("o_totalprice", EDGES, SIZES).alias("amount_bucket")
    return (
        read(spark, sf_dir, "orders")
        .groupBy("o_orderstatus", bucket)
        .agg(F.count("*").alias("order_count"), F.round(F.sum("o_totalprice"), 2).alias("total_amount"))
    )


@query("agg_global", """
    select round(sum(o_totalprice), 2) as total_amount,
        cast(sum(cast(trunc(o_totalprice * 100) as bigint)) as bigint) as total_cents,
        count(*) as row_count from orders""")
def agg_global(spark, sf_dir):
    return read(spark, sf_dir, "orders").agg(
        F.round(F.sum("o_totalprice"), 2).alias("total_amount"),
        F.sum(cents_truncated("o_totalprice")).alias("total_cents"),
        F.count("*").alias("row_count"),
    )


@query("agg_conditional", """
    select l_returnflag, cast(sum(case when l_quantity > 25 then 1 else 0 end) as bigint) as large_lines,
        count(*) as lines from lineitem group by 1""")
def agg_conditional(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count_if(F.col("l_quantity") > 25).alias("large_lines"), F.count("*").alias("lines")
    )


@query("sort_order_by", """
    select o_orderpriority, o_orderstatus, count(*) as order_count from orders
    group by 1, 2 order by o_orderpriority, o_orderstatus""")
def sort_order_by(spark, sf_dir):
    counts = read(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus")
    return counts.agg(F.count("*").alias("order_count")).orderBy("o_orderpriority", "o_orderstatus")


@query("setop_union_all", """
    select c_custkey as id, c_name as name from customer
    union all select s_suppkey, s_name from supplier""")
def setop_union_all(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return customers.union(read(spark, sf_dir, "supplier").select("s_suppkey", "s_name"))


@query("join_merge_inner", """
    with bal as (select nullif(n_regionkey, 0) as zone, count(*) as customers,
            round(sum(c_acctbal), 2) as balance
        from customer join nation on c_nationkey = n_nationkey group by 1),
    sup as (select nullif(n_regionkey, 0) as zone, count(*) as suppliers,
            round(sum(s_acctbal), 2) as balance
        from supplier join nation on s_nationkey = n_nationkey group by 1)
    select bal.zone, customers, bal.balance as balance_x, suppliers, sup.balance as balance_y
    from bal join sup on bal.zone is not distinct from sup.zone""")
def join_merge_inner(spark, sf_dir):
    """Two frames with a null key on both sides and a column name in common."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", F.nullif("n_regionkey", F.lit(0)).alias("zone"))

    def by_zone(table, nation_key, balance, count):
        located = read(spark, sf_dir, table).join(nation, F.col(nation_key) == F.col("n_nationkey"))
        return located.groupBy("zone").agg(
            F.count("*").alias(count), F.round(F.sum(balance), 2).alias("balance")
        )

    customers = by_zone("customer", "c_nationkey", "c_acctbal", "customers")
    suppliers = by_zone("supplier", "s_nationkey", "s_acctbal", "suppliers")
    return merge(customers, suppliers, "zone", null_safe=True)


# --- SQL texts ----------------------------------------------------------------------


def _sql_model(spark, sf_dir, tables, text):
    project = Project(scratch_schema(spark))
    for table in tables:
        project.source("raw", table, path=path(sf_dir, table))
    project.sql_model("result", text)
    project.run(spark)
    return read_relation(spark, project.relation("result"))


@query("sqlmodel_join_agg", """
    select r_name, n_name, count(*) as orders, round(sum(o_totalprice), 2) as revenue
    from customer join orders on c_custkey = o_custkey
        join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    group by r_name, n_name""")
def sqlmodel_join_agg(spark, sf_dir):
    return _sql_model(spark, sf_dir, ["customer", "orders", "nation", "region"], """
        select r_name, n_name, count(*) as orders, round(sum(o_totalprice), 2) as revenue
        from {{ source('raw', 'customer') }}
            join {{ source('raw', 'orders') }} on c_custkey = o_custkey
            join {{ source('raw', 'nation') }} on c_nationkey = n_nationkey
            join {{ source('raw', 'region') }} on n_regionkey = r_regionkey
        group by r_name, n_name""")


@query("sqlmodel_window", """
    select o_custkey, o_orderkey, o_totalprice from (
        select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn
        from orders) where rn = 1""")
def sqlmodel_window(spark, sf_dir):
    # with the rank bounded, Spark keeps one row per customer and task before the shuffle
    return _sql_model(spark, sf_dir, ["orders"], """
        select o_custkey, o_orderkey, o_totalprice from (
            select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn
            from {{ source('raw', 'orders') }}) where rn = 1""")


@query("sqlmodel_semi_anti", """
    select c_custkey, c_name, c_custkey in (
        select o_custkey from orders where o_orderpriority = '1-URGENT') as has_urgent from customer""")
def sqlmodel_semi_anti(spark, sf_dir):
    return _sql_model(spark, sf_dir, ["customer", "orders"], """
        select c_custkey, c_name, true as has_urgent from {{ source('raw', 'customer') }}
            left semi join {{ source('raw', 'orders') }}
            on c_custkey = o_custkey and o_orderpriority = '1-URGENT'
        union all
        select c_custkey, c_name, false from {{ source('raw', 'customer') }}
            left anti join {{ source('raw', 'orders') }}
            on c_custkey = o_custkey and o_orderpriority = '1-URGENT'""")
