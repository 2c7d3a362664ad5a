"""The parallel map, scoring, enrichment and feature jobs."""

from __future__ import annotations

import json
import math

import numpy as np

from pyspark.sql import functions as F

from modelloom.functions import bucketize, empty_like, flag
from modelloom.operators import (
    churn_score,
    embed_text,
    enrich,
    fit_centroids,
    lead_sentence,
    logistic,
    lookup,
    monte_carlo_pi,
    nearest_centroid,
    order_activity,
    parallel_map,
    ticket_prompt,
)
from modelloom.operators.scoring import (
    CHURN_DEFAULT_RECENCY,
    CHURN_ORDER_SCALE,
    CHURN_ORDER_WEIGHT,
    CHURN_RECENCY_SCALE,
)
from showcase.registry import query, read

LINE = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]


# --- parallel map -------------------------------------------------------------


def _net_row(row):
    return {**row, "net": row["l_extendedprice"] * (1 - row["l_discount"])}


def _net_rows(rows):
    return [_net_row(row) for row in rows]


def _net_frame(frame):
    return frame.assign(net=frame["l_extendedprice"] * (1 - frame["l_discount"]))


NET_SQL = f"select {', '.join(LINE)}, l_extendedprice * (1 - l_discount) as net from lineitem"


@query("map_rows", NET_SQL)
def map_rows(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(*LINE)
    return parallel_map(lines, _net_row, adds="net double", input_cols=["l_extendedprice", "l_discount"])


@query("map_rows_whole", NET_SQL)
def map_rows_whole(spark, sf_dir):
    """The function sees and returns the whole row."""
    return parallel_map(read(spark, sf_dir, "lineitem").select(*LINE), _net_row, adds="net double")


@query("map_batches", NET_SQL)
def map_batches(spark, sf_dir):
    return parallel_map(
        read(spark, sf_dir, "lineitem"), _net_frame, adds="net double", mode="batch",
        batch_size=1000, input_cols=LINE,
    )


@query("map_batches_nulls", """
    with x as (select l_orderkey, l_linenumber, case l_linenumber % 3 when 0 then null when 1 then 'nan'::double else l_quantity end as v from lineitem)
    select l_orderkey, l_linenumber, v is null as is_null, coalesce(isnan(v), false) as is_nan, case when not isnan(v) then v * 2 end as doubled from x""")
def map_batches_nulls(spark, sf_dir):
    """Nulls and NaN go through a batch function as what they are."""
    value = F.when(F.col("l_linenumber") % 3 == 1, F.lit(float("nan"))).when(F.col("l_linenumber") % 3 == 2, F.col("l_quantity"))
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", value.alias("v"))
    twice = parallel_map(lines, lambda frame: frame.assign(v=frame["v"] * 2), schema=lines.schema, mode="batch", batch_size=1000)
    return twice.select(
        "l_orderkey", "l_linenumber", F.isnull("v").alias("is_null"), F.coalesce(F.isnan("v"), F.lit(False)).alias("is_nan"),
        F.when(~F.isnan("v"), F.col("v")).alias("doubled"),
    )


@query("map_lists", NET_SQL)
def map_lists(spark, sf_dir):
    """Batches as lists of dicts."""
    return parallel_map(
        read(spark, sf_dir, "lineitem"), _net_rows, adds="net double", mode="list",
        batch_size=100, input_cols=LINE,
    )


def _rate_table():
    return {"A": 0.25, "N": 0.0, "R": 0.5}


def _refund(row, rates):
    return {"refund": row["l_extendedprice"] * rates[row["l_returnflag"]]}


@query("map_partition_setup", """
    select l_orderkey, l_linenumber, l_returnflag, l_extendedprice * case l_returnflag
        when 'A' then 0.25::double when 'R' then 0.5::double else 0.0::double end as refund from lineitem""")
def map_partition_setup(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return parallel_map(
        lines, _refund, adds="refund double", setup=_rate_table,
        input_cols=["l_extendedprice", "l_returnflag"],
    ).drop("l_extendedprice")


def _boxes(rows):
    return [
        {"p_partkey": row["p_partkey"], "box": box}
        for row in rows
        for box in range(row["p_size"] // 20)
    ]


@query("map_flatten", """
    select p_partkey, box from (
        select p_partkey, unnest(range(cast(p_size // 20 as bigint))) as box from part)""")
def map_flatten(spark, sf_dir):
    """None, one or two rows for a part, by its size."""
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_size")
    return parallel_map(parts, _boxes, schema="p_partkey bigint, box bigint", mode="list", batch_size=500)


def _inverse_discount(row):
    if row["l_discount"] == 0:
        raise ValueError(f"no discount on line {row['l_linenumber']}")
    return {**row, "inverse": 1 / row["l_discount"]}


@query("map_error_column", """
    select l_orderkey, l_linenumber, l_discount,
        case when l_discount <> 0 then 1 / l_discount end as inverse,
        case when l_discount = 0 then 'no discount on line ' || l_linenumber end as error from lineitem""")
def map_error_column(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return parallel_map(lines, _inverse_discount, adds="inverse double", on_error="column")


@query("map_empty_input", NET_SQL)
def map_empty_input(spark, sf_dir):
    """A map over no rows has the same columns, so its result goes together with the others."""
    lines = read(spark, sf_dir, "lineitem").select(*LINE)
    nothing = parallel_map(empty_like(lines), _net_row, adds="net double")
    return nothing.unionByName(
        parallel_map(lines, _net_row, adds="net double", input_cols=["l_extendedprice", "l_discount"])
    )


def _sometimes_wrong(row):
    if row["l_linenumber"] == 1:
        return {"l_linenumber": 1, "note": "too little"}
    if row["l_linenumber"] == 2:
        return {**row, "twice": 4, "note": "too much"}
    return {**row, "twice": 2 * row["l_linenumber"]}


@query("map_result_check", """
    select l_orderkey, l_linenumber, case when l_linenumber > 2 then 2 * l_linenumber end as twice,
        case l_linenumber
            when 1 then 'result does not fit the declared columns: '
                || 'missing [''l_orderkey'', ''twice''], not declared [''note'']'
            when 2 then 'result does not fit the declared columns: missing [], not declared [''note'']'
        end as error from lineitem""")
def map_result_check(spark, sf_dir):
    """Results with columns too few or too many."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return parallel_map(lines, _sometimes_wrong, adds="twice int", on_error="column")


@query("map_worker_cap", """
    select o_orderkey, cast(o_totalprice as bigint) as amount, length(o_orderpriority) as n
    from (select o_orderkey, floor(o_totalprice) as o_totalprice, o_orderpriority from orders)""")
def map_worker_cap(spark, sf_dir):
    """At most three tasks call the function at once."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return parallel_map(
        orders,
        lambda r: {"amount": math.floor(r["o_totalprice"]), "n": len(r["o_orderpriority"])},
        adds="amount bigint, n bigint", workers=3, input_cols=["o_totalprice", "o_orderpriority"],
    ).drop("o_totalprice", "o_orderpriority")


# --- scoring --------------------------------------------------------------------

CHURN_SQL = """
    with a as (select o_custkey, sum(o_totalprice) as total_spend, count(*) as order_count,
            date_diff('day', cast(max(o_orderdate) as date),
                (select cast(max(o_orderdate) as date) from orders)) as days
        from orders group by o_custkey)
    select c_custkey, round(total_spend, 2) as total_spend, order_count,
        cast(days as int) as days_since_last_order,
        round(least(1 - exp(-coalesce(nullif(days, 0), 365) / 90.0::double)
            + 0.1::double * exp(-coalesce(order_count, 0) / 5.0::double), 1.0::double), 4) as churn_score
    from customer left join a on c_custkey = o_custkey"""


def activity(customers, orders):
    return order_activity(
        customers.select("c_custkey"), orders,
        customer_key="c_custkey", order_customer="o_custkey",
        order_date="o_orderdate", order_amount="o_totalprice",
    ).withColumn("total_spend", F.round("total_spend", 2))


def customer_activity(spark, sf_dir):
    return activity(read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders"))


def churn_frame(frame):
    """The score over a frame at once; the constants are those of the column expression."""
    days = frame["days_since_last_order"].astype("float64").fillna(0.0)
    orders = frame["order_count"].astype("float64").fillna(0.0)
    recency = np.exp(days.mask(days == 0, CHURN_DEFAULT_RECENCY) / -CHURN_RECENCY_SCALE)
    total = (1.0 + CHURN_ORDER_WEIGHT * np.exp(orders / -CHURN_ORDER_SCALE) - recency).clip(upper=1.0)
    return frame.assign(churn_score=total.round(4))


@query("score_churn", CHURN_SQL)
def score_churn(spark, sf_dir):
    scored = churn_score("days_since_last_order", "order_count")
    return customer_activity(spark, sf_dir).withColumn("churn_score", scored)


@query("score_churn_rows", CHURN_SQL)
def score_churn_rows(spark, sf_dir):
    return parallel_map(
        customer_activity(spark, sf_dir), churn_frame, adds="churn_score double", mode="batch", batch_size=10_000,
    )


@query("score_model_batch", """
    select l_orderkey, l_linenumber, round(1.0::double / (1.0::double + exp(-(
        l_quantity * 0.03::double + l_discount * -8.0::double + l_tax * 5.0::double + -0.4::double))), 6) as score
    from lineitem""")
def score_model_batch(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    scored = logistic(lines, {"l_quantity": 0.03, "l_discount": -8.0, "l_tax": 5.0}, -0.4)
    return scored.select("l_orderkey", "l_linenumber", "score")


@query("score_embedding_centroid", """
    with e as (select vec_id, label, unnest(range(len(embedding))) as pos,
            cast(unnest(embedding) as double) as v from embeddings),
    c as (select label, pos, avg(v) as m from e group by all),
    cn as (select label, sqrt(sum(m * m)) as n from c group by label),
    vn as (select vec_id, sqrt(sum(v * v)) as n from e group by vec_id),
    s as (select e.vec_id, e.label, c.label as other, sum(e.v * c.m) as dot
        from e join c using (pos) group by all),
    r as (select s.vec_id, s.label, s.other, round(dot / vn.n / cn.n, 6) as similarity
        from s join vn on s.vec_id = vn.vec_id join cn on s.other = cn.label)
    select vec_id, label, other as nearest, similarity from (
        select *, row_number() over (partition by vec_id order by similarity desc, other) as rn from r)
    where rn = 1""")
def score_embedding_centroid(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    centroids = fit_centroids(vectors, "label", "embedding")
    return nearest_centroid(vectors, "vec_id", "embedding", centroids).drop("embedding")


# --- enrichment -----------------------------------------------------------------

# fixed values: which letters stand for which answer in the offline client
CATEGORY_MARKS = [("the ", "billing"), ("la ", "technical"), ("und ", "sales")]
SENTIMENT_MARKS = [("ing", "positive"), ("ei", "negative")]


def keyword_client():
    """An offline stand-in for a classification service: reply text for a prompt."""

    def reply(prompt):
        if "pf" in prompt:
            raise RuntimeError("service unavailable")
        if "ñ" in prompt:
            return "no idea"
        category = next((name for mark, name in CATEGORY_MARKS if mark in prompt), "other")
        sentiment = next((name for mark, name in SENTIMENT_MARKS if mark in prompt), "neutral")
        return json.dumps({"category": category, "sentiment": sentiment})

    return reply


def ticket_columns(conversations):
    """User turns as tickets with a subject and a body."""
    return conversations.where("role = 'user'").select(
        "conv_id", "turn",
        F.concat(F.lit("#"), F.col("conv_id").cast("string"), F.lit("."), F.col("turn").cast("string")).alias("subject"),
        F.col("text").alias("body"),
    )


PROMPT_SQL = "'Subject: #' || conv_id || '.' || turn || chr(10) || chr(10) || text"
TICKETS_SQL = f"""
    with t as (select conv_id, turn, {PROMPT_SQL} as prompt from conversations where role = 'user'),
    a as (select *, contains(prompt, 'pf') as down, not contains(prompt, 'pf') and contains(prompt, 'ñ') as odd
        from t)
    select conv_id, turn,
        case when down or odd then null when contains(prompt, 'the ') then 'billing'
            when contains(prompt, 'la ') then 'technical' when contains(prompt, 'und ') then 'sales'
            else 'other' end as category,
        case when down or odd then null when contains(prompt, 'ing') then 'positive'
            when contains(prompt, 'ei') then 'negative' else 'neutral' end as sentiment,
        case when down then 'service unavailable' when odd then 'reply is not valid JSON: no idea' end as error
    from a"""


def classified(tickets):
    return enrich(
        tickets, ticket_prompt(F.col("subject"), F.col("body")), keyword_client,
        "category string, sentiment string",
    )


@query("enrich_classify", TICKETS_SQL)
def enrich_classify(spark, sf_dir):
    tickets = ticket_columns(read(spark, sf_dir, "conversations"))
    return classified(tickets).drop("subject", "body")


@query("enrich_prompt", f"select conv_id, turn, {PROMPT_SQL} as prompt from conversations where role = 'user'")
def enrich_prompt(spark, sf_dir):
    tickets = ticket_columns(read(spark, sf_dir, "conversations"))
    return tickets.select("conv_id", "turn", ticket_prompt(F.col("subject"), F.col("body")).alias("prompt"))


@query("enrich_embed", r"""
    with w as (select doc_id, unnest(string_split(trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g')), ' ')) as word
        from documents),
    c as (select doc_id, (unicode(word) * 31 + length(word)) % 64 as bucket, count(*) as n
        from w where word <> '' group by all),
    n as (select doc_id, sqrt(cast(sum(n * n) as double)) as norm from c group by all)
    select doc_id, cast(bucket as int) as bucket, round(n / norm, 6) as weight from c join n using (doc_id)""")
def enrich_embed(spark, sf_dir):
    """Word vectors of 64 buckets, chosen by first letter and length; shown as their non-zero entries."""
    vectors = embed_text(
        read(spark, sf_dir, "documents"), "doc_id", "text", dim=64,
        place=lambda word: (ord(word[0]) * 31 + len(word)) % 64,
    )
    entries = vectors.select("doc_id", F.posexplode("embedding").alias("bucket", "weight"))
    return entries.where("weight > 0").withColumn("weight", F.round("weight", 6))


@query("enrich_summarize", """
    select doc_id, trim(split_part(text, '. ', 1)) as summary from documents""")
def enrich_summarize(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", lead_sentence(F.col("text")).alias("summary"))


def part_service():
    """An offline stand-in for a part information service."""

    def ask(part):
        if part % 11 == 0:
            raise LookupError(f"part {part} is unknown")
        return {"tier": f"T{part % 7}", "lead_days": part % 30 + 1}

    return ask


def _ask_part(row, ask):
    return {**row, **ask(row["l_partkey"])}


LOOKUP_SQL = """
    select l_orderkey, l_linenumber, l_partkey,
        case when l_partkey % 11 <> 0 then 'T' || (l_partkey % 7) end as tier,
        case when l_partkey % 11 <> 0 then cast(l_partkey % 30 + 1 as int) end as lead_days,
        case when l_partkey % 11 = 0 then 'part ' || l_partkey || ' is unknown' end as error from lineitem"""


@query("enrich_lookup", LOOKUP_SQL)
def enrich_lookup(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookup(
        lines, "l_partkey", _ask_part, "tier string, lead_days int", setup=part_service, on_error="column"
    )


def _ask_parts(rows, ask):
    return [_ask_part(row, ask) for row in rows]


@query("enrich_lookup_batches", LOOKUP_SQL)
def enrich_lookup_batches(spark, sf_dir):
    """A hundred keys a call; the batches with an unknown part are asked again key by key."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookup(
        lines, "l_partkey", _ask_parts, "tier string, lead_days int", setup=part_service, on_error="column", batch_size=100
    )


# --- features -------------------------------------------------------------------


@query("features_wide", """
    select l_orderkey, l_linenumber,
        l_extendedprice * (1 - l_discount) as revenue,
        l_extendedprice * (1 - l_discount) * (1 + l_tax) as charge,
        l_extendedprice / l_quantity as unit_price,
        l_extendedprice * l_discount as discount_amount,
        l_extendedprice * (1 - l_discount) * l_tax as tax_amount,
        l_discount > 0 as is_discounted, l_quantity >= 30 as is_bulk,
        l_returnflag = 'R' as is_returned, l_linestatus = 'O' as is_open,
        case when l_quantity is null or l_quantity <= 0 then 'nan' when l_quantity <= 10 then 'few'
            when l_quantity <= 30 then 'some' else 'many' end as quantity_bucket,
        cast(floor(l_extendedprice / 10000) as bigint) as price_band,
        round(ln(l_extendedprice), 6) as log_price, round(sqrt(l_quantity), 6) as sqrt_quantity,
        cast(year(l_shipdate) as int) as ship_year, cast(month(l_shipdate) as int) as ship_month,
        cast(quarter(l_shipdate) as int) as ship_quarter, cast(dayofweek(l_shipdate) + 1 as int) as ship_weekday,
        dayofweek(l_shipdate) in (0, 6) as ships_on_weekend,
        l_orderkey || '-' || l_linenumber as line_key, l_returnflag || l_linestatus as state
    from lineitem""")
def features_wide(spark, sf_dir):
    price, quantity, date = F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_shipdate")
    net = price * (1 - F.col("l_discount"))
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        net.alias("revenue"),
        (net * (1 + F.col("l_tax"))).alias("charge"),
        (price / quantity).alias("unit_price"),
        (price * F.col("l_discount")).alias("discount_amount"),
        (net * F.col("l_tax")).alias("tax_amount"),
        flag(F.col("l_discount") > 0).alias("is_discounted"),
        flag(quantity >= 30).alias("is_bulk"),
        flag(F.col("l_returnflag") == "R").alias("is_returned"),
        flag(F.col("l_linestatus") == "O").alias("is_open"),
        bucketize(quantity, [0, 10, 30, float("inf")], ["few", "some", "many"]).alias("quantity_bucket"),
        F.floor(price / 10_000).alias("price_band"),
        F.round(F.ln(price), 6).alias("log_price"),
        F.round(F.sqrt(quantity), 6).alias("sqrt_quantity"),
        F.year(date).alias("ship_year"),
        F.month(date).alias("ship_month"),
        F.quarter(date).alias("ship_quarter"),
        F.dayofweek(date).alias("ship_weekday"),
        F.dayofweek(date).isin(1, 7).alias("ships_on_weekend"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("line_key"),
        F.concat("l_returnflag", "l_linestatus").alias("state"),
    )


FANOUT_SQL = """
    with s as (select l_suppkey as id, count(*) as n_samples from lineitem group by 1),
    p as (select id, cast(unnest(range(1, n_samples + 1)) as double) as k from s),
    z as (select id, id * 0.6180339887498949::double + k * 0.7548776662466927::double as z1,
        id * 0.4142135623730951::double + k * 0.5698402909980532::double as z2 from p),
    i as (select id, count(*) filter (where (z1 - floor(z1)) * (z1 - floor(z1))
        + (z2 - floor(z2)) * (z2 - floor(z2)) <= 1.0) as inside from z group by id)
    select id, n_samples, 4.0::double * coalesce(inside, 0) / greatest(n_samples, 1) as pi_estimate,
        cast(null as varchar) as error from s left join i using (id)"""


def sample_counts(spark, sf_dir):
    """One row per supplier with as many samples as it has order lines."""
    lines = read(spark, sf_dir, "lineitem")
    return lines.groupBy(F.col("l_suppkey").alias("id")).agg(F.count("*").alias("n_samples"))


@query("fanout_monte_carlo", FANOUT_SQL)
def fanout_monte_carlo(spark, sf_dir):
    return monte_carlo_pi(sample_counts(spark, sf_dir), "id", "n_samples")


@query("extract_pages", """
    select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title,
        length(regexp_replace(html, '<[^>]*>', '', 'g')) as text_chars from pages""")
def extract_pages(spark, sf_dir):
    return read(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.length(F.regexp_replace("html", "<[^>]*>", "")).cast("bigint").alias("text_chars"),
    )
