"""Operators on orders, times and intervals that a hot key cannot stall."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelloom.operators import (
    add_ranks,
    asof_join,
    distinct_aggregates,
    exact_quantiles,
    interval_join,
    lattice,
    merge_lattice,
    multiset_intersect,
    semi_join,
    sketches,
    table_difference,
    top_k,
)
from modelloom.shared import Scratch
from showcase.registry import query, read

# --- global ranks -----------------------------------------------------------------


@query("rank_global", """
    select l_orderkey, l_linenumber, l_returnflag, l_quantity,
      rank() over (partition by l_returnflag order by l_quantity desc) as rank,
      dense_rank() over (partition by l_returnflag order by l_quantity desc) as dense_rank
    from lineitem""")
def rank_global(spark, sf_dir):
    """Three groups, the largest half of the table, with a few dozen values to tie on."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    return add_ranks(lines, "l_quantity desc", by="l_returnflag", scratch=Scratch(spark, "rank_global")).drop("position")


FRACTIONS = [0.01, 0.25, 0.5, 0.75, 0.99]


@query("quantile_exact", f"""
    with r as (
      select o_orderpriority, o_totalprice, row_number() over (partition by o_orderpriority order by o_totalprice) as place,
        count(*) over (partition by o_orderpriority) as n from orders
    ), f as (select unnest({FRACTIONS}::double[]) as fraction)
    select o_orderpriority, fraction, o_totalprice as value from r, f where place = greatest(ceil(fraction * n), 1)""")
def quantile_exact(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice")
    return exact_quantiles(orders, "o_totalprice", FRACTIONS, by="o_orderpriority", scratch=Scratch(spark, "quantile_exact"))


@query("topk_ties", """
    select l_suppkey, l_orderkey, l_linenumber, l_quantity, rank from (
      select *, rank() over (partition by l_suppkey order by l_quantity desc, l_shipdate) as rank from lineitem
    ) where rank <= 3""")
def topk_ties(spark, sf_dir):
    """The three largest lines of each supplier, the earliest first; equal ones share a rank."""
    lines = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    best = top_k(lines, ["l_quantity desc", "l_shipdate"], 3, by="l_suppkey", scratch=Scratch(spark, "topk_ties"))
    return best.drop("l_shipdate")


@query("rank_whole_table", """
    select o_orderkey, o_orderdate, rank() over (order by o_orderdate) as rank from orders""")
def rank_whole_table(spark, sf_dir):
    """One group: the whole table in one order, still over all tasks."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return add_ranks(orders, "o_orderdate", scratch=Scratch(spark, "rank_whole_table")).drop("position", "dense_rank")


# --- as-of and interval joins -------------------------------------------------------


@query("join_asof", """
    with m as (
      select event_id, o_orderkey, o_orderdate, row_number() over (partition by event_id order by o_orderdate desc, o_orderkey desc) as place
      from events join orders on o_custkey = user_id and o_orderdate <= ts
    )
    select e.event_id, e.user_id, e.ts, m.o_orderkey, m.o_orderdate
    from events e left join m on m.event_id = e.event_id and place = 1""")
def join_asof(spark, sf_dir):
    """Every event with its customer's latest order."""
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    found = asof_join(
        events, orders, ("ts", "o_orderdate"), by=[("user_id", "o_custkey")], prefer="o_orderkey", scratch=Scratch(spark, "join_asof"),
    )
    return found.drop("o_custkey")


@query("join_asof_forward", """
    with r as (select distinct l_suppkey, l_shipdate from lineitem where l_returnflag = 'R')
    select l.l_orderkey, l.l_linenumber, l.l_shipdate,
      (select min(r.l_shipdate) from r where r.l_suppkey = l.l_suppkey and r.l_shipdate > l.l_shipdate
        and r.l_shipdate <= l.l_shipdate + interval 3 day) as next_returned
    from lineitem l""")
def join_asof_forward(spark, sf_dir):
    """Every line with the date of the supplier's next returned one, if it is within three days."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_returnflag")
    returned = lines.where("l_returnflag = 'R'").select("l_suppkey", F.col("l_shipdate").alias("next_returned"))
    found = asof_join(
        lines, returned, ("l_shipdate", "next_returned"), by="l_suppkey", direction="forward", exact=False,
        tolerance=F.expr("interval 3 days"), scratch=Scratch(spark, "join_asof_forward"),
    )
    return found.select("l_orderkey", "l_linenumber", "l_shipdate", "next_returned")


PERIODS = """
    l as (select l_suppkey, l_orderkey, l_linenumber, l_shipdate as since, l_shipdate + to_days(cast(l_quantity as int)) as until, l_returnflag from lineitem)"""


@query("join_interval", f"""
    with {PERIODS}
    select a.l_suppkey, a.l_orderkey, a.l_linenumber, a.since, a.until, b.l_orderkey as open_orderkey, b.l_linenumber as open_linenumber,
      b.since as open_since, b.until as open_until
    from l a join l b on a.l_suppkey = b.l_suppkey and a.since < b.until and b.since < a.until
    where a.l_returnflag = 'R' and b.l_returnflag = 'N'""")
def join_interval(spark, sf_dir):
    """Returned and open lines of a supplier that were under way at the same time, a day per piece."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("since"),
        (F.col("l_shipdate") + F.make_dt_interval(F.col("l_quantity").cast("int"))).alias("until"), "l_returnflag",
    )
    returned = lines.where("l_returnflag = 'R'").drop("l_returnflag")
    still_open = lines.where("l_returnflag = 'N'").select(
        "l_suppkey", F.col("l_orderkey").alias("open_orderkey"), F.col("l_linenumber").alias("open_linenumber"),
        F.col("since").alias("open_since"), F.col("until").alias("open_until"),
    )
    met = interval_join(
        returned, still_open, ("since", "until"), ("open_since", "open_until"), by="l_suppkey", scratch=Scratch(spark, "join_interval"),
    )
    return met.drop("l_suppkey_right")


# --- aggregates ---------------------------------------------------------------------


@query("agg_sketches", """
    select '2024-01-01 to 2024-01-10' as days, count(*) as rows, count(distinct user_id) as users, true as users_near,
      true as median_near, (select event_type from events where day(ts) <= 10 group by 1 order by count(*) desc, 1 limit 1) as most,
      (select count(*) from events where day(ts) <= 10 group by event_type order by 1 desc limit 1) as most_events
    from events where day(ts) <= 10""")
def agg_sketches(spark, sf_dir):
    """Ten stored days merged without their rows, and whether that is as near to the exact answers as promised."""
    events = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    scratch = Scratch(spark, "agg_sketches")
    stored = scratch.keep(sketches.sketch(events, "day", distinct=["user_id"], quantiles=["value"], frequent=["event_type"]), "days")
    ten = sketches.merge_sketches(stored.where("day <= '2024-01-10'")).select(
        "rows", sketches.distinct_estimate("user_id").alias("users_about"), sketches.quantile_estimate("value", 0.5).alias("median"),
        sketches.frequent_estimate("event_type", 1)[0].alias("top"),
    )
    # ten short days of each side: the estimates are one row, the check scans the rows once
    exact = events.where("day <= '2024-01-10'").join(F.broadcast(ten.select("median")), F.lit(True), "inner").agg(
        F.count_distinct("user_id").alias("users"), F.avg((F.col("value") <= F.col("median")).cast("int")).alias("rank"),
    )
    return ten.join(F.broadcast(exact), F.lit(True), "inner").select(
        F.lit("2024-01-01 to 2024-01-10").alias("days"), "rows", "users",
        (F.abs(F.col("users_about") - F.col("users")) <= F.greatest(4 * sketches.DISTINCT_ERROR * F.col("users"), F.lit(1))).alias("users_near"),
        (F.abs(F.col("rank") - 0.5) <= sketches.RANK_ERROR + 0.005).alias("median_near"),
        F.col("top.item").alias("most"), F.col("top.count").alias("most_events"),
    )


DIMENSIONS = ["l_returnflag", "l_linestatus", "l_linenumber"]
MEASURES = {"lines": ("count", "*"), "quantity": ("sum", "l_quantity"), "first_day": ("min", "l_shipdate"), "dearest": ("max", "l_extendedprice")}


@query("agg_lattice", """
    select l_returnflag, l_linestatus, l_linenumber, cast(grouping_id(l_returnflag, l_linestatus, l_linenumber) as bigint) as grouping,
      count(*) as lines, sum(l_quantity) as quantity, min(l_shipdate) as first_day, max(l_extendedprice) as dearest
    from lineitem group by cube (l_returnflag, l_linestatus, l_linenumber)""")
def agg_lattice(spark, sf_dir):
    """All sets of three dimensions: those of most lines stored, those of the others merged in."""
    lines, scratch = read(spark, sf_dir, "lineitem"), Scratch(spark, "agg_lattice")
    later = F.col("l_orderkey") % 10 == 7
    stored = scratch.keep(lattice(lines.where(~later), DIMENSIONS, MEASURES, scratch=scratch), "stored")
    return merge_lattice(stored, lattice(lines.where(later), DIMENSIONS, MEASURES, scratch=scratch), DIMENSIONS, MEASURES)


@query("agg_distinct", """
    select l_returnflag, count(distinct l_orderkey) as orders, count(distinct l_partkey) as parts, sum(distinct l_quantity) as quantities
    from lineitem group by 1""")
def agg_distinct(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_partkey", "l_quantity")
    return distinct_aggregates(
        lines, "l_returnflag", {"orders": ("count", "l_orderkey"), "parts": ("count", "l_partkey"), "quantities": ("sum", "l_quantity")},
    )


# --- joins and differences ------------------------------------------------------------


@query("join_bloom_semi", """
    select l_orderkey, l_linenumber, l_quantity from lineitem
    where l_orderkey in (select o_orderkey from orders where o_orderpriority = '1-URGENT' and o_totalprice > 300000)""")
def join_bloom_semi(spark, sf_dir):
    """Lines of a few large urgent orders; most lines go before the shuffle."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT' and o_totalprice > 300000")
    return semi_join(lines, orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", scratch=Scratch(spark, "join_bloom_semi"))


@query("join_bloom_anti", """
    select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 480000)""")
def join_bloom_anti(spark, sf_dir):
    """Customers without a very large order; most are known to have none before the shuffle."""
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = read(spark, sf_dir, "orders").where("o_totalprice > 480000").select(F.col("o_custkey").alias("c_custkey"))
    return semi_join(customers, orders, "c_custkey", scratch=Scratch(spark, "join_bloom_anti"), anti=True)


VERSIONS_SQL = """
    o as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders),
    n as (select o_orderkey, o_custkey, o_orderstatus, case when o_orderkey % 890 = 5 then o_totalprice + 1 else o_totalprice end as o_totalprice
        from o where o_orderkey % 970 <> 3 union all select * from o where o_orderkey % 830 = 2)"""


def _versions(spark, sf_dir):
    old = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    raised = F.when(F.col("o_orderkey") % 890 == 5, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    new = old.where("o_orderkey % 970 <> 3").withColumn("o_totalprice", raised).unionAll(old.where("o_orderkey % 830 = 2"))
    return old, new


@query("setop_difference", f"""
    with {VERSIONS_SQL}, r as (select * from o except all select * from n), a as (select * from n except all select * from o)
    select *, 'removed' as change, count(*) as copies from r group by all
    union all select *, 'added' as change, count(*) as copies from a group by all""")
def setop_difference(spark, sf_dir):
    """Two versions of the orders: some gone, some dearer, some twice."""
    return table_difference(*_versions(spark, sf_dir), "o_orderkey", scratch=Scratch(spark, "setop_difference"))


@query("setop_intersect", """
    with s as (select l_suppkey, l_quantity from lineitem where l_returnflag = 'R'), t as (select l_suppkey, l_quantity from lineitem where l_returnflag = 'A'),
    b as (select * from s intersect all select * from t) select l_suppkey, l_quantity, count(*) as copies from b group by all""")
def setop_intersect(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    sides = [lines.where(F.col("l_returnflag") == flag).select("l_suppkey", "l_quantity") for flag in ("R", "A")]
    return multiset_intersect(*sides)
