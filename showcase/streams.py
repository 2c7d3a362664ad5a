"""Event-time streams: the events table as files that arrive one after another, some rows late."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelloom.shared import scratch_path, scratch_schema
from modelloom.sources import read_relation
from modelloom.streaming import EventTime, session_stream, stream_files, window_stream
from showcase.registry import query, read

#: Five days of events a file; one in ten comes a file late, one in a hundred three files.
ARRIVAL = "cast((day(ts) - 1) {} 5 as int) + case when event_id % 100 = 7 then 3 when event_id % 10 = 3 then 1 else 0 end"
LAST_FILE = 9  # the thirty-first day's, three files late
TIME = EventTime("ts", 6 * 86_400)

#: The rows with the watermark of their file: the newest of the files before, less six days.
ARRIVED_SQL = f"""
    a as (select *, {ARRIVAL.format('//')} as arrival from events),
    m as (select arrival, max(max(ts)) over (order by arrival rows between unbounded preceding and 1 preceding) - interval 6 day as mark
        from a group by arrival),
    r as (select a.*, mark from a join m using (arrival))"""


def _run(spark, sf_dir, run):
    """Half of the files, a run, the others, another run from the same checkpoint."""
    events = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    folder, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "checkpoint")
    arrivals = events.withColumn("arrival", F.expr(ARRIVAL.format("div")))
    for half in (range(0, 5), range(5, LAST_FILE + 1)):
        for k in half:  # files are read in the order of their times
            arrivals.where(F.col("arrival") == k).drop("arrival").coalesce(1).write.mode("append").parquet(folder)
        run(stream_files(spark, folder, events.schema, max_files=1), checkpoint)


def _sums():
    return [F.count("*").alias("events"), F.round(F.sum("value"), 2).alias("total")]


@query("stream_windows", f"""
    with {ARRIVED_SQL}, k as (
      select date_trunc('day', ts) as window_start, date_trunc('day', ts) + interval 1 day as window_end, * from r
    ), t as (select * from k where mark is null or window_end > mark)
    select window_start, window_end, event_type, count(*) as events, round(sum(value), 2) as total from t
    where window_end <= (select max(ts) from t) - interval 6 day group by 1, 2, 3""")
def stream_windows(spark, sf_dir):
    """Days by type of event, each when the watermark has passed it."""
    schema = scratch_schema(spark)
    _run(spark, sf_dir, lambda stream, checkpoint: window_stream(
        stream, TIME, "1 day", _sums(), f"{schema}.days", f"{schema}.late", checkpoint, by=["event_type"]))
    return read_relation(spark, f"{schema}.days")


@query("stream_late_rows", f"""
    with {ARRIVED_SQL}
    select event_id, ts, user_id, event_type, value from r where date_trunc('day', ts) + interval 1 day <= mark""")
def stream_late_rows(spark, sf_dir):
    """The rows that came after their day was closed."""
    schema = scratch_schema(spark)
    _run(spark, sf_dir, lambda stream, checkpoint: window_stream(
        stream, TIME, "1 day", _sums(), f"{schema}.days", f"{schema}.late", checkpoint, by=["event_type"]))
    return read_relation(spark, f"{schema}.late")


@query("stream_sessions", f"""
    with {ARRIVED_SQL}, t as (select * from r where mark is null or ts > mark),
    g as (select *, case when ts - lag(ts) over (partition by user_id order by ts) < interval 12 hour then 0 else 1 end as first from t),
    s as (select *, sum(first) over (partition by user_id order by ts rows unbounded preceding) as session from g)
    select min(ts) as session_start, max(ts) + interval 12 hour as session_end, user_id, count(*) as events, round(sum(value), 2) as total
    from s group by user_id, session having max(ts) + interval 12 hour <= (select max(ts) from t) - interval 6 day""")
def stream_sessions(spark, sf_dir):
    """A user's events less than twelve hours apart, each session when the watermark has passed it."""
    schema = scratch_schema(spark)
    _run(spark, sf_dir, lambda stream, checkpoint: session_stream(
        stream, TIME, "12 hours", _sums(), f"{schema}.sessions", f"{schema}.late", checkpoint, by=["user_id"]))
    return read_relation(spark, f"{schema}.sessions")
