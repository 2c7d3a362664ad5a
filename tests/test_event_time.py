"""Windows and sessions over late rows against plain Python, with runs that die and go on."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from modelloom.errors import ConfigError
from modelloom.shared import scratch_path
from modelloom.streaming import EventTime, session_stream, split_late, stream_files, window_stream
from modelloom.streaming.incremental import FileTable

START = dt.datetime(2024, 1, 1)
SCHEMA = "id int, k string, ts timestamp_ntz"


def arrivals(seed, files=7, rows=25):
    """Files of rows whose times go on by ten minutes a file, some far behind."""
    rng, out = random.Random(seed), []
    for f in range(files):
        at = [f * 600 + rng.choice([0, 0, 0, 0, -300, -1500]) + rng.randint(0, 599) for _ in range(rows)]
        out.append([(100 * f + i, rng.choice(["a", "b"]), START + dt.timedelta(seconds=t)) for i, t in enumerate(at)])
    return out


def split(files, delay, expires):
    """The rows in time and the late ones, and the last watermark."""
    newest, kept, late = None, [], []
    for rows in files:
        for row in rows:
            passed = row[2] is None or (newest is not None and expires(row[2]) <= newest - delay)
            (late if passed else kept).append(row)
        newest = max([t for _, _, t in rows if t is not None] + ([newest] if newest else []), default=None)
    return kept, late, max(t for _, _, t in kept) - delay


def feed(spark, folder, files):
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("dies", [False, True])
def test_windows_against_plain_python(spark, schema, monkeypatch, dies):
    files, folder, checkpoint = arrivals(1), scratch_path(spark), scratch_path(spark)
    files[2].append((999, "a", None))

    def run():
        window_stream(
            stream_files(spark, folder, SCHEMA, max_files=1), EventTime("ts", 700), "5 minutes",
            [F.count("*").alias("n"), F.max("id").alias("last")], f"{schema}.w", f"{schema}.late", checkpoint, by=["k"],
        )

    feed(spark, folder, files[:4])
    if dies:  # between the two tables of a batch
        add, calls = FileTable.add_once, []

        def once(self, *args):
            calls.append(args[2])
            if len(calls) == 4:
                raise OSError("lost")
            add(self, *args)

        monkeypatch.setattr(FileTable, "add_once", once)
        with pytest.raises(Exception):
            run()
        monkeypatch.setattr(FileTable, "add_once", add)
    run()
    feed(spark, folder, files[4:])
    run()
    run()  # nothing new
    five = dt.timedelta(minutes=5)
    end = lambda t: START + ((t - START) // five + 1) * five
    kept, late, mark = split(files, dt.timedelta(seconds=700), end)
    want = {}
    for i, k, t in kept:
        if end(t) <= mark:
            n, last = want.get((end(t), k), (0, -1))
            want[end(t), k] = (n + 1, max(last, i))
    got = {(r.window_end, r.k): (r.n, r.last) for r in spark.table(f"{schema}.w").collect()}
    assert got == want and spark.table(f"{schema}.w").count() == len(want)
    assert sorted(r.id for r in spark.table(f"{schema}.late").collect()) == sorted(i for i, _, _ in late) and len(late) > 1
    assert spark.table(f"{schema}.w__in_time").count() == len(kept)


def test_sessions_against_plain_python(spark, schema):
    files, folder, checkpoint = arrivals(2, rows=6), scratch_path(spark), scratch_path(spark)
    for part in (files[:3], files[3:]):
        feed(spark, folder, part)
        session_stream(
            stream_files(spark, folder, SCHEMA, max_files=1), EventTime("ts", 900), "200 seconds",
            [F.count("*").alias("n")], f"{schema}.s", f"{schema}.late", checkpoint, by=["k"],
        )
    gap = dt.timedelta(seconds=200)
    kept, late, mark = split(files, dt.timedelta(seconds=900), lambda t: t)
    want = []
    for key in ("a", "b"):
        times = sorted(t for _, k, t in kept if k == key)
        runs = [[times[0]]]
        for t in times[1:]:
            runs[-1].append(t) if t - runs[-1][-1] < gap else runs.append([t])
        want += [(r[0], r[-1] + gap, key, len(r)) for r in runs if r[-1] + gap <= mark]
    assert sorted(map(tuple, spark.table(f"{schema}.s").collect())) == sorted(want) and late and want


def test_splits(spark, schema):
    with pytest.raises(ConfigError):
        EventTime("ts", -1)
    folder = scratch_path(spark)
    feed(spark, folder, [[(1, "a", None)], [(2, "a", START)], [(3, "a", START - dt.timedelta(days=1)), (4, "a", START)]])
    stream = stream_files(spark, folder, SCHEMA, max_files=1)
    split_late(stream, EventTime("ts", 0), F.col("ts"), f"{schema}.kept", f"{schema}.late", scratch_path(spark))
    assert [r.id for r in spark.table(f"{schema}.kept").collect()] == [2]
    assert sorted(r.id for r in spark.table(f"{schema}.late").collect()) == [1, 3, 4]
