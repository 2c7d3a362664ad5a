"""As-of and interval joins against plain Python, with keys that span tasks and bins."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from modelloom.errors import ConfigError
from modelloom.operators import asof_join, interval_join
from modelloom.shared import Scratch


@pytest.fixture
def scratch(spark):
    with Scratch(spark, "joins") as owner:
        yield owner


def some_rows(rng, n, first):
    return [(first + i, rng.choice([None, "a", "b"] + ["hot"] * 6), rng.choice([None] + list(range(60)))) for i in range(n)]


def nearest(row, others, direction, exact, tolerance):
    _, key, t = row
    fits = [
        (u, i) for i, k, u in others
        if None not in (key, t, k, u) and k == key and ((u < t if direction == "backward" else u > t) or (exact and u == t))
        and (tolerance is None or abs(u - t) <= tolerance)
    ]
    if not fits:
        return None
    best = (max if direction == "backward" else min)(u for u, _ in fits)
    return max(i for u, i in fits if u == best)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact, tolerance, tasks", [(True, None, 9), (False, None, 30), (True, 3, 1)])
def test_asof_against_plain_python(spark, scratch, direction, exact, tolerance, tasks):
    rng = random.Random(tasks)
    left, right = some_rows(rng, 300, 0), some_rows(rng, 60, 1000)
    left += left[:5]
    a = spark.createDataFrame(left, "id int, k string, t int").repartition(3)
    b = spark.createDataFrame([(i, k, t, f"row {i}") for i, k, t in right], "id int, key string, t int, note string").repartition(2)
    out = asof_join(
        a, b, "t", by=[("k", "key")], direction=direction, exact=exact, tolerance=None if tolerance is None else F.lit(tolerance),
        prefer="id", scratch=scratch, tasks=tasks,
    )
    assert out.columns == ["id", "k", "t", "id_right", "key", "t_right", "note"]
    got = sorted((r["id"], r["id_right"], r["note"]) for r in out.select("id", F.coalesce("id_right", F.lit(-1)).alias("id_right"), F.coalesce("note", F.lit("")).alias("note")).collect())
    want = [(row[0], nearest(row, right, direction, exact, tolerance)) for row in left]
    assert got == sorted((i, -1 if m is None else m, "" if m is None else f"row {m}") for i, m in want)


def test_asof_one_key_over_all_tasks(spark, scratch):
    a = spark.range(2000).selectExpr("id", "id as t")
    b = spark.createDataFrame([(5, 5)], "t bigint, v int")
    out = asof_join(a, b, "t", scratch=scratch, tasks=16)
    assert out.where("v = 5").count() == 1995 and out.where("v is null").count() == 5
    assert asof_join(a, b.limit(0), "t", scratch=scratch).where("v is null").count() == 2000
    assert asof_join(a.limit(0), b, "t", scratch=scratch).isEmpty()
    for wrong in ({"on": "x"}, {"on": "t", "direction": "up"}, {"on": "t", "by": "k"}):
        with pytest.raises(ConfigError):
            asof_join(a, b, scratch=scratch, **wrong)
    with pytest.raises(ConfigError):
        asof_join(a, b.selectExpr("cast(t as string) as t"), "t", scratch=scratch)


def spans(rng, n, first, longest):
    return [(first + i, rng.choice([None, "a", "b"] + ["hot"] * 6), *rng.choice([(None, 3), (3, None), (7, 7), (9, 8)] + [(s := rng.randint(0, 50), s + rng.randint(1, longest))] * 9)) for i in range(n)]


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("per_bin, longest", [(10_000, 10), (7, 6), (3, 60), (40, 60)])
def test_intervals_against_plain_python(spark, scratch, closed, per_bin, longest):
    rng = random.Random(per_bin + closed)
    left, right = spans(rng, 150, 0, longest), spans(rng, 120, 1000, longest)
    left += left[:4]
    a = spark.createDataFrame(left, "id int, k string, s int, e int").repartition(3)
    b = spark.createDataFrame(right, "id int, k string, from int, to int").repartition(2)
    out = interval_join(a, b, ("s", "e"), ("from", "to"), by="k", closed=closed, per_bin=per_bin, scratch=scratch, tasks=5)
    assert out.columns == ["id", "k", "s", "e", "id_right", "k_right", "from", "to"]
    want = []
    for i, k, s, e in left:
        for j, q, f, t in right:
            if None in (k, q, s, e, f, t) or k != q:
                continue
            if (closed and s <= e and f <= t and s <= t and f <= e) or (not closed and s < e and f < t and s < t and f < e):
                want.append((i, j))
    assert sorted((r["id"], r["id_right"]) for r in out.collect()) == sorted(want) and want


def test_intervals_without_keys_and_of_times(spark, scratch):
    day = lambda d: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=d)
    a = spark.createDataFrame([(i, day(i), day(i + 3)) for i in range(200)], "id int, s timestamp_ntz, e timestamp_ntz")
    b = a.selectExpr("id as other", "s as s2", "e as e2")
    out = interval_join(a, b, ("s", "e"), ("s2", "e2"), per_bin=16, scratch=scratch)
    assert {(r["id"], r["other"]) for r in out.collect()} == {(i, j) for i in range(200) for j in range(max(0, i - 2), min(200, i + 3))}
    assert interval_join(a.limit(0), b, ("s", "e"), ("s2", "e2"), scratch=scratch).isEmpty()
    with pytest.raises(ConfigError):
        interval_join(a, b, ("s", "e"), ("s2", "other"), scratch=scratch)


def test_many_rows_with_one_start(spark, scratch):
    a = spark.range(300).selectExpr("id", "1 as s", "2 as e")
    out = interval_join(a, a.withColumnRenamed("id", "other"), ("s", "e"), ("s", "e"), per_bin=50, scratch=scratch, tasks=6)
    assert out.selectExpr("count(*)", "count(distinct id, other)").first() == (90_000, 90_000)
