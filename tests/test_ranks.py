"""Global ranks against plain Python, with ties that span tasks."""

import math
import random

import pytest

from modelloom.errors import ConfigError
from modelloom.operators import add_ranks, exact_quantiles, top_k
from modelloom.shared import Scratch


@pytest.fixture
def scratch(spark):
    with Scratch(spark, "ranks") as owner:
        yield owner


def smallest_first(x):
    return (x is not None, not (x is None or not math.isnan(x)), 0 if x is None or math.isnan(x) else x)


def brute(rows, descending=False):
    """(group, value) -> its positions, rank and dense rank."""
    out = {}
    for group in {g for g, _ in rows}:
        values = sorted((v for g, v in rows if g == group), key=smallest_first, reverse=descending)
        kinds = sorted(set(map(smallest_first, values)), reverse=descending)
        for v in values:
            k = smallest_first(v)
            keys = [smallest_first(x) for x in values]
            out[group, k] = (keys.index(k) + 1, kinds.index(k) + 1, keys.count(k))
    return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("tasks", [1, 7, 40])
def test_ranks_against_plain_python(spark, scratch, descending, tasks):
    rng = random.Random(tasks)
    rows = [(rng.choice([None, "a", "b"] + ["hot"] * 5), rng.choice([None, math.nan, 0.0, -0.0, 1.5] + [2.0] * 6 + [float(rng.randint(3, 30))])) for _ in range(600)]
    df = spark.createDataFrame([(g, v, i % 3) for i, (g, v) in enumerate(rows)], "g string, v double, rank int").repartition(5)
    out = add_ranks(df, "v desc" if descending else "v", by="g", scratch=scratch, tasks=tasks).collect()
    want = brute(rows, descending)
    assert len(out) == len(rows)
    seen = {}
    for r in out:
        rank, dense, n = want[r["g"], smallest_first(r["v"])]
        assert (r["rank"], r["dense_rank"]) == (rank, dense)
        assert rank <= r["position"] < rank + n
        seen.setdefault(r["g"], []).append(r["position"])
    for g, positions in seen.items():
        assert sorted(positions) == list(range(1, len(positions) + 1))


def test_one_value_over_all_tasks(spark, scratch):
    df = spark.range(1000).selectExpr("'x' as g", "1 as v", "id")
    out = add_ranks(df, "v", by="g", scratch=scratch, tasks=8)
    assert out.selectExpr("max(rank)", "max(dense_rank)", "count(distinct position)", "max(position)").first() == (1, 1, 1000, 1000)


def test_without_groups_two_orders_and_empty(spark, scratch):
    df = spark.createDataFrame([(i % 4, f"n{i % 3}", i) for i in range(50)], "a int, b string, id int")
    got = {r["id"]: (r["rank"], r["dense_rank"]) for r in add_ranks(df, ["a desc", "b"], scratch=scratch, tasks=6).collect()}
    keys = sorted({(-(i % 4), f"n{i % 3}") for i in range(50)})
    every = sorted((-(i % 4), f"n{i % 3}") for i in range(50))
    assert got == {i: (every.index((-(i % 4), f"n{i % 3}")) + 1, keys.index((-(i % 4), f"n{i % 3}")) + 1) for i in range(50)}
    assert add_ranks(df.where("a > 9"), "a", scratch=scratch).isEmpty()
    with pytest.raises(ConfigError):
        add_ranks(df, "zz", scratch=scratch)


def test_quantiles_and_top_rows(spark, scratch):
    rows = [("a", x) for x in [5, 1, 1, 9, 7, None]] + [("b", None), (None, 4)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = exact_quantiles(df, "v", [0, 0.5, 1], by="g", scratch=scratch, tasks=3)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("a", 0.0, 1), ("a", 0.5, 5), ("a", 1.0, 9), (None, 0.0, 4), (None, 0.5, 4), (None, 1.0, 4)], key=repr)
    assert [r[1] for r in exact_quantiles(df, "v", [0.5], scratch=scratch).collect()] == [4]
    best = top_k(df.where("v is not null"), "v", 1, by="g", scratch=scratch, tasks=4)
    assert sorted((r["g"] or "", r["v"]) for r in best.collect()) == [("", 4), ("a", 1), ("a", 1)]
    single = top_k(df.where("v is not null"), "v", 1, by="g", scratch=scratch, ties=False, tasks=4)
    assert single.count() == 2
