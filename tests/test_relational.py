"""Sketches, lattices, distinct aggregates, filtered joins and differences against plain Python and Spark's own."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from modelloom.errors import ConfigError, ResultError
from modelloom.operators import bloom, diff, distinct_aggregates, lattice, merge_lattice, multiset_intersect, semi_join, sketches, table_difference
from modelloom.shared import Scratch


@pytest.fixture
def scratch(spark):
    with Scratch(spark, "relational") as owner:
        yield owner


def test_sketches_merge_within_their_errors(spark):
    df = spark.range(60_000).selectExpr("id % 7 as d", "id % 5000 as u", "cast(id as double) as v", "if(id % 3 = 0, 'hot', cast(id % 1000 as string)) as s")
    stored = sketches.sketch(df, "d", distinct=["u", "s"], quantiles=["v"], frequent=["s"])
    for some in (stored, stored.where("d in (1, 4)")):
        rows = df.join(some.select("d").distinct(), "d")
        got = sketches.merge_sketches(some).select(
            "rows", sketches.distinct_estimate("u").alias("u"), sketches.quantile_estimate("v", 0.25).alias("q"), sketches.frequent_estimate("s", 2).alias("top")
        ).first()
        n, exact = rows.agg(F.count("*"), F.count_distinct("u")).first()
        assert got["rows"] == n and abs(got["u"] - exact) <= 4 * sketches.DISTINCT_ERROR * exact
        assert abs(rows.where(F.col("v") <= got["q"]).count() / n - 0.25) <= sketches.RANK_ERROR
        assert got["top"][0]["item"] == "hot" and got["top"][0]["count"] == rows.where("s = 'hot'").count()
    nothing = sketches.merge_sketches(sketches.sketch(df.limit(0), "d", distinct=["u"]))
    assert nothing.select(F.coalesce(sketches.distinct_estimate("u"), F.lit(0)).alias("n")).first()["n"] == 0
    with pytest.raises(ConfigError):
        sketches.merge_sketches(df)


def some_rows(spark, seed, n):
    rng = random.Random(seed)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]), rng.randint(0, 4), rng.choice([None, 1.5, 2.0])) for _ in range(n)]
    return spark.createDataFrame(rows, "a string, b int, c int, v double")


def test_lattice_is_the_cube_and_takes_increments(spark, scratch):
    measures = {"n": ("count", "*"), "known": ("count", "v"), "total": ("sum", "v"), "least": ("min", "v"), "most": ("max", "c")}
    first, more = some_rows(spark, 1, 150), some_rows(spark, 2, 60)
    keys = ["a", "b", "c"]
    cube = lambda df: sorted(map(tuple, df.cube(*keys).agg(
        F.grouping_id().alias("grouping"), F.count("*").alias("n"), F.count("v").alias("known"), F.sum("v").alias("total"), F.min("v").alias("least"),
        F.max("c").alias("most")).select(*keys, "grouping", *measures).collect()), key=repr)
    one = lattice(first, keys, measures, scratch=scratch)
    assert sorted(map(tuple, one.collect()), key=repr) == cube(first)
    both = merge_lattice(one, lattice(more, keys, measures, scratch=scratch), keys, measures)
    assert sorted(map(tuple, both.select(*one.columns).collect()), key=repr) == cube(first.unionAll(more))
    some = lattice(first, keys, measures, scratch=scratch, sets=[["a"], ["b", "c"]])
    assert {r[0] for r in some.select("grouping").distinct().collect()} == {3, 4}
    empty = lattice(first.limit(0), keys, {"n": ("count", "*")}, scratch=scratch).collect()
    assert [(r["grouping"], r["n"]) for r in empty] == [(7, 0)]
    for wrong in ({"measures": {"x": ("avg", "v")}}, {"dimensions": ["zz"]}, {"sets": [["v"]]}):
        with pytest.raises(ConfigError):
            lattice(first, **({"dimensions": keys, "measures": measures, "scratch": scratch} | wrong))


def test_distinct_aggregates(spark):
    df = spark.createDataFrame(
        [("h", i % 50, float(i % 7), f"s{i % 3}") for i in range(500)] + [("a", None, None, None), (None, 1, -0.0, "x"), (None, 1, 0.0, "x"), ("a", 2, float("nan"), None)],
        "g string, i int, d double, s string",
    ).repartition(4)
    got = distinct_aggregates(df, "g", {"ni": ("count", "i"), "si": ("sum", "i"), "nd": ("count", "d"), "ns": ("count", "s")})
    want = df.groupBy("g").agg(F.count_distinct("i").alias("ni"), F.sum_distinct("i").alias("si"), F.count_distinct("d").alias("nd"), F.count_distinct("s").alias("ns"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g" in plan and plan.count("_which") > 1  # values are dealt by group and value
    assert distinct_aggregates(df.limit(0), "g", {"n": ("count", "i")}).isEmpty()
    with pytest.raises(ConfigError):
        distinct_aggregates(df, "g", {"n": ("avg", "i")})


@pytest.mark.parametrize("anti", [False, True])
@pytest.mark.parametrize("how", [{}, {"most_blocks": 1}, {"least_dropped": 0.0}, {"least_dropped": 1.1}])
def test_filtered_joins_equal_plain_ones(spark, scratch, anti, how):
    large = spark.range(5000).selectExpr("if(id % 50 = 0, null, id % 900) as k", "concat('x', id % 3) as t", "id as _block")
    small = spark.createDataFrame([(i, f"x{i % 4}") for i in range(0, 900, 7)] + [(None, "x1"), (7, None), (7, "x3"), (7, "x3")], "k bigint, t string")
    for on in (["k"], ["k", "t"]):
        got = semi_join(large, small, on, scratch=scratch, anti=anti, **how)
        want = large.join(small, on, "left_anti" if anti else "left_semi").select(*large.columns)
        assert got.columns == large.columns and got.exceptAll(want).isEmpty() and got.count() == want.count()
    assert semi_join(large, small.limit(0), "k", scratch=scratch, anti=anti, **how).count() == (5000 if anti else 0)


def test_bloom_filter_drops_most_foreign_keys(spark, scratch):
    keys = spark.range(4000).select("id")
    found = bloom.bloom_filter(keys, ["id"], scratch, 1 << 20)
    assert found.count() <= 500
    assert bloom._passing(spark.range(4000), found, ["id"]).count() == 4000
    assert bloom._passing(spark.range(10_000, 30_000), found, ["id"]).count() < 0.06 * 20_000
    with pytest.raises(ConfigError):
        semi_join(keys, keys.selectExpr("cast(id as string) as id"), "id", scratch=scratch)


@pytest.mark.parametrize("top, finer", [(1024, 64), (4, 8), (2, 1)])
def test_differences_against_counters(spark, scratch, top, finer):
    rng = random.Random(top)
    old = [(rng.choice([None, *range(300)]), rng.choice([None, "a", "b"]), rng.choice([0.5, None])) for _ in range(800)]
    new = [r for r in old if r[0] != old[9][0]] + old[:5] + [(1000, "n", None), (None, None, None)]
    rng.shuffle(new)
    a, b = (spark.createDataFrame(x, "k int, s string, v double").repartition(3) for x in (old, new))
    got = {(tuple(r)[:3], r["change"]): r["copies"] for r in table_difference(a, b.select("v", "k", "s"), "k", scratch=scratch, top=top, finer=finer).collect()}
    less, more = Counter(old) - Counter(new), Counter(new) - Counter(old)
    assert got == {**{(r, "removed"): n for r, n in less.items()}, **{(r, "added"): n for r, n in more.items()}} and less and more
    assert table_difference(a, a.repartition(7), "k", scratch=scratch, top=top, finer=finer).isEmpty()
    assert table_difference(a.limit(0), b.limit(0), "k", scratch=scratch).isEmpty()
    both = {tuple(r)[:3]: r["copies"] for r in multiset_intersect(a, b).collect()}
    assert both == dict(Counter(old) & Counter(new))
    with pytest.raises(ResultError):
        table_difference(a, b.drop("v"), "k", scratch=scratch)
    with pytest.raises(ConfigError):
        table_difference(a, b, "zz", scratch=scratch)


def test_equal_ranges_are_not_shuffled(spark, scratch):
    old = spark.range(20_000).selectExpr("id as k", "id * 2 as v")
    new = old.withColumn("v", F.when(F.col("k") == 77, -1).otherwise(F.col("v")))
    assert sorted(map(tuple, table_difference(old, new, "k", scratch=scratch).collect())) == [(77, -1, "added", 1), (77, 154, "removed", 1)]
    ranges = [spark.read.parquet(p).count() for p in scratch.paths]
    assert ranges == [1, 1]  # one top range, one fine one
    assert diff.TOP * diff.FINER == 65_536
