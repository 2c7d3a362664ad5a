"""Merkle manifest of a dataset: a tree of digests per source, and one over the sources' roots.

Nodes are kept by content: a store maps a node's digest to those of its children, so equal
subtrees are one record and a proof needs nothing but the root, the store and a leaf's rank.
Requests descend from the root by the digits of their ranks. Requests that agree in the digits
so far go down as one row, which collects the unselected children; reversed, its segments are
the path from the leaf up. Levels are written one by one, each a sixteenth of the one below.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelloom.llm.common import Workspace
from modelloom.operators.ranks import add_ranks

FANOUT = 16


def row_digest(values: Sequence[Column]) -> Column:
    """Hex SHA-256 of values put together: ``-`` for a null, else byte count, ``:`` and the value as text."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*map(field, values)), 256)


@dataclass
class Manifest:
    """``store`` (digest, children), ``places`` of the leaves (their columns, ``s``: number of the
    source, ``r``: number of the leaf in it, ``n``: leaves there), ``root`` (None without leaves)."""

    root: str | None
    store: DataFrame
    places: DataFrame
    sources: int
    largest: int
    fanout: int


def _depth(n: int, fanout: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def _levels(nodes: DataFrame, levels: int, fanout: int, work: Workspace, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The levels above nodes (tree, i, n, digest), and the (tree, digest) of what remains of each tree."""
    done, made = [nodes.where("n = 1")], []
    for level in range(levels):
        above = nodes.where("n > 1").groupBy("tree", F.floor(F.col("i") / fanout).alias("i")).agg(
            F.ceil(F.any_value("n") / fanout).alias("n"),
            F.transform(F.sort_array(F.collect_list(F.struct("i", "digest"))), lambda x: x["digest"]).alias("children"),
        )
        nodes = work.keep(above.withColumn("digest", F.sha2(F.concat_ws("", "children"), 256)), f"{name}{level}")
        made.append(nodes)
        done.append(nodes.where("n = 1"))
    return made, reduce(DataFrame.unionAll, [d.select("tree", "digest") for d in done])


def build(
    spark: SparkSession, leaves: DataFrame, work: Workspace, source: str = "source", key: str = "doc_id",
    leaf: str = "leaf", fanout: int = FANOUT,
) -> Manifest:
    """The manifest of ``leaves``, which hold a source, a key and the digest of a row.

    Leaves of a source ascend by key (null first), ties by digest, so that the root does not
    depend on the order of rows; a repeated row is a leaf each time. A source of any size is
    ranked by all tasks, and a node's children are at most ``fanout`` rows. A null source is one
    like any other, before the others.
    """
    placed = add_ranks(leaves, [key, leaf], by=source, scratch=work, names=("_r", "_rank", "_dense")).drop("_rank", "_dense")
    counted = work.keep(placed.groupBy(F.col(f"`{source}`").alias("_source")).agg(F.count("*").alias("_n")), "counted")
    numbered = add_ranks(counted, "_source", scratch=work, names=("_s", "_rank", "_dense"))
    same = F.col(f"`{source}`").eqNullSafe(F.col("_source"))
    places = work.keep(placed.join(numbered, same).select(
        *[F.col(f"`{c}`") for c in leaves.columns], (F.col("_s") - 1).alias("s"), (F.col("_r") - 1).alias("r"), F.col("_n").alias("n"),
    ), "places")
    sources, largest = counted.agg(F.count("*"), F.max("_n")).first()
    if not sources:
        return Manifest(None, places.select(F.col(f"`{leaf}`").alias("digest"), F.array(F.col(f"`{leaf}`")).alias("children")), places, 0, 0, fanout)
    nodes = places.select(F.col("s").alias("tree"), F.col("r").alias("i"), "n", F.col(f"`{leaf}`").alias("digest"))
    low, tops = _levels(nodes, _depth(largest, fanout), fanout, work, "level")
    over = tops.select(F.lit(0).alias("tree"), F.col("tree").alias("i"), F.lit(sources).cast("bigint").alias("n"), "digest")
    high, top = _levels(over, _depth(sources, fanout), fanout, work, "top")
    records = [made.select("digest", "children") for made in [*low, *high]]
    empty = places.select(F.col(f"`{leaf}`").alias("digest"), F.array(F.col(f"`{leaf}`")).alias("children")).limit(0)
    store = work.keep(reduce(DataFrame.unionAll, records, empty).dropDuplicates(["digest"]), "store")
    return Manifest(top.first()["digest"], store, places, sources, largest, fanout)


def prove(spark: SparkSession, manifest: Manifest, requests: DataFrame, work: Workspace) -> DataFrame:
    """Add to requests (rows of ``places``) what the store says of the leaves at their ranks.

    ``found`` is the leaf's digest, ``subroot`` its source's, ``root`` the dataset's; ``segments``
    holds, from the leaf up, the digests left and right of the path in each run, as text. Those
    three and ``s``, ``r``, ``n`` must not be names of other columns.
    """
    f, high = manifest.fanout, _depth(manifest.sources, manifest.fanout)
    deepest = high + _depth(manifest.largest, f)
    segment = "array<struct<left: string, right: string>>"
    columns = [F.col(f"`{c}`") for c in requests.columns if c not in ("s", "r", "n")]
    if deepest == 0:  # at most one leaf: it is the root
        root = F.lit(manifest.root)
        return requests.select(*columns, root.alias("found"), root.alias("subroot"), root.alias("root"), F.array().cast(segment).alias("segments"))

    steps = reduce(lambda a, b: a + b, [(F.col("n") > f ** k).cast("int") for k in range(deepest - high)], F.lit(high))
    asked = requests.withColumn("depth", steps)  # of the leaf; a lone leaf of a source is a child of the upper tree

    def prefix(depth: Column, s: Column, r: Column, at: Column) -> tuple[Column, Column]:
        """The node at depth ``at`` above a leaf: its number in the upper tree, or in that of a source."""
        upper = F.floor(s / F.pow(F.lit(float(f)), F.greatest(F.lit(high) - at, F.lit(0)))).cast("bigint")
        lower = F.floor(r / F.pow(F.lit(float(f)), depth - at)).cast("bigint")
        return upper, F.when(at > high, lower).otherwise(0).cast("bigint")

    runs = asked.select("depth", "s", F.floor(F.col("r") / f).alias("run")).distinct()
    ups = runs.select(F.explode(F.sequence(F.lit(0), F.col("depth") - 1)).alias("at"), "depth", "s", (F.col("run") * f).alias("r"))
    upper, lower = prefix(F.col("depth"), F.col("s"), F.col("r"), F.col("at"))
    wanted = work.keep(ups.where("depth > 0").select("at", upper.alias("us"), lower.alias("ur")).distinct(), "wanted")

    store = manifest.store
    state = wanted.where("at = 0").select(
        F.col("at"), "us", "ur", F.lit(manifest.root).alias("digest"), F.array().cast(segment).alias("segments"), F.lit(None).cast("string").alias("subroot")
    )
    opened = []
    for depth in range(deepest):
        if depth == high:
            state = state.withColumn("subroot", F.col("digest"))
        here = work.keep(state.join(store, "digest").select("at", "us", "ur", "subroot", "segments", "children"), f"opened{depth}")
        opened.append(here)
        child = here.select(F.col("us"), F.col("ur"), "subroot", "segments", "children", F.posexplode("children").alias("digit", "digest"))
        numbers = ((F.col("us") * f + F.col("digit")).alias("us"), F.col("ur")) if depth < high else (F.col("us"), (F.col("ur") * f + F.col("digit")).alias("ur"))
        child = child.select(
            F.lit(depth + 1).alias("at"), *numbers, "digest",
            F.concat("segments", F.array(_beside("children", F.col("digit")))).alias("segments"), "subroot",
        )
        state = child.join(wanted.where(F.col("at") == depth + 1).drop("at"), ["us", "ur"])
    every = reduce(DataFrame.unionAll, opened).withColumnRenamed("at", "last")
    upper, lower = prefix(F.col("depth"), F.col("s"), F.col("r"), F.col("depth") - 1)
    asked = asked.withColumn("us", upper).withColumn("ur", lower).withColumn("last", F.col("depth") - 1)
    digit = F.when(F.col("depth") > high, F.col("r")).otherwise(F.col("s")) % f
    met = asked.join(every, ["last", "us", "ur"]).withColumn("digit", digit.cast("int"))
    found = F.element_at("children", F.col("digit") + 1)
    return met.select(
        *columns, found.alias("found"), F.coalesce(F.col("subroot"), found).alias("subroot"), F.lit(manifest.root).alias("root"),
        F.reverse(F.concat("segments", F.array(_beside("children", F.col("digit"))))).alias("segments"),
    )


def _beside(children: str, digit: Column) -> Column:
    return F.struct(
        F.concat_ws("", F.slice(children, F.lit(1), digit)).alias("left"),
        F.concat_ws("", F.slice(children, digit + 2, F.size(children))).alias("right"),
    )


def proof_digest(segments: str = "segments") -> Column:
    """Hex SHA-256 of all siblings, from the leaf's level up; of nothing where there are none."""
    return F.sha2(F.concat_ws("", F.transform(segments, lambda s: F.concat(s["left"], s["right"]))), 256)


def fold(leaf: str, segments: str = "segments") -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(segments, F.col(leaf), lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256))
