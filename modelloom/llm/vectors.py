"""Near-duplicate vectors by an epsilon grid order join.

Vectors of length one are put into cells of half epsilon on their leading principal axes and
sorted by cell. The sorted sequence is joined with itself recursively: a pair of intervals
whose boxes lie further apart than epsilon is skipped, others are halved until they are
compared. Spark carries the recursion down to intervals of a few thousand vectors, a task per
pair of those goes on with it.

What tasks of that recursion get is short: a vector's places on some two dozen axes, and the length
of the rest of it, whose distance is never larger than that of the vectors. Whole vectors are
shuffled only where a short one has another within epsilon.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelloom.llm.common import Workspace, column_values, components

#: Vectors in the smallest interval that boxes are compared for, and bits of fan-out per level.
BLOCK = 256
FAN_BITS = 2


def unit_vector(values: list | None) -> np.ndarray | None:
    """The vector over its length, in double precision; None where it has no direction."""
    if not values or any(v is None for v in values):
        return None
    vector = np.asarray(values, np.float64)
    top = np.abs(vector).max()
    if not np.isfinite(top) or top == 0 or not np.isfinite(vector).all():
        return None
    vector = vector / top  # else the squares of very large or small numbers leave the range
    return vector / math.sqrt(float(vector @ vector))


def principal_axes(sample: np.ndarray, axes: int) -> np.ndarray:
    """The leading principal directions of some vectors, as columns."""
    centred = sample - sample.mean(axis=0)
    return np.linalg.svd(centred, full_matrices=False)[2][:axes].T if len(sample) else np.zeros((sample.shape[1], 0))


def shortened(vectors: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Places on the axes, and the length of what lies off them: never further apart than the vectors of length one."""
    at = vectors @ basis
    return np.column_stack([at, np.sqrt(np.maximum(0, 1 - (at * at).sum(axis=1)))])


def within(a: np.ndarray, b: np.ndarray, epsilon: float) -> np.ndarray:
    """Which pairs are at most epsilon apart; the slack is far above the error of single precision."""
    apart = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return apart <= epsilon * epsilon + 1e-4


def join_intervals(box_a: np.ndarray, box_b: np.ndarray, epsilon: float, same: bool, test: Callable[[slice, slice], np.ndarray], block: int = BLOCK):
    """Yield the (rows of a, rows of b) that ``test`` finds in what lies near enough, part by part.

    ``box_a`` and ``box_b`` are the short vectors in grid order; ``test`` gets a slice of each and says which
    pairs link. With ``same`` both are one sequence; each pair is given once, and none of a
    vector with itself.
    """
    reach = epsilon * epsilon + 1e-4
    waiting = [(0, len(box_a), 0, len(box_b))]
    while waiting:
        a0, a1, b0, b1 = waiting.pop()
        if a0 >= a1 or b0 >= b1 or same and b1 <= a0:
            continue
        x, y = box_a[a0:a1], box_b[b0:b1]
        apart = np.maximum(0, np.maximum(x.min(axis=0) - y.max(axis=0), y.min(axis=0) - x.max(axis=0)))
        if float(apart @ apart) > reach:
            continue
        if max(a1 - a0, b1 - b0) > block:
            ca, cb = (a0 + a1) // 2, (b0 + b1) // 2
            left = [(a0, ca), (ca, a1)] if a1 - a0 > block else [(a0, a1)]
            right = [(b0, cb), (cb, b1)] if b1 - b0 > block else [(b0, b1)]
            waiting += [(*p, *q) for p in left for q in right]
            continue
        rows, columns = np.nonzero(test(slice(a0, a1), slice(b0, b1)))
        rows, columns = rows + a0, columns + b0
        if same:
            once = rows < columns
            rows, columns = rows[once], columns[once]
        if len(rows):
            yield rows, columns


class Forest:
    """Union-find over 0 to n - 1 whose roots are found for whole arrays at once."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, nodes: np.ndarray) -> np.ndarray:
        found = self.parent[nodes]
        while True:
            further = self.parent[found]
            if (further == found).all():
                self.parent[nodes] = found
                return found
            found = further

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.roots(a), self.roots(b)
            apart = x != y
            if not apart.any():
                return
            a, b = np.maximum(x[apart], y[apart]), np.minimum(x[apart], y[apart])
            np.minimum.at(self.parent, a, b)


def _unpacked(parts: list[bytes], dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(parts), "<f8").reshape(-1, dims)


def near_vectors(
    spark: SparkSession, df: DataFrame, work: Workspace, key: str = "vec_id", embedding: str = "embedding", least: float = 0.95,
    axes: int = 8, short: int = 24, interval: int = 8192, sample: int = 4000,
) -> DataFrame:
    """(key, n_links, component_id, kept) per row of ``df``.

    Two vectors link at a cosine of ``least`` or more, in double precision; ``n_links`` counts the
    other vectors linked directly, ``component_id`` is the smallest key reachable, ``kept`` says
    that it is the row's own. Vectors that are null, zero, or hold null or non-finite components
    link with nothing, nor do vectors of different lengths. Rows with equal vectors are one
    class and compared once, but count each for itself, repeated keys too; rows without a key
    have their links and component, and are not kept. Other columns are left out.

    The principal axes come from at most ``sample`` vectors of each length. They decide what is
    skipped, never what links: distances on some axes are never larger than the whole distance.
    ``axes`` of them order the sequence, ``short`` (as many or more) make the short vectors. Intervals
    are of ``interval`` vectors, or of 16 MB of them where that is fewer.
    """
    epsilon = math.sqrt(2 - 2 * least) + 1e-9

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [unit_vector(v) for v in column_values(batch, "vector")]
            data = [None if v is None else v.astype("<f8").tobytes() for v in vectors]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([None if v is None else xxhash.xxh3_128_digest(v) for v in data], pa.binary()),
                pa.array([None if v is None else len(v) for v in vectors], pa.int32()), pa.array(data, pa.binary()),
            ], names=["key", "class", "dims", "data"])

    source = df.select(F.col(key).cast("bigint").alias("key"), F.col(embedding).alias("vector"))
    rows = work.keep(source.mapInArrow(pack, "key bigint, class binary, dims int, data binary"), "rows")
    found = rows.where("class is not null").groupBy("class").agg(
        F.min("key").alias("least_key"), F.count("*").alias("copies"), F.min("dims").alias("dims"), F.min("data").alias("data")
    )
    classes = work.keep(found.withColumn("node", F.monotonically_increasing_id()), "classes")

    lengths = [r["dims"] for r in classes.groupBy("dims").count().where("count > 1").orderBy("dims").collect()]
    links, counts = None, None
    for dims in lengths:
        got = _join_length(
            spark, classes.where(F.col("dims") == dims), work, dims, least, epsilon, axes, max(axes, short), min(interval, max(64, 2_000_000 // dims)), sample,
        )
        links = got if links is None else links.unionByName(got)
    if links is not None:
        links = work.keep(links, "found")
        counts = links.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
        edges = links.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
        group = components(spark, edges, work)
        member = classes.select("node", "class", "least_key", "copies").join(group, "node", "left").join(counts, "node", "left")
    else:
        member = classes.select("node", "class", "least_key", "copies").withColumns(
            {"component": F.lit(None).cast("bigint"), "links": F.lit(None).cast("bigint")}
        )
    member = work.keep(member, "members")
    smallest = member.where("component is not null").groupBy("component").agg(F.min("least_key").alias("smallest"))
    facts = member.join(smallest, "component", "left").select(
        "class", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("smallest", "least_key").alias("component_id"),
    )
    # vectors without a direction have no class and need no join
    alone = rows.where("class is null").select("key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id"))
    joined = rows.where("class is not null").select("key", "class").join(facts, "class").select("key", "n_links", "component_id")
    return joined.unionByName(alone).select(
        F.col("key").alias(key), "n_links", "component_id", F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)).alias("kept")
    )


def _join_length(spark, classes, work, dims, least, epsilon, axes, short, interval, sample) -> DataFrame:
    """Links among vectors of one length: (node, links, null) and (node, 0, another node of its component)."""
    drawn = classes.orderBy(F.xxhash64("class")).select("data").limit(min(sample, max(50, 2_000_000 // dims))).toArrow()
    basis = principal_axes(_unpacked(drawn.column("data").to_pylist(), dims), short)
    used = min(axes, basis.shape[1])
    width = basis.shape[1] + 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = shortened(_unpacked(column_values(batch, "data"), dims), basis)
            cells = np.floor(at[:, :used] / (epsilon / 2)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([x.tobytes() for x in at.astype("<f4")], pa.binary()), pa.array(list(cells), pa.list_(pa.int32())),
            ], names=[*batch.schema.names, "short", "cell"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Intervals of the sorted sequence, with their boxes on the leading axes."""
        number, held = 0, {"node": [], "copies": [], "data": [], "short": []}

        def close(number: int, rows: dict[str, list]) -> pa.RecordBatch:
            at = np.frombuffer(b"".join(rows["short"]), "<f4").reshape(-1, width)[:, :used].astype(np.float64)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int64()), "seq": pa.array([number], pa.int64()),
                "low": pa.array([at.min(axis=0).tolist()], pa.list_(pa.float64())), "high": pa.array([at.max(axis=0).tolist()], pa.list_(pa.float64())),
                "node": pa.array([rows["node"]], pa.list_(pa.int64())), "copies": pa.array([rows["copies"]], pa.list_(pa.int64())),
                "data": pa.array([rows["data"]], pa.list_(pa.binary())), "short": pa.array([b"".join(rows["short"])], pa.binary()),
            })

        for batch in batches:
            for name in held:
                held[name] += column_values(batch, name)
            while len(held["node"]) >= interval:
                yield close(number, {k: v[:interval] for k, v in held.items()})
                held, number = {k: v[interval:] for k, v in held.items()}, number + 1
        if held["node"]:
            yield close(number, held)

    placed = classes.select("node", "copies", "data").mapInArrow(place, "node bigint, copies bigint, data binary, short binary, cell array<int>")
    count = classes.count()
    parts = max(1, min(-(-count // interval), 100_000))
    ordered = placed.repartitionByRange(parts, "cell", "node").sortWithinPartitions("cell", "node").drop("cell")
    blocks = work.keep(ordered.mapInArrow(
        block, "part bigint, seq bigint, low array<double>, high array<double>, node array<bigint>, copies array<bigint>, data array<binary>, short binary"
    ), f"blocks{dims}")

    # numbers in sequence order, with gaps, so that an interval of a level is a prefix of the bits
    most = blocks.agg(F.max("part"), F.max("seq")).first()
    seq_bits = max(1, int(most[1]).bit_length())
    blocks = blocks.withColumn("no", F.shiftleft("part", seq_bits) + F.col("seq"))
    bits = seq_bits + max(1, int(most[0]).bit_length())
    boxes = work.keep(blocks.select("no", "low", "high"), f"boxes{dims}")
    ends = [
        *(F.min(F.col("low")[i]).alias(f"l{i}") for i in range(used)), *(F.max(F.col("high")[i]).alias(f"h{i}") for i in range(used)),
    ]
    shift = -(-bits // FAN_BITS) * FAN_BITS
    pairs = spark.range(1).select(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))
    while shift > 0:
        shift -= FAN_BITS
        level = boxes.groupBy(F.shiftright("no", shift).alias("no")).agg(*ends)
        kids = F.explode(F.sequence(F.lit(0), F.lit((1 << FAN_BITS) - 1)))
        split = pairs.select("a", "b", kids.alias("ka")).select("a", "b", "ka", kids.alias("kb")).select(
            (F.shiftleft("a", FAN_BITS) + F.col("ka")).alias("a"), (F.shiftleft("b", FAN_BITS) + F.col("kb")).alias("b")
        ).where("a <= b")
        sides = [level.select(F.col("no").alias(s), *(F.col(c).alias(s + c) for c in level.columns if c != "no")) for s in "ab"]
        apart = sum(F.pow(F.greatest(F.lit(0.0), F.col(f"al{i}") - F.col(f"bh{i}"), F.col(f"bl{i}") - F.col(f"ah{i}")), 2) for i in range(used))
        split = split.join(sides[0], "a").join(sides[1], "b")
        pairs = work.keep((split.where(apart <= epsilon * epsilon + 1e-4) if used else split).select("a", "b"), f"pairs{dims}_{shift}")

    # which vectors of two intervals have one within epsilon, by the short ones
    places = blocks.select("no", "short")
    first = pairs.join(places, F.col("a") == F.col("no")).select("a", "b", F.lit(0).alias("side"), "short")
    second = pairs.where("a <> b").join(places, F.col("b") == F.col("no")).select("a", "b", F.lit(1).alias("side"), "short")

    def shorts(parts: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(parts), "<f4").reshape(-1, width)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        side = {r.side: r for r in rows.itertuples()}
        x = shorts([side[0].short])
        y = shorts([side[1].short]) if 1 in side else x
        hit = [np.zeros(len(x), bool), np.zeros(len(y), bool)]
        for i, j in join_intervals(x, y, epsilon, 1 not in side, lambda p, q: within(x[p], y[q], epsilon)):
            hit[0][i] = True
            hit[len(side) - 1][j] = True
        out = [(side[0].a, side[0].b, s, np.flatnonzero(hit[s]).tolist()) for s in sorted(side) if hit[s].any()]
        return pd.DataFrame(out, columns=["a", "b", "side", "place"])

    chosen = work.keep(
        first.unionByName(second).groupBy("a", "b").applyInPandas(choose, "a bigint, b bigint, side int, place array<int>"), f"chosen{dims}"
    )
    chosen = chosen.select(F.when(F.col("side") == 0, F.col("a")).otherwise(F.col("b")).alias("no"), "a", "b", "side", F.explode("place").alias("place"))
    whole = blocks.select("no", F.posexplode(F.arrays_zip("node", "copies", "data")).alias("place", "v")).select("no", "place", "v.*")
    needed = chosen.join(whole, ["no", "place"]).select("a", "b", "side", "place", "node", "copies", "data")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "place"])
        nodes, copies = rows["node"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64)
        vectors, beyond = _unpacked(rows["data"].tolist(), dims), int((rows["side"] == 0).sum())
        same = beyond == len(rows)
        beyond = 0 if same else beyond
        x, y = (vectors, vectors) if same else (vectors[:beyond], vectors[beyond:])
        linked, forest = np.zeros(len(nodes), np.int64), Forest(len(nodes))
        for i, j in join_intervals(shortened(x, basis), shortened(y, basis), epsilon, same, lambda p, q: x[p] @ y[q].T >= least):
            np.add.at(linked, i, copies[j + beyond])
            np.add.at(linked, j + beyond, copies[i])
            forest.join(i, j + beyond)
        hit = np.flatnonzero(linked)
        roots = forest.roots(np.arange(len(nodes)))[hit]
        tied = hit != roots
        return pd.DataFrame({
            "node": np.concatenate([nodes[hit], nodes[hit[tied]]]),
            "links": np.concatenate([linked[hit], np.zeros(tied.sum(), np.int64)]),
            "other": pd.array([None] * len(hit) + nodes[roots[tied]].tolist(), "Int64"),
        })

    return needed.groupBy("a", "b").applyInPandas(compare, "node bigint, links bigint, other bigint")
