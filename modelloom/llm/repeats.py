"""Removal of long repeated passages: prefix doubling over content-defined anchors.

A position is an anchor if a hash of the bytes from it on says so; two equal strings have their
anchors at the same places. Documents thus become strings of blocks, from anchor to anchor, and
prefix doubling ranks these: positions are paired with the rank at a growing offset, sorted over
all tasks by the pair and ranked anew in that order, those with a rank of their own are dropped,
until the ranks cover all that the positions may need to decide. Where few need more steps, only
the texts that these or a partner of theirs lie in go on. What is left are anchors of passages that may repeat. Which starts before
such an anchor repeat to the byte is then decided on the text, by halving ranges: all starts of a
range repeat if the string from the first to the end of the last does, and none does unless what
they have in common repeats.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from modelloom.llm.common import Workspace, column_values, portions
from modelloom.operators.bloom import semi_join
from modelloom.shared import task_count

#: Bytes that decide whether a position is an anchor.
GRAM = 16
#: Lengths of the ranges of starts that are tested, each a multiple of the next.
RANGES = (64, 8, 1)
#: Blocks from which on few positions need more: a string holds about six.
FEW = 8
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def anchors(data: bytes, length: int) -> np.ndarray:
    """Places of the anchors of some bytes, about six to a string of ``length``."""
    n = len(data)
    if n < max(length, GRAM):
        return np.zeros(0, np.int64)
    bits = max(2, round(math.log2(length / 6)))
    padded = data + bytes(24)
    eights = np.empty(8 * (n // 8 + 1), np.uint64)
    for shift in range(8):
        eights[shift::8] = np.frombuffer(padded, "<u8", n // 8 + 1, shift)
    low, high = eights[:n - GRAM + 1] * _A, eights[8:n - GRAM + 9] * _B
    mixed = (low ^ (high >> np.uint64(29)) ^ (high << np.uint64(35))) * _C
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _A
    return np.flatnonzero(mixed >> np.uint64(64 - bits) == 0)


def starts_of(at: np.ndarray, n: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last start whose first anchor is each one; the last is before the first if there is none."""
    before = np.concatenate([[-1], at[:-1]])
    low = np.maximum(np.maximum(before + 1, at - (length - GRAM)), 0)
    return low, np.minimum(at, n - length)


def lone_starts(at: np.ndarray, n: int, length: int) -> list[tuple[int, int]]:
    """Ranges of starts of strings that hold no anchor."""
    if n < length:
        return []
    first = np.concatenate([[-1], at]) + 1
    last = np.minimum(np.concatenate([at - (length - GRAM) - 1, [n - length]]), n - length)
    some = first <= last
    return list(zip(first[some].tolist(), last[some].tolist()))


def own_repeats(data: bytes, ranges: list[tuple[int, int]], length: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(known, rest): of ranges of starts, those that repeat within the same bytes at a fixed distance,
    and those still to be compared with others.

    Strings without an anchor are mostly of a short period, such as a word said a thousand
    times. Of such a run one period stays in ``rest`` to stand for it, and the rest is known.
    """
    known, rest = [], []
    view = np.frombuffer(data, np.uint8)
    for first, last in ranges:
        while first <= last:
            period = data.find(data[first:first + length], first + 1) - first
            if period <= 0:
                # the next start that could repeat nearby is found by doubling steps through the range
                step = min(last - first + 1, 32)
                rest.append((first, first + step - 1))
                first += step
                continue
            same = view[first:len(data) - period] == view[first + period:]
            end = len(same) if same.all() else int(np.argmin(same))
            known.append((first, first + end - length))
            known.append((first + period, first + period + end - length))
            rest.append((first, min(last, first + period - 1)))
            first = max(first + period, first + end - length + 1)
    return known, rest


def blocks(data: bytes, at: np.ndarray, length: int) -> tuple[list, list]:
    """Per anchor, the name of the block to the next one (None if no string needs it), and how many
    blocks the strings that begin with it hold at least (-1 if none begins with it)."""
    names = [None] * len(at)
    ends = (at[1:] + GRAM).tolist()
    for t, (a, b) in enumerate(zip(at.tolist(), ends)):
        if b - a <= length:
            names[t] = xxhash.xxh3_64_intdigest(data[a:b]) - (1 << 63)
    low, high = starts_of(at, len(data), length)
    needs = np.searchsorted(at, low + length - GRAM, "right") - 1 - np.arange(len(at))
    return names, np.where(low <= high, needs, -1).tolist()


def removed(data: bytes, starts: list[tuple[int, int]], length: int) -> tuple[bytes, int, int]:
    """The bytes that no string of ``length`` from any of the ranges of starts covers, how many are
    covered, and in how many runs."""
    kept, at, gone, runs = [], 0, 0, 0
    end = -1
    for first, last in sorted(starts):
        if first > end:  # runs that touch are one
            kept.append(data[max(at, 0):first])
            runs += 1
            gone += last + length - first
        elif last + length > end:
            gone += last + length - end
        end = max(end, last + length)
        at = end
    kept.append(data[at:])
    return b"".join(kept), gone, runs


def _prepared(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches):
        texts = [(t or "").encode("utf-8", "replace") for t in column_values(batch, "text")]
        found = []
        for data in texts:
            at = anchors(data, length)
            found.append((at, *blocks(data, at, length), *own_repeats(data, lone_starts(at, len(data), length), length)))
        spans = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(texts, pa.binary()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in texts]), pa.array([f[0] for f in found], pa.list_(pa.int64())),
            pa.array([f[1] for f in found], pa.list_(pa.int64())), pa.array([f[2] for f in found], pa.list_(pa.int32())),
            *(pa.array([[{"first": a, "last": b} for a, b in f[i]] for f in found], spans) for i in (3, 4)),
        ], names=["uid", "row", "data", "n_bytes", "sha256", "anchors", "blocks", "needs", "known", "lone"])


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["uid", "first", "low", "high", "core", "hull"]
    )


def _ranges(length: int, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tested strings of the ranges of ``size`` starts: what all share, and what all cover.

    A batch has ``uid``, ``data`` and ``items``: (first, low, high, size) of ranges to cut into
    ranges of this size; only those that hold starts from ``low`` to ``high`` are taken.
    """
    core_of, hull_of = xxhash.xxh3_64_intdigest, xxhash.xxh3_128_digest
    rows: list[tuple] = []
    for batch in portions(batches):
        for uid, data, items in zip(*(column_values(batch, c) for c in ("uid", "data", "items"))):
            n, seen = len(data), set()
            for item in items:
                low, high, first = item["low"], item["high"], item["first"]
                skip = max(0, (low - first) // size)
                for s in range(first + skip * size, min(first + item["size"], high + 1), size):
                    if s in seen:
                        continue
                    seen.add(s)
                    e = s + size - 1
                    core = core_of(data[e:s + length]) - (1 << 63)
                    hull = hull_of(data[s:e + length]) if s >= 0 and e + length <= n else None
                    rows.append((uid, s, low, high, core, hull))
            if len(rows) >= 50_000:
                yield _emit(rows)
                rows = []
    if rows:
        yield _emit(rows)


def _single(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The string of ``length`` from every single start of the items, as (uid, first, hull)."""
    hull_of = xxhash.xxh3_128_digest
    uids, starts, hulls = [], [], []

    def emit() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(starts, pa.int64()), pa.array(hulls, pa.binary())], names=["uid", "first", "hull"])

    for batch in portions(batches):
        for uid, data, items in zip(*(column_values(batch, c) for c in ("uid", "data", "items"))):
            places, n = set(), len(data)
            for item in items:
                first = item["first"]
                places.update(range(max(first, item["low"], 0), min(first + item["size"] - 1, item["high"], n - length) + 1))
            view = memoryview(data)
            starts.extend(places)
            hulls.extend([hull_of(view[s:s + length]) for s in places])
            uids.extend([uid] * len(places))
            if len(starts) >= 50_000:
                yield emit()
                uids, starts, hulls = [], [], []
    if starts:
        yield emit()


ROW = "uid bigint, first bigint, low bigint, high bigint, core bigint, hull binary"


#: A position, its number among the distinct pairs of its task, and where it may be alone (see ``_numbered``).
NUMBERED = "task bigint, uid bigint, t bigint, need int, local bigint, edge int, n bigint, low struct<rank: bigint, next: bigint>, high struct<rank: bigint, next: bigint>"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted positions of a task whose pair (rank, next) others have, too, numbered by pair; then a row about the task.

    The first and the last position stay even if alone in the task: ``edge`` is 1 if such a one
    may only share its pair with the task before, 2 with the task after, 3 with either, else 0.
    The last row has no uid; ``n`` is the number of pairs, ``low`` and ``high`` are the first and the last.
    """
    task = TaskContext.get().partitionId()
    kind = pa.struct([("rank", pa.int64()), ("next", pa.int64())])
    held = before = low = None  # the last row so far, the pair before it, the first pair
    number = -1

    def rows(uid, t, need, local, edge) -> pa.RecordBatch:
        n = len(uid)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(n, task, np.int64)), pa.array(uid), pa.array(t), pa.array(need, pa.int32()), pa.array(local), pa.array(edge, pa.int32()),
            pa.nulls(n, pa.int64()), pa.nulls(n, kind), pa.nulls(n, kind),
        ], names=["task", "uid", "t", "need", "local", "edge", "n", "low", "high"])

    def ranked(columns: list[np.ndarray], last: bool) -> pa.RecordBatch:
        """All rows but the last one, which waits for what follows; at the end that, too."""
        nonlocal before, number, low
        uid, t, need, rank, after = columns
        new = np.ones(len(uid), bool)
        new[1:] = (rank[1:] != rank[:-1]) | (after[1:] != after[:-1])
        if before is not None:
            new[0] = (int(rank[0]), int(after[0])) != before
        else:
            low = (int(rank[0]), int(after[0]))
        local = number + np.cumsum(new)
        end = len(uid) if last else len(uid) - 1
        single = new[:end] & np.append(new[1:], last)[:end]
        edge = np.zeros(end, np.int32)
        if before is None and end:
            edge[0] |= 1
        if last:
            edge[-1] |= 2
        keep = ~single | (edge > 0)
        edge[~single] = 0
        if end:
            before, number = (int(rank[end - 1]), int(after[end - 1])), int(local[end - 1])
        return rows(uid[:end][keep], t[:end][keep], need[:end][keep], local[:end][keep], edge[keep])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(5)]
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns)]
        held = [c[-1:].copy() for c in columns]
        yield ranked(columns, False)
    if held is not None:
        yield ranked(held, True)
        ends = [pa.array([{"rank": p[0], "next": p[1]}], kind) for p in (low, before)]
        yield pa.RecordBatch.from_arrays([
            pa.array([task], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()),
            pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([number + 1], pa.int64()), *ends,
        ], names=["task", "uid", "t", "need", "local", "edge", "n", "low", "high"])


def _ranked(spark: SparkSession, pairs: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(uid, t, rank, need) of the positions whose pair (rank, next) is not theirs alone.

    All are sorted by the pair in ranges, so a frequent pair may fill many tasks. The new rank is the
    dense one: a task's own numbers and the sum of the tasks before, a row each.
    """
    order = ["rank", "next", "uid", "t"]
    dealt = pairs.select("uid", "t", "need", "rank", "next").repartitionByRange(task_count(spark), *order).sortWithinPartitions(*order)
    numbered = work.keep(dealt.mapInArrow(_numbered, NUMBERED), name)
    base, borders, last = 0, [], None
    for row in sorted(numbered.where("uid is null").select("task", "n", "low", "high").collect()):
        joined = last is not None and last == row["low"]
        if joined:
            borders[-1][3] = True
            base -= 1
        borders.append([row["task"], base, joined, False])
        base, last = base + row["n"], row["high"]
    around = spark.createDataFrame(borders, "task bigint, base bigint, before boolean, after boolean")
    shared = (F.col("edge") == 0) | ((F.col("edge").bitwiseAND(1) > 0) & F.col("before")) | ((F.col("edge").bitwiseAND(2) > 0) & F.col("after"))
    placed = numbered.where("uid is not null").select("task", "uid", "t", "need", "local", "edge").join(F.broadcast(around), "task")
    return placed.where(shared).select("uid", "t", (F.col("base") + F.col("local")).alias("rank"), "need")


def _followed(step: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions (uid, t, need, rank), sorted by uid and t, with the rank of that ``step`` places on as ``next``; those without one go."""

    def paired(uid: np.ndarray, t: np.ndarray, need: np.ndarray, rank: np.ndarray) -> pa.RecordBatch:
        text = np.cumsum(np.concatenate([[0], uid[1:] != uid[:-1]]))
        place = text * (int(t.max()) + step + 1) + t
        at = np.minimum(np.searchsorted(place, place + step), len(place) - 1)
        some = place[at] == place + step
        return pa.RecordBatch.from_arrays(
            [pa.array(c[some]) for c in (uid, t, need, rank)] + [pa.array(rank[at[some]])], names=["uid", "t", "need", "rank", "next"]
        )

    held = None  # the positions of the last text, which the next batch may go on with
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(4)]
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns)]
        whole = int(np.searchsorted(columns[0], columns[0][-1]))
        if whole:
            yield paired(*(c[:whole] for c in columns))
        held = [c[whole:].copy() for c in columns]
    if held is not None:
        yield paired(*held)


def _going_on(ranked: DataFrame, blocks: int, work: Workspace) -> DataFrame:
    """Of ``ranked`` the texts in which a position needs ``blocks`` blocks or more, or has the rank of such a one.

    All that later steps compare lies in them: partners of a position share its rank, and what
    follows a position is of its text.
    """
    ranks = ranked.where(F.col("need") >= blocks).select("rank")
    return semi_join(ranked, semi_join(ranked, ranks, "rank", scratch=work).select("uid"), "uid", scratch=work)


def _doubled(spark: SparkSession, texts: DataFrame, work: Workspace) -> DataFrame:
    """(uid, t) of the anchors that prefix doubling leaves."""
    every = texts.select("uid", F.posexplode(F.arrays_zip("blocks", "needs")).alias("t", "b")).select(
        "uid", F.col("t").cast("bigint").alias("t"), F.col("b.blocks").alias("rank"), F.col("b.needs").alias("need")
    )
    left = [every.where("need = 0").select("uid", "t")]
    # the name of a block is its first rank; at each step the ranks are those of the order of 2 ** step blocks
    pairs, step = every.where("rank is not null").withColumn("next", F.lit(0).cast("bigint")), 1
    while True:
        ranked = _ranked(spark, pairs, work, f"rank{step}")
        work.release()
        left.append(ranked.where((F.col("need") >= step) & (F.col("need") < 2 * step)).select("uid", "t"))
        if ranked.where(F.col("need") >= 2 * step).isEmpty():
            break
        if step >= FEW:
            ranked = _going_on(ranked, 2 * step, work)
        dealt = ranked.select("uid", "t", "need", "rank").repartition("uid").sortWithinPartitions("uid", "t")
        pairs = dealt.mapInArrow(lambda it, step=step: _followed(step, it), "uid bigint, t bigint, need int, rank bigint, next bigint")
        step *= 2
    out = left[0]
    for more in left[1:]:
        out = out.unionByName(more)
    return out


def _cut(found: DataFrame, size: int, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """From the tested ranges: (uid, first, last) of repeated starts, and the items to test further."""
    hull = F.coalesce("hull", F.lit(b""))
    found = found.withColumn("hull", hull)
    # any range of the smallest uid is the model; a least struct would be had by sorts
    groups = found.groupBy("core", "hull").agg(F.count("*").alias("n"), F.min("uid").alias("model"), F.min_by("first", "uid").alias("place"))
    groups = groups.withColumn("full", (F.col("n") > 1) & (F.octet_length("hull") > 0))
    cores = groups.groupBy("core").agg(F.sum("n").alias("all"), F.max(~F.col("full")).alias("open")).where("all > 1").select("core", "open")
    judged = found.join(groups.join(cores, "core").select("core", "hull", "model", "place", "full", "open"), ["core", "hull"])
    judged = work.keep(judged.select(
        "uid", "first", "low", "high", "full", "open", ((F.col("uid") == F.col("model")) & (F.col("first") == F.col("place"))).alias("is_model")
    ), f"judged{size}")
    full = judged.where("full").select("uid", "first", (F.col("first") + size - 1).alias("last"))
    # ranges that repeat as a whole stand in once each, for open ones to be compared with
    standing = judged.where("full and open and is_model")
    items = judged.where("not full").select("uid", "first", "low", "high").unionByName(
        standing.select("uid", "first", F.col("first").alias("low"), (F.col("first") + size - 1).alias("high"))
    )
    return full, items.withColumn("size", F.lit(size).cast("bigint"))


def repeated_passages(spark: SparkSession, df: DataFrame, work: Workspace, text: str = "text", length: int = 400) -> DataFrame:
    """(uid, row, n_bytes, sha256, n_removed, n_spans, kept_sha256, kept, kept_text) per row of ``df``.

    ``row`` holds the other columns of ``df``. A byte of a text (as UTF-8; null is empty) is
    removed if a string of ``length`` bytes that covers it starts anywhere else, too, in any
    row; strings do not cross rows and are judged on the input. ``kept`` are the remaining
    bytes; a removed passage may begin or end within a character, of which ``kept_text`` leaves out
    what remains.
    Repeated rows are copies of one another like any others. Names of anchors and blocks are
    hashes that can only leave more to test; what decides is a 128-bit hash of whole strings.
    """
    if length < 64:
        raise ValueError("passages have 64 bytes or more")
    rest = [c for c in df.columns if c != text]
    row = F.struct(*(F.col(f"`{c}`") for c in rest)) if rest else F.struct(F.lit(0).alias("none"))
    source = df.select(F.monotonically_increasing_id().alias("uid"), row.alias("row"), F.col(f"`{text}`").alias("text"))
    schema = StructType([
        *source.schema.fields[:2],
        *StructType.fromDDL(
            "data binary, n_bytes bigint, sha256 string, anchors array<bigint>, blocks array<bigint>, needs array<int>, "
            "known array<struct<first: bigint, last: bigint>>, lone array<struct<first: bigint, last: bigint>>"
        ),
    ])
    # written once: the row numbers hold from here on
    texts = work.keep(source.mapInArrow(lambda it: _prepared(length, it), schema), "texts", whole=True)
    left = work.keep(_doubled(spark, texts, work).groupBy("uid").agg(F.collect_list("t").alias("ts")), "left")
    work.drop(*(f"rank{1 << i}" for i in range(20)))
    work.release()

    # apart: the texts that may hold repeated passages, with the starts to test
    some = F.col("ts").isNotNull() | (F.size("lone") > 0) | (F.size("known") > 0)
    marked = texts.join(left, "uid", "left").select(
        "uid", "row", "n_bytes", "sha256", "data", F.when(some, F.col("anchors")).alias("anchors"), "known", "lone", "ts", some.alias("held")
    )
    marked = work.keep(marked, "marked", by="held")
    work.drop("texts", "left")
    work.release()
    held = marked.where("held")

    def first_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "low", "high", "size")]))
        for batch in portions(batches):
            out = []
            for at, ts, n in zip(*(column_values(batch, c) for c in ("anchors", "ts", "n_bytes"))):
                at, items = np.asarray(at, np.int64), []
                low, high = starts_of(at, n, length)
                for t in sorted(ts or []):
                    a, b, x = int(low[t]), int(high[t]), int(at[t])
                    if a <= b:
                        size = RANGES[0] * -(-(x - a + 1) // RANGES[0])  # ranges are counted back from the anchor
                        items.append({"first": x - size + 1, "low": a, "high": b, "size": size})
                out.append(items)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in ("uid", "data")] + [pa.array(out, kind)], names=["uid", "data", "items"]
            )

    # cut into items and tested in one function, so that a task needs one Python worker
    tested, items_first = held.select("uid", "data", "n_bytes", "anchors", "ts").where("ts is not null"), first_items
    repeated = held.select("uid", F.explode("known").alias("k")).select("uid", "k.first", "k.last")
    for size in RANGES[:-1]:
        found = work.keep(tested.mapInArrow(lambda it, size=size, f=items_first: _ranges(length, size, f(it)), ROW), f"found{size}", whole=True)
        work.release()
        full, items = _cut(found, size, work)
        work.drop(f"found{size}")
        repeated = repeated.unionByName(full)
        if RANGES[-2] == size:  # strings without an anchor are tested start by start
            lone = held.select("uid", F.explode("lone").alias("l")).select(
                "uid", F.col("l.first").alias("first"), F.col("l.first").alias("low"), F.col("l.last").alias("high"),
                (F.col("l.last") - F.col("l.first") + 1).alias("size"),
            )
            items = items.unionByName(lone)
        grouped = items.groupBy("uid").agg(F.collect_list(F.struct("first", "low", "high", "size")).alias("items"))
        tested, items_first = held.select("uid", "data").join(grouped, "uid"), portions
        work.release()
    # of single starts the two strings are one
    found = work.keep(tested.mapInArrow(lambda it: _single(length, it), "uid bigint, first bigint, hull binary"), "found1", whole=True)
    work.release()
    twice = found.groupBy("hull").agg(F.count("*").alias("n")).where("n > 1").select("hull")
    single = work.keep(found.join(twice, "hull").select("uid", "first", F.col("first").alias("last")), "single")
    work.drop("found1")
    work.release()
    spans = repeated.unionByName(single).groupBy("uid").agg(F.collect_list(F.struct("first", "last")).alias("starts"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            out = [
                removed(data, [(s["first"], s["last"]) for s in starts], length)
                for data, starts in zip(column_values(batch, "data"), column_values(batch, "starts"))
            ]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()),
                pa.array([hashlib.sha256(o[0]).hexdigest() for o in out], pa.string()), pa.array([o[0] for o in out], pa.binary()),
                pa.array([o[0].decode(errors="ignore") for o in out], pa.string()),
            ], names=["uid", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text"])

    cut = held.select("uid", "data").join(spans, "uid").mapInArrow(
        remove, "uid bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, kept_text string"
    )
    cut = work.keep(cut, "cut", whole=True)
    work.release()
    zero = F.lit(0).cast("bigint")
    columns = ["uid", "row", "n_bytes", "sha256", "data"]
    final = held.select(*columns).join(cut, "uid", "left").select(
        *columns[:4], F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"), F.coalesce("kept", "data").alias("kept"),
        F.coalesce("kept_text", F.col("data").cast("string")).alias("kept_text"),
    )
    rest = marked.where("not held").select(
        *columns[:4], zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha256").alias("kept_sha256"), F.col("data").alias("kept"),
        F.col("data").cast("string").alias("kept_text"),
    )
    return final.unionByName(rest)
