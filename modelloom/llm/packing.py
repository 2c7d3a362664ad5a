"""Packing of tokenized documents into windows of a fixed size, best fit decreasing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from modelloom.llm.bpe import shared_encoder
from modelloom.llm.common import column_values, free_name, portions, with_arrays


class OpenWindows:
    """Windows by remaining capacity; finds the one with the least that still takes a piece.

    A segment tree over the capacities 0 to ``size``: leaf ``c`` holds how many open windows
    have ``c`` left, inner nodes the sums. Windows of one capacity are used last in, first out.
    """

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.tree[node] += by
            node >>= 1

    def put(self, window: int, capacity: int) -> None:
        self.windows[capacity].append(window)
        self._add(capacity, 1)

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of ``least`` or more that an open window has."""
        node = least + self.leaves
        if self.tree[node]:
            return least
        while node > 1:
            if not node & 1 and self.tree[node + 1]:  # a left child whose sibling holds larger ones
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None

    def take(self, capacity: int) -> int:
        self._add(capacity, -1)
        return self.windows[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The window and the offset of each piece; every length is 1 to ``size``."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, used = OpenWindows(size), 0
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        capacity = tree.tightest(need)
        if capacity is None:
            window[i], capacity = used, size
            used += 1
        else:
            window[i] = tree.take(capacity)
        offset[i] = size - capacity
        if capacity > need:
            tree.put(int(window[i]), capacity - need)
    return window, offset


PIECE = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(
    df: DataFrame, definition: str, pattern: str, size: int = 2048, end_id: int = 1, text: str = "text",
    keep: list[str] | None = None, ids: bool = False, added: bool = False, memo: int = 800_000,
) -> DataFrame:
    """One row per piece of a document: where it starts in the document, its window and place there.

    A document is its text's ids and then ``end_id``; null and empty texts are that id alone. Full
    windows are cut off first, and what remains (under ``size`` ids) is packed best fit decreasing
    with the other remainders of the task's rows. A task holds a few numbers per document of its
    input split, so its memory is bounded by the split, and no row is shuffled; at most the last
    windows of a task stay open. ``keep`` are the columns that go along (all but the text by
    default; columns with the names of the new ones are replaced); with ``ids`` each piece carries
    its ids as an array. With ``added`` a text's added tokens have their own ids, as the library gives
    by default; else they are text. A worker remembers the ids of ``memo`` words (about 200 bytes each). Sequence ids are the task's number and the window's, so a task that runs
    again gives the same ones. Repeated rows are packed each for itself.
    """
    new = StructType.fromDDL(PIECE + (", ids array<int>" if ids else ""))
    taken = {f.name.lower() for f in new} | {text.lower()}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    source = free_name(df, "value")
    rows = df.select(*keep, F.col(f"`{text}`").alias(source))
    schema = StructType([*(df.schema[c] for c in keep), *new])

    def piece_arrays(batch, of, start, length, crc, total, sequence, offset, parts) -> pa.RecordBatch:
        table = batch.take(pa.array(of, pa.int64()))
        added = dict(zip(
            ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"),
            (pa.array(x, pa.int64()) for x in (start, length, crc, total, sequence, offset)),
        ))
        if ids:
            added["ids"] = pa.array([np.frombuffer(p, "<u4") for p in parts], pa.list_(pa.int32()))
        return with_arrays(table, keep, added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = shared_encoder(definition, pattern, added, memo)
        first = TaskContext.get().partitionId() << 40
        end = np.asarray([end_id], "<u4").tobytes()
        windows, kept, rest = 0, [], [[], [], [], []]
        left_parts: list[bytes] = []
        for batch in portions(batches):
            texts = column_values(batch, source)
            light = with_arrays(batch, keep, {source: pa.nulls(batch.num_rows)})
            of, start, length, crc, total, sequence, parts, left = [], [], [], [], [], [], [], []
            for i, data in enumerate(encode(texts)):
                data += end
                n = len(data) // 4
                full = n // size
                for w in range(full):
                    part = data[4 * w * size:4 * (w + 1) * size]
                    for column, value in zip((of, start, length, crc, total, sequence), (i, w * size, size, zlib.crc32(part), n, first + windows)):
                        column.append(value)
                    if ids:
                        parts.append(part)
                    windows += 1
                if n > full * size:
                    part = data[4 * full * size:]
                    left.append(i)
                    for column, value in zip(rest, (full * size, n - full * size, zlib.crc32(part), n)):
                        column.append(value)
                    if ids:
                        left_parts.append(part)
            if of:
                yield piece_arrays(light, of, start, length, crc, total, sequence, [0] * len(of), parts)
            if left:
                kept.append(light.take(pa.array(left, pa.int64())))
        if kept:
            window, offset = best_fit_decreasing(np.asarray(rest[1], np.int64), size)
            at = 0
            for batch in kept:
                to = at + batch.num_rows
                yield piece_arrays(
                    batch, range(batch.num_rows), *(r[at:to] for r in rest), first + windows + window[at:to], offset[at:to], left_parts[at:to],
                )
                at = to

    return rows.mapInArrow(run, schema)
