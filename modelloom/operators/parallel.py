"""The parallel map: ordinary Python functions over the rows of a DataFrame.

Spark partitions the work and moves it as Arrow batches; the code below only
turns a batch into what the function takes and its answers back into a batch.
A function can run more than once for a row (task retries, and the row-by-row
second try of a failed batch), so calls with side effects must be idempotent.
"""

from __future__ import annotations

import sys
import time
import types
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.resource import (
    ExecutorResourceRequests,
    ResourceProfile,
    ResourceProfileBuilder,
    TaskResourceRequests,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from modelloom.errors import ConfigError, ResultError
from modelloom.functions import free_name
from modelloom.shared import is_local

#: A worker drops the state of a map that no task has used for so many seconds.
IDLE_S = 900
MODES = ("row", "list", "batch", "partition")
BUNDLE_ROWS, BUNDLE_BYTES = 10_000, 64 << 20  # converted between Arrow and Python at a time
_MISFITS = (pa.ArrowException, TypeError, ValueError, OverflowError)
ERROR_COLUMN = "error"


def parallel_map(
    df: DataFrame,
    fn: Callable[..., Any],
    *,
    adds: str | None = None,
    schema: str | StructType | None = None,
    mode: str = "row",
    workers: int | None = None,
    batch_size: int | None = None,
    setup: Callable[[], Any] | None = None,
    on_error: str = "fail",
    input_cols: Sequence[str] | None = None,
    resources: ResourceProfile | None = None,
) -> DataFrame:
    """Apply ``fn`` on the executors; lazy, like any DataFrame operation.

    mode
        what ``fn`` takes and returns: ``"row"`` dict to dict, ``"list"`` list
        of dicts to list of dicts, ``"batch"`` pandas frame to pandas frame,
        ``"partition"`` iterator of frames to iterator of frames. Only ``row``
        keeps the number of rows.
    adds, schema
        the result: input columns plus the ones in the ``adds`` DDL, or a full
        schema. Results with missing or additional columns are errors. In row
        mode with ``adds`` the function may return just the added columns.
    workers
        upper bound on tasks running at once (by a shuffle to that many
        partitions). Leave unset unless a service behind ``fn`` demands it.
    batch_size
        rows per call in the list, batch and partition modes.
    setup
        makes a state (model, client) once per Python worker process; ``fn`` is
        then called as ``fn(x, state)``.
    on_error
        ``"column"`` keeps a failing row, with null results and the message in
        an ``error`` column, instead of failing the job.
    input_cols
        the columns ``fn`` needs. In row mode with ``adds`` the others stay in
        the JVM and come back unchanged; elsewhere they are dropped before the
        map.
    resources
        a profile from :func:`worker_resources`; a local session ignores it.
    """
    if mode not in MODES:
        raise ConfigError(f"mode={mode!r}, expected one of {MODES}")
    if on_error not in ("fail", "column"):
        raise ConfigError(f"on_error={on_error!r}, expected 'fail' or 'column'")
    if adds is not None and schema is not None:
        raise ConfigError("give adds or schema, not both")
    if on_error == "column" and mode == "partition":
        raise ConfigError("a partition function sees no single rows, so it cannot mark them")
    for name, value in (("workers", workers), ("batch_size", batch_size)):
        if value is not None and value < 1:
            raise ConfigError(f"{name} must be at least 1, got {value}")

    carries = mode == "row" and schema is None
    if input_cols is not None and not carries:
        df = df.select(*input_cols)
    if len(set(df.columns)) != len(df.columns):
        raise ConfigError("the input has two columns of one name; rename one first")

    exact = str(df.sparkSession.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"
    fold = str if exact else str.lower  # names are the same if the session takes them for the same
    added = _parse(adds) if adds else StructType([])
    if len({fold(n) for n in added.fieldNames()}) != len(added.fields):
        raise ConfigError("the map adds two columns of one name")
    result = _parse(schema) if schema is not None else _with_fields(df.schema, added, fold)
    keep_errors = on_error == "column"
    if keep_errors and fold(ERROR_COLUMN) in {fold(n) for n in result.fieldNames()}:
        raise ConfigError(f"on_error='column' needs the name `{ERROR_COLUMN}` for itself")

    large = df.sparkSession.conf.get("spark.sql.execution.arrow.useLargeVarTypes", "false")
    shape = _Shape(
        seen=tuple(input_cols if input_cols is not None else df.columns),
        added=tuple(added.fieldNames()) if carries else (),
        out=to_arrow_schema(result, prefers_large_types=str(large).lower() == "true"),
        keep_errors=keep_errors,
    )
    bind = bind_setup(fn, setup)
    if workers is not None:
        df = df.repartition(workers)
    if is_local(df.sparkSession):
        resources = None

    if carries and input_cols is not None and added.fields and resources is None:
        return _map_beside(df, bind, shape, added, result)
    task = {"row": _row_task, "list": _list_task, "batch": _frame_task,
            "partition": _stream_task}[mode](bind, shape, batch_size)
    return df.mapInArrow(task, _result_schema(result, keep_errors), profile=resources)


def worker_resources(cpus: int = 1, ram_gb: int | None = None) -> ResourceProfile | None:
    """CPUs per task and, where dynamic allocation is on, memory per executor."""
    if cpus == 1 and ram_gb is None:
        return None
    builder = ResourceProfileBuilder().require(TaskResourceRequests().cpus(cpus))
    if ram_gb is not None:
        builder = builder.require(
            ExecutorResourceRequests().cores(cpus).memory(f"{ram_gb}g")
        )
    return builder.build


# --- schemas ----------------------------------------------------------------


def _parse(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def _with_fields(base: StructType, added: StructType, fold: Callable[[str], str]) -> StructType:
    """``added`` behind ``base``; a field of the same folded name is replaced in place."""
    by_name = {fold(f.name): f for f in added.fields}
    kept = [by_name.get(fold(f.name), f) for f in base.fields]
    new = [f for f in added.fields if fold(f.name) not in {fold(n) for n in base.fieldNames()}]
    return StructType([StructField(f.name, f.dataType, True) for f in kept + new])


def _result_schema(result: StructType, keep_errors: bool) -> StructType:
    error = [StructField(ERROR_COLUMN, StringType(), True)] if keep_errors else []
    return StructType([*result.fields, *error])


@dataclass(frozen=True)
class _Shape:
    """What a task must know about rows going in and coming out."""

    seen: tuple[str, ...]  # columns the function gets
    added: tuple[str, ...]  # columns it must add; empty if it makes whole rows
    out: pa.Schema  # result without the error column
    keep_errors: bool

    def check_keys(self, keys: Iterable[str], expected: set[str]) -> None:
        keys = set(keys)
        if keys != expected:
            raise ResultError(
                f"result does not fit the declared columns: "
                f"missing {sorted(expected - keys)}, not declared {sorted(keys - expected)}"
            )


# --- calling user code --------------------------------------------------------


def bind_setup(fn: Callable, setup: Callable | None) -> Callable[[], Callable]:
    """A factory, run inside the task, of the one-argument call."""
    if setup is None:
        return lambda: fn
    token = uuid.uuid4().hex

    def bind() -> Callable:
        state = _worker_state(token, setup)
        return lambda x: fn(x, state)

    return bind


def _worker_state(token: str, setup: Callable[[], Any]) -> Any:
    """``setup()`` once per worker process; its later tasks of this map reuse the state."""
    home = sys.modules.setdefault("_modelloom_worker", types.ModuleType("_modelloom_worker"))
    states: dict[str, Any] = home.__dict__.setdefault("states", {})
    used: dict[str, float] = home.__dict__.setdefault("used", {})
    now = time.monotonic()
    if token not in states:
        for old in [t for t, at in used.items() if now - at > IDLE_S]:  # states of maps that have ended
            states.pop(old, None)
            used.pop(old)
        states[token] = setup()
    used[token] = now
    return states[token]


def _started(batches: Iterable, bind: Callable[[], Callable]) -> Iterator[tuple[Callable, Iterator]]:
    """The call and all batches, or nothing at all for an empty partition."""
    batches = iter(batches)
    for first in batches:
        yield bind(), chain([first], batches)
        return


def _message(exc: Exception) -> str:
    return str(exc) or type(exc).__name__


# --- row mode -----------------------------------------------------------------


def _row_task(bind: Callable, shape: _Shape, _size: int | None) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for call, todo in _started(batches, bind):
            for batch in todo:
                arrays, errors = _apply_rows(batch, call, shape, shape.out)
                yield _record_batch(arrays, errors, shape)

    return task


def _map_beside(
    df: DataFrame, bind: Callable, shape: _Shape, added: StructType, result: StructType
) -> DataFrame:
    """Row mode where only the columns the function needs travel to Python."""
    answer = _result_schema(added, shape.keep_errors)
    fields = pa.schema([shape.out.field(n) for n in added.fieldNames()])

    def task(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for call, todo in _started(parts, bind):
            for part in todo:
                batch = pa.RecordBatch.from_struct_array(part)
                arrays, errors = _apply_rows(batch, call, shape, fields)
                if shape.keep_errors:
                    arrays = [*arrays, pa.array(errors, pa.string())]
                yield pa.StructArray.from_arrays(arrays, names=answer.fieldNames())

    # marked as not deterministic so that no later filter makes it run twice
    call = F.arrow_udf(task, answer).asNondeterministic()
    seen = F.struct(*[F.col(f"`{c}`") for c in shape.seen])
    new = set(answer.fieldNames())
    slot = free_name(df, "_answer")
    return df.withColumn(slot, call(seen)).select(
        *[
            F.col(f"`{slot}`.`{n}`" if n in new else f"`{n}`").alias(n)
            for n in _result_schema(result, shape.keep_errors).fieldNames()
        ]
    )


def _apply_rows(
    batch: pa.RecordBatch, call: Callable, shape: _Shape, fields: pa.Schema
) -> tuple[list[pa.Array], list[str | None]]:
    """Call per row; the columns named by ``fields`` and one error text per row."""
    names, added = shape.seen, set(shape.added)
    whole = set(names) | added if added else set(fields.names)
    inputs = {name: _values(batch.column(name)) for name in names}
    outs: list[dict | None] = []
    errors: list[str | None] = [None] * batch.num_rows
    brief = True  # whether all results hold just the added columns
    for i, row in enumerate(_dicts(inputs, batch.num_rows)):
        try:
            out = call(row)
            if not isinstance(out, dict):
                raise ResultError(f"a row function must return a dict, got {type(out).__name__}")
            if not added or out.keys() != added:
                if out.keys() != whole:
                    shape.check_keys(out, whole)
                brief = False
            outs.append(out)
        except Exception as exc:
            if not shape.keep_errors:
                raise
            outs.append(None)
            errors[i] = _message(exc)

    def column(field: pa.Field, bad: dict[int, str]) -> pa.Array | None:
        name = field.name
        given = name in batch.schema.names and name not in added
        if given and added and (
            brief or name not in inputs or _untouched(field, inputs[name], outs)
        ):
            return batch.column(name).cast(field.type)
        given = given and batch.schema.field(name).type == field.type
        return _built(field, outs, batch.column(name) if given else None, bad)

    while True:
        bad: dict[int, str] = {}
        arrays = [column(field, bad) for field in fields]
        if not bad:
            return arrays, errors
        if not shape.keep_errors:
            raise ResultError(next(iter(bad.values())))
        for i, text in bad.items():
            outs[i], errors[i] = None, text


def _untouched(field: pa.Field, given: list, outs: list[dict | None]) -> bool:
    """Whether the functions handed on an input column as it was."""
    name = field.name
    return not pa.types.is_nested(field.type) and all(
        out is None or name not in out or out[name] is value for out, value in zip(outs, given)
    )


def _built(
    field: pa.Field, outs: list[dict | None], given: pa.Array | None, bad: dict[int, str]
) -> pa.Array | None:
    """A column of result values. Rows whose value does not fit its type go to ``bad``."""
    name = field.name
    if all(out is not None and name in out for out in outs):
        values = [out[name] for out in outs]
    else:  # failed rows and brief results keep what came in
        values = given.to_pylist() if given is not None else [None] * len(outs)
        values = [v if out is None else out.get(name, v) for out, v in zip(outs, values)]
    try:
        return pa.array(values, field.type)
    except _MISFITS:
        for i, value in enumerate(values):
            try:
                pa.array([value], field.type)
            except _MISFITS as exc:
                bad.setdefault(i, f"column {name} cannot hold {value!r}: {exc}")
        return None


def _values(column: pa.Array) -> list:
    """The Python values of a column, like ``to_pylist`` but faster for common types."""
    kind = column.type
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return column.to_numpy(zero_copy_only=False).tolist()
    if not column.null_count and (pa.types.is_integer(kind) or pa.types.is_floating(kind)):
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


def _dicts(columns: dict[str, list], count: int) -> Iterator[dict]:
    if not columns:
        return ({} for _ in range(count))
    names = list(columns)
    return (dict(zip(names, values)) for values in zip(*columns.values()))


# --- list, batch and partition modes --------------------------------------------


def _list_task(bind: Callable, shape: _Shape, size: int | None) -> Callable:
    def unpack(table: pa.Table) -> list[dict]:
        columns = {n: _values(table.column(n).combine_chunks()) for n in table.column_names}
        return list(_dicts(columns, table.num_rows))

    def cut(rows: list[dict], start: int, stop: int) -> list[dict]:
        return rows[start:stop]

    return _chunk_task(bind, shape, size, unpack, cut, _from_rows)


def _frame_task(bind: Callable, shape: _Shape, size: int | None) -> Callable:
    def unpack(table: pa.Table) -> pd.DataFrame:
        return _to_frame(table)

    def cut(frame: pd.DataFrame, start: int, stop: int) -> pd.DataFrame:
        return frame.iloc[start:stop].reset_index(drop=True)

    return _chunk_task(bind, shape, size, unpack, cut, _from_frame)


def _chunk_task(
    bind: Callable, shape: _Shape, size: int | None, unpack: Callable, cut: Callable, pack: Callable
) -> Callable:
    """Many calls per conversion: small batches are cut from a bundle and results put together."""

    def results(call: Callable, table: pa.Table) -> Iterator[pa.RecordBatch]:
        whole, count = unpack(table), table.num_rows
        step = size or max(count, 1)
        for start in range(0, count, step):
            stop = min(start + step, count)
            try:
                yield pack(call(cut(whole, start, stop)), shape)
                continue
            except Exception:
                if not shape.keep_errors:
                    raise
            # one bad row must not take the others with it
            for i in range(start, stop):
                one = table.slice(i, 1)
                try:
                    result = pack(call(unpack(one)), shape)
                except Exception as exc:
                    result = _failed(one, _message(exc), shape)
                yield result

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for call, todo in _started(batches, bind):
            parts = (part for table in _bundles(todo, size) for part in results(call, table))
            for table in _bundles(parts, 1):
                yield from table.combine_chunks().to_batches()

    return task


# whole numbers stay whole beside nulls, and a null is not NaN, in every batch alike
_NULLABLE = {
    pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype(),
    pa.float32(): pd.Float32Dtype(), pa.float64(): pd.Float64Dtype(),
}


def _to_frame(table: pa.Table) -> pd.DataFrame:
    return table.to_pandas(use_threads=False, types_mapper=_NULLABLE.get)


def _stream_task(bind: Callable, shape: _Shape, size: int | None) -> Callable:
    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for table in _bundles(batches, size):
            for start in range(0, table.num_rows, size or max(table.num_rows, 1)):
                yield _to_frame(table.slice(start, size))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for call, todo in _started(batches, bind):
            for frame in call(frames(todo)):
                yield _from_frame(frame, shape)

    return task


def _bundles(batches: Iterable[pa.RecordBatch], size: int | None) -> Iterator[pa.Table]:
    """Tables of some multiple of ``size`` rows (the last one may have a rest).

    Big enough to make converting them worth while, small enough for memory;
    without a size, the batches as they come.
    """
    if size is None:
        yield from (pa.Table.from_batches([b]) for b in batches)
        return
    held: list[pa.RecordBatch] = []
    count = weight = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        weight += batch.nbytes
        if count >= size and (count >= BUNDLE_ROWS or weight >= BUNDLE_BYTES):
            table = pa.Table.from_batches(held)
            rest = table.slice(count - count % size)
            yield table.slice(0, count - count % size)
            held, count, weight = rest.to_batches(), rest.num_rows, rest.nbytes
    if count:
        yield pa.Table.from_batches(held)


def _from_rows(rows: Any, shape: _Shape) -> pa.RecordBatch:
    if not isinstance(rows, list):
        raise ResultError(f"a list function must return a list, got {type(rows).__name__}")
    names = set(shape.out.names)
    for row in rows:
        if not isinstance(row, dict):
            raise ResultError(f"the list must hold dicts, got {type(row).__name__}")
        if row.keys() != names:
            shape.check_keys(row, names)
    return _record_batch(
        [pa.array([r[f.name] for r in rows], f.type) for f in shape.out], [None] * len(rows), shape
    )


def _from_frame(frame: Any, shape: _Shape) -> pa.RecordBatch:
    if not isinstance(frame, pd.DataFrame):
        raise ResultError(f"a batch function must return a pandas frame, got {type(frame).__name__}")
    shape.check_keys(frame.columns, set(shape.out.names))
    columns = dict(frame.items())
    arrays = []
    for field in shape.out:
        column = columns[field.name]
        values = column.values if isinstance(column.values, np.ndarray) else column
        floats = pa.types.is_floating(field.type)  # there NaN is a value; None and NA are nulls
        if floats and isinstance(values, np.ndarray) and values.dtype == object:
            values = [None if v is pd.NA else v for v in values]
        array = pa.array(values, type=field.type, from_pandas=not floats)
        arrays.append(array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array)
    return _record_batch(arrays, [None] * len(frame), shape)


def _failed(one: pa.Table, text: str, shape: _Shape) -> pa.RecordBatch:
    given = one.schema
    arrays = [
        one.column(f.name).combine_chunks()
        if f.name in given.names and given.field(f.name).type == f.type
        else pa.nulls(1, f.type)
        for f in shape.out
    ]
    return _record_batch(arrays, [text], shape)


def _record_batch(
    arrays: list[pa.Array], errors: list[str | None], shape: _Shape
) -> pa.RecordBatch:
    schema = shape.out
    if shape.keep_errors:
        arrays = [*arrays, pa.array(errors, pa.string())]
        schema = schema.append(pa.field(ERROR_COLUMN, pa.string()))
    if not len(schema):
        return pa.RecordBatch.from_struct_array(pa.nulls(len(errors), pa.struct([])))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
