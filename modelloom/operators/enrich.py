"""Enriching rows by a client: prompts, parsed replies, lookups, text vectors."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import and_
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from modelloom.errors import ConfigError, ResultError
from modelloom.functions import free_name, json_fields
from modelloom.operators.parallel import ERROR_COLUMN, parallel_map
from modelloom.shared import Scratch, task_count

#: Words whose places a task remembers.
REMEMBERED_WORDS = 100_000
_WORD = re.compile("[^ \t\r\n]+")


def ticket_prompt(subject: Column, body: Column) -> Column:
    """The text a ticket classifier gets."""
    return F.concat(F.lit("Subject: "), subject, F.lit("\n\n"), body)


def enrich(
    df: DataFrame,
    prompt: Column,
    make_client: Callable[[], Callable[[str], str]],
    fields: str,
    *,
    workers: int | None = None,
    on_error: str = "column",
    resources: ResourceProfile | None = None,
) -> DataFrame:
    """Send a prompt per row to a client and put the JSON reply's fields into columns.

    ``make_client`` runs on the worker and returns a callable from prompt to
    reply text. Only the prompt travels to Python; replies are parsed in the
    JVM. With ``on_error="column"`` a failing call or a reply that is no valid
    JSON keeps the row, nulls the fields and fills ``error``; otherwise it fails
    the job wherever one of the fields is used, and there is no such column.
    """
    names = StructType.fromDDL(fields).fieldNames()
    question, answer, found = (free_name(df, n) for n in ("_prompt", "_reply", "_fields"))

    def ask(row: dict, client: Callable[[str], str]) -> dict:
        return {answer: client(row[question])}

    asked = parallel_map(
        df.withColumn(question, prompt),
        ask,
        adds=f"`{answer}` string",
        setup=make_client,
        input_cols=[question],
        workers=workers,
        on_error=on_error,
        resources=resources,
    )
    parsed = asked.withColumn(found, json_fields(answer, fields, broken="_corrupt"))
    broken = F.col(f"`{found}`._corrupt").isNotNull()
    text = F.concat(F.lit("reply is not valid JSON: "), F.col(f"`{found}`._corrupt"))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in names]
    if on_error != "column":  # any field that is read fails the job
        return parsed.select(
            *kept, *[F.when(broken, F.raise_error(text)).otherwise(F.col(f"`{found}`.`{n}`")).alias(n) for n in names]
        )
    return parsed.select(
        *kept, *[F.when(~broken, F.col(f"`{found}`.`{n}`")).alias(n) for n in names],
        F.coalesce(F.col(ERROR_COLUMN), F.when(broken, text)).alias(ERROR_COLUMN),
    )


def lookup(
    df: DataFrame,
    keys: str | Sequence[str],
    call: Callable[..., dict],
    adds: str,
    *,
    setup: Callable[[], Any] | None = None,
    workers: int | None = None,
    on_error: str = "fail",
    resources: ResourceProfile | None = None,
    batch_size: int | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Ask an outside service once per distinct key and join the answers back.

    With ``batch_size`` a call gets a list of up to so many keys, as dicts, and
    returns a list of dicts, each with its key and the answers, in any order.

    Duplicates are removed map-side first, so a key that fills a third of the
    table costs one call; the calls are spread over many tasks, ``workers`` at
    most. Rows with a null key get null answers. The join keeps every row and
    may be split by adaptive skew handling on the row side. ``df`` is needed
    twice: with a ``scratch`` it is computed once and stored there, without one
    it is computed twice, which suits a plain scan. Columns of ``df`` with the
    name of an answer are replaced.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not keys:
        raise ConfigError("lookup needs at least one key column")
    if scratch is not None:
        df = scratch.keep(df, "lookup")
    present = reduce(and_, [F.col(k).isNotNull() for k in keys])
    distinct = df.where(present).select(*keys).distinct()
    answers = parallel_map(
        distinct, call, adds=adds, mode="list" if batch_size else "row", batch_size=batch_size, setup=setup,
        workers=workers or task_count(df.sparkSession), on_error=on_error, resources=resources,
    )
    new = set(answers.columns) - set(keys)
    df = df.drop(*new)
    return df.join(answers, keys, "left").select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.col(f"`{c}`") for c in answers.columns if c not in keys],
    )


def lead_sentence(text: Column) -> Column:
    """The text up to its first sentence end."""
    return F.trim(F.substring_index(text, ". ", 1))


def words(text: Column) -> Column:
    """Words between blanks, tabs and line ends; some are empty where several of them meet."""
    return F.split(F.regexp_replace(text, "[\t\r\n]", " "), " ")


def embed_text(
    df: DataFrame,
    key: str,
    text: str,
    *,
    dim: int = 64,
    place: Callable[[str], int | None] | None = None,
    bucket: Callable[[Column], Column] | None = None,
    out: str = "embedding",
) -> DataFrame:
    """Add a hashed bag of words: one unit-length vector of ``dim`` per row.

    ``place`` gives a word's place, 0 to ``dim - 1`` (others fail the job; None
    counts as 0); without one it is a hash of the word. ``bucket`` does the same
    by a column expression, which is slower. A text without words gets zeros.
    Words are counted in Arrow batches beside the row, so nothing is shuffled,
    all columns stay and rows that repeat a key are independent.
    """
    if place is not None and bucket is not None:
        raise ConfigError("give place or bucket, not both")

    def checked(found: int | None, word: str) -> int:
        if found is not None and not 0 <= found < dim:
            raise ResultError(f"bucket {found} of {word!r} is not in 0 to {dim - 1}")
        return int(found or 0)

    def place_of(word: str) -> int:
        if place is not None:
            return checked(place(word), word)
        found = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), 42)
        return (found - (found >> 63 << 64)) % dim  # as a signed number

    def unit(counts: np.ndarray) -> pa.Array:
        norm = np.sqrt((counts * counts).sum(axis=1, keepdims=True).astype(float))
        values = counts / np.where(norm > 0, norm, 1.0)
        offsets = np.arange(len(counts) + 1, dtype=np.int32) * dim
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))

    def count_words(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        places: dict[str, int] = {}
        for part in parts:
            counts = np.zeros((len(part), dim))
            for row, value in zip(counts, part.to_pylist()):
                for word, n in Counter(_WORD.findall(value or "")).items():
                    at = places.get(word)
                    if at is None:
                        if len(places) >= REMEMBERED_WORDS:
                            places.clear()
                        at = places[word] = place_of(word)
                    row[at] += n
            yield unit(counts)

    def count_places(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            lengths, found = np.diff(part.offsets.to_numpy()), part.flatten().to_numpy(zero_copy_only=False)
            if len(found) and (found.min() < 0 or found.max() >= dim):
                raise ResultError(f"bucket {found[(found < 0) | (found >= dim)][0]} is not in 0 to {dim - 1}")
            slots = np.repeat(np.arange(len(part)), lengths) * dim + found
            yield unit(np.bincount(slots, minlength=len(part) * dim).reshape(len(part), dim))

    if bucket is None:
        return df.withColumn(out, F.arrow_udf(count_words, "array<double>")(F.col(f"`{text}`")))
    found = F.filter(words(F.col(f"`{text}`")), lambda word: word != "")
    places = F.transform(found, lambda word: F.coalesce(bucket(word).cast("int"), F.lit(0)))
    return df.withColumn(out, F.arrow_udf(count_places, "array<double>")(F.coalesce(places, F.array().cast("array<int>"))))
