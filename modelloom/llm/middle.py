"""Fill-in-the-middle: texts cut at unit borders into prefix, middle and suffix, and put in a new order.

One full match of ``(unit)*`` by the regex library keeps every repetition, so the ends of its
first group are the borders of all units: their number is n, and both cuts are read from them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from modelloom.errors import ConfigError
from modelloom.llm.common import column_values, free_name, portions, with_arrays

#: Lines, with their ends.
LINES = r"[^\n]*\n|[^\n]+"
MARKERS = ("<P>", "<S>", "<M>")


def _checked(markers: Sequence[str]) -> tuple[str, str, str]:
    if len(markers) != 3 or not all(markers) or len(set(markers)) != 3:
        raise ConfigError("three different markers are needed")
    first = {m[0] for m in markers}
    if any(c in first for m in markers for c in m[1:]):
        raise ConfigError("a marker's first character must not occur later in a marker, or outputs could be read in two ways")
    return tuple(markers)


def fill_in_middle(
    df: DataFrame, key: str = "doc_id", text: str = "text", unit: str = LINES, markers: Sequence[str] = MARKERS,
    rate: int = 100, suffix_first: int = 50, seed: int = 7,
) -> DataFrame:
    """Add ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` to ``df``.

    The first four 8-digit groups of the hex SHA-256 of ``seed:key`` choose the cuts, whether a
    text is changed (``rate`` in a hundred) and whether its suffix comes first (``suffix_first``
    in a hundred: ``spm``, else ``psm``), so a retry or another order of rows gives the same
    output, and rows that repeat a key and text the same. Null texts are empty, null keys hashed
    as an empty one. Empty texts, texts with a marker and those not made of units (n is 0 then)
    stay ``plain``: the text itself, with null lengths. Columns with these names are replaced.
    """
    p, s, m = _checked(markers)
    adds = StructType.fromDDL("n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    names = [f.name for f in adds]
    keep = [c for c in df.columns if c.lower() not in names]
    source, draw = free_name(df, "value"), free_name(df, "draw")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256)
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(source), F.substring(digest, 1, 32).alias(draw))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"(?V0)({unit})*+")
        for batch in portions(batches):
            out = []
            for value, digits in zip(column_values(batch, source), column_values(batch, draw)):
                value = value or ""
                found = units.fullmatch(value)
                ends = found.ends(1) if found else []
                n = len(ends)
                h1, h2, h3, h4 = (int(digits[i:i + 8], 16) for i in (0, 8, 16, 24))
                if not n or p in value or s in value or m in value or h3 % 100 >= rate:
                    out.append((n, "plain", None, None, value))
                    continue
                low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                a, b = (ends[k - 1] if k else 0 for k in (low, high))
                if h4 % 100 < suffix_first:
                    out.append((n, "spm", a, b - a, "".join((s, value[b:], p, value[:a], m, value[a:b]))))
                else:
                    out.append((n, "psm", a, b - a, "".join((p, value[:a], s, value[b:], m, value[a:b]))))
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield with_arrays(batch, keep, {n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(names, types))})

    return rows.mapInArrow(run, StructType([*(df.schema[c] for c in keep), *adds]))


def restored(output: str = "output", form: str = "form", markers: Sequence[str] = MARKERS) -> Column:
    """The text again, from output and form alone."""
    _checked(markers)
    parts = F.split(F.col(output), "|".join(rf"\Q{m}\E" for m in markers))
    return (
        F.when(F.col(form) == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(F.col(form) == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(F.col(output))
    )
