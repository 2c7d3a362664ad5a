"""Column builders with the semantics data-frame code in Python has.

All of them are plain Spark expressions and stay inside code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelloom.errors import ConfigError


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def free_name(df: DataFrame, name: str) -> str:
    """A name for a helper column that the frame does not have yet."""
    while name in df.columns:
        name += "_"
    return name


def cents_truncated(amount: Column | str) -> Column:
    """Amount in cents, cut off toward zero."""
    return (_col(amount).cast("double") * 100).cast("bigint")


def cents_rounded(amount: Column | str) -> Column:
    """Amount in cents, halves going to the even neighbour."""
    return F.rint(_col(amount).cast("double") * 100).cast("bigint")


def flag(condition: Column) -> Column:
    """A comparison where null counts as false."""
    return F.coalesce(condition, F.lit(False))


def fill_template(template: str, *columns: Column | str, null_text: str | None = None) -> Column:
    """Put columns into the ``{}`` places of a text.

    A null makes the whole text null unless ``null_text`` stands in for it.
    """
    pieces = template.split("{}")
    if len(pieces) != len(columns) + 1:
        raise ConfigError(f"{template!r} has {len(pieces) - 1} places for {len(columns)} columns")
    parts: list[Column] = []
    for piece, column in zip(pieces, [*columns, None]):
        if piece:
            parts.append(F.lit(piece))
        if column is not None:
            value = _col(column).cast("string")
            parts.append(value if null_text is None else F.coalesce(value, F.lit(null_text)))
    return F.concat(*parts) if parts else F.lit("")


def bucketize(
    x: Column | str,
    bins: Sequence[float],
    labels: Sequence[str],
    out_of_range: str | None = "nan",
) -> Column:
    """Label the right-closed interval ``(bins[i], bins[i+1]]`` that holds ``x``.

    Nulls, NaN and values outside all intervals get ``out_of_range``.
    """
    if len(labels) != len(bins) - 1 or not labels:
        raise ConfigError(f"{len(bins)} bin edges need {len(bins) - 1} labels, got {len(labels)}")
    if any(low >= high for low, high in zip(bins, bins[1:])):
        raise ConfigError(f"bin edges must increase: {list(bins)}")
    x = _col(x)
    outside = F.lit(out_of_range)
    chain = F.when(x.isNull() | (x <= F.lit(bins[0])), outside)
    for edge, label in zip(bins[1:], labels):
        chain = chain.when(x <= F.lit(edge), F.lit(label))
    # NaN sorts above infinity, so it falls through to here too
    return chain.otherwise(outside)


def default_if_falsy(x: Column | str, default: object, falsy: object = 0) -> Column:
    """``x or default``: null and the falsy value (0, or ``""`` for text) give the default."""
    return F.coalesce(F.nullif(_col(x), F.lit(falsy)), F.lit(default))


def json_fields(text: Column | str, schema: str, broken: str | None = None) -> Column:
    """Fields of a JSON text as a struct; missing fields, null and empty text give nulls.

    ``broken`` names one more field of the struct, which holds the text itself
    where it is no valid JSON and is null elsewhere.
    """
    options = {}
    if broken is not None:
        schema = f"{schema}, `{broken}` string"
        options["columnNameOfCorruptRecord"] = broken
    return F.from_json(
        F.coalesce(F.nullif(_col(text), F.lit("")), F.lit("{}")), schema, options
    )


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Cast columns to string in place, for sinks that lack their types."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same columns; the optimizer drops the scan."""
    return df.where(F.lit(False))
