"""Declared data tests: columns without nulls, columns without repeated values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelloom.errors import ConfigError

TESTS = ("not_null", "unique")


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """The rows with a null in any of the columns."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values (or combinations) that occur more than once, with how often; nulls are left out."""
    present = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    return present.groupBy(*columns).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def suite(tables: Mapping[str, tuple[DataFrame, Mapping[str, Sequence[str]]]]) -> DataFrame:
    """All declared tests as one frame of (model, column, test, failures).

    ``tables`` maps a model to its frame and to the tests of its columns. The
    ``not_null`` tests of one table share a single pass; a ``unique`` test of
    several columns names them with commas between.
    """
    results: list[DataFrame] = []
    for model, (df, tests) in tables.items():
        for column, names in tests.items():
            for name in names:
                if name not in TESTS:
                    raise ConfigError(f"unknown test {name!r} on {model}.{column}")
        required = [c for c, names in tests.items() if "not_null" in names]
        if required:
            results.append(_null_counts(model, df, required))
        for column, names in tests.items():
            if "unique" in names:
                keys = [c.strip() for c in column.split(",")]
                results.append(
                    unique(df, *keys).agg(F.count("*").alias("failures")).select(
                        F.lit(model).alias("model"), F.lit(column).alias("column"),
                        F.lit("unique").alias("test"), "failures",
                    )
                )
    if not results:
        raise ConfigError("no tests declared")
    return reduce(DataFrame.unionByName, results)


def _null_counts(model: str, df: DataFrame, columns: list[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    lines = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("failures"))
        for i, c in enumerate(columns)
    ])
    return counts.select(F.explode(lines).alias("t")).select(
        F.lit(model).alias("model"), F.col("t.column").alias("column"),
        F.lit("not_null").alias("test"), F.col("t.failures").alias("failures"),
    )


def passed(results: DataFrame) -> bool:
    """Whether no test of a suite has failures."""
    return results.where("failures > 0").isEmpty()
