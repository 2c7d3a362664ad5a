"""Scoring rows: closed formulas as columns, fitted models as batch functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from modelloom.functions import default_if_falsy, free_name
from modelloom.operators.parallel import bind_setup, parallel_map
from modelloom.shared import Scratch, scratch_path

# fixed values of the churn formula
CHURN_RECENCY_SCALE = 90.0
CHURN_ORDER_SCALE = 5.0
CHURN_ORDER_WEIGHT = 0.1
CHURN_DEFAULT_RECENCY = 365


def churn_score(recency: Column | str, orders: Column | str) -> Column:
    """Churn score in [0, 1], four decimals; a recency of null or 0 counts as 365 days."""
    days = default_if_falsy(recency, CHURN_DEFAULT_RECENCY)
    count = default_if_falsy(orders, 0)
    raw = (
        1.0
        - F.exp(-days / CHURN_RECENCY_SCALE)
        + CHURN_ORDER_WEIGHT * F.exp(-count / CHURN_ORDER_SCALE)
    )
    return F.round(F.least(raw, F.lit(1.0)), 4)


def order_activity(
    customers: DataFrame, orders: DataFrame, *, customer_key: str, order_customer: str,
    order_date: str, order_amount: str,
) -> DataFrame:
    """Spend, order count and days since the last order of every customer.

    Orders are summed per customer before the join, so the join sees one row
    per key. Days count back from the newest order in the data.
    """
    summed = orders.groupBy(F.col(order_customer).alias(customer_key)).agg(
        F.sum(order_amount).alias("total_spend"),
        F.count("*").alias("order_count"),
        F.max(order_date).alias("_last"),
    )
    # the newest of all from the sums; it asks for all their columns so that both uses share one shuffle
    newest = summed.agg(F.max(F.struct("_last", "order_count", "total_spend")).getField("_last")).scalar()
    per_customer = (
        summed.select(
            customer_key, "total_spend", "order_count",
            F.datediff(newest, F.col("_last")).alias("days_since_last_order"),
        )
    )
    return customers.join(per_customer, customer_key, "left")


def score_batches(
    df: DataFrame,
    features: Sequence[str],
    load: Callable[[], Any],
    predict: Callable[[pd.DataFrame, Any], Any],
    adds: str,
    *,
    workers: int | None = None,
    resources: ResourceProfile | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """Run a fitted model over batches of its feature columns.

    ``load`` makes the model once per Python worker. ``predict`` gets a frame
    of the features and the model, and returns one value per row (or, for
    several added columns, a frame). All other columns stay in the JVM, unless
    ``workers``, ``resources`` or ``on_error="column"`` ask for a whole
    :func:`parallel_map` in batches, which has the meaning of these three.
    """
    names = StructType.fromDDL(adds).fieldNames()
    if workers is not None or resources is not None or on_error != "fail":

        def beside(frame: pd.DataFrame, model: Any) -> pd.DataFrame:
            result = predict(frame[list(features)], model)
            if not isinstance(result, pd.DataFrame):
                result = pd.DataFrame({names[0]: result})
            return frame.assign(**{n: result[n].array for n in names})

        return parallel_map(
            df, beside, adds=adds, mode="batch", setup=load, workers=workers, resources=resources, on_error=on_error
        )
    bind = bind_setup(predict, load)

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = None
        for frame in parts:
            call = call or bind()
            result = call(frame)
            if not isinstance(result, pd.DataFrame):
                result = pd.DataFrame({names[0]: result})
            yield result[names].reset_index(drop=True)

    udf = F.pandas_udf(score, adds).asNondeterministic()
    slot = free_name(df, "_scores")
    scored = df.withColumn(slot, udf(F.struct(*[F.col(f"`{c}`") for c in features])))
    return scored.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in names],
        *[F.col(f"`{slot}`.`{n}`").alias(n) for n in names],
    )


def logistic(
    df: DataFrame, weights: dict[str, float], bias: float, *, out: str = "score"
) -> DataFrame:
    """Logistic regression with given weights, six decimals; a null feature gives a null score."""
    total = F.lit(float(bias))
    for name, weight in weights.items():
        total = total + F.col(f"`{name}`").cast("double") * float(weight)
    return df.withColumn(out, F.round(1.0 / (1.0 + F.exp(-total)), 6))


def fit_centroids(df: DataFrame, label: str, vector: str, *, scratch: Scratch | None = None) -> DataFrame:
    """Mean vector of every label, written to the shared folder as the fitted model.

    With a ``scratch`` the folder goes when that is closed. Sums per (label, position) are combined map-side, so a label holding most
    of the vectors costs its task no more than any other.
    """
    means = (
        df.where(F.col(label).isNotNull())
        .select(label, F.posexplode(vector).alias("_at", "_value"))
        .groupBy(label, "_at")
        .agg(F.avg(F.col("_value").cast("double")).alias("_mean"))
        .groupBy(label)
        .agg(F.sort_array(F.collect_list(F.struct("_at", "_mean"))).alias("_means"))
        .select(label, F.col("_means._mean").alias("centroid"))
    )
    spark = df.sparkSession
    path = scratch.path("centroids") if scratch else scratch_path(spark, "centroids")
    means.write.parquet(path)
    return spark.read.schema(means.schema).parquet(path)


def nearest_centroid(
    df: DataFrame,
    key: str,
    vector: str,
    centroids: DataFrame,
    *,
    label: str = "label",
    out: tuple[str, str] = ("nearest", "similarity"),
    block: int = 4096,
    scratch: Scratch | None = None,
    budget: int = 128 << 20,
) -> DataFrame:
    """The centroid of highest cosine (six decimals; ties to the smaller label).

    The centroids are written to the shared folder at unit length. Rows stay
    where they are: every task streams over the written blocks of ``block``
    centroids and keeps the best so far for its batch of rows. Centroids of up to
    ``budget`` bytes are read once a task, more once for every batch of rows. With
    a ``scratch`` their folder goes when that is closed. Rows are
    independent, whatever their ``key``. A vector that is null, zero, not finite
    or of another length than all centroids gets a null label and similarity; so
    does every row if there are no centroids.
    """
    name, similarity = out
    spark = df.sparkSession
    folder = scratch.path("units") if scratch else scratch_path(spark, "units")
    centroids.select(F.col(label).alias("label"), _unit(F.col("centroid")).alias("unit")).where(
        F.col("label").isNotNull() & F.col("unit").isNotNull()
    ).write.parquet(folder)
    label_type = centroids.schema[label].dataType.simpleString()

    def blocks() -> Iterator[tuple[np.ndarray, list]]:
        place, base = _file_system(folder)
        for info in sorted(place.get_file_info(fs.FileSelector(base)), key=lambda i: i.path):
            if info.path.endswith(".parquet"):
                with place.open_input_file(info.path) as file:
                    for batch in pq.ParquetFile(file).iter_batches(block):
                        by_length: dict[int, list] = {}
                        for name, unit in zip(*(c.to_pylist() for c in batch.columns)):
                            if unit and None not in unit:
                                by_length.setdefault(len(unit), []).append((name, unit))
                        for pairs in by_length.values():
                            pairs.sort(key=lambda p: p[0])
                            units = np.array([p[1] for p in pairs], dtype=float)
                            if np.isfinite(units).all(axis=1).any():
                                yield np.nan_to_num(units, nan=-np.inf), [p[0] for p in pairs]

    def nearest(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held: list | None = None  # all blocks, once they are known to fit

        def every() -> Iterator[tuple[np.ndarray, list]]:
            nonlocal held
            if held is not None:
                yield from held
                return
            kept, weight = [], 0
            for matrix, labels in blocks():
                weight += matrix.nbytes
                kept = kept + [(matrix, labels)] if weight <= budget else []
                yield matrix, labels
            if weight <= budget:
                held = kept

        for vectors in parts:
            units = [_unit_vector(v) for v in vectors]
            lengths = np.array([-1 if u is None else len(u) for u in units])
            best, found = np.full(len(units), -np.inf), np.full(len(units), None, dtype=object)
            stacked = {n: np.stack([u for u in units if u is not None and len(u) == n]) for n in set(lengths) - {-1}}
            for matrix, labels in every() if stacked else ():
                rows = np.flatnonzero(lengths == matrix.shape[1])
                if not len(rows):
                    continue
                with np.errstate(invalid="ignore"):
                    cosine = np.round(stacked[matrix.shape[1]] @ matrix.T, 6)
                cosine[~np.isfinite(cosine)] = -np.inf
                top = cosine.argmax(axis=1)  # the first of equals, hence the smaller label
                value = cosine[np.arange(len(rows)), top]
                for i, v, t in zip(rows, value, top):
                    if v > best[i] or (v == best[i] and found[i] is not None and labels[t] < found[i]):
                        best[i], found[i] = v, labels[t]
            yield pd.DataFrame({
                name: found, similarity: [None if f is None else float(b) for b, f in zip(best, found)],
            })

    udf = F.pandas_udf(nearest, f"`{name}` {label_type}, `{similarity}` double").asNondeterministic()
    slot = free_name(df, "_nearest")
    return df.withColumn(slot, udf(F.col(f"`{vector}`"))).select(
        *[F.col(f"`{c}`") for c in df.columns if c not in out],
        *[F.col(f"`{slot}`.`{n}`").alias(n) for n in out],
    )


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path in the shared folder, and the path there."""
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


def _unit_vector(values: np.ndarray | None) -> np.ndarray | None:
    if values is None or not len(values):
        return None
    vector = np.asarray(values, dtype=float)  # a null component becomes NaN
    length = np.linalg.norm(vector)
    return vector / length if np.isfinite(length) and length > 0 else None


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def _unit(v: Column) -> Column:
    length = F.sqrt(_dot(v, v))
    return F.when(length > 0, F.transform(v, lambda x: x.cast("double") / length))
