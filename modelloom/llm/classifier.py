"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

Each text becomes a vector of statistics. Cosines of random projections approximate a Gaussian
kernel between such vectors, so a linear ridge fit on them is a kernel fit. Its normal equations
are sums over rows: every task adds up its own, and the sums are added up in two more steps; all
labelled rows take part. Calibration pools adjacent bins of the score until the share of good
texts rises with it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from modelloom.llm.common import Workspace, add_columns, free_name, portions, with_arrays

_BYTES = np.arange(256)


def _among(characters: bytes) -> np.ndarray:
    return np.isin(_BYTES, list(characters))


SPACES = _among(b" \t\n\v\f\r")
SIGNS = _among(b"#*$%&|<>~^=+@/\\_{}[]")
CALLS = _among(b"!?")
STOPS = _among(b".,;:")
DIGITS = _among(b"0123456789")
UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
LOWER = (_BYTES >= 0x61) & (_BYTES <= 0x7A)
WIDTH = 15


def document_statistics(text: str | None) -> list[float]:
    """``WIDTH`` finite numbers about a whole text; zeros without words."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    if not words:
        return [0.0] * WIDTH
    n = len(words)
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    solid = len(data) - int(seen[SPACES].sum())
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    letters = int(seen[UPPER].sum() + seen[LOWER].sum())
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    windows = Counter(zip(words, words[1:], words[2:]))
    again = sum(c for c in windows.values() if c > 1)
    share = lambda mask: math.sqrt(int(seen[mask].sum()) / solid)
    return [
        math.log1p(n), math.log(lengths.mean()), math.log1p(float(lengths.std())), math.log1p(int(lengths.max())),
        share(SIGNS), share(CALLS), share(STOPS), share(DIGITS), share(_BYTES >= 0x80),
        math.sqrt(int(seen[UPPER].sum()) / letters) if letters else 0.0,
        math.log1p(len(counts)) / math.log1p(n), math.sqrt(max(counts.values()) / n),
        math.log1p(n / len(lines)), math.sqrt(1 - len(set(lines)) / len(lines)), math.sqrt(again / max(n - 2, 1)),
    ]


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``statistics`` of each whole text; a column of that name is replaced."""
    def make():
        return lambda texts: {"statistics": pa.array([document_statistics(t) for t in texts], pa.list_(pa.float64()))}

    return add_columns(df, text, make, "statistics array<double>")


@dataclass
class QualityModel:
    """``centre`` and ``scale`` of the statistics, random ``directions`` and ``phases``, ridge
    ``weights`` (first the constant), and the calibration's ``knots`` and ``shares``."""

    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    shares: np.ndarray

    def features(self, statistics: np.ndarray) -> np.ndarray:
        x = np.clip((statistics - self.centre) / self.scale, -8, 8)
        waves = math.sqrt(2 / len(self.phases)) * np.cos(x @ self.directions + self.phases)
        return np.hstack([np.ones((len(x), 1)), waves])

    def raw(self, statistics: np.ndarray) -> np.ndarray:
        return np.round(self.features(statistics) @ self.weights, 9)  # products differ in the last bit by the batch they are in

    def score(self, statistics: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(statistics), self.knots, self.shares)


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)


def fit_quality(
    spark: SparkSession, stats: DataFrame, labels: DataFrame, work: Workspace, key: str = "doc_id", label: str = "quality",
    waves: int = 256, bandwidth: float = 1.0, ridge: float = 1e-4, seed: int = 11, bins: int = 1024,
) -> QualityModel:
    """Learn from all rows of ``stats`` (key and ``statistics``) that ``labels`` names.

    A hash of the key gives three quarters of them to the fit and one to the calibration. The
    kernel's width is ``bandwidth`` times the root of the dimension, in standard deviations;
    ``ridge`` is the penalty per row. A key labelled more than once has its highest label, null
    keys and labels are left out. Without labels of both kinds the score is the same for all
    texts: the share of good ones, half without any. Only sums of fixed size reach the driver.
    """
    chosen = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        (F.max(F.col(label).cast("double")) > 0).cast("double").alias("good")
    )
    known = stats.select(F.col(key).alias("_key"), "statistics").join(chosen, "_key").select(
        "statistics", "good", (F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(4)) == 0).alias("later")
    )
    rows = work.keep(known, "labelled")
    s = [F.col("statistics")[i] for i in range(WIDTH)]
    n, good, *moments = rows.agg(F.count("*"), F.sum("good"), *[F.avg(x) for x in s], *[F.stddev_pop(x) for x in s]).first()
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(WIDTH, waves)) / (bandwidth * math.sqrt(WIDTH))
    phases = rng.uniform(0, 2 * math.pi, waves)
    nothing = QualityModel(
        np.zeros(WIDTH), np.ones(WIDTH), directions, phases, np.zeros(waves + 1), np.zeros(1), np.array([good / n if n else 0.5])
    )
    if not n or good in (0, n):
        return nothing
    centre, scale = np.array(moments[:WIDTH]), np.array(moments[WIDTH:])
    model = QualityModel(centre, np.where(scale > 1e-9, scale, 1.0), directions, phases, nothing.weights, nothing.knots, nothing.shares)
    gram, target, count = _normal_equations(rows.where("not later"), model)
    if not count:
        gram, target, count = _normal_equations(rows, model)
    penalty = np.full(waves + 1, ridge * count)
    penalty[0] = 0
    model.weights = np.linalg.solve(gram + np.diag(penalty) + 1e-9 * np.eye(waves + 1), target)
    model.knots, model.shares = _calibration(rows, model, bins)
    return model


def _normal_equations(rows: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums over all rows of the features' products, of features times label, and of ones."""
    size = len(model.weights)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, target, count = np.zeros((size, size)), np.zeros(size), 0
        for batch in portions(batches, 4096):
            z = model.features(_matrix(batch, "statistics"))
            y = batch.column(batch.schema.get_field_index("good")).to_numpy(zero_copy_only=False)
            gram, target, count = gram + z.T @ z, target + z.T @ y, count + len(y)
        if count:
            yield packed(np.concatenate([gram.ravel(), target, [count]]))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for value in batch.column(0):
                sums = np.frombuffer(value.as_buffer(), float)
                held = sums.copy() if held is None else held + sums
        if held is not None:
            yield packed(held)

    def packed(sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    parts = rows.select("statistics", "good").mapInArrow(partial, "sums binary")
    got = parts.repartition(16).mapInArrow(total, "sums binary").repartition(1).mapInArrow(total, "sums binary").first()
    if got is None:
        return np.zeros((size, size)), np.zeros(size), 0
    sums = np.frombuffer(bytes(got["sums"]), float)
    return sums[:size * size].reshape(size, size), sums[size * size:-1], int(sums[-1])


def _calibration(rows: DataFrame, model: QualityModel, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Knots and shares of good texts that rise with the raw score, from the rows left for it."""
    raw = _scored(rows, "raw double", lambda m: [pa.array(model.raw(m))])
    for later in (raw.where("later"), raw):
        place = F.floor(F.least(F.greatest(F.col("raw"), F.lit(-1.0)), F.lit(2.0)) * bins)
        got = later.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("raw").alias("raw")).collect()
        if 0 < sum(r["good"] for r in got) < sum(r["n"] for r in got):
            break
    blocks: list[list[float]] = []
    for r in sorted(got, key=lambda r: r["bin"]):
        blocks.append([r["n"], r["good"], r["raw"]])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([raw / n for n, _, raw in blocks]), np.array([good / n for n, good, _ in blocks])


def _scored(df: DataFrame, adds: str, compute) -> DataFrame:
    """Add columns computed from the matrix of ``statistics`` to ``df``, those of the same names replaced."""
    new = StructType.fromDDL(adds)
    taken = {f.name.lower() for f in new}
    keep = [c for c in df.columns if c.lower() not in taken]
    source = free_name(df, "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 4096):
            yield with_arrays(batch, keep, dict(zip((f.name for f in new), compute(_matrix(batch, source)))))

    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col("statistics").alias(source))
    return rows.mapInArrow(run, StructType([*(df.schema[c] for c in keep), *new]))


def quality_score(stats: DataFrame, model: QualityModel) -> DataFrame:
    """Add ``score`` (0 to 1, higher: likelier good) and ``predicted`` (1 from 0.5 on) to rows of ``statistics``.

    Null and empty texts have statistics of zeros and get their score. Columns with these names
    are replaced, others stay; repeated rows get the same result.
    """
    def compute(matrix: np.ndarray) -> list[pa.Array]:
        score = model.score(matrix)
        return [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]

    return _scored(stats, "score double, predicted int", compute)
