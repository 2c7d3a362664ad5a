"""Language of texts: averaged hashed subword embeddings with a linear softmax.

A text's subwords (letters in runs of two to four, word ends marked) are hashed into buckets;
the mean of their vectors goes through a linear layer. Both are trained together by stochastic
gradient descent in numpy, on a bounded sample. Since all of it is linear up to the softmax,
a trained model is one table of a score per bucket and language.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelloom.llm.common import add_columns, worker_state

UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # buckets x languages, embedding times softmax weights
    bias: np.ndarray
    temperature: float  # of the softmax, fitted on rows not trained on
    threshold: float  # predictions under it are rejected


def letter_table() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def subword_counts(text: str, letters: np.ndarray, buckets: int) -> np.ndarray:
    """How often each bucket's subwords occur in the whole text.

    Runs of other characters than letters count as one word end. A subword has word ends
    only as its first or last character.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    points = np.where(letters[points], points, 0)
    points = np.concatenate([[0], points, [0]]).astype(np.uint32)
    points = points[np.concatenate([[True], (points[1:] != 0) | (points[:-1] != 0)])]
    ends = points == 0
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    total = np.zeros(buckets, np.int64)
    rolled = points * np.uint32(0x01000193)
    inside = np.ones(len(points), bool)
    for size in (2, 3, 4):
        if len(points) < size:
            break
        rolled = (rolled[:-1] ^ points[size - 1:]) * np.uint32(0x01000193)
        if size > 2:
            inside = inside[:-1] & ~ends[size - 2:-1]
            found = rolled[inside]
        else:
            inside, found = inside[:-1], rolled
        mixed = (found ^ (found >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        total += np.bincount(mixed >> shift, minlength=buckets)
    return total


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(
    counts: np.ndarray, labels: np.ndarray, languages: list[str], dimensions: int = 16, epochs: int = 30,
    rate: float = 4.0, batch: int = 32, seed: int = 7, reject: float = 0.001,
) -> LanguageModel:
    """Fit on rows of bucket counts; every fifth row is held back for temperature and threshold.

    The threshold is the score that all but a share ``reject`` of the held-back rows reach with
    their true language, and 0.5 at most, so that ordinary texts are kept.
    """
    random = np.random.default_rng(seed)
    x = np.asarray(counts, np.float32)
    x = np.divide(x, np.maximum(x.sum(axis=1, keepdims=True), 1), out=x if x.flags.writeable else None)
    order = random.permutation(len(x))
    back, used = (order[::5], order[np.arange(len(order)) % 5 != 0]) if len(x) >= 10 else (order, order)
    buckets, k = x.shape[1], len(languages)
    vectors = random.normal(0, 0.5, (buckets, dimensions)).astype(np.float32)
    weights, bias = np.zeros((dimensions, k), np.float32), np.zeros(k, np.float32)
    share = np.bincount(labels[used], minlength=k)
    weight = (len(used) / (k * np.maximum(share, 1))).astype(np.float32)  # a large language does not drown small ones
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for part in np.array_split(random.permutation(used), max(1, len(used) // batch)):
            mean = x[part] @ vectors
            error = _softmax(mean @ weights + bias)
            error[np.arange(len(part)), labels[part]] -= 1
            error *= weight[labels[part]][:, None] / len(part)
            to_mean = error @ weights.T
            weights -= step * mean.T @ error
            bias -= 0.1 * step * error.sum(axis=0)
            vectors -= step * buckets ** 0.5 * (x[part].T @ to_mean)
    table = vectors @ weights
    scores, truth = x[back] @ table + bias, labels[back]
    at = np.arange(len(back))
    temperature = min(
        np.geomspace(0.05, 20, 60), key=lambda t: -np.log(np.maximum(_softmax(scores / t)[at, truth], 1e-12)).mean()
    ) if k > 1 else 1.0
    sure = _softmax(scores / temperature)[at, truth]
    threshold = float(min(0.5, np.quantile(sure, reject))) if len(sure) else 0.0
    return LanguageModel(languages, table.astype(np.float32), bias, float(temperature), threshold)


def fit_language(
    df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", usable: Column | None = None,
    per_language: int = 400, buckets: int = 4096, most_rows: int = 8000, most_languages: int = 400,
) -> LanguageModel | None:
    """Train on about ``per_language`` whole texts of each language of ``df`` (of the rows ``usable``).

    With more than ``most_rows`` / ``per_language`` languages each gives fewer, so that the driver
    holds about ``most_rows`` rows of ``buckets`` numbers. These bounds are the only sampling here:
    rows are chosen by a hash of their key and text, so the same rows at any partitioning, and
    repeated rows once. The languages are the values of ``lang`` that occur, of more than
    ``most_languages`` the most frequent ones; rows with null text or language are left out.
    None if no row is left.
    """
    rows = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.lit(True) if usable is None else usable))
    rows = rows.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    often = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages)
    sizes = {r["lang"]: r["count"] for r in often.collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    per_language = min(per_language, max(1, most_rows // len(languages)))
    share = F.create_map(*(F.lit(v) for name in languages for v in (name, min(1.0, per_language / sizes[name]))))
    drawn = F.pmod(F.xxhash64("key", "text"), F.lit(1_000_003)) < share[F.col("lang")] * 1_000_003
    sample = rows.where(drawn).dropDuplicates(["key", "text", "lang"]).select("lang", "text")

    def make():
        letters = worker_state("letters", letter_table)

        def compute(texts: list) -> dict[str, pa.Array]:
            return {"counts": pa.array([subword_counts(t, letters, buckets).astype("<f4").tobytes() for t in texts], pa.binary())}

        return compute

    found = add_columns(sample, "text", make, "counts binary").select("lang", "counts").toArrow()
    if not found.num_rows:
        return None
    # in an order of their own, whatever the partitioning; the driver holds the counts once
    names, data = found.column("lang").to_pylist(), found.column("counts")
    order = sorted(range(len(names)), key=lambda i: (names[i], hashlib.sha256(data[i].as_buffer()).digest()))
    counts = np.empty((len(names), buckets), np.float32)
    for row, i in enumerate(order):
        counts[row] = np.frombuffer(data[i].as_buffer(), "<f4")
    del found, data
    return train(counts, np.asarray([languages.index(names[i]) for i in order]), languages)


def detect_language(df: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (of that language, calibrated, 0 to 1) and ``rejected`` to ``df``.

    Texts that are null or have no letter get ``und``, score 0, and are rejected; so does every
    text if there is no model. Others always get a learned language and are rejected if its
    score is under the model's threshold. Columns with these names are replaced, others stay;
    repeated rows get the same result.
    """
    def make() -> Callable[[list], dict[str, pa.Array]]:
        letters = worker_state("letters", letter_table)

        def compute(texts: list) -> dict[str, pa.Array]:
            names, scores, rejected = [], [], []
            for value in texts:
                counts = subword_counts(value, letters, len(model.table)) if value and model else None
                if counts is None or not counts.any():
                    names.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                    continue
                z = (counts @ model.table / counts.sum() + model.bias)[None, :]
                p = _softmax(z.astype(np.float64) / model.temperature)[0]
                best = int(p.argmax())
                names.append(model.languages[best])
                scores.append(float(p[best]))
                rejected.append(bool(p[best] < model.threshold))
            return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64()), "rejected": pa.array(rejected, pa.bool_())}

        return compute

    return add_columns(df, text, make, "lang_pred string, score double, rejected boolean")


