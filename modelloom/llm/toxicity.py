"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded texts.

Folding undoes look-alike letters of other scripts and digits or signs put for letters, so that
a disguised word meets its entry. Entries are words or beginnings of words; a word counts its
heaviest entry once, unless it stands in an exception phrase. The sum, as it is and normalised by
the text's length, goes through a logistic function. Entries, weights, exceptions and that
function are learned from labelled rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelloom.llm.common import Workspace, add_columns, column_values, portions

# fixed values: letters of other scripts that look like Latin ones
LOOK_ALIKES = dict(zip(
    "абвгеёзікмнорсстуухьјѕԁԛԝһ" "αβγεικνορτυχω",
    "a6bree3ikmhopcctyyxbjsdqwh" "abyeikvoptuxw",
))
# fixed values: digits and signs that stand for letters
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "b", "7": "t", "8": "b", "9": "g"}
INNER_SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "€": "e"}
HIDDEN = dict.fromkeys([0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])

_TABLE = {ord(a): b for a, b in (LOOK_ALIKES | SUBSTITUTES).items()} | HIDDEN | {ord("l"): "i"}
_TABLE |= {k: _TABLE.get(ord(v), v) for k, v in _TABLE.items() if isinstance(v, str)}
_INNER = re.compile(r"(?<=\w)[@$!|€](?=\w)")
_BETWEEN = re.compile(r"[\W_]+")


def folded(text: str | None) -> str:
    """The words of a text in folded form, a space before, between and after them.

    ``l`` and ``i`` become one letter, since ``1`` and ``|`` are put for either.
    """
    text = (text or "")
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = _INNER.sub(lambda m: INNER_SIGNS[m[0]], text.lower()).translate(_TABLE)
    return f" {_BETWEEN.sub(' ', text).strip()} "


@dataclass
class Lexicon:
    """Entries are `` word `` or `` beginning`` (a space in front, one behind for whole words)."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    coefficients: tuple[float, float, float] = (0.0, 0.0, 0.0)


def matcher(lexicon: Lexicon) -> Callable[[str], list[tuple[int, float]]]:
    """From a folded text to the places of its counted words and their weights."""
    import ahocorasick

    entries = ahocorasick.Automaton()
    for phrase in lexicon.exceptions:
        entries.add_word(phrase, (phrase, None))
    for entry, weight in lexicon.weights.items():
        entries.add_word(entry, (entry, weight))
    if not len(entries):
        return lambda text: []
    entries.make_automaton()

    def find(text: str) -> list[tuple[int, float]]:
        found, excepted = {}, []
        for end, (entry, weight) in entries.iter(text):
            start = end - len(entry) + 1
            if weight is None:
                excepted.append((start, end))
            else:
                found[start] = max(weight, found.get(start, -math.inf))
        return [(s, w) for s, w in sorted(found.items()) if not any(a <= s < b for a, b in excepted)]

    return find


def features(total: float, words: int) -> list[float]:
    return [1.0, math.log1p(total), math.log1p(100 * total / (words + 20))]


def toxicity(df: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``hits`` (counted words) to ``df``.

    Null and empty texts have no hits and get the score of a text without any. Columns of these
    names are replaced, others stay; repeated rows get the same result.
    """
    def make():
        find = matcher(lexicon)

        def compute(texts: list) -> dict[str, pa.Array]:
            scores, hits = [], []
            for value in texts:
                words = folded(value)
                found = find(words)
                x = features(sum(w for _, w in found), max(words.count(" ") - 1, 0))
                z = sum(a * b for a, b in zip(lexicon.coefficients, x))
                scores.append(1 / (1 + math.exp(-max(-500.0, min(500.0, z)))))
                hits.append(len(found))
            return {
                "score": pa.array(scores, pa.float64()), "predicted": pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                "hits": pa.array(hits, pa.int32()),
            }

        return compute

    return add_columns(df, text, make, "score double, predicted int, hits int")


def word_features(text: str, shortest: int = 4, longest: int = 8) -> set[str]:
    """The words of a folded text, and their beginnings."""
    found = set()
    for word in set(text.split()):
        if len(word) > 2:
            found.add(f" {word} ")
            found.update(f" {word[:n]}" for n in range(shortest, min(longest, len(word) - 1) + 1))
    return found


def neighbours(text: str, find) -> set[str]:
    """The two-word phrases around the counted words of a folded text."""
    found = set()
    for start, _ in find(text):
        end = text.index(" ", start + 1)
        after = text.find(" ", end + 1)
        if after > 0:
            found.add(text[start:after + 1])
        if start > 0:
            found.add(text[text.rindex(" ", 0, start):end + 1])
    return found


def _counted(rows: DataFrame, make: Callable[[], Callable[[str], set[str]]]) -> DataFrame:
    """(feature, toxic, clean): in how many texts of either label each feature is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, counts = make(), (Counter(), Counter())
        for batch in portions(batches):
            for text, toxic in zip(column_values(batch, "text"), column_values(batch, "toxic")):
                counts[toxic].update(of(folded(text)))
        every = list(counts[0].keys() | counts[1].keys())
        for at in range(0, len(every), 50_000):
            part = every[at:at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array([counts[1][f] for f in part], pa.int64()), pa.array([counts[0][f] for f in part], pa.int64())],
                names=["feature", "toxic", "clean"],
            )

    found = rows.mapInArrow(run, "feature string, toxic bigint, clean bigint")
    return found.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, work: Workspace, text: str = "text", key: str = "doc_id",
    label: str = "toxic", most_rows: int = 30_000, most_entries: int = 20_000, least_lift: float = 20.0,
) -> Lexicon:
    """Learn from at most ``most_rows`` labelled rows (of ``labels``, chosen by a hash of the key).

    That documented bound is the only sampling: it also proves the bound of the broadcast that
    picks their texts out of ``docs`` without a shuffle. Two thirds of the rows give entries -
    words and beginnings of words at least ``least_lift`` times as frequent in toxic texts - and
    exceptions, one third the coefficients. A key labelled more than once takes its highest
    label. Without toxic rows the lexicon is empty and the score is constant.
    """
    chosen = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("key"), F.col(label).cast("int").alias("toxic")
    ).orderBy(F.xxhash64("key"), "key", "toxic").limit(most_rows).groupBy("key").agg(F.max("toxic").alias("toxic"))
    rows = work.keep(
        docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")
        .select("text", F.least(F.greatest("toxic", F.lit(0)), F.lit(1)).alias("toxic"), (F.pmod(F.xxhash64("key", F.lit(1)), F.lit(3)) == 0).alias("later")),
        "labelled",
    )
    first = rows.where("not later").select("text", "toxic")
    n_clean, n_toxic = (first.where(F.col("toxic") == t).count() for t in (0, 1))
    lexicon = Lexicon()
    if n_toxic:
        support = max(2, math.ceil(0.002 * n_toxic))
        seen = _counted(first.where("toxic = 1"), lambda: word_features).where(F.col("toxic") >= support)
        candidates = frozenset(r["feature"] for r in seen.orderBy(F.desc("toxic"), "feature").limit(10 * most_entries).collect())
        both = _counted(first, lambda: lambda t: word_features(t) & candidates)
        rate = lambda c, n: (F.col(c) + 0.5) / (n + 1)
        lift = F.log(rate("toxic", n_toxic) / rate("clean", n_clean))
        best = both.withColumn("lift", lift).where((F.col("lift") >= math.log(least_lift)) & (F.col("toxic") >= support))
        found = best.orderBy(F.desc("lift"), "feature").limit(most_entries).collect()
        lexicon.weights = {r["feature"]: round(float(r["lift"]), 4) for r in found}
        around = Lexicon(lexicon.weights)

        def phrases():
            find = matcher(around)
            return lambda t: neighbours(t, find)

        mild = _counted(first, phrases).where((F.col("clean") >= support) & (F.col("toxic") * 9 <= F.col("clean")))
        lexicon.exceptions = [r["feature"] for r in mild.orderBy(F.desc("clean"), "feature").limit(most_entries).collect()]
    lexicon.coefficients = _fit(rows.where("later"), lexicon)
    return lexicon


def _fit(rows: DataFrame, lexicon: Lexicon) -> tuple[float, float, float]:
    """Logistic regression on the features of the later third of the rows, by Newton's method."""
    def make():
        find = matcher(lexicon)

        def compute(texts: list) -> dict[str, pa.Array]:
            words = [folded(t) for t in texts]
            return {"total": pa.array([sum(w for _, w in find(t)) for t in words], pa.float64()),
                    "words": pa.array([max(t.count(" ") - 1, 0) for t in words], pa.int64())}

        return compute

    got = add_columns(rows, "text", make, "total double, words bigint").select("total", "words", "toxic").orderBy("total", "words", "toxic").collect()
    y = np.array([r["toxic"] for r in got], float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return (math.log(share / (1 - share)), 0.0, 0.0)
    x = np.array([features(r["total"], r["words"]) for r in got])
    b, ridge = np.zeros(3), np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in b)
