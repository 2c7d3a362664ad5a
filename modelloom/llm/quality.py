"""Quality of texts: fixed base rules, and robust multivariate outliers per language and source.

Each text becomes a vector of transformed statistics. Per language and source, the mean and
covariance of the half or more of its rows with the smallest covariance determinant are
estimated (concentration steps over all rows, as Spark aggregations), and texts far from them
by Mahalanobis distance are rejected. Groups of every size are estimated the same way: the
estimate of all rows counts as some rows more in that of a language, and that in its sources'.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelloom.llm.common import Workspace, add_columns

STATISTICS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, vector array<double>"
DIMENSIONS = 6
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
PLAIN = np.isin(np.arange(256), [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]) | SPACES


def text_statistics(text: str | None) -> tuple[int, int, int, int, int, list[float] | None]:
    """Counts of a whole text, and its vector (null without words)."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()  # of bytes: at 0x20 and 0x09 to 0x0D only
    if not words:
        symbols = int(SYMBOLS[np.frombuffer(data, np.uint8)].sum()) if data else 0
        return 0, 0, symbols, 0, 0, None
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, symbols = len(words), int(seen[SYMBOLS].sum())
    characters = len(text) - int(seen[SPACES].sum())
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    repeats = len(lines) - len(set(lines))
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    covered = 0
    if n >= 3:
        # windows as pairs of a pair's number and a word: no overflow at any length
        _, pair = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
        _, window, often = np.unique(pair[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
        twice = np.zeros(n + 2, bool)
        twice[2:n] = often[window] > 1
        covered = int((twice[2:] | twice[1:-1] | twice[:-2]).sum())
    odd = int(seen[~PLAIN].sum())
    vector = [
        math.log(n), math.log(characters / n), math.sqrt(symbols / characters), math.sqrt(odd / len(data)),
        math.sqrt(repeats / len(lines)), math.sqrt(covered / n),
    ]
    return n, characters, symbols, repeats, covered, vector


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of each whole text, ``vector`` and ``base_failed`` to ``df``.

    Null and empty texts have no words: zero counts, a null vector, and they fail the base
    rules. Columns with these names are replaced, others stay.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def make():
        def compute(texts: list) -> dict[str, pa.Array]:
            found = list(zip(*map(text_statistics, texts))) or [()] * 6
            out = {name: pa.array(found[i], pa.int64()) for i, name in enumerate(names)}
            return out | {"vector": pa.array(found[5], pa.list_(pa.float64()))}

        return compute

    counted = add_columns(df, text, make, STATISTICS)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def chi2_below(x: float, freedom: int) -> float:
    """The chi-squared distribution function, for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for k in range(1, freedom // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(p: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_below(middle, freedom) < p else (low, middle)
    return (low + high) / 2


#: Least standard deviation of each coordinate: most groups have no symbols or repeats at all,
#: and a first one is no outlier.
FLOOR = (0.25, 0.05, 0.05, 0.05, 0.15, 0.15)
#: Groups and starts whose estimates (under half a kilobyte each) are broadcast; of more, Spark chooses and may split the join.
FEW_GROUPS = 20_000
#: What the logarithm of a determinant must fall by for another step.
LEAST_FALL = 1e-3
#: Bins of the squared distance; fixed, so that their counts add up in any order.
BINS_PER_DOUBLING, FEWEST_BITS, MOST_BITS = 16, -20, 60


def _distance(mean: str = "mean", inverse: str = "inverse"):
    """Squared Mahalanobis distance of ``vector``, as a column expression."""
    apart = [F.col("vector")[i] - F.col(mean)[i] for i in range(DIMENSIONS)]
    return sum(
        (2 if i < j else 1) * F.col(inverse)[i * DIMENSIONS + j] * apart[i] * apart[j]
        for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)
    )


def regularised(n: float, total: np.ndarray, products: np.ndarray, factor: float, prior: float, centre: np.ndarray, spread: np.ndarray):
    """Mean, covariance and log determinant from the sums of ``n`` rows and a prior that counts as ``prior`` more.

    Of all means and covariances these fit best, by penalised likelihood, the ``n`` rows (their
    squares times ``factor``), the prior's centre and spread, and the floors. So a step to the rows
    nearest to them and the fit to those never lets the determinant of n rows rise.
    """
    mean = (factor * total + prior * centre) / (factor * n + prior)
    apart = centre - mean
    scatter = products - np.outer(total, mean) - np.outer(mean, total) + n * np.outer(mean, mean)
    raw = (factor * scatter + prior * (spread + np.outer(apart, apart))) / (n + prior)
    return mean, raw, float(np.linalg.slogdet(raw + np.diag(np.square(FLOOR)))[1])


_STATE = (
    "grp string, start int, centre array<double>, spread array<double>, mean array<double>, cov array<double>, inverse array<double>, "
    "logdet double, active boolean"
)
_UPPER = np.triu_indices(DIMENSIONS)


def _better(state: dict, n: int, sums: np.ndarray, products: np.ndarray, factor: float, prior: float) -> dict:
    """The next estimate of a group and start from the sums of its ``n`` rows, or the last if it is no better."""
    full = np.zeros((DIMENSIONS, DIMENSIONS))
    full[_UPPER] = products
    full = full + np.triu(full, 1).T
    spread = np.asarray(state["spread"]).reshape(DIMENSIONS, DIMENSIONS)
    mean, raw, logdet = regularised(n, sums, full, factor, prior, np.asarray(state["centre"]), spread)
    falls = not logdet > state["logdet"] - LEAST_FALL
    if not falls and state["cov"] is not None:
        return state | {"active": False}
    inverse = np.linalg.inv(raw + np.diag(np.square(FLOOR)))
    return state | {"mean": mean.tolist(), "cov": raw.ravel().tolist(), "inverse": inverse.ravel().tolist(), "logdet": logdet, "active": falls}


def _solved(batches: Iterator[pa.RecordBatch], share: float, factor: float, prior: float) -> Iterator[pa.RecordBatch]:
    """The states after a step. A state (without ``bin``) is followed by the sums of its bins in order of distance;
    of these the nearest that hold ``share`` of the rows count. States that have ended stay as they are."""
    names = ["grp", "start", "centre", "spread", "mean", "cov", "inverse", "logdet", "active"]
    kinds = [pa.string(), pa.int32(), *[pa.list_(pa.float64())] * 5, pa.float64(), pa.bool_()]

    def solved(rows: pa.Table) -> pa.RecordBatch:
        first = np.flatnonzero(rows.column("bin").is_null().to_numpy())
        n = rows.column("n").to_numpy()
        sums, products = (rows.column(c).combine_chunks().flatten().to_numpy().reshape(len(n), -1) for c in ("sums", "products"))
        out = []
        for state, a, b in zip(rows.select(names).take(first).to_pylist(), first + 1, [*first[1:], len(n)]):
            if state["active"]:
                taken = a + int(np.searchsorted(np.cumsum(n[a:b]) - n[a:b], share * n[a:b].sum()))
                state = _better(state, int(n[a:taken].sum()), sums[a:taken].sum(axis=0), products[a:taken].sum(axis=0), factor, prior)
            out.append(state)
        return pa.RecordBatch.from_pylist(out, pa.schema(list(zip(names, kinds))))

    held = None  # the last state and its bins so far
    for batch in batches:
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        first = np.flatnonzero(rows.column("bin").is_null().to_numpy())
        last = int(first[-1]) if len(first) else 0
        if last:
            yield solved(rows.slice(0, last).combine_chunks())
        held = rows.slice(last)
    if held is not None and held.num_rows:
        yield solved(held.combine_chunks())


def _level(grouped: DataFrame, above: DataFrame | None, work: Workspace, name: str, share: float, prior: float) -> DataFrame:
    """(grp, centre, spread, mean, cov, inverse) of the groups of ``grouped`` (grp, vector).

    ``above`` has each group's prior (grp, centre, spread, prior_inverse); without it the medians and spreads of the
    middle half are one. Starts: those, the medians with spreads of the middle quarter, and the prior. Each group and start takes steps until its determinant falls no more;
    the start that ends with the smallest one counts. A step is one aggregation by group, start
    and distance bin with map-side combine, so a group of any size is spread over all tasks; the bins
    then follow their state, in order, through one sort.
    """
    middles = grouped.groupBy("grp").agg(*(
        F.percentile_approx(F.col("vector")[i], [0.25, 0.375, 0.5, 0.625, 0.75], 1000).alias(f"q{i}") for i in range(DIMENSIONS)
    ))
    middle = F.array(*(F.col(f"q{i}")[2] for i in range(DIMENSIONS)))

    def spreads(a: int, b: int, normal: float):
        return [F.greatest((F.col(f"q{i}")[b] - F.col(f"q{i}")[a]) / normal, F.lit(FLOOR[i])) for i in range(DIMENSIONS)]

    def diagonal(values: list):
        return F.array(*(values[i] if i == j else F.lit(0.0) for i in range(DIMENSIONS) for j in range(DIMENSIONS)))

    half, quarter = spreads(0, 4, 1.349), spreads(1, 3, 0.637)
    inverses = [diagonal([1 / (x * x) for x in of]) for of in (half, quarter)]
    starts = [F.struct(F.lit(i).alias("start"), middle.alias("mean"), x.alias("inverse")) for i, x in enumerate(inverses)]
    if above is None:
        middles = middles.withColumns({"centre": middle, "spread": diagonal([x * x for x in half])})
    else:
        middles = middles.join(above, "grp")
        starts.append(F.struct(F.lit(2).alias("start"), F.col("centre").alias("mean"), F.col("prior_inverse").alias("inverse")))
    state = work.keep(middles.select("grp", "centre", "spread", F.explode(F.array(*starts)).alias("s")).select(
        "grp", "s.start", "centre", "spread", "s.mean", F.lit(None).cast("array<double>").alias("cov"), "s.inverse",
        F.lit(float("inf")).alias("logdet"), F.lit(True).alias("active"),
    ), f"{name}_state")
    edge = chi2_quantile(share, DIMENSIONS)
    factor = share / chi2_below(edge, DIMENSIONS + 2)  # makes the trimmed covariance consistent
    v = [F.col("vector")[i] for i in range(DIMENSIONS)]
    lists = {"sums": [f"s{i}" for i in range(DIMENSIONS)], "products": [f"p{i}{j}" for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]}
    zeros = [F.array(*(F.lit(0.0) for _ in columns)).alias(c) for c, columns in lists.items()]
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in state.schema[2:]]
    groups = state.count()
    while groups:
        bits = F.log2(F.greatest(_distance(), F.lit(2.0 ** FEWEST_BITS)))
        near = state.where("active").select("grp", "start", "mean", "inverse")
        near = F.broadcast(near) if groups <= FEW_GROUPS else near  # else rows of a large group would meet by its name
        binned = grouped.join(near, "grp").withColumn(
            "bin", F.floor(F.least(bits, F.lit(float(MOST_BITS))) * BINS_PER_DOUBLING)
        )
        sums = binned.groupBy("grp", "start", "bin").agg(
            F.count("*").alias("n"), *(F.sum(v[i]).alias(f"s{i}") for i in range(DIMENSIONS)),
            *(F.sum(v[i] * v[j]).alias(f"p{i}{j}") for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)),
        )
        # each state, then its bins: at most some 1,300 rows, whatever the size of the group
        heads = state.select("*", F.lit(None).cast("bigint").alias("bin"), F.lit(0).cast("bigint").alias("n"), *zeros)
        bins = sums.select("grp", "start", *none, "bin", "n", *(F.array(*columns).alias(c) for c, columns in lists.items()))
        dealt = heads.unionByName(bins).repartition("grp", "start").sortWithinPartitions("grp", "start", "bin")
        state = work.keep(dealt.mapInArrow(lambda it: _solved(it, share, factor, prior), _STATE), f"{name}_state")
        if groups > FEW_GROUPS:
            groups = state.where("active").count()
        elif state.where("active").isEmpty():  # they only grow fewer
            groups = 0
    work.release()
    best = state.groupBy("grp").agg(F.min_by(F.struct("centre", "spread", "mean", "cov", "inverse"), F.struct("logdet", "start")).alias("s"))
    return work.keep(best.select("grp", "s.*"), f"{name}_best")


def estimate(
    spark: SparkSession, stats: DataFrame, work: Workspace, lang: str = "lang", source: str = "source",
    share: float = 0.75, prior: float = 50.0,
) -> tuple[DataFrame, DataFrame]:
    """(places, estimates): the group of each (lang, source), and mean and inverse covariance per group.

    Estimated from all rows of ``stats`` that pass the base rules: once for all, then per language with
    that as ``prior`` rows more, then per language and source with its language's. So a source of
    ten rows follows its language, one of thousands itself, and nothing changes at any size.
    Null languages and sources are values like any other.
    """
    rows = stats.where("not base_failed").select(
        F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"), "vector"
    )
    everyone, of_lang, of_source = F.lit("all"), F.to_json(F.struct("lang")), F.to_json(F.struct("lang", "source"))
    rows = work.keep(rows.select(everyone.alias("all"), of_lang.alias("by_lang"), of_source.alias("by_source"), "lang", "source", "vector"), "vectors")
    groups = work.keep(rows.select("all", "by_lang", "by_source", "lang", "source").distinct(), "groups")
    above = found = None
    for column, upper in (("all", None), ("by_lang", "all"), ("by_source", "by_lang")):
        if upper is not None:
            of = groups.select(F.col(column).alias("own"), F.col(upper).alias("grp")).distinct()
            above = of.join(found, "grp").select(
                F.col("own").alias("grp"), F.col("mean").alias("centre"), F.col("cov").alias("spread"), F.col("inverse").alias("prior_inverse")
            )
        found = _level(rows.select(F.col(column).alias("grp"), "vector"), above, work, column, share, prior)
    return groups.select("lang", "source", F.col("by_source").alias("grp")), found.select("grp", "mean", "inverse")


def judge(
    stats: DataFrame, places: DataFrame, estimates: DataFrame, lang: str = "lang", source: str = "source",
    outlier: float = 1e-9,
) -> DataFrame:
    """Add ``distance`` and ``kept`` to rows of ``statistics``.

    Rows that fail the base rules are not kept; of the others those are kept whose squared
    distance from their group's estimate a normal vector would exceed with probability
    ``outlier`` or more. The estimates are a row per group: Spark broadcasts them while they
    are small, and else the join splits large groups. Columns of these names are replaced.
    """
    limit = chi2_quantile(1 - outlier, DIMENSIONS)
    mine = [c for c in stats.columns if c.lower() not in ("distance", "kept", "_grp", "_mean", "_inverse")]
    found = places.join(estimates, "grp").select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.col("mean").alias("_mean"), F.col("inverse").alias("_inverse")
    )
    rows = stats.select(*mine)
    same = F.col(lang).cast("string").eqNullSafe(F.col("_lang")) & F.col(source).cast("string").eqNullSafe(F.col("_source"))
    joined = rows.join(found, same, "left")
    distance = F.when(F.col("_mean").isNotNull(), _distance("_mean", "_inverse"))
    return joined.select(
        *mine, distance.alias("distance"),
        (~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= limit)).alias("kept"),
    )
