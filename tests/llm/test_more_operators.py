"""Quality classifier, Merkle manifest and fill-in-the-middle against plain Python."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("regex")

from pyspark.sql import functions as F  # noqa: E402

from modelloom.errors import ConfigError  # noqa: E402
from modelloom.llm import classifier, jaccard, merkle, middle, repeats  # noqa: E402
from modelloom.llm.common import Workspace, return_freed  # noqa: E402


@pytest.fixture
def work(spark):
    with Workspace(spark, "test") as workspace:
        yield workspace


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- fill in the middle

TEXTS = [
    None, "", "\n", "one line", "a\nb\n", "a\n\n\nb", "has <S> inside\nx", "ends <\n<P\n<S\nM>\n", "naïve 日本\n🙂🙂\r\nx y\n", "\n" * 5, "x" * 100_000,
]


def cut(key, text, spm=50, rate=100):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = sha(f"7:{'' if key is None else key}")
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, mid, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}"
    return n, "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}"


def test_cuts_against_plain_python(spark):
    rows = [(k, t) for k in [None, *range(12)] for t in TEXTS] + [(3, "a\nb\n")] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"form": F.lit("mine"), "VALUE": F.lit(1), "Output": F.lit(2)})
    made = middle.fill_in_middle(df)
    assert made.columns == ["doc_id", "text", "VALUE", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = made.withColumn("back", middle.restored()).collect()
    assert len(got) == len(rows) and {r["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == cut(r["doc_id"], r["text"] or "")
        assert r["back"] == (r["text"] or "")
    some = middle.fill_in_middle(df, rate=30, suffix_first=0)
    assert all((r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == cut(r["doc_id"], r["text"] or "", 0, 30) for r in some.collect())
    assert middle.fill_in_middle(df.limit(0)).isEmpty()


def test_many_units_other_units_and_markers(spark):
    lines = "".join(f"{i}\n" for i in range(300_000))
    df = spark.createDataFrame([(1, lines), (2, "one two three"), (3, "1 2")], "doc_id bigint, text string")
    assert {r["n"] for r in middle.fill_in_middle(df).where("doc_id = 1").collect()} == {300_000}
    words = {r["doc_id"]: r for r in middle.fill_in_middle(df, unit=r"[a-z]+ ?", markers=("[p", "{s", "(m")).withColumn(
        "back", middle.restored(markers=("[p", "{s", "(m"))).where("doc_id > 1").collect()}
    assert words[2]["n"] == 3 and words[2]["form"] != "plain" and words[2]["back"] == "one two three"
    assert (words[3]["n"], words[3]["form"], words[3]["output"]) == (0, "plain", "1 2")
    for markers in (("<P>", "<P>", "<M>"), ("<P>", "", "<M>"), ("<<", "<S>", "<M>"), ("a", "b")):
        with pytest.raises(ConfigError):
            middle.fill_in_middle(df, markers=markers)


# --- Merkle manifest


def tree(digests, fanout):
    """Levels from the leaves to the root."""
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + fanout])) for i in range(0, len(below), fanout)])
    return levels


def siblings(levels, at, fanout):
    found = []
    for below in levels[:-1]:
        start = at // fanout * fanout
        run = below[start:start + fanout]
        found.append(("".join(run[:at - start]), "".join(run[at - start + 1:])))
        at //= fanout
    return found


@pytest.mark.parametrize("fanout, sizes", [(16, {"a": 300, None: 17, "b": 1, "ß": 16}), (2, {"x": 9, "y": 1, "z": 2, "w": 3, None: 1}), (3, {"only": 10}), (16, {"one": 1})])
def test_manifest_against_plain_python(spark, work, fanout, sizes):
    rng = random.Random(fanout)
    rows = []
    for source, n in sizes.items():
        keys = [None, None, 7, 7, 7][:n] + rng.sample(range(100, 10_000), max(0, n - 5))
        rows += [(source, k, sha(f"{source}{k}{'same' if k == 7 else i}")) for i, k in enumerate(keys)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "source string, doc_id bigint, leaf string").repartition(5)
    manifest = merkle.build(spark, df, work, fanout=fanout)
    proved = merkle.prove(spark, manifest, manifest.places, work)
    got = proved.withColumn("back", merkle.fold("leaf")).withColumn("proof", merkle.proof_digest()).collect()
    order = sorted(sizes, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {s: sorted(((k, d) for t, k, d in rows if t == s), key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for s in order}
    trees = {s: tree([d for _, d in leaves[s]], fanout) for s in order}
    top = tree([trees[s][-1][0] for s in order], fanout)
    want = []
    for s in order:
        for i, (key, leaf) in enumerate(leaves[s]):
            path = siblings(trees[s], i, fanout) + siblings(top, order.index(s), fanout)
            want.append((s, key, leaf, leaf, trees[s][-1][0], top[-1][0], path, sha("".join(a + b for a, b in path)), top[-1][0]))
    rows = [(r["source"], r["doc_id"], r["leaf"], r["found"], r["subroot"], r["root"], [tuple(x) for x in r["segments"]], r["proof"], r["back"]) for r in got]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    some = merkle.prove(spark, manifest, manifest.places.where("doc_id = 7 or s = 0 and r = 0"), work)
    picked = {(r["source"], r["doc_id"], r["found"], r["subroot"]) for r in some.collect()}
    assert picked == {(s, k, leaf, sub) for s, k, leaf, _, sub, *_ in want if k == 7 or (s == order[0] and leaf == leaves[s][0][1])}


def test_manifest_of_nothing(spark, work):
    empty = spark.createDataFrame([], "source string, doc_id bigint, leaf string")
    manifest = merkle.build(spark, empty, work)
    assert manifest.root is None and merkle.prove(spark, manifest, manifest.places, work).isEmpty()


def test_row_digests(spark):
    df = spark.createDataFrame([(12, None, "aß日"), (None, "", "x")], "a bigint, b string, c string")
    got = [r[0] for r in df.select(merkle.row_digest([F.col("a"), F.col("b"), F.col("c")])).collect()]
    assert got == [sha("2:12-6:aß日"), sha("-0:1:x")]


# --- quality classifier


def good_text(rng):
    return " ".join("".join(rng.choice("abcdefghilmnoprst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(30, 200))) + "."


def bad_text(rng):
    return " ".join(w.upper() + "!!" if rng.random() < 0.5 else w + "###" for w in good_text(rng).split())


def labelled(spark, n=400):
    rng = random.Random(3)
    rows = [(i, good_text(rng) if i % 3 else bad_text(rng), int(i % 3 > 0)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, quality int")


def test_statistics():
    for text in (None, "", " \n\t"):
        assert classifier.document_statistics(text) == [0.0] * classifier.WIDTH
    got = classifier.document_statistics("Aa bb! bb!\n\nAa bb! bb!\n$5 é")
    want = [
        math.log1p(8), math.log(20 / 8), None, math.log1p(3), math.sqrt(1 / 20), math.sqrt(4 / 20), 0.0, math.sqrt(1 / 20), math.sqrt(2 / 20),
        math.sqrt(2 / 12), math.log1p(4) / math.log1p(8), math.sqrt(4 / 8), math.log1p(8 / 3), math.sqrt(1 / 3), math.sqrt(2 / 6),
    ]
    assert all(w is None or abs(g - w) < 1e-12 for g, w in zip(got, want))
    assert np.isfinite(classifier.document_statistics("x" * 3_000_000 + " y" * 100_000)).all()


def test_sums_equal_one_fit(spark, work):
    data = labelled(spark).repartition(7)
    stats = classifier.statistics(data)
    model = classifier.fit_quality(spark, stats, data, work, waves=40)
    rows = stats.select("doc_id", "statistics", "quality", (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(4)) == 0).alias("later")).collect()
    every = np.array([r["statistics"] for r in rows])
    assert np.allclose(model.centre, every.mean(axis=0)) and np.allclose(model.scale, np.where(every.std(axis=0) > 1e-9, every.std(axis=0), 1))
    fit = [r for r in rows if not r["later"]]
    z = model.features(np.array([r["statistics"] for r in fit]))
    y = np.array([r["quality"] for r in fit], float)
    penalty = 1e-4 * len(fit) * np.eye(41)
    penalty[0, 0] = 0
    assert np.allclose(z.T @ z @ model.weights + penalty @ model.weights, z.T @ y, atol=1e-5)
    # cosines approximate the kernel
    x = np.clip((every - model.centre) / model.scale, -8, 8)[:20]
    wide = classifier.fit_quality(spark, stats, data, work, waves=4000)
    near = wide.features(every[:20])[:, 1:]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * classifier.WIDTH))
    assert np.abs(near @ near.T - kernel).max() < 0.1
    # calibration: the rising step function nearest to the labels, by minima over maxima of means
    later = sorted((math.floor(min(max(model.raw(np.array([r["statistics"]]))[0], -1), 2) * 1024), r["quality"]) for r in rows if r["later"])
    bins = sorted({b for b, _ in later})
    good, n = ([sum(f(q) for b, q in later if b == x) for x in bins] for f in (lambda q: q, lambda q: 1))
    fitted = [max(min(sum(good[i:j + 1]) / sum(n[i:j + 1]) for j in range(k, len(bins))) for i in range(k + 1)) for k in range(len(bins))]
    assert sorted(set(np.round(fitted, 9))) == sorted(set(np.round(model.shares, 9)))
    assert (np.diff(model.knots) > 0).all() and (np.diff(model.shares) > 0).all()


def test_scores_separate_and_keep_rows(spark, work):
    data = labelled(spark)
    model = classifier.fit_quality(spark, classifier.statistics(data), data.where("doc_id % 2 = 0"), work)
    rng = random.Random(9)
    texts = [(1, good_text(rng)), (1, bad_text(rng)), (2, None), (2, ""), (None, "x" * 2_000_000)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").withColumns({"SCORE": F.lit("kept out"), "value": F.lit(5)})
    out = classifier.quality_score(classifier.statistics(df), model)
    assert out.columns == ["doc_id", "text", "value", "statistics", "score", "predicted"]
    got = out.collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert [r["predicted"] for r in got[:2]] == [1, 0] and got[2]["score"] == got[3]["score"]
    held = classifier.quality_score(classifier.statistics(data.where("doc_id % 2 = 1")), model)
    assert held.where("predicted = quality").count() >= 0.97 * held.count()


@pytest.mark.parametrize("labels, share", [([], 0.5), ([(1, 1), (2, 1), (2, 0), (None, 0), (3, None)], 1.0), ([(1, 0)], 0.0), ([(99, 1)], 0.5)])
def test_labels_of_one_kind(spark, work, labels, share):
    stats = classifier.statistics(spark.createDataFrame([(i, f"text {i}") for i in range(5)], "doc_id bigint, text string"))
    model = classifier.fit_quality(spark, stats, spark.createDataFrame(labels, "doc_id bigint, quality int"), work)
    assert {r["score"] for r in classifier.quality_score(stats, model).collect()} == {share}
    assert classifier.quality_score(stats.limit(0), model).isEmpty()


def test_few_labels_of_both_kinds(spark, work):
    rng = random.Random(1)
    data = spark.createDataFrame([(i, good_text(rng) if i else bad_text(rng), int(i > 0)) for i in range(3)], "doc_id bigint, text string, quality int")
    scored = classifier.quality_score(classifier.statistics(data), classifier.fit_quality(spark, classifier.statistics(data), data, work))
    assert all(0 <= r["score"] <= 1 for r in scored.collect())


def test_languages_beyond_the_bound(spark):
    from modelloom.llm import language

    rows = [(i, f"{'abcdefgh'[i % 8] * 3} " * 20, f"l{i % 8}" if i < 160 else "rare") for i in range(163)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit_language(df, most_rows=80, most_languages=8, buckets=256)
    assert model.languages == [f"l{i}" for i in range(8)]


def test_a_table_united_with_itself(spark, work):
    from modelloom.llm import jaccard
    from test_operators import brute_components, near_copies

    texts = near_copies(5)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = jaccard.similar_documents(spark, df.repartition(3).union(df.repartition(2)), work).collect()
    want = {key: (n, component) for key, n, component in brute_components(rows)}
    assert len(got) == 2 * len(rows) and all(want[r["doc_id"]] == (r["n_shingles"], r["component_id"]) for r in got)


def test_encoding_by_another_pattern(spark):
    import base64

    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    from modelloom.llm import bpe

    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    pattern = r" ?\p{L}+|\p{N}{1,3}|[^\s\p{L}\p{N}]+|\s+"
    library = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["abc 1234567 x", "abc 1234567 日本 x", "日本12345語 !? 9999", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for row in bpe.encode(df, ranks, pattern).collect():
        assert row["ids"] == library.encode_ordinary(row["text"] or "")


def test_signatures_of_a_batch():
    rng = np.random.default_rng(3)
    lists = [rng.integers(0, 30, rng.integers(0, 12)).astype(np.uint64) for _ in range(40)] + [np.zeros(0, np.uint64)]
    lists = [np.unique(x) for x in lists]
    ids = rng.permutation(len(lists)).astype(np.int64) - 5
    first, several, owner = jaccard.combined(np.concatenate(lists), np.cumsum([len(x) for x in lists]), ids)
    places = [(int(v), int(i)) for x, i in zip(lists, ids) for v in x]
    holders = {}
    for v, i in places:
        holders.setdefault(v, []).append(i)
    assert sorted(p for p, f in zip(places, first) if f) == sorted((v, min(h)) for v, h in holders.items())
    assert several.tolist() == [len(holders[v]) > 1 for v, _ in places]
    assert owner.tolist() == [min(holders[v]) for v, _ in places]
    assert all(len(x) == 0 for x in jaccard.combined(np.zeros(0, np.uint64), np.zeros(3, np.int64), ids[:3]))


@pytest.mark.parametrize("size", [3, 20, 100, 420, 700, 1000, 5000])
def test_partitions_hold_several_shingles_and_leave_enough(size):
    bands, rng = jaccard.Bands(0.75), np.random.default_rng(size)
    for band, k in bands.signs(size):
        held = [len(np.unique(rng.integers(0, bands.partitions(band), size))) for _ in range(200)]
        assert sum(h > k for h in held) >= (199 if size > 3 else 150)
        assert bands.partitions(band) < max(40, 1.2 * size)


@pytest.mark.parametrize("n, distinct", [(0, 1), (1, 1), (3, 3), (400, 1), (400, 150), (400, 4000)])
def test_ranks_of_pairs(spark, work, n, distinct):
    rng = random.Random(n + distinct)
    rows = [(i, i % 7, i % 5, *((5, 5) if i % 3 == 0 else (rng.randrange(distinct), rng.randrange(3)))) for i in range(n)]
    pairs = spark.createDataFrame(rows, "uid bigint, t bigint, need int, rank bigint, next bigint").repartition(3)
    got = repeats._ranked(spark, pairs, work, "ranked").collect()
    keys = [(r[3], r[4]) for r in rows]
    dense = {k: i for i, k in enumerate(sorted(set(keys)))}
    assert sorted(map(tuple, got)) == sorted((r[0], r[1], dense[k], r[2]) for r, k in zip(rows, keys) if keys.count(k) > 1)


def test_whole_texts_go_to_python_in_small_batches(spark, work):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    rows = spark.range(0, 2500, 1, 1).mapInArrow(sizes, "n bigint")
    assert max(r["n"] for r in work.keep(rows, "small", whole=True).collect()) <= 1000 and spark.conf.get(name) == before
    assert max(r["n"] for r in work.keep(rows, "large").collect()) > 1000


def test_a_kept_text_goes_to_python_once(spark):
    from modelloom.llm import quality

    df = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    python = [x for x in quality.statistics(df)._jdf.queryExecution().optimizedPlan().toString().splitlines() if "MapInArrow" in x]
    assert len(python) == 1 and "value" not in python[0]


def test_written_steps_return_the_native_memory_the_driver_has_freed(spark, work):
    if not return_freed(spark):
        pytest.skip("this JVM has no such command")
    jvm = spark._jvm
    pid = jvm.java.lang.ProcessHandle.current().pid()

    platform = jvm.org.apache.spark.unsafe.Platform
    blocks = [platform.allocateMemory(100_000) for _ in range(1000)]
    for block in blocks:
        platform.setMemory(block, 1, 100_000)

    def resident():
        """MB of the mapped areas that hold the blocks."""
        total, inside = 0, False
        with open(f"/proc/{pid}/smaps") as file:
            for line in file:
                if area := re.match(r"([0-9a-f]+)-([0-9a-f]+) ", line):
                    low, high = (int(x, 16) for x in area.groups())
                    inside = any(low <= block < high for block in blocks)
                elif inside and line.startswith("Rss:"):
                    total += int(line.split()[1]) / 1024
        return total

    for i, block in enumerate(blocks):
        if i % 50:  # the others keep the allocator from giving back what lies between
            platform.freeMemory(block)
    held = resident()
    assert work.keep(spark.range(10).toDF("id"), "kept").count() == 10
    assert held - resident() > 50
    for block in blocks[::50]:
        platform.freeMemory(block)
