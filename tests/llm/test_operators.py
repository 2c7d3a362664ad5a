"""The training-data operators against brute force, round trips and held-out accuracy."""

import base64
import hashlib
import math
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from modelloom.llm import bpe, jaccard, language, packing, quality, repeats, toxicity, urls, vectors, warc  # noqa: E402
from modelloom.llm.common import Workspace, components  # noqa: E402

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0d]+")
ODD_TEXTS = [
    None, "", " \n\t", "one", "a b c d", "naïve Ünïcödé 日本語 🙂🙂 the end", "x" * 5000, "it's  two\u00a0spaces\u2003here <|endoftext|>",
    "a\x00b\x85c\x1cd", "\u0558\u058b letters after the shared range", "1234567 ½ ² ٣",
]


@pytest.fixture
def work(spark):
    with Workspace(spark, "test") as workspace:
        yield workspace


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return bpe.parse_ranks(file.read())


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def words(seed, n, size=400):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(size)]
    return [rng.choice(vocabulary) for _ in range(n)]


# --- shared helpers


def test_components(spark, work):
    pairs = [(1, 2), (2, 3), (9, 3), (5, 6), (6, 5), (7, 7), (20, 21), (21, 22), (22, 23), (23, 24), (24, 20)]
    got = components(spark, spark.createDataFrame(pairs, "a bigint, b bigint"), work)
    assert {r[0]: r[1] for r in got.collect()} == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5, **dict.fromkeys(range(20, 25), 20)}
    assert components(spark, spark.createDataFrame([], "a bigint, b bigint"), work, "none").count() == 0


# --- byte-level BPE


def test_encoding_equals_the_rank_library(spark, ranks, reference):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS + [" ".join(words(1, 3000)) + "!?", "Ω≈ç√∫ " * 50])]
    df = spark.createDataFrame(rows, "ID bigint, text string").withColumn("starts", F.lit("kept apart"))
    out = bpe.decode(bpe.encode(df, ranks, public_tokenizers.PATTERN, offsets=True), ranks)
    for row in out.collect():
        text = dict(rows)[row["ID"]] or ""
        ids = reference.encode_ordinary(text)
        assert row["ids"] == ids
        assert bytes(row["decoded"]) == text.encode() and row["decoded_text"] == text
        _, starts = reference.decode_with_offsets(ids)
        assert row["starts"] == starts
    packed = bpe.encode(df, ranks, public_tokenizers.PATTERN, packed=True).collect()
    assert all(np.frombuffer(r["ids"], "<u4").tolist() == reference.encode_ordinary(r["text"] or "") for r in packed)


def test_every_character_is_split_alike(ranks, reference):
    encode = bpe.encoder(bpe.tokenizer_definition(ranks), public_tokenizers.PATTERN, memo=50)
    texts = ["".join(f"ab{chr(c)}cd 12{chr(c)} {chr(c)}{chr(c)}'s!{chr(c)} " for c in range(low, low + 64))
             for low in range(0, 0x3000, 64)]
    for text, ids in zip(texts, encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)


@pytest.mark.parametrize("memo", [0, 20, 10_000])
def test_each_match_is_looked_up_once(ranks, reference, monkeypatch, memo):
    looked = []

    class Counting(bpe._Memo):
        def __getitem__(self, piece):
            looked.append(piece)
            return super().__getitem__(piece)

    monkeypatch.setattr(bpe, "_Memo", Counting)
    texts = [" ".join(words(seed % 90, 40, 300)) + ODD_TEXTS[5 + seed % 4] for seed in range(150)] + [None, ""]
    encode = bpe.encoder(bpe.tokenizer_definition(ranks), public_tokenizers.PATTERN, memo=memo)
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == [reference.encode_ordinary(t or "") for t in texts]
    split = bpe.fast_pattern(public_tokenizers.PATTERN).findall
    usual = [t for t in texts if t and max(map(ord, t)) < bpe.SAME_CLASSES_BELOW]
    assert len(usual) > 50 and looked == [piece for t in usual for piece in split(t)]


def test_characters_split_by_tokens(spark, ranks, reference):
    ids = reference.encode_ordinary("🙂")
    assert len(ids) > 1
    out = bpe.decode(spark.createDataFrame([(ids[:1],), (ids,), (None,)], "ids array<int>"), ranks).collect()
    assert "\ufffd" in out[0]["decoded_text"] and out[1]["decoded_text"] == "🙂" and bytes(out[2]["decoded"]) == b""


# --- packing


def test_best_fit_decreasing():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 65, 500)
    window, offset = packing.best_fit_decreasing(lengths, 64)
    used = np.bincount(window, lengths)
    assert used.max() <= 64 and len(used) <= math.ceil(lengths.sum() / 64) * 1.05 + 1
    left = {}
    for i in np.argsort(-lengths, kind="stable"):  # the tightest open window, by looking at all
        fits = [c for c in left.values() if c >= lengths[i]]
        assert (64 - offset[i] == min(fits)) if fits else offset[i] == 0
        left[window[i]] = 64 - offset[i] - lengths[i]


def test_packing_holds_every_id_once(spark, reference):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS + [" ".join(words(s, 40 * s)) for s in range(1, 30)] * 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("LENGTH", F.lit(1)).repartition(3)
    out = packing.pack(df, definition, public_tokenizers.PATTERN, size=128, ids=True).collect()
    documents, sequences = {}, {}
    for r in out:
        documents.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for i, text in rows:
        ids, at = [*reference.encode_ordinary(text or ""), 1], 0
        for r in sorted(documents[i], key=lambda r: r["start"]):
            part = ids[at:at + r["length"]]
            assert (r["start"], r["ids"], r["doc_tokens"]) == (at, part, len(ids))
            assert r["ids_crc32"] == zlib.crc32(np.asarray(part, "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 128
    assert packing.pack(df.limit(0), definition, public_tokenizers.PATTERN).count() == 0


# --- language


def test_language(spark):
    langs = {"aa": "abcdefg", "bb": "stuvwxyz", "cc": "àéîõüß"}
    rng = random.Random(5)
    text = lambda chars: " ".join("".join(rng.choice(chars) for _ in range(6)) for _ in range(30))
    rows = [(i, text(c), name) for i, (name, c) in enumerate(list(langs.items()) * 60)]
    odd = [(1000 + i, t, None) for i, t in enumerate([None, "", "123 !?", "\U0001F642", "x" * 100_000])]
    df = spark.createDataFrame(rows + odd + rows[:5], "doc_id bigint, text string, lang string").withColumn("Score", F.lit("s"))
    model = language.fit_language(df, usable=F.col("doc_id") % 4 != 0, per_language=30)
    out = {r["doc_id"]: r for r in language.detect_language(df, model).collect()}
    assert all(out[i]["lang_pred"] == name for i, _, name in rows)
    assert [out[1000 + i]["lang_pred"] == "und" for i in range(5)] == [True] * 4 + [False]
    assert all(0 <= r["score"] <= 1 for r in out.values()) and out[1000]["rejected"] and not out[0]["rejected"]
    assert language.fit_language(df.where("lang is null")) is None
    assert {r["lang_pred"] for r in language.detect_language(df.limit(3), None).collect()} == {"und"}


# --- quality


def brute_statistics(text):
    found, lines = WORD.findall(text or ""), (text or "").split("\n")
    full = [x for x in lines if WORD.search(x)]
    windows = Counter(zip(found, found[1:], found[2:]))
    covered = {i + k for i in range(len(found) - 2) if windows[tuple(found[i:i + 3])] > 1 for k in range(3)}
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), len(full) - len(set(full)), len(covered))


def test_quality(spark, work):
    assert abs(quality.chi2_below(quality.chi2_quantile(0.9, 6), 6) - 0.9) < 1e-9
    assert abs(quality.chi2_quantile(0.95, 4) - 9.487729) < 1e-5
    clean = [(i, ". ".join(" ".join(words(s, 12)) for s in range(i * 20, i * 20 + 6 + i % 5)), "en", "s") for i in range(240)]
    junk = [(500 + i, " ".join(w + "###$$$" for w in words(i, 80)), "en", "s") for i in range(10)]
    odd = [(600 + i, t, None, None) for i, t in enumerate([*ODD_TEXTS, "a b c\na b c\n" * 40, "\u00a0 x\u2028y\x1cz\x85"])]
    df = spark.createDataFrame(clean + junk + odd + clean[:2], "doc_id bigint, text string, lang string, source string")
    stats = work.keep(quality.statistics(df.withColumn("N_Words", F.lit("x"))), "stats")
    for r in stats.collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_statistics(r["text"])
    judged = {r["doc_id"]: r for r in quality.judge(stats, *quality.estimate(spark, stats, work)).collect()}
    assert all(judged[i]["kept"] for i, *_ in clean) and not any(judged[i]["kept"] for i, *_ in junk)
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in judged.values())
    none = stats.limit(0)
    assert quality.judge(none, *quality.estimate(spark, none, work)).count() == 0


@pytest.mark.parametrize("given", [True, False])
def test_smallest_determinant(spark, work, given):
    """Small groups against every subset of three quarters of their rows: mostly the least determinant, and never one far from it."""
    rng = np.random.default_rng(11)
    size, share, prior, dims = 12, 0.75, 6.0, quality.DIMENSIONS
    groups = {f"g{g}": rng.normal(size=(size, dims)) * rng.uniform(0.3, 2, dims) for g in range(8)}
    for i, rows in enumerate(groups.values()):
        rows[: i % 4] += 9  # up to three outliers
    grouped = spark.createDataFrame([(g, v.tolist()) for g, rows in groups.items() for v in rows], "grp string, vector array<double>")
    above, spread = None, np.diag(np.full(dims, 1.5))
    if given:
        inverse = np.linalg.inv(spread + np.diag(np.square(quality.FLOOR)))
        above = spark.createDataFrame(
            [(g, [0.2] * dims, spread.ravel().tolist(), inverse.ravel().tolist()) for g in groups],
            "grp string, centre array<double>, spread array<double>, prior_inverse array<double>",
        )
    got = quality._level(grouped, above, work, "level", share, prior).collect()
    factor = share / quality.chi2_below(quality.chi2_quantile(share, dims), dims + 2)
    assert {r["grp"] for r in got} == set(groups)
    above_least = []
    for r in got:
        inverse, centre, spread = (np.array(r[c]) for c in ("inverse", "centre", "spread"))
        least = min(
            quality.regularised(len(x), x.sum(axis=0), x.T @ x, factor, prior, centre, spread.reshape(dims, dims))[2]
            for c in itertools.combinations(range(size), int(share * size)) for x in [groups[r["grp"]][list(c)]]
        )
        above_least.append(-np.linalg.slogdet(inverse.reshape(dims, dims))[1] - least)
    assert min(above_least) > -1e-6 and max(above_least) < 0.3 and sum(x < 1e-6 for x in above_least) >= 6, above_least


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_bins_follow_their_state_over_batches(size):
    rng, dims = np.random.default_rng(5), quality.DIMENSIONS
    eye, zeros, wide = np.eye(dims).ravel().tolist(), [0.0] * dims, dims * (dims + 1) // 2
    rows, groups = [], {}
    for g in range(5):
        state = {"grp": f"g{g}", "start": g % 2, "centre": zeros, "spread": eye, "mean": zeros, "cov": None, "inverse": eye, "logdet": math.inf, "active": g != 3}
        rows.append(state | {"bin": None, "n": 0, "sums": zeros, "products": [0.0] * wide})
        groups[g] = [rng.normal(size=(k, dims)) for k in (3, 2, 4, 1, 1 + g)]
        rows += [
            {"grp": f"g{g}", "start": g % 2, "bin": b, "n": len(x), "sums": x.sum(axis=0).tolist(), "products": (x.T @ x)[quality._UPPER].tolist()}
            for b, x in enumerate(groups[g]) if g != 3
        ]
    floats = pa.list_(pa.float64())
    kinds = {"grp": pa.string(), "start": pa.int32(), **dict.fromkeys(("centre", "spread", "mean", "cov", "inverse"), floats)}
    kinds |= {"logdet": pa.float64(), "active": pa.bool_(), "bin": pa.int64(), "n": pa.int64(), "sums": floats, "products": floats}
    batches = pa.Table.from_pylist(rows, pa.schema(list(kinds.items()))).to_batches(max_chunksize=size)
    out = [r for b in quality._solved(iter(batches), 0.75, 1.2, 5.0) for r in b.to_pylist()]
    assert [r["grp"] for r in out] == [f"g{g}" for g in range(5)]
    for g, r in enumerate(out):
        if g == 3:
            assert r["mean"] == zeros and r["cov"] is None and not r["active"]
            continue
        total = sum(map(len, groups[g]))
        near = np.concatenate([x for i, x in enumerate(groups[g]) if sum(map(len, groups[g][:i])) < 0.75 * total])
        mean, raw, logdet = quality.regularised(len(near), near.sum(axis=0), near.T @ near, 1.2, 5.0, np.zeros(dims), np.eye(dims))
        assert np.allclose(r["mean"], mean) and np.allclose(r["cov"], raw.ravel()) and abs(r["logdet"] - logdet) < 1e-9 and r["active"]


def test_a_step_is_one_write_without_windows(spark, work):
    """Every query is planned in the driver, which holds its plans and broadcasts until it collects its garbage."""
    rng = np.random.default_rng(3)
    grouped = work.keep(spark.createDataFrame([(f"g{i % 4}", rng.normal(size=quality.DIMENSIONS).tolist()) for i in range(200)], "grp string, vector array<double>"), "grouped")
    written = []

    class Counting(Workspace):
        def keep(self, df, name, by=None):
            written.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
            return super().keep(df, name, by)

    with Counting(spark, "steps") as counting:
        assert quality._level(grouped, None, counting, "level", 0.75, 5.0).count() == 4
    steps = [plan for name, plan in written if name == "level_state"][1:]
    assert steps and all(plan.count("Aggregate [") == 1 and plan.count("Join ") == 1 and "Window [" not in plan for plan in steps)


def test_small_sources_follow_their_language(spark, work):
    """A source of any size has an estimate, between its own rows and its language's; the larger, the nearer to its own."""
    rng = np.random.default_rng(12)
    rows = [("en", "big", (rng.normal(size=6)).tolist()) for _ in range(2000)]
    for n, name in ((1, "one"), (10, "ten"), (400, "many")):
        rows += [("en", name, (rng.normal(size=6) + 2).tolist()) for _ in range(n)]
    rows += [(None, None, [1.0] * 6)]
    stats = spark.createDataFrame(rows, "lang string, source string, vector array<double>").withColumn("base_failed", F.lit(False))
    places, estimates = quality.estimate(spark, stats, work)
    found = {r["source"]: np.mean(r["mean"]) for r in places.join(estimates, "grp").collect()}
    assert abs(found["big"]) < 0.1 and found["one"] < found["ten"] < 1 < found["many"] and set(found) == {"big", "one", "ten", "many", None}
    assert quality.judge(stats, places, estimates).where("not kept").count() == 0


# --- toxicity


def test_folding():
    assert toxicity.folded("1D10T") == toxicity.folded("idiot") == toxicity.folded("іdіоt")
    assert toxicity.folded("pa\u200bthetic!") == toxicity.folded("p@thetic")
    assert toxicity.folded(None) == toxicity.folded("...").replace("   ", "  ") == "  "


def test_toxicity(spark, work):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        text = words(i, 60)
        if i % 4 == 0:
            for w in ("zzgrob", "zzgrobling", "qqfoul"):
                text.insert(rng.randrange(60), w)
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    extra = spark.createDataFrame([(900, None), (901, ""), (902, "you zzgr0b and QQF0UL zzgrobs")], "doc_id bigint, text string")
    lexicon = toxicity.learn_lexicon(spark, df.select("doc_id", "text"), df.where("doc_id % 5 <> 0").unionByName(df.limit(3)), work)
    scored = toxicity.toxicity(df.select("doc_id", "text").unionByName(extra).withColumn("HITS", F.lit("x")), lexicon)
    out = {r["doc_id"]: r for r in scored.collect()}
    assert all(out[i]["predicted"] == toxic for i, _, toxic in rows)
    assert out[900]["score"] == out[901]["score"] < 0.5 <= out[902]["score"]
    none = toxicity.learn_lexicon(spark, df, df.where("toxic = 0"), work)
    assert none.weights == {} and toxicity.toxicity(extra, none).where("predicted = 1").count() == 0


def test_exception_phrases_cancel_words():
    lexicon = toxicity.Lexicon({" foui ": 3.0, " fou": 2.0}, [" not foui "], (0, 1, 1))
    find = toxicity.matcher(lexicon)
    assert [w for _, w in find(" a foui b fouing ")] == [3.0, 2.0]
    assert find(" is not foui at ") == []


# --- archives


def test_archives(spark, work):
    long = "<p>" + "ä" * 200
    pages = [(5, "http://a/x y\r\nz", long), (3, None, long), (9, "u", long), (None, "v", long), (4, "w", "short"), (6, "w", "short"),
             (7, "w", None), (8, "w", ""), (3, "again", long)]
    pages += [(100 + i, f"http://h/{i}", "<p>" + " ".join(words(i, 300))) for i in range(60)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("digest", F.lit("x")).repartition(2)
    out = warc.round_trip(spark, df, work, archive_size=20_000).collect()
    assert len(out) == len(pages)
    for key, _, html in pages:
        data = (html or "").encode()
        for r in (r for r in out if r["key"] == (None if key is None else str(key))):
            assert (r["length"], r["digest"]) == (len(data), hashlib.sha256(data).hexdigest())
            again = html == long and key != 3
            assert (r["type"], r["refers_to"]) == (("revisit", "3") if again else ("response", None))
            assert again or bytes(r["payload"]) == data
    assert warc.round_trip(spark, df.limit(0), work).count() == 0


def test_an_archive_begins_with_its_dictionary():
    import io
    records = [warc.make_record(i, "http://h/", " ".join(words(i % 7, 500)).encode(), 1, "d", None, "2020-01-01T00:00:00Z") for i in range(80)]
    data = b"".join(warc.archive_bytes(records, 112_640, 2 << 20, 3))
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_MAGIC
    assert list(warc.read_archive(io.BytesIO(data))) == records
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(data[:-3])))


# --- URLs


def test_url_rules_and_ranks(spark, work):
    link = lambda *hosts: " ".join(f'<a class=x href="https://{h}/p">' for h in hosts)
    rows = [
        (1, "http://GOOD.org/fr/a", link("friend.com")), (2, "http://friend.com/", link("other.com")), (3, "http://farm.com/x", link("bad.net", "bad2.net")),
        (4, "http://bad.net/x", ""), (5, "http://bad2.net/?q", None), (6, "https://Ünï.com:8080?x#y", ""), (7, None, link("bad.net")),
        (8, "no scheme", ""), (9, "http://www.example.net/en/z?q=1", ""), (10, "http://www.example.net/de", ""), (11, "x://a.net", ""),
        (12, "http://other.com/q#://b.net/", '<a href="/relative">'), (12, "http://other.com/q#://b.net/", ""),
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("Trust", F.lit("x"))
    rules = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
    out = {r["page_id"]: r for r in urls.judge_urls(spark, df, rules, work).collect()}
    assert {i: r["host"] for i, r in out.items()} == {
        1: "good.org", 2: "friend.com", 3: "farm.com", 4: "bad.net", 5: "bad2.net", 6: "Ünï.com:8080", 7: "", 8: "", 9: "www.example.net",
        10: "www.example.net", 11: "a.net", 12: "other.com"}
    assert out[1]["path"] == "/fr/a" and out[6]["path"] == "" and out[12]["path"] == "/q"
    assert {i: r["rule"] for i, r in out.items() if r["rule"]} == {1: "org/fr/", 4: "net/", 5: "net/", 9: "example.net/en/", 10: "net/"}
    assert {i for i, r in out.items() if r["verdict"] == "block"} == {3, 4, 5, 10}
    # brute force: ranks by matrix powers
    hosts = sorted({"good.org", "friend.com", "other.com", "farm.com", "bad.net", "bad2.net", "www.example.net"})
    at = {h: i for i, h in enumerate(hosts)}
    m = np.zeros((len(hosts),) * 2)
    for a, b, share in (("good.org", "friend.com", 1), ("friend.com", "other.com", 1), ("farm.com", "bad.net", .5), ("farm.com", "bad2.net", .5)):
        m[at[b], at[a]] = share
    seed = np.zeros(len(hosts))
    seed[[at["good.org"], at["www.example.net"]]] = 0.5
    want = np.linalg.solve(np.eye(len(hosts)) - 0.85 * m, 0.15 * seed)
    for i, h in ((1, "good.org"), (2, "friend.com"), (12, "other.com")):
        assert out[i]["trust"] == pytest.approx(want[at[h]], abs=1e-5)
    assert urls.judge_urls(spark, df.limit(0), rules, work).count() == 0


def test_ranks_of_a_cycle_and_a_long_chain(spark, work):
    links = [(f"c{i}", f"c{i + 1}", 1) for i in range(40)] + [("x", "y", 1), ("y", "x", 2), ("y", "c0", 1)]
    hosts = sorted({h for a, b, _ in links for h in (a, b)})
    m, seed = np.zeros((len(hosts),) * 2), np.zeros(len(hosts))
    for a, b, n in links:
        m[hosts.index(b), hosts.index(a)] = n / sum(k for c, _, k in links if c == a)
    seed[hosts.index("x")], seed[hosts.index("c0")] = 0.25, 0.75
    want = np.linalg.solve(np.eye(len(hosts)) - 0.85 * m, 0.15 * seed)
    seeds = spark.createDataFrame([("x", 1.0), ("c0", 3.0)], "host string, weight double")
    got = dict(map(tuple, urls.personalised_rank(spark.createDataFrame(links, "src string, dst string, n bigint"), seeds, work, "r").collect()))
    assert [got[h] for h in hosts] == pytest.approx(want.tolist(), abs=1e-6)


# --- vectors


def test_near_vectors(spark, work):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 12))
    rows = [(i, (centres[i % 40] + rng.normal(size=12) * (0.02 + 0.25 * (i % 3))).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)] + [(3, rows[8][1]), (None, rows[9][1])]
    odd = [None, [], [0.0] * 12, [float("nan")] + [1.0] * 11, [float("inf")] * 12, [None] + [1.0] * 11, [1.0] * 5, [2.0] * 5, [1e-300] * 12, [1e300] * 12]
    rows += [(2000 + i, v) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("n_links", F.lit("x"))
    got = Counter(map(tuple, vectors.near_vectors(spark, df, work, interval=64).collect()))
    unit = [vectors.unit_vector(v) for _, v in rows]
    n, parent, links = len(rows), list(range(len(rows))), [0] * len(rows)

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    want = Counter((key, links[i], least.get(find(i)), key is not None and key == least.get(find(i))) for i, (key, _) in enumerate(rows))
    assert got == want
    assert vectors.near_vectors(spark, df.limit(0), work).count() == 0


def test_near_vectors_of_many_dimensions(spark, work):
    """Short vectors that leave axes out: no link is lost, and next to nothing else is compared whole."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(900, 64))
    several = rng.integers(0, 900, 700)
    all_rows = np.concatenate([centres, centres[several] + rng.normal(size=(700, 64)) * rng.choice([0.05, 0.2, 0.33, 0.5], (700, 1))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(all_rows)], "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(spark, df, work, axes=4, short=20, interval=200).collect()}
    unit = np.array([vectors.unit_vector(v.tolist()) for v in all_rows])
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    assert {k: v[0] for k, v in got.items()} == dict(enumerate(linked.sum(axis=1).tolist()))
    for a, b in zip(*np.nonzero(linked)):
        assert got[a][1] == got[b][1] <= min(a, b)
    epsilon = np.sqrt(0.1)
    short = vectors.shortened(unit, vectors.principal_axes(unit, 20)).astype(np.float32)
    near = vectors.within(short, short, epsilon)
    assert near[linked].all() and near.sum() - linked.sum() - len(unit) < 0.002 * near.size


# --- Jaccard join


def brute_components(rows, percent=75):
    sets, parent = [], list(range(len(rows)))
    for _, text in rows:
        w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= percent * len(a | sets[j]) or rows[i][0] == rows[j][0]:
                x, y = find(i), find(j)
                if rows[x][0] < rows[y][0]:
                    x, y = y, x
                parent[x] = y
    return {(key, len(sets[i]), rows[find(i)][0]) for i, (key, _) in enumerate(rows)}


def near_copies(seed, groups=25, common=()):
    rng, out = random.Random(seed), []
    for g in range(groups):
        base = words(seed * 1000 + g, rng.choice([3, 6, 12, 30, 80, 200, 600])) + list(common)
        for _ in range(rng.choice([1, 2, 5, 12])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = f"edit{rng.random()}"
            out.append(" ".join(copy))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("common", [0, 60])
def test_similar_documents(spark, work, common, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRS", 1)  # so that crowds occur, too
    texts = near_copies(4, common=words(99, common)) + ["A b C d", "a B c D", "", None, " ", "one", "One", "ä b c d e", "Ä b c d e"]
    rows = list(enumerate(texts)) + [(2, texts[2])]
    df = spark.createDataFrame(rows + [(None, texts[0])], "doc_id bigint, text string").withColumn("Id", F.lit("x"))
    got = {tuple(r) for r in jaccard.similar_documents(spark, df, work).collect()}
    assert {r for r in got if r[0] is not None} == brute_components(rows)
    assert [r[2] for r in got if r[0] is None] == [None]


def linked_group(seed, n, strays):
    """Copies of one text of 120 words with an edit each, and texts that share its last 99 words, under 75 %."""
    base, rng = words(seed, 120, 5000), random.Random(seed)
    out = []
    for i in range(n):
        copy = list(base)
        copy[rng.randrange(60)] = f"edit{i}"
        out.append(" ".join(copy))
    return out + [" ".join(words(seed + 1 + i, 21, 5000) + base[21:]) for i in range(strays)]


def test_similar_documents_in_pieces_of_one_component(spark, work, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 4)
    rows = list(enumerate(linked_group(70, 60, 1)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert {tuple(r) for r in jaccard.similar_documents(spark, df, work).collect()} == brute_components(rows)


def test_similar_documents_of_a_table_twice(spark, work):
    # in each four the second and third are alike, but share no signature that the first, like neither, has not
    rows = list(enumerate(near_copies(4)))
    for g in range(12):
        x, y, *ends = (words(500 + 10 * g + i, n, 5000) for i, n in enumerate([104, 44, 10, 10, 60]))
        rows += [(1000 + 10 * g + i, " ".join(t)) for i, t in enumerate([x + y, x + ends[0], x + ends[1], y + ends[2]])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    df = df.repartition(3).union(df.repartition(2, "doc_id"))
    got = Counter(map(tuple, jaccard.similar_documents(spark, df, work).collect()))
    assert got == Counter({r: 2 for r in brute_components(rows)})


@pytest.mark.parametrize("apart", [1, 9])
def test_pieces_of_a_large_component(spark, work, apart, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 4)
    groups = {i: 0 if i < 200 else i - i % 2 for i in range(200 + apart)}
    placed = [(7, i, g) for i, g in groups.items()] + [(8, i, 0) for i in range(50)] + [(9, i, groups[i]) for i in (0, 200)]
    kept = work.keep(spark.createDataFrame(placed, "signature bigint, id bigint, `group` bigint"), "placed")
    found = {}
    for signature, x, y, i, g in jaccard.pieces(kept).collect():
        assert g == groups[i]
        found.setdefault((signature, x, y), []).append(i)
    met = {(s, *sorted((a, b))) for (s, _, _), ids in found.items() for a in ids for b in ids}
    assert {(7, a, b) for a in groups for b in range(a) if groups[a] != groups[b]} <= {(s, b, a) for s, a, b in met} and (9, 0, 200) in met
    chunks = [-(-n // 4) for n in (200, apart)]
    assert sum(len(ids) for (s, *_), ids in found.items() if s == 7) == 200 * chunks[1] + apart * (sum(chunks) - 1)
    assert all(any(groups[i] for i in ids) for ids in found.values()) and {s for s, *_ in found} == {7, 9}


def test_similar_documents_of_no_rows(spark, work):
    assert jaccard.similar_documents(spark, spark.createDataFrame([], "doc_id bigint, text string"), work).count() == 0


def test_similar_sets_share_a_signature():
    rng, bands = np.random.default_rng(6), jaccard.Bands(0.75)
    for size in [1, 2, 3, 4, 7, 8, 30, 31, 100, 101, 733, 734, 4000]:
        for _ in range(40):
            a = rng.integers(0, 2 ** 63, size, dtype=np.uint64)
            drop = rng.integers(0, size // 4 + 1)
            add = int((size - drop) / 0.75 - size + 1e-9)  # as far as 75 % allow
            b = np.concatenate([a[drop:], rng.integers(0, 2 ** 63, max(0, add), dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            shared = len(np.intersect1d(a, b))
            assert 100 * shared >= 75 * (len(a) + len(b) - shared)
            assert np.intersect1d(jaccard.signatures(a, bands, a[:size // 3]), jaccard.signatures(b, bands, a[:size // 3])).size
            assert jaccard.may_link(jaccard.sketch(a), jaccard.sketch(b), len(a), len(b), 75)


@pytest.mark.parametrize("partitions", [1, 2, 4, 16])
def test_similar_sets_of_few_partitions_share_a_signature(partitions, monkeypatch):
    monkeypatch.setattr(jaccard.Bands, "partitions", lambda self, band: partitions)
    test_similar_sets_share_a_signature()


def test_similar_documents_of_one_partition(spark, work):
    text = "rig rob len bes fal bab bum"  # its three shingles lie in one of 1,024 partitions
    rows = list(enumerate([text, f"{text} end", f"start {text}", "rig rob len bes fal bab", text]))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {tuple(r) for r in jaccard.similar_documents(spark, df, work).collect()} == brute_components(rows)


# --- repeated passages


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length", [64, 150])
def test_repeated_passages(spark, work, length):
    rng = random.Random(length)
    shared = ["é".join(words(1000 + i, 5 * i)) for i in range(1, 14)]
    texts = []
    for i in range(90):
        parts = [" ".join(words(i, rng.randint(0, 30), 5000))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            a = rng.randint(0, len(passage) // 2)
            parts += [passage[a:rng.randint(a, len(passage))], " ".join(words(rng.random(), rng.randint(0, 9), 5000))]
        texts.append(rng.choice(["", " ", "\n"]).join(parts))
    texts += texts[:4] + ODD_TEXTS + ["ab" * 400, "abc" * 100 + "x" + "abc" * 90, "y" * length, "y" * (length - 1), "z" * (length + 1), "Ñezes " * 200]
    rows = [(i, t, "kept") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_removed string").repartition(3)
    out = {r["row"]["doc_id"]: r for r in repeats.repeated_passages(spark, df, work, length=length).collect()}
    for i, want in enumerate(brute_repeats(texts, length)):
        r = out[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want, i
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == want[3] and r["row"]["n_removed"] == "kept"
    assert repeats.repeated_passages(spark, df.limit(0), work, length=length).count() == 0


def test_positions_are_followed_within_their_text(spark):
    rng = random.Random(3)
    rows = sorted({(rng.randrange(9) ** 3, rng.randrange(40)) for _ in range(200)})
    rows = [(u, t, i % 9, 7 * i) for i, (u, t) in enumerate(rows)]
    rank = {r[:2]: r[3] for r in rows}
    for size in (1, 7, 64, 500):
        batches = [pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows[i:i + size]))), names=["uid", "t", "need", "rank"]) for i in range(0, len(rows), size)]
        for step in (1, 4, 64):
            got = [tuple(r.values()) for b in repeats._followed(step, iter([batches[0].slice(0, 0), *batches])) for r in b.to_pylist()]
            assert got == [(*r, rank[r[0], r[1] + step]) for r in rows if (r[0], r[1] + step) in rank]


def test_late_steps_take_only_texts_that_need_them(spark, work, monkeypatch):
    sizes, ranked = {}, repeats._ranked

    def counted(spark, pairs, work, name):
        sizes[int(name[4:])] = pairs.count()
        return ranked(spark, pairs, work, name)

    monkeypatch.setattr(repeats, "_ranked", counted)
    plain = [" ".join(words(i, 300, 5000)) for i in range(12)]
    dense, rng = "", random.Random(2)  # a gram that is an anchor, again and again
    while not dense:
        gram = "".join(rng.choice("abcdefgh") for _ in range(repeats.GRAM))
        dense = gram if 0 in repeats.anchors((gram + " " * 400).encode(), 400) else ""
    dense = "".join(f"{dense}{i % 7}" for i in range(60))
    texts = [*plain, *plain, f"{plain[0]} {dense}{plain[1]}", f"{plain[2]} {dense}{plain[3]}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    out = {r["row"]["doc_id"]: r for r in repeats.repeated_passages(spark, df, work, length=400).collect()}
    for i, want in enumerate(brute_repeats(texts, 400)):
        assert (out[i]["n_bytes"], out[i]["n_removed"], out[i]["n_spans"], out[i]["kept_sha256"]) == want, i
    assert 2 * repeats.FEW in sizes and sizes[2 * repeats.FEW] < sizes[repeats.FEW] / 3
