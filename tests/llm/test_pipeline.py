"""The queries over the smallest tables, and the pipeline's stages."""

import os
import zlib

import duckdb
import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from modelloom.llm import queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("pages", "documents"):
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF_DIR).select(*want.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


@needs_tables
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_gives_a_row_for_each(spark, name):
    table, key = ("pages", "page_id") if name == "op5_urls" else ("embeddings", "vec_id") if name == "op7_vectors" else ("documents", "doc_id")
    want = {r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in queries.QUERIES[name](spark, SF_DIR).select(key).collect()} == want


@needs_tables
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    found = queries.QUERIES["op8_language"](spark, SF_DIR).where("held_out").join(docs, "doc_id")
    assert found.where("lang_pred = lang").count() >= 0.9 * found.count()


def test_packed_ids_are_those_of_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  日本\n", "<|endoftext |> <|endoftext|", "plain <| text", "", None]
    want = []
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((i, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for packed in (queries.QUERIES["op9_packing"](spark, str(tmp_path)), corpus_pipeline.packing_stage(spark, docs, "")):
        assert sorted(map(tuple, packed.select("doc_id", "length", "ids_crc32").collect())) == want


def test_stages_keep_the_columns(spark):
    text = lambda i: " ".join(f"word{i % 7}{k}x{(i * k) % 11}" for k in range(80 + i % 9)) + "."
    rows = [(i, text(i), "en", "s", 1, "mine") for i in range(60)] + [(60, text(1), None, None, None, None), (60, text(1), "en", "s", 1, "m"),
            (None, text(2) + " more", "en", "s", 1, "m"), (61, None, "en", "s", 0, "m"), (62, "", "en", "s", 0, "m"), (63, "...", "en", "s", 3, "m")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string")
    columns, counts = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "").cache()
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] == len(rows) - 3 and counts[-1] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert {r[0] for r in packed.select("doc_id").collect()} == {r[0] for r in docs.select("doc_id").collect()}


def test_stages_against_plain_python(spark):
    import hashlib
    from collections import Counter

    from test_operators import brute_components, brute_repeats, near_copies, words

    passage = " ".join(words(7, 90, 5000))
    texts = [" ".join([*words(100 + i, 70, 5000), passage[:300 + i] if i % 3 else "", *words(200 + i, 40, 5000)]) for i in range(30)]
    texts += [t for t in near_copies(8) if len(t.split()) >= 60] + texts[:4]
    rows = [(1000 - i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(5, "1 2 3", "en", "s", 5), (6, "too short", "en", "s", 9)]
    rows += [rows[3], (None, texts[5], "en", "s", len(texts[5])), (None, None, "en", "s", None)]
    docs, stages = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "").cache()
        stages[name] = [tuple(r) for r in docs.collect()]
    # the first two keep whole rows, as often as they come
    assert not Counter(stages["language"]) - Counter(rows) and not Counter(stages["quality"]) - Counter(stages["language"])
    assert {r[0] for r in rows} - {r[0] for r in stages["language"]} == {5} and 6 not in {r[0] for r in stages["quality"]}
    # of each group the smallest id, once
    least = {key for key, _, component in brute_components([r[:2] for r in stages["quality"] if r[0] is not None]) if key == component}
    want = {r for r in stages["quality"] if r[0] in least}
    assert 0 < len(want) == len(least) < len(stages["quality"])
    assert Counter(stages["near_duplicates"]) == Counter(want) + Counter(r for r in stages["quality"] if r[0] is None)
    # without what occurs twice
    before, after = stages["near_duplicates"], stages["repeated_passages"]
    removed = brute_repeats([r[1] for r in before], corpus_pipeline.PASSAGE_BYTES)
    want = Counter((r[0], kept, r[4] - gone) for r, (_, gone, _, kept) in zip(before, removed))
    assert Counter((r[0], hashlib.sha256(r[1].encode()).hexdigest(), r[4]) for r in after) == want and any(gone for _, gone, _, _ in removed)
    # every id of what is left
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = Counter()
    for r in corpus_pipeline.packing_stage(spark, docs, "").collect():
        tokens[r["doc_id"]] += r["length"]
    want = Counter()
    for r in after:
        want[r[0]] += len(library.encode(r[1], add_special_tokens=False).ids) + 1
    assert tokens == want


def test_passages_of_51_words_go_and_clean_documents_stay(spark):
    from test_operators import words

    passages = [" ".join(words(i, 51, 5000)) for i in range(6)]
    own = lambda i: " ".join(words(100 + i, 60, 5000))
    short = " ".join(words(99, 20, 5000))  # fewer words may repeat
    rows = [(i, f"{own(2 * i)} {passages[i % 6]} {own(2 * i + 1)}", "en", "s", 1) for i in range(18)]
    rows += [(100 + i, f"{own(200 + i)} {short} {own(300 + i)}", "en", "s", 1) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    after = {r["doc_id"]: r["text"] for r in corpus_pipeline.passage_stage(spark, docs, "").collect()}
    for i, text, *_ in rows:
        if i < 100:
            assert passages[i % 6][20:-20] not in after[i] and len(after[i]) <= len(text) - len(passages[i % 6])
        else:
            assert after[i] == text


def test_of_rows_with_one_id_the_same_stays(spark):
    from test_operators import words

    rows = [(1, " ".join(words(i, 80, 5000)), "en", "s", i) for i in range(6)] + [(2, " ".join(words(9, 80, 5000)), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = [sorted(map(tuple, corpus_pipeline.near_duplicate_stage(spark, docs.repartition(n), "").collect())) for n in (1, 4)]
    assert kept[0] == kept[1] and [r[0] for r in kept[0]] == [1, 2]


@needs_tables
def test_run(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.count() > 0 and "sequence_id" in out.columns
