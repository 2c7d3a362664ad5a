"""Queries of the training-data operators over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelloom.llm import bpe, classifier, jaccard, language, merkle, middle, packing, quality, repeats, toxicity, urls, vectors, warc
from modelloom.llm.common import Workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(column: str, of: int):
    """The remainder that a fixed share of rows is held out by."""
    return F.crc32(F.col(column).cast("string")) % of


@query("op1_warc", """
    with p as (
      select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
    ), f as (select *, min(page_id) over (partition by payload_digest) as first_id from p)
    select page_id, payload_bytes, payload_digest,
      case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
      case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
    from f""")
def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    with Workspace(spark, "warc") as work:
        records = warc.round_trip(spark, pages, work)
        return work.result(records.select(
            F.col("key").cast("bigint").alias("page_id"), F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
            F.col("type").alias("record_type"), F.col("refers_to").cast("bigint").alias("refers_to"),
        ))


@query("op2_repeats")
def repeats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with Workspace(spark, "repeats") as work:
        found = repeats.repeated_passages(spark, docs, work)
        return work.result(found.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256"))


@query("op3_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    with Workspace(spark, "toxicity") as work:
        lexicon = toxicity.learn_lexicon(spark, docs, labels, work)
    scored = toxicity.toxicity(docs, lexicon)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "hits")


@query("op4_quality")
def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with Workspace(spark, "quality") as work:
        stats = work.keep(quality.statistics(docs.select("doc_id", "text", "lang", "source")).drop("text"), "stats")
        judged = quality.judge(stats, *quality.estimate(spark, stats, work))
        return work.result(judged.select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance",
        ))


#: Rules as given for the pages table.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query("op5_urls")
def urls_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    with Workspace(spark, "urls") as work:
        judged = urls.judge_urls(spark, pages, URL_RULES, work)
        return work.result(judged.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust"))


@query("op6_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, ranks, public_tokenizers.PATTERN, packed=True).drop("text")
    return bpe.decode(ids, ranks).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op7_vectors")
def vectors_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Workspace(spark, "vectors") as work:
        return work.result(vectors.near_vectors(spark, table(spark, sf_dir, "embeddings"), work))


@query("op8_language")
def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit_language(docs, usable=fold("doc_id", 4) != 2)
    found = language.detect_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query("op9_packing")
def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, definition, public_tokenizers.PATTERN, added=True)


@query("op10_jaccard")
def jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Workspace(spark, "jaccard") as work:
        return work.result(jaccard.similar_documents(spark, table(spark, sf_dir, "documents"), work))


@query("op11_quality_classifier")
def quality_classifier_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1)
    with Workspace(spark, "classifier") as work:
        stats = work.keep(classifier.statistics(docs).select("doc_id", "statistics"), "stats")
        scored = classifier.quality_score(stats, classifier.fit_quality(spark, stats, labels, work))
        return work.result(scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted"))


#: CRC-32 of the decimal doc_id, bit by bit.
CRC_SQL = """xor(4294967295, list_reduce(
        list_concat([4294967295::bigint], flatten(list_transform(string_split(cast(doc_id as varchar), ''), lambda x: [ascii(x)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))))"""


def merkle_sql(depth: int = 7, upper: int = 3, fanout: int = 16) -> str:
    """All levels by aggregation, for up to ``fanout ** depth`` rows a source and ``fanout ** upper`` sources."""
    field = lambda c: f"coalesce(cast(strlen(cast({c} as varchar)) as varchar) || ':' || cast({c} as varchar), '-')"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    steps = [f"""with leaves as materialized (
      select doc_id, source, {leaf("text")} as leaf, {leaf(lowered)} as lowered from documents
    ), placed as materialized (
      select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as r,
        count(*) over (partition by source) as n, dense_rank() over (order by source nulls first) - 1 as s from leaves
    ), a0 as materialized (select s as tree, r as i, n, leaf as digest from placed)"""]

    def levels(name: str, count: int) -> None:
        for k in range(count):
            steps.append(f"""{name}{k}x as materialized (
      select tree, i, n, digest,
        case when n > 1 then coalesce(string_agg(digest, '') over (partition by tree, i // {fanout} order by i
          rows between unbounded preceding and 1 preceding), '') else '' end as l,
        case when n > 1 then coalesce(string_agg(digest, '') over (partition by tree, i // {fanout} order by i
          rows between 1 following and unbounded following), '') else '' end as r
      from {name}{k}
    ), {name}{k + 1} as materialized (
      select tree, i // {fanout} as i, (any_value(n) + {fanout - 1}) // {fanout} as n,
        case when any_value(n) > 1 then sha256(string_agg(digest, '' order by i)) else any_value(digest) end as digest
      from {name}{k} group by tree, i // {fanout}
    )""")

    levels("a", depth)
    steps.append(f"b0 as materialized (select 0 as tree, tree as i, count(*) over () as n, digest from a{depth})")
    levels("b", upper)
    steps.append(f"""f0 as materialized (
      select *, case when {CRC_SQL} % 5 = 0 then lowered else leaf end as folded, '' as proof from placed
    )""")
    at = 0
    for name, count, index in (("a", depth, "f.r"), ("b", upper, "f.s")):
        for k in range(count):
            tree = "x.tree = f.s" if name == "a" else "x.tree = 0"
            steps.append(f"""f{at + 1} as materialized (
      select f.* exclude (folded, proof), f.proof || x.l || x.r as proof,
        case when x.n > 1 then sha256(x.l || f.folded || x.r) else f.folded end as folded
      from f{at} f join {name}{k}x x on {tree} and x.i = {index} // {fanout ** k}
    )""")
            at += 1
    return ", ".join(steps) + f"""
    select f.doc_id, f.leaf, a.digest as subroot, b.digest as root, sha256(f.proof) as proof_sha256, f.folded as folded_root,
      f.folded = b.digest as verified
    from f{at} f join a{depth} a on a.tree = f.s cross join b{upper} b"""


@query("op12_merkle", merkle_sql())
def merkle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ("doc_id", "source", "lang", "n_chars")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    digest = lambda text: merkle.row_digest([*map(F.col, fields), text])
    with Workspace(spark, "merkle") as work:
        leaves = work.keep(docs.select("doc_id", "source", digest(F.col("text")).alias("leaf"), F.when(
            F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, digest(lowered)).alias("tampered")), "leaves")
        manifest = merkle.build(spark, leaves, work)
        proved = merkle.prove(spark, manifest, manifest.places, work).withColumn("tampered", F.coalesce("tampered", "found"))
        folded = proved.withColumn("folded_root", merkle.fold("tampered"))
        return work.result(folded.select(
            "doc_id", F.col("found").alias("leaf"), "subroot", "root", merkle.proof_digest().alias("proof_sha256"),
            "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
        ))


MIDDLE_SQL = r"""
    with t as (
      select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h from documents
    ), u as (
      select *, regexp_extract_all(text, '[^
]*
|[^
]+') as units, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
        cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4 from t
    ), k as (
      select *, cast(len(units) as bigint) as n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) as lo,
        greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) as hi from u
    ), p as (
      select *, array_to_string(units[1:lo], '') as prefix, array_to_string(units[lo + 1:hi], '') as middle,
        array_to_string(units[hi + 1:n], '') as suffix,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 100 then 'plain'
          when h4 % 100 < 50 then 'spm' else 'psm' end as form from k
    )
    select doc_id, n, form, case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
      case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
      sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256, sha256(text) as restored_sha256
    from p"""


@query("op13_fim", MIDDLE_SQL)
def middle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return middle.fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restored(), 256).alias("restored_sha256"),
    )
