"""The dealt operators applied to their whole tables: one ``opN_<name>`` query each, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm import align, bpe, decontaminate, exact_dedup, langid, lexical, licenses, minhash, mixture, quality, toxicity, url_rules, warc
from salesflow.llm.shared import ship_package

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    _REGISTRY[query.__name__] = query
    return query


def table(spark: SparkSession, d: str, name: str, *columns: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{d}/{name}.parquet").select(*columns)


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


@register
def op1_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return minhash.near_groups(table(spark, d, "documents", "doc_id", "text"), words=4, percent=80)


@register
def op2_language(spark: SparkSession, d: str) -> DataFrame:
    return langid.identified(table(spark, d, "documents", "doc_id", "text", "lang"))


@register
def op3_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.judged(table(spark, d, "documents", "doc_id", "text"), table(spark, d, "labels", "doc_id", "toxic"))


@register
def op4_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, d, "documents", "doc_id", "text"), table(spark, d, "benchmark", "item_id", "text"))


@register
def op5_quality(spark: SparkSession, d: str) -> DataFrame:
    """The source is the host, source and language the path below it."""
    docs = table(spark, d, "documents", "doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path"))
    return quality.judged(docs, table(spark, d, "labels", "doc_id", "quality"))


@register
def op6_warc(spark: SparkSession, d: str) -> DataFrame:
    return warc.archived(table(spark, d, "pages", "page_id", "url", "html"), least_bytes=0)


@register
def op7_license_scan(spark: SparkSession, d: str) -> DataFrame:
    found = licenses.scan(table(spark, d, "documents", "doc_id", "text"))
    joined = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *joined, "score")


@register
def op8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix(table(spark, d, "documents", "doc_id", "source", "text")).drop("copies")


@register
def op9_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, d, "documents", "doc_id", "text"))


@register
def op10_url_rules(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages", "page_id", "url")
    return url_rules.judged(pages, url_rules.labelled_pages(spark, pages, table(spark, d, "labels", "doc_id", "quality", "toxic"))).drop("confidence")


@register
def op11_tokenizer_alignment(spark: SparkSession, d: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.link_report(table(spark, d, "documents", "doc_id", "text"), *paths)


@register
def op12_lexical_search(spark: SparkSession, d: str) -> DataFrame:
    documents, items = table(spark, d, "documents", "doc_id", "text"), table(spark, d, "benchmark", "item_id", "text")
    return lexical.search(lexical.index(documents), items, 10)


@register
def op13_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    back = bpe.decoded(bpe.encoded(table(spark, d, "documents", "doc_id", "text"), path), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
