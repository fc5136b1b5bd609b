"""The registered queries of the operators, one for each, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import ann, jaccard, language, leaks, merkle, mixing, packing, quality, secret_scan, sharding, urls, warc, whitening
from ledgerlake.llm.common import table
from ledgerlake.session import scratch_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# fixed values: the rules that the url query judges by
URL_RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes, equal texts together."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest others of every embedding whose vec_id is divisible by 50."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret in every document."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the size of their 3-word shingle sets and their component at a similarity of 0.9."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), 3, Fraction(9, 10))


def op4_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the number of other documents that each is linked with."""
    return jaccard.jaccard_links(table(spark, sf_dir, "documents"), 3, Fraction(9, 10))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of pages, judged."""
    return urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    path = scratch_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    page = lambda c: F.nullif(F.regexp_extract(c, r"^<urn:page:(.*)>$", 1), F.lit("")).cast("long")
    again = F.col("kind") == "revisit"
    return warc.read_archives(spark, path).select(
        page("id").alias("page_id"),
        F.when(again, F.col("http_length")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(again, F.regexp_replace("declared", "^sha1:", "")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.when(again, page("refers")).alias("refers_to"),
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from three of four folds."""
    return language.identify(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed: weights 1, 2, 3 by source, at most three epochs."""
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their base counts and verdicts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge_documents(docs).select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A leaf and witness of every document in a manifest by source, checked against texts of which half have lost their line ends."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.merkle_manifest(table(spark, sf_dir, "documents"), now={"text": text})


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the 16 leading components, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), 16).withColumn("deviation", F.col("deviation").cast("long"))


def op13_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words inside passages of ten words of the benchmark."""
    return leaks.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding, op2_neighbours, op3_secrets, op4_jaccard, op4_links, op5_urls, op6_warc, op7_language, op8_mixing,
        op9_packing, op10_quality, op11_merkle, op12_whitening, op13_leaks,
    )
}
