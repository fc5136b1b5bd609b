"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import jaccard, mixing, packing, quality, secret_scan
from ledgerlake.llm.common import table, written
from ledgerlake.llm.queries import TOKENIZER

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: SQL can neither train the forest nor tokenise; stages are tested against brute force.
ORACLE_SQL = None


def _documents(df: DataFrame, text: str = "text") -> DataFrame:
    """The columns of documents, with the new text and its length in characters."""
    return df.select("doc_id", F.col(text).alias("text"), "lang", "source", F.length(text).cast(df.schema["n_chars"].dataType).alias("n_chars"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that fail them."""
    return _documents(quality.judge_documents(docs.select(*COLUMNS)).filter("kept"), "clean_text")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    return jaccard.keep_first(docs.select(*COLUMNS), 5, Fraction(4, 5))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind."""
    return _documents(secret_scan.redact(docs.select(*COLUMNS)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; sources weigh 1, 2, 3, repeating."""
    mixed = mixing.mix_documents(docs.select(*COLUMNS)).filter("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of a document."""
    return packing.pack_documents(docs, TOKENIZER, keep_ids=False).drop("row")


STAGES = [
    ("quality_rules", clean),
    ("near_duplicates", deduplicate),
    ("secret_scans", hide_secrets),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
