"""Documents to training tokens in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``. Its result is written as Parquet to the
shared folder and read again as the next one's documents, so a lost executor never costs more
than a stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe, mixing, quality, secrets, simhash
from marquee.llm.queries import byte_ranks, word_vocabulary
from marquee.llm.text import table
from marquee.session import new_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the others go."""
    return quality.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints over four-word shingles hang together by 4 bits or fewer, the first stays."""
    return simhash.one_of_each_group(docs, words=4, radius=4)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in it are masked and its number of characters is counted again."""
    masked = secrets.mask_secrets(docs, *byte_ranks())
    return masked.withColumn("n_chars", F.char_length("text").cast("bigint"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to twice; one that it takes in part is cut there."""
    mixed = mixing.mixed_documents(docs)
    return mixed.withColumn("n_chars", F.char_length("text").cast("bigint"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document of the mix: ``doc_id``, ``lang``, ``source``, ``n_tokens``, ``ids``."""
    keyed = docs.select(F.struct("doc_id", "lang", "source").alias("key"), "text")
    coded = bpe.encode(keyed, word_vocabulary(), "key", "text")
    return coded.select("key.doc_id", "key.lang", "key.source", (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
                        "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("tokens", tokens),
]

#: Near duplicates and byte pair encoding have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
