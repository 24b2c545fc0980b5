"""From raw documents to token files: quality rules, near-duplicates, decontamination, mixing, token ids.

`run` writes every stage's result as Parquet to the shared folder and reads it
again as the next stage's documents.  All stages but the last keep the columns of
`documents`.  A stage can also be called by itself on any documents; null values,
repeated rows, empty tables and other columns are treated as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasador.llm import decontam, mixing, quality, simhash, tokenfile
from tasador.llm.common import prepared, stored, table
from tasador.llm.tokenizer import vocabulary_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep.

    The raw multinomial is that of `docs`, the trusted one that of those among them
    whose label says good quality.
    """
    prepared(spark)
    return quality.keep_good(docs, quality.trusted_ids(table(spark, sf_dir, "labels")))


def simhash_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    prepared(spark)
    return simhash.keep_one(docs, shingle=3, max_distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    prepared(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mixture wants them, in random order.

    Target weights: the size of a source to the power 0.5; as many documents as there are.
    `token_files` sorts by doc_id again, which undoes the order.
    """
    prepared(spark)
    packed = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("_whole"))
    return mixing.mix(packed).select("_whole.*")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the token files."""
    prepared(spark)
    return tokenfile.written_and_read(docs, vocabulary_path(tokenfile.VOCABULARY))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_duplicates", simhash_near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_files", token_files),
]

# Neither fingerprints nor token ids can be had from SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
