"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next.

Every stage but the last returns the columns of ``documents`` for the rows that it keeps; the last returns a row for each
piece of a document with its place in a sequence.

In every stage a null text counts as empty, texts are taken whole whatever their length, and further columns stay, whatever
their names. Empty texts are one group for either de-duplication, contain no item, and are packed as their end id. Rows
that share a doc_id are rows of their own; of equal texts that tie in length and doc_id one stays, and a null doc_id comes
after all others. Empty table: no rows.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termpulse.llm import decontaminate, exact, packing, quality, simhash
from termpulse.session import shared_dir

VOCABULARY, END_ID = "word_bpe_49k.json", 1


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules, learned from ``labels``, predict to be good."""
    return quality.accepted(docs, _table(spark, sf_dir, "labels"))


def keep_one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the longest, then that with the smallest doc_id."""
    return exact.deduplicate(docs)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (fingerprints of three-word shingles, 2 bits) that with the smallest doc_id."""
    return simhash.deduplicate(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of ``benchmark``."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their place in sequences of 4096."""
    pieces = packing.pieces(docs, public_tokenizers.path(VOCABULARY), END_ID)
    digested = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digested).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", keep_one_of_equal),
    ("near_dedup", keep_one_of_similar),
    ("decontamination", keep_uncontaminated),
    ("packing", pack),
]

#: Stages with learned rules, minima and token ids are beyond SQL; tests compare the pipeline with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, folder = _table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
