"""Exact de-duplication by content-defined chunk recipes, in DataFrame operations only.

A normalised text (white space deleted) is cut after a punctuation mark once a chunk has ``LEAST`` characters, so equal
texts give equal chunks. Chunks get a 64-bit identifier that is verified: all chunks of an identifier must have one
SHA-256, and those that differ are told apart by an ordinal. A document's recipe is the ordered list of its verified
identifiers; texts are equal when their recipes are. Texts are never shuffled: ``groups`` reads them once, and
``deduplicate`` writes them numbered, reads recipes and then the rows that stay.

Null text: empty; all texts without a character other than white space are one group. Null doc_id: after all others.
Rows that tie in length and doc_id: one of them stays. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termpulse.llm import common

#: Characters of a chunk before it may end at a mark, and at most.
LEAST, MOST = 1024, 8192
CHUNK = rf"(?s).{{{LEAST},{MOST}}}?(?<=[.,;:!?)\]\"'])|.{{1,{MOST}}}"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r", "")


def recipes(docs: DataFrame, row: str | None = None) -> DataFrame:
    """``row, doc_id, n_chars, text_sha256, recipe``: recipe is array<struct<id, digest>> in the order of the text.

    ``row`` names a column that numbers the rows already.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    rows = docs.select(
        number.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("norm", normalised(F.col("text")))
    chunk = lambda c: F.struct(F.xxhash64(c).alias("id"), F.unhex(F.sha2(c, 256)).alias("digest"))
    return rows.select(
        "row",
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("norm", 256).alias("text_sha256"),
        F.transform(F.regexp_extract_all("norm", F.lit(CHUNK), F.lit(0)), chunk).alias("recipe"),
    )


def verified(rows: DataFrame) -> DataFrame:
    """Staged recipes with ``key``: the ordered list of (id, ordinal) pairs."""
    uses = rows.select("row", "doc_id", "n_chars", "text_sha256", F.posexplode_outer("recipe").alias("pos", "chunk"))
    uses = uses.select("row", "doc_id", "n_chars", "text_sha256", "pos", "chunk.id", "chunk.digest")
    chunks = rows.select(F.explode("recipe").alias("chunk")).select("chunk.id", "chunk.digest").distinct()
    # chunks of one identifier and more than one digest: none, unless 64 bits happen to meet
    own = Window.partitionBy("id")
    clashes = (
        chunks.withColumn("n", F.count("*").over(own))
        .filter("n > 1")
        .select("id", "digest", F.row_number().over(own.orderBy("digest")).alias("ordinal"))
    )
    uses = uses.join(clashes, ["id", "digest"], "left")
    pair = F.when(F.col("pos").isNotNull(), F.struct("pos", "id", F.coalesce("ordinal", F.lit(0)).alias("ordinal")))
    whole = uses.groupBy("row").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "n_chars", "text_sha256")], F.sort_array(F.collect_list(pair)).alias("uses")
    )
    key = F.transform("uses", lambda u: F.struct(u["id"].alias("id"), u["ordinal"].alias("ordinal")))
    return whole.select("row", "doc_id", "n_chars", "text_sha256", key.alias("key"))


def groups(docs: DataFrame, row: str | None = None) -> DataFrame:
    """``row, doc_id, keep_row, keep_id, group_size, text_sha256`` of every row of ``docs``.

    Of equal texts the row with the most characters stays, then the one with the smallest doc_id.
    """
    rows = common.stage(verified(common.stage(recipes(docs, row), "recipes")), "verified-recipes")
    rank = F.struct(
        (-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row")
    )
    # one row for a group, summed before the shuffle; staged so that a hot group's join can be split
    alike = rows.groupBy("key").agg(F.count("*").alias("group_size"), F.min(rank).alias("best")).filter("group_size > 1")
    alike = common.stage(alike.select("key", "group_size", "best.keep_id", "best.keep_row"), "equal-texts")
    alone = F.col("group_size").isNull()
    return rows.join(alike, "key", "left").select(
        "row",
        "doc_id",
        F.when(alone, F.col("row")).otherwise(F.col("keep_row")).alias("keep_row"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. ``docs`` has doc_id and text, and any others."""
    written, row = common.numbered_files(docs, "numbered")
    return common.kept_rows(written, row, groups(written, row).filter("row = keep_row").select("row"))
