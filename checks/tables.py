"""The given tables as corpus tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termpulse.fixed_values import MAX_TERMS_PER_DAY
from termpulse.functions import article as art
from termpulse.functions import text as txt
from termpulse.operators import daystats, daytotals
from termpulse.session import spread, stage

AS_OF = "2024-01-30"
AS_OF_SQL = f"DATE '{AS_OF}'"
FETCHED_AT = "2024-01-30T06:00:00Z"
BLOCKED = ("example.org", "spam-farm.example.org")
# Frequent words of the generated prose, in addition to the package's own list.
PROSE_STOPWORDS = ("le", "la", "les", "de", "des", "un", "une", "et", "ou", "que", "qui", "en", "der", "die", "das", "und", "el", "los", "con", "por")


def as_of_date():
    return F.expr(AS_OF_SQL)


def stopwords() -> tuple[str, ...]:
    from termpulse.fixed_values import STOPWORDS

    return STOPWORDS + PROSE_STOPWORDS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` in the raw item shape, with its day."""
    return as_raw_items(spread(table(spark, sf_dir, "documents"), "doc_id"))


def as_raw_items(documents: DataFrame, *more: str) -> DataFrame:
    """``documents`` in the raw item shape, with its day and the columns ``more``."""
    n = F.col("doc_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (n % 30).cast("int"))
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/p/"), n.cast("string"))
    return documents.select(
        F.col("source").alias("source_id"),
        n.cast("string").alias("external_id"),
        art.article_id(F.col("source"), n.cast("string")).alias("article_id"),
        art.article_key(F.col("source"), n.cast("string")).alias("article_key"),
        day.alias("date"),
        url.alias("url"),
        url.alias("url_canonical"),
        F.lit("").alias("title"),
        F.when(n % 10 != 0, F.concat(F.lit("author-"), (n % 50).cast("string"))).alias("author"),
        F.when(n % 97 == 0, "")
        .when(n % 89 == 0, "2030-01-01T00:00:00+00:00")
        .otherwise(F.concat(day.cast("string"), F.lit("T12:00:00+00:00")))
        .alias("published_at"),
        F.col("text").alias("content_text"),
        F.when(F.col("n_chars") <= 280, "tweet").otherwise("article").alias("kind"),
        F.lit(None).cast("string").alias("via_source_id"),
        *more,
    )


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date, article_id, article_key, author, term_counts`` of every document."""
    return txt.with_term_counts(
        raw_items(spark, sf_dir), F.col("content_text"), keep=("date", "article_id", "article_key", "author"), stopwords=stopwords()
    )


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daystats.day_headers(raw_items(spark, sf_dir).select("date", "article_key"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date, article_id, author, text`` of every document with a day, written by day."""
    items = as_raw_items(table(spark, sf_dir, "documents")).withColumnRenamed("content_text", "text")
    return daytotals.by_day(items, "date", "article_id", "author", "text")


def uncapped_totals(spark: SparkSession, sf_dir: str, headers: DataFrame, max_terms: int | None = None, rows: DataFrame | None = None) -> DataFrame:
    """``date, term, tf, df, document_count``; those that no cap of ``max_terms`` keeps may be left out."""
    rows = texts(spark, sf_dir) if rows is None else rows
    return daytotals.text_totals(rows, F.col("text"), headers, max_terms=max_terms, stopwords=stopwords())


def totals(spark: SparkSession, sf_dir: str, headers: DataFrame | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Capped ``date, term, tf, df, document_count``; no per-article lists."""
    headers = days(spark, sf_dir) if headers is None else headers
    return daystats.cap_terms(uncapped_totals(spark, sf_dir, headers, MAX_TERMS_PER_DAY, rows))


def day_terms(spark: SparkSession, sf_dir: str, max_terms: int = MAX_TERMS_PER_DAY, headers: DataFrame | None = None, **bounds) -> DataFrame:
    """The full rollup of every document's text."""
    headers = stage(days(spark, sf_dir), "day-headers") if headers is None else headers
    return daytotals.day_terms(texts(spark, sf_dir), F.col("text"), headers, max_terms=max_terms, stopwords=stopwords(), **bounds)
