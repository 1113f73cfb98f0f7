"""Raw items to article derivatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions import article as art
from termpulse.functions import text as txt

ARTICLE_COLUMNS = (
    "article_id", "source_id", "via_source_id", "kind", "url", "url_canonical", "title", "author", "published_at",
    "fetched_at", "content_sha256", "content_chars", "content_tokens", "snippet", "top_terms", "bucket_date", "article_key",
)


def derive_articles(
    items: DataFrame, as_of: Column, fetched_at: Column, n_top: int | None = fixed.TOP_TERMS_PER_ARTICLE, **term_options
) -> DataFrame:
    """One derivative per raw item, plus its full ``term_counts``; narrow, no shuffle.

    Full text is not among the columns; ``full_texts`` gives it for the separate table.
    """
    body = F.col("content_text")
    base = items.withColumn("content_text", F.coalesce(body, F.lit(""))).withColumn(
        "__all", art.title_and_text(F.col("title"), body)
    )
    # two columns of their own: whoever drops the counts of all terms does not pay for them
    counted = base.select(
        *items.columns, txt.top_counts(F.col("__all"), n_top, **term_options).alias("top_terms"), txt.term_counts(F.col("__all"), **term_options).alias("term_counts")
    )
    return counted.select(
        art.article_id(F.col("source_id"), F.col("external_id")).alias("article_id"),
        "source_id",
        "via_source_id",
        "kind",
        "url",
        "url_canonical",
        "title",
        "author",
        "published_at",
        fetched_at.alias("fetched_at"),
        art.content_hash(body).alias("content_sha256"),
        art.content_chars(body).alias("content_chars"),
        art.estimate_tokens(body).alias("content_tokens"),
        art.snippet(body).alias("snippet"),
        "top_terms",
        art.bucket_date(F.col("published_at"), as_of).alias("bucket_date"),
        art.article_key(F.col("source_id"), F.col("external_id")).alias("article_key"),
        "term_counts",
    )


def full_texts(items: DataFrame, as_of: Column, *more: str) -> DataFrame:
    """``article_id, article_key, content_text, bucket_date`` and the columns ``more`` for the unpublished full-text table."""
    return items.select(
        art.article_id(F.col("source_id"), F.col("external_id")).alias("article_id"),
        art.article_key(F.col("source_id"), F.col("external_id")).alias("article_key"),
        F.coalesce("content_text", F.lit("")).alias("content_text"),
        art.bucket_date(F.col("published_at"), as_of).alias("bucket_date"),
        *more,
    )
