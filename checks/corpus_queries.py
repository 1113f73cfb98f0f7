"""Queries on terms, day rollups, scores, elections and article fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from termpulse import fixed_values as fixed
from termpulse.functions import article as art
from termpulse.functions import text as txt
from termpulse.operators import daystats, daytotals, scoring
from termpulse.session import stage


def _list(name: str):
    return F.array_join(name, ",").alias(name)


def tokenize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    toks = t.raw_items(spark, sf_dir).select(F.explode(txt.tokens(F.col("content_text"))).alias("token"))
    return toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def ngram_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept 1- to 3-grams of every article with their counts."""
    return daystats.article_terms(t.counted(spark, sf_dir), "article_id").select("article_id", "term", "tf")


def article_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = t.counted(spark, sf_dir).select("article_id", txt.top_terms(F.col("term_counts")).alias("top"))
    rows = top.select("article_id", F.posexplode_outer("top")).where(F.col("pos").isNotNull())
    return rows.select("article_id", (F.col("pos") + 1).cast("bigint").alias("rank"), "col.term", "col.tf")


def day_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = t.day_terms(spark, sf_dir)
    return full.select("date", "term", "tf", "df", _list("article_ids"), _list("authors"))


def day_terms_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = t.day_terms(spark, sf_dir, max_terms=200, max_articles=5, max_authors=3)
    return full.select("date", "term", "tf", "df", _list("article_ids"), _list("authors"))


def day_terms_uncapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All terms of every day with all of their articles and authors."""
    rows, headers = t.as_raw_items(t.table(spark, sf_dir, "documents")), stage(t.days(spark, sf_dir), "day-headers")
    bounds = {"max_terms": None, "max_articles": None, "max_authors": None}
    full = daytotals.day_terms(rows, F.col("content_text"), headers, stopwords=t.stopwords(), **bounds)
    return full.select("date", "term", "tf", "df", _list("article_ids"), _list("authors"))


def day_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.days(spark, sf_dir)


def day_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daystats.day_articles(t.raw_items(spark, sf_dir))


def baseline_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = stage(t.days(spark, sf_dir), "day-headers")
    based = scoring.with_baseline(t.totals(spark, sf_dir, days), days, 7)
    return based.select("date", "term", F.round("avg_tf_baseline", 4).alias("avg_tf_baseline"), "ever_present")


def _scored(spark: SparkSession, sf_dir: str, days: DataFrame | None = None, rows: DataFrame | None = None) -> DataFrame:
    days = stage(t.days(spark, sf_dir), "day-headers") if days is None else days
    return scoring.score_terms(t.totals(spark, sf_dir, days, rows), days)


def term_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("date", "term", "tf", "df", F.round("score", 4).alias("score"))


def elect_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading term of every day."""
    days = stage(t.days(spark, sf_dir), "day-headers")
    top = scoring.rank_candidates(_scored(spark, sf_dir, days), 1)
    return days.select("date").join(top, "date", "left").select(
        "date", F.col("term").alias("word"), "tf", "df", F.coalesce(F.round("score", 6), F.lit(0.0)).alias("score")
    )


def leaders(spark: SparkSession, sf_dir: str, days: DataFrame, rows: DataFrame) -> DataFrame:
    """The first ``RERANK_INPUT`` terms of every day, written: at most that many rows per calendar day."""
    return stage(scoring.rank_candidates(_scored(spark, sf_dir, days, rows), fixed.RERANK_INPUT), "leaders")


def elections(
    spark: SparkSession,
    sf_dir: str,
    rerank: DataFrame | None = None,
    head: DataFrame | None = None,
    days: DataFrame | None = None,
    rows: DataFrame | None = None,
) -> DataFrame:
    """Elections with candidates and evidence; the article lists are built for the candidates only."""
    days = stage(t.days(spark, sf_dir), "day-headers") if days is None else days
    rows = t.texts(spark, sf_dir) if rows is None else rows
    head = leaders(spark, sf_dir, days, rows) if head is None else head
    found = daytotals.text_occurrences(rows, F.col("text"), head, stopwords=t.stopwords())
    return scoring.elect(head.join(daystats.term_articles(found), ["date", "term"], "left"), days, rerank)


def elect_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = elections(spark, sf_dir).select("date", F.posexplode("candidates").alias("pos", "c"), "evidence_article_ids")
    return rows.select(
        "date",
        (F.col("pos") + 1).cast("bigint").alias("rank"),
        "c.term",
        "c.score",
        "c.tf_today",
        "c.df_today",
        "c.avg_tf_baseline",
        F.array_join("c.articles", ",").alias("articles"),
        _list("evidence_article_ids"),
    )


def event_type_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of event types: the type is the term, the user is the article."""
    e = t.table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"), F.col("event_type").alias("term"), F.col("user_id").cast("string").alias("article_id")
    )
    days = daystats.day_headers(e)
    per_article = e.groupBy("date", "article_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    scored = scoring.score_terms(daystats.day_totals(per_article, days), days, baseline_days=10)
    return scored.select("date", "term", "tf", "df", F.round("score", 4).alias("score"))


def article_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.raw_items(spark, sf_dir).select("source_id", "external_id", "article_id")


def article_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shown id, and the key that tables and joins use."""
    return t.raw_items(spark, sf_dir).select("source_id", "external_id", "article_id", "article_key")


def snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.raw_items(spark, sf_dir).select("article_id", art.snippet(F.col("content_text")).alias("snippet"))


def bucket_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.raw_items(spark, sf_dir).select(
        "article_id", art.bucket_date(F.col("published_at"), t.as_of_date()).alias("bucket_date")
    )


def derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    from termpulse.operators.derive import derive_articles

    return derive_articles(t.raw_items(spark, sf_dir), t.as_of_date(), F.lit(t.FETCHED_AT), stopwords=t.stopwords())


def derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = F.array_join(F.transform("top_terms", lambda x: F.concat(x["term"], F.lit(":"), x["tf"].cast("string"))), ",")
    return derived(spark, sf_dir).withColumn("top_terms", flat).drop("term_counts")


def conversation_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as short posts: id, sizes, snippet and title of each."""
    c = t.table(spark, sf_dir, "conversations")
    ext = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return c.select(
        art.article_id(F.col("role"), ext).alias("article_id"),
        ext.alias("external_id"),
        art.content_hash(F.col("text")).alias("content_sha256"),
        art.content_chars(F.col("text")).alias("content_chars"),
        art.estimate_tokens(F.col("text")).alias("content_tokens"),
        art.snippet(F.col("text")).alias("snippet"),
        F.substring("text", 1, fixed.TWEET_TITLE_CHARS).alias("title"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        tokenize_counts, ngram_terms, article_top_terms, day_terms, day_terms_capped, day_terms_uncapped, day_headers, day_articles,
        baseline_window, term_scores, elect_daily, elect_candidates, event_type_trend, article_ids, article_keys, snippets,
        bucket_dates, derivatives, conversation_posts,
    )
}
