"""Imports of JSON corpora: files of one article, day's stats or election, or of an array of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ARTICLE = (
    "article_id string, source_id string, via_source_id string, kind string, url string, url_canonical string, "
    "title string, author string, published_at string, fetched_at string, content_sha256 string, "
    "content_chars bigint, content_tokens bigint, snippet string, top_terms array<array<string>>"
)
_STATS = (
    "date string, document_count bigint, article_ids array<string>, "
    "terms map<string, struct<tf:bigint,df:bigint,articles:array<string>,authors:array<string>>>"
)
_ELECTION = (
    "date string, word string, score double, evidence_article_ids array<string>, "
    "candidates array<struct<term:string,score:double,tf_today:bigint,df_today:bigint,avg_tf_baseline:double,articles:array<string>>>, "
    "rerank struct<by:string,model:string,top:array<string>>, "
    "llm struct<summary:string,why:string,model:string,generated_at:string,definition:struct<text:string,references:array<string>>>"
)


JSON_FILES = "*.json"


def _read(spark: SparkSession, path: str, schema: str, pattern: str) -> DataFrame:
    reader = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", pattern).json(path)


def read_articles(spark: SparkSession, path: str, day: str | None = None, pattern: str = JSON_FILES) -> DataFrame:
    """Article files under ``path/<YYYY-MM-DD>/`` or ``path/<name>=<YYYY-MM-DD>/``; the folder is the bucket date."""
    raw = _read(spark, path if day is None else f"{path}/{day}", _ARTICLE, pattern)
    bucket = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:[^/=]+=)?(\d{4}-\d{2}-\d{2})/[^/]+$", 1).try_cast("date")
    pairs = F.transform("top_terms", lambda p: F.struct(F.get(p, F.lit(0)).alias("term"), F.get(p, F.lit(1)).try_cast("bigint").alias("tf")))
    return raw.withColumn("bucket_date", bucket).where(F.col("bucket_date").isNotNull()).withColumn("top_terms", pairs)


def read_stats(spark: SparkSession, path: str, pattern: str = JSON_FILES) -> tuple[DataFrame, DataFrame]:
    """(terms, days) tables from day-stats files."""
    raw = _read(spark, path, _STATS, pattern).withColumn("date", F.col("date").try_cast("date")).where(F.col("date").isNotNull())
    terms = raw.select("date", F.explode("terms").alias("term", "s")).select(
        "date",
        "term",
        F.coalesce("s.tf", F.lit(0)).alias("tf"),
        F.coalesce("s.df", F.lit(0)).alias("df"),
        F.col("s.articles").alias("article_ids"),
        F.col("s.authors").alias("authors"),
    )
    return terms, raw.select("date", "document_count")


def read_elections(spark: SparkSession, path: str, pattern: str = JSON_FILES) -> DataFrame:
    return _read(spark, path, _ELECTION, pattern).withColumn("date", F.col("date").try_cast("date"))
