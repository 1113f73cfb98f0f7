"""Partitioned Parquet tables: reads, whole-day overwrites and append-only state logs."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "articles": (
        "article_id string, source_id string, via_source_id string, kind string, url string, url_canonical string, "
        "title string, author string, published_at string, fetched_at string, content_sha256 string, "
        "content_chars bigint, content_tokens bigint, snippet string, top_terms array<struct<term:string,tf:bigint>>, "
        "article_key string, bucket_date date"
    ),
    # title and author stand beside the texts of a stream, whose stats come from this table alone
    "fulltext": "article_id string, article_key string, content_text string, title string, author string, bucket_date date",
    "terms": "term string, tf bigint, df bigint, article_ids array<string>, authors array<string>, date date",
    "days": "document_count bigint, date date",
    "elections": (
        "word string, score double, candidates array<struct<term:string,score:double,tf_today:bigint,df_today:bigint,"
        "avg_tf_baseline:double,articles:array<string>>>, evidence_article_ids array<string>, "
        "rerank struct<by:string,model:string,top:array<string>>, "
        "llm struct<summary:string,why:string,model:string,generated_at:string,definition:struct<text:string,references:array<string>>>, "
        "date date"
    ),
    "cursors": "source_id string, last_guid string, last_fetched_at string, etag string, last_modified string",
    "url_cache": "url_canonical string, article_id string, first_seen_date date, status string",
    "processed_days": "date date, processed_at string, document_count bigint, reprocessed boolean",
    "term_first_seen": "term string, first_seen date",
    "rejects": "source_id string, reason string, run_at string",
    # one row for each write and day of a partitioned table
    "changes": "name string, date date, change string",
}
PARTITION = {"articles": "bucket_date", "fulltext": "bucket_date", "terms": "date", "days": "date", "elections": "date"}


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table, or an empty frame of its schema when it was never written."""
    path = f"{root}/{name}"
    if not exists(spark, path):
        return spark.createDataFrame([], SCHEMAS[name])
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def _typed(df: DataFrame, name: str) -> DataFrame:
    empty = df.sparkSession.createDataFrame([], SCHEMAS[name])
    columns = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in empty.schema
    ]
    return df.select(*columns)


def _by_day(df: DataFrame, name: str) -> DataFrame:
    """Rows typed and grouped by day for writing: few files per day, and large days split."""
    return _typed(df, name).hint("rebalance", F.col(PARTITION[name]))


def append(df: DataFrame, root: str, name: str, dealt: bool = False) -> None:
    """Add rows. ``dealt`` says that tasks hold ranges of days already, so that they need not be moved for the write."""
    rows = _by_day(df, name) if name in PARTITION and not dealt else _typed(df, name)
    writer = rows.write.mode("append").option("compression", "zstd")
    if name not in PARTITION:
        writer.parquet(f"{root}/{name}")
        return
    days = _days(df, name)
    writer.partitionBy(PARTITION[name]).parquet(f"{root}/{name}")
    _note(df.sparkSession, days, root, name)


def _days(df: DataFrame, name: str) -> list:
    """Calendar days that ``df`` has rows for."""
    return [r[0] for r in df.select(F.col(PARTITION[name]).cast("date")).distinct().collect()]


def _note(spark: SparkSession, days: list, root: str, name: str) -> None:
    """Log that ``days`` of a table have changed. The write comes first: a lost note is written by its repetition."""
    if days:
        change = uuid.uuid4().hex
        rows = spark.createDataFrame([(name, day, change) for day in days], SCHEMAS["changes"])
        rows.coalesce(1).write.mode("append").parquet(f"{root}/changes")


def changed_days(spark: SparkSession, root: str, name: str, seen: DataFrame | None = None) -> DataFrame:
    """``date, change`` of a table's changes that ``seen`` (change) does not have."""
    rows = read(spark, root, "changes").where(F.col("name") == name).select("date", "change")
    return rows if seen is None else rows.join(seen.select("change").distinct(), "change", "left_anti")


def overwrite_days(df: DataFrame, root: str, name: str) -> None:
    """Replace the partitions that ``df`` has rows for; other days stay."""
    # before the write, as ``df`` may read the files that it replaces
    days = _days(df, name)
    (
        _by_day(df, name)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(PARTITION[name])
        .parquet(f"{root}/{name}")
    )
    _note(df.sparkSession, days, root, name)


def drop_days(spark: SparkSession, root: str, name: str, days: Iterable) -> None:
    """Remove whole day partitions."""
    days = list(days)
    for day in days:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/{PARTITION[name]}={day}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _note(spark, days, root, name)


def days_of(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The days a table has rows for, as ``date``."""
    return read(spark, root, name).select(F.col(PARTITION[name]).alias("date")).distinct()


def upsert_articles(new: DataFrame, root: str, name: str = "articles", dealt: bool = False) -> None:
    """Add rows by (bucket date, article key); a row that is there is replaced.

    Usually nothing collides and this is a plain append. Only days with a collision are rewritten, and of the table only the
    keys of the days in ``new`` are read.
    """
    spark, keys = new.sparkSession, ["bucket_date", "article_key"]
    # calendar days only
    days = [r.bucket_date for r in new.select("bucket_date").distinct().collect()]
    old = read(spark, root, name).where(F.col("bucket_date").isin(days))
    # before the write, which replaces files that they come from
    touched = [r.bucket_date for r in old.join(new.select(*keys), keys, "left_semi").select("bucket_date").distinct().collect()]
    if touched:
        own = F.col("bucket_date").isin(touched)
        kept = old.where(own).join(new.select(*keys), keys, "left_anti")
        overwrite_days(kept.unionByName(_typed(new, name).where(own)), root, name)
    rest = [d for d in days if d not in touched]
    if rest:
        append(new.where(F.col("bucket_date").isin(rest)), root, name, dealt)


def url_cache(spark: SparkSession, root: str) -> DataFrame:
    """The URL log resolved to one row per URL: an article wins over a failure, then the first date."""
    best = F.min(F.struct(F.col("article_id").isNull().alias("none"), "first_seen_date", "article_id", "status")).alias("b")
    return read(spark, root, "url_cache").groupBy("url_canonical").agg(best).select(
        "url_canonical", "b.article_id", "b.first_seen_date", "b.status"
    )


def cursors(spark: SparkSession, root: str) -> DataFrame:
    """The latest position of each source."""
    last = F.max(F.struct("last_fetched_at", "last_guid", "etag", "last_modified")).alias("c")
    return read(spark, root, "cursors").groupBy("source_id").agg(last).select(
        "source_id", "c.last_guid", "c.last_fetched_at", "c.etag", "c.last_modified"
    )


def processed_days(spark: SparkSession, root: str) -> DataFrame:
    """The latest log entry of each processed day."""
    last = F.max(F.struct("processed_at", "reprocessed", "document_count")).alias("p")
    return read(spark, root, "processed_days").groupBy("date").agg(last).select(
        "date", "p.processed_at", "p.document_count", "p.reprocessed"
    )


def term_first_seen(spark: SparkSession, root: str) -> DataFrame:
    """The first day of each term, from the log that every processing adds to."""
    return read(spark, root, "term_first_seen").groupBy("term").agg(F.min("first_seen").alias("first_seen"))
