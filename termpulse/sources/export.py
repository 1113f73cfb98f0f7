"""Published Parquet tables: articles, terms, elections; whole, or the days that have changed."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termpulse.sources import tables

#: Folder column of tables that are published by day, and the log of changes that they hold already.
DAY, SEEN = "day", "published_changes"


def articles_table(articles: DataFrame, *more: Column) -> DataFrame:
    return articles.select(
        "article_id", "source_id", "via_source_id", "kind", "url", "url_canonical", "title", "author", "published_at",
        "fetched_at", "content_sha256", F.coalesce("content_chars", F.lit(0)).cast("bigint").alias("content_chars"),
        F.coalesce("content_tokens", F.lit(0)).cast("bigint").alias("content_tokens"), "snippet", *more,
    )


def terms_table(terms: DataFrame, *more: Column) -> DataFrame:
    none = F.array().cast("array<string>")
    return terms.select(
        F.col("date").cast("string").alias("date"),
        "term",
        F.coalesce("tf", F.lit(0)).cast("bigint").alias("tf"),
        F.coalesce("df", F.lit(0)).cast("bigint").alias("df"),
        F.coalesce("article_ids", none).alias("article_ids"),
        F.coalesce("authors", none).alias("authors"),
        *more,
    )


def elections_table(elections: DataFrame, *more: Column) -> DataFrame:
    none = F.array().cast("array<string>")
    return elections.select(
        F.col("date").cast("string").alias("date"),
        "word",
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
        F.coalesce("evidence_article_ids", none).alias("evidence_article_ids"),
        F.coalesce(F.transform("candidates", lambda c: c["term"]), none).alias("candidate_terms"),
        F.col("llm.summary").alias("llm_summary"),
        F.col("llm.why").alias("llm_why"),
        F.col("llm.model").alias("llm_model"),
        F.col("llm.generated_at").alias("llm_generated_at"),
        *more,
    )


def export_all(articles: DataFrame, terms: DataFrame, elections: DataFrame, out: str) -> dict[str, int]:
    """Write the three tables, range-ordered, and return their row counts.

    Rows are ordered across files, so readers skip files by their date and term ranges.
    """
    spark: SparkSession = articles.sparkSession
    tables = {
        "articles": (articles_table(articles), ("published_at", "article_id")),
        "terms": (terms_table(terms), ("date", "term")),
        "elections": (elections_table(elections), ("date",)),
    }
    counts = {}
    for name, (df, order) in tables.items():
        keys = [F.coalesce(c, F.lit("")) for c in order]
        df.orderBy(*keys).write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/{name}")
        counts[name] = spark.read.parquet(f"{out}/{name}").count()
    return counts


def write_days(df: DataFrame, days: Iterable, path: str, *order: str) -> None:
    """Replace the folders of ``days`` by the rows of ``df`` (with the column ``day``); other folders are not touched.

    A day without rows loses its folder. Rows are ordered within a day, so that readers skip by them.
    """
    spark, days = df.sparkSession, list(days)
    if not days:
        return
    keys = [F.coalesce(c, F.lit("")) for c in order]
    rows = df.where(F.col(DAY).isin(days)).repartitionByRange(DAY, *keys).sortWithinPartitions(DAY, *keys)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.partitionBy(DAY).parquet(path)
    # calendar days only
    there = {r[DAY] for r in df.where(F.col(DAY).isin(days)).select(DAY).distinct().collect()}
    for day in days:
        if day not in there:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{DAY}={day}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def published(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A published table, written whole or by day, without its folder column; empty if nothing was published yet."""
    path, reader = f"{out}/{name}", spark.read
    if name in PUBLISHED:
        empty = PUBLISHED[name][0](spark.createDataFrame([], tables.SCHEMAS[name]))
        if not tables.exists(spark, path):
            return empty
        # given, as a folder may hold no rows
        reader = reader.schema(empty.schema)
    return reader.parquet(path).drop(DAY)


def _seen(spark: SparkSession, out: str) -> DataFrame:
    path = f"{out}/{SEEN}"
    schema = "name string, change string"
    return spark.read.schema(schema).parquet(path) if tables.exists(spark, path) else spark.createDataFrame([], schema)


def new_changes(spark: SparkSession, root: str, out: str, name: str, *sources: str) -> tuple[list, DataFrame]:
    """(days of the tables ``sources`` that have changed since ``out`` was written, their changes under ``name``)."""
    seen = _seen(spark, out).where(F.col("name") == name)
    rows = [tables.changed_days(spark, root, source, seen) for source in sources]
    changes = rows[0]
    for more in rows[1:]:
        changes = changes.unionByName(more)
    # a calendar's worth of rows for each write
    found = changes.distinct().collect()
    noted = spark.createDataFrame([(name, r.change) for r in found], "name string, change string").distinct()
    return sorted({r.date for r in found}), noted


def note_published(noted: DataFrame, out: str) -> None:
    noted.coalesce(1).write.mode("append").parquet(f"{out}/{SEEN}")


PUBLISHED: dict[str, tuple[Callable, tuple[str, ...]]] = {
    "articles": (articles_table, ("published_at", "article_id")),
    "terms": (terms_table, ("date", "term")),
    "elections": (elections_table, ("date",)),
}


def export_changed(spark: SparkSession, root: str, out: str) -> dict[str, int]:
    """Publish the days of each table that have changed since the last export to ``out``; the row counts of the whole tables.

    A run that dies leaves its changes unnoted, so the next one writes those days again.
    """
    counts = {}
    for name, (shown, order) in PUBLISHED.items():
        days, noted = new_changes(spark, root, out, name, name)
        if days:
            day = tables.PARTITION[name]
            rows = tables.read(spark, root, name).where(F.col(day).isin(days))
            write_days(shown(rows, F.col(day).alias(DAY)), days, f"{out}/{name}", *order)
            note_published(noted, out)
        counts[name] = published(spark, out, name).count()
    return counts
