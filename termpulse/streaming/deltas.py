"""The corpus as a stream: first-wins by keyed state, and bounds of the day stats as sums of what each micro-batch adds.

A URL's first item wins over all later ones of the stream. The URLs seen are keyed state of the query, which its
checkpoint keeps over restarts, so no log is read. Each micro-batch writes one folder of day states named by its number; a
batch that is run again after a failure replaces its folder. A state is the hash buckets of a day (``daytotals``), whose
sums bound every term from above at a fixed size. The few terms that they leave are counted and listed from the texts of
the days that a batch touches: those texts are much smaller than states of all of their terms. ``compact`` merges the
folders of many batches into one.

A table folder is fed either by this stream or by the batch jobs: day stats here know only what the stream has added.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termpulse.functions import article as art
from termpulse.operators import daystats, daytotals
from termpulse.operators.derive import derive_articles, full_texts
from termpulse.plans.jobs import Settings
from termpulse.session import stage, unstage
from termpulse.sources import tables

SCHEMAS = {"terms": "date date, part int, counts binary", "days": "date date, document_count bigint"}
PREFIX = "batch="
#: Stands for a number that an item's order lacks; before every number.
NO_ORDER = -(1 << 63)


def first_wins(items: DataFrame) -> DataFrame:
    """The first item of each canonical URL in the stream; of one micro-batch the least ``item_ord``, then source and id.

    Items without a URL count as one URL. The least of a micro-batch is found where an exchange by URL has brought its items
    together; only these meet the keyed state. Columns of their order go to Python, and no text.
    """

    def least(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        best: dict = {}
        ends = [0]
        for columns in batches:
            rows = zip(*(c.to_pylist() for c in columns))
            for at, (url, order, source, external) in enumerate(rows, ends[-1]):
                place = ([NO_ORDER if k is None else k for k in order], str(source), str(external))
                if url not in best or place < best[url][0]:
                    best[url] = (place, at)
            ends.append(ends[-1] + len(columns[0]))
        chosen = np.zeros(ends[-1], bool)
        chosen[[at for _, at in best.values()]] = True
        for first, last in zip(ends, ends[1:]):
            yield pa.array(chosen[first:last])

    # what a task finds depends on the rows that it has, so the choice may not move to before the exchange
    chosen = F.arrow_udf(least, "boolean").asNondeterministic()
    dealt = items.repartition("url_canonical")
    return dealt.where(chosen("url_canonical", "item_ord", "source_id", "external_id")).dropDuplicates(["url_canonical"])


# ---- delta folders


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def live(spark: SparkSession, root: str, name: str) -> list[tuple[int, int, str]]:
    """(first batch, last batch, path) of the finished folders that no larger finished one covers; in order."""
    files, at = _file_system(spark, f"{root}/deltas/{name}")
    found = []
    for status in files.listStatus(at) if files.exists(at) else ():
        path = status.getPath().toString()
        done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if files.exists(done):
            first, last = path.rpartition(PREFIX)[2].split("-")
            found.append((int(first), int(last), path))
    out: list[tuple[int, int, str]] = []
    for first, last, path in sorted(found, key=lambda f: (f[0], -f[1])):
        if not out or last > out[-1][1]:
            out.append((first, last, path))
    return out


def _write(df: DataFrame, root: str, name: str, first: int, last: int) -> None:
    rows = df.hint("rebalance", F.col("date")).write.mode("overwrite").option("compression", "zstd")
    rows.partitionBy("date").parquet(f"{root}/deltas/{name}/{PREFIX}{first:012d}-{last:012d}")


def deltas(spark: SparkSession, root: str, name: str, days: Iterable | None = None) -> DataFrame:
    """The rows of all live folders; of ``days`` only their partitions are read."""
    paths = [path for _, _, path in live(spark, root, name)]
    empty = spark.createDataFrame([], SCHEMAS[name])
    if not paths:
        return empty
    rows = spark.read.schema(SCHEMAS[name]).option("basePath", f"{root}/deltas/{name}").parquet(*paths).select(*empty.columns)
    return rows if days is None else rows.where(F.col("date").isin(list(days)))


def compact(spark: SparkSession, root: str, settings: Settings) -> None:
    """Merge the folders of all batches into one for each table. A run that dies leaves the old ones in force."""
    for name in SCHEMAS:
        folders = live(spark, root, name)
        if len(folders) < 2:
            continue
        rows = deltas(spark, root, name)
        whole = daytotals.added_buckets(rows) if name == "terms" else rows.groupBy("date").agg(F.sum("document_count").alias("document_count"))
        _write(whole, root, name, folders[0][0], folders[-1][1])
        for *_, path in folders:
            files, at = _file_system(spark, path)
            files.delete(at, True)


# ---- micro-batches


def _texts(spark: SparkSession, root: str, days: Iterable | None) -> DataFrame:
    """``date, article_id, author, text`` of the articles of ``days``, or of all.

    All of it stands in the table of texts, by day: no text is joined, moved or written again to be counted.
    """
    own = F.lit(True) if days is None else F.col("bucket_date").isin(list(days))
    text = art.title_and_text(F.col("title"), F.col("content_text")).alias("text")
    rows = tables.read(spark, root, "fulltext").where(own & F.col("bucket_date").isNotNull())
    return rows.select(F.col("bucket_date").alias("date"), "article_id", F.nullif("author", F.lit("")).alias("author"), text)


def day_stats(spark: SparkSession, root: str, settings: Settings, days: Iterable | None = None) -> tuple[DataFrame, DataFrame]:
    """(terms, day headers) of the given days, or of all: sums of all batches, and the texts of the tables."""
    headers = deltas(spark, root, "days", days).groupBy("date").agg(F.sum("document_count").alias("document_count"))
    headers = stage(headers, "day-headers")
    added = stage(daytotals.added_buckets(deltas(spark, root, "terms", days)), "day-buckets")
    terms = daytotals.day_terms(
        _texts(spark, root, days),
        F.col("text"),
        headers,
        max_terms=settings.max_terms,
        max_articles=settings.max_articles,
        max_authors=settings.max_authors,
        added=added,
        **settings.term_options(),
    )
    return terms, headers


def write_batch(batch: DataFrame, batch_id: int, root: str, settings: Settings) -> None:
    """Add one micro-batch of first-wins items (raw item columns, ``item_ord``, ``landed_at``) to the tables.

    Every item goes to its own day, or to that of its landing if its date is not plausible; stats of the days that the
    batch touches come from ``day_stats``. Running a batch again changes nothing.
    """
    if "landed_at" not in batch.columns:
        raise ValueError("items of a stream need landed_at: days of rows without a usable date are those of their landing")
    spark = batch.sparkSession
    as_of = F.to_date("landed_at")
    now = F.date_format(F.to_utc_timestamp("landed_at", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    items = stage(batch, "batch")
    keys = ["bucket_date", "article_key"]
    keyed = items.withColumns(
        {"bucket_date": art.bucket_date(F.col("published_at"), as_of), "article_key": art.article_key(F.col("source_id"), F.col("external_id"))}
    )
    # the one time that a batch's texts are moved: all that follows reads them in the ranges of days that they are written in
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = stage(keyed.repartitionByRange(n, *keys).dropDuplicates(keys), "batch-by-day")
    derived = derive_articles(whole, as_of, now, settings.top_terms, **settings.term_options()).drop("term_counts")
    texts = full_texts(whole, as_of, "title", "author")
    tables.upsert_articles(derived, root, dealt=True)
    tables.upsert_articles(texts, root, "fulltext", dealt=True)
    rows = whole.select(F.col("bucket_date").alias("date"), art.title_and_text(F.col("title"), F.col("content_text")).alias("text"))
    _write(daytotals.added_buckets(daytotals.buckets(rows, F.col("text"), **settings.term_options())), root, "terms", batch_id, batch_id)
    counts = whole.select(F.col("bucket_date").alias("date"), "article_key")
    _write(daystats.day_headers(counts), root, "days", batch_id, batch_id)
    seen = items.select("url_canonical", art.article_id(F.col("source_id"), F.col("external_id")).alias("article_id"), as_of.alias("first_seen_date"))
    tables.append(seen, root, "url_cache")
    touched = [r.date for r in counts.select("date").distinct().collect()]
    unstage(items, whole)
    # calendar days only
    publish(spark, root, settings, touched)


def publish(spark: SparkSession, root: str, settings: Settings, days: list) -> None:
    """Replace the stats of ``days`` in the tables."""
    if not days:
        return
    terms, headers = day_stats(spark, root, settings, days)
    terms = stage(terms, "day-terms")
    # a day can lose all of its terms: clear it first, as an overwrite leaves it in place
    termless = headers.join(terms.select("date").distinct(), "date", "left_anti")
    tables.drop_days(spark, root, "terms", [r.date for r in termless.collect()])
    tables.overwrite_days(terms, root, "terms")
    tables.overwrite_days(headers, root, "days")
    tables.append(terms.groupBy("term").agg(F.min("date").alias("first_seen")), root, "term_first_seen")
    log = headers.withColumn("processed_at", F.lit(settings.now)).withColumn("reprocessed", F.lit(False))
    tables.append(log, root, "processed_days")


def start(items: DataFrame, root: str, settings: Settings, checkpoint: str, available_now: bool = False):
    """Start the stream over ``items`` (raw item columns with ``item_ord`` and ``landed_at``); it goes on from ``checkpoint``."""
    writer = first_wins(items).writeStream.outputMode("append")
    writer = writer.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, root, settings))
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
