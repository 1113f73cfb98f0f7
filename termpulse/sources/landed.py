"""Landed bytes: folders of feed, reply and sitemap files, and the table of fetched pages."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions import urls

ITEM_COLUMNS = (
    "source_id", "source_type", "item_ord", "external_id", "url", "url_canonical", "title", "author", "published_at",
    "content_text", "kind", "via_source_id", "content_html",
)


@dataclass
class Landed:
    """Everything a source adapter may read.

    ``feeds`` and ``api``: ``source_id, content`` and, where known, ``file`` and ``landed_at``; a source may have many.
    ``sitemaps``: ``loc, content``. ``pages``: ``url, status, content_type, html`` and, where known, ``landed_at``; of
    several rows of a URL the newest counts. ``sources`` is the catalog, at most a bounded number of rows.
    """

    sources: DataFrame
    feeds: DataFrame
    api: DataFrame
    sitemaps: DataFrame
    pages: DataFrame
    cursors: DataFrame
    url_cache: DataFrame
    as_of: str
    max_items: int = fixed.MAX_ITEMS_PER_SOURCE
    #: What the adapters of a run have read already, by name.
    held: dict = field(default_factory=dict, repr=False)

    def of_type(self, *types: str) -> DataFrame:
        return self.sources.where(F.col("source_type").isin(*types))

    def now(self) -> Column:
        return F.lit(self.as_of)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``source_id, content, file, landed_at`` from files under ``source_id=<id>/``; one file is one row."""
    return spark.read.text(path, wholetext=True).select(
        "source_id",
        F.col("value").alias("content"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    )


def file_order(files: DataFrame) -> Column:
    """The place of a file among those of its source, newest first: an array to which the place in the file is added.

    Files of one time stand by a hash of their name, or of their content where they have no name.
    """
    time = -F.unix_micros("landed_at") if "landed_at" in files.columns else F.lit(0)
    name = F.col("file") if "file" in files.columns else F.col("content")
    return F.array(time.cast("bigint"), F.xxhash64(name))


def _newest(pages: DataFrame) -> Column:
    """How late a row of a page is: by landing, then a page that was read, then its content."""
    landed = ["landed_at"] if "landed_at" in pages.columns else []
    return F.struct(*landed, (F.col("status") == 200).alias("read"), F.xxhash64("html").alias("h"))


def newest_pages(pages: DataFrame) -> DataFrame:
    """One row for a URL: the page that landed last."""
    others = [c for c in pages.columns if c != "url"]
    return pages.groupBy("url").agg(F.max_by(F.struct(*others), _newest(pages)).alias("__p")).select("url", "__p.*")


def _readable() -> Column:
    return (F.col("status") == 200) & urls.has_content_type_text(F.col("content_type"))


def readable_pages(pages: DataFrame) -> DataFrame:
    """Fetched pages that are text: status 200 and an HTML, XML or text content type."""
    return newest_pages(pages).where(_readable()).select("url", "html")


def page_facts(pages: DataFrame, **facts: Column) -> DataFrame:
    """``url`` of the readable pages, and ``facts`` of their HTML.

    Only the facts meet in the exchange that finds the newest row of a URL: pages are read where they stand.
    """
    narrow = pages.select("url", _newest(pages).alias("__at"), _readable().alias("__readable"), *[c.alias(n) for n, c in facts.items()])
    newest = F.max_by(F.struct("__readable", *facts), "__at").alias("__p")
    return narrow.groupBy("url").agg(newest).select("url", "__p.*").where("__readable").drop("__readable")
