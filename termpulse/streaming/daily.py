"""Loads of landed items into the tables, with rebuilds of the days that change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termpulse.operators.dedupe import drop_known, first_per
from termpulse.operators.derive import derive_articles, full_texts
from termpulse.functions import article as art
from termpulse.plans.jobs import Settings, process
from termpulse.session import stage
from termpulse.sources import tables


def write_batch(batch: DataFrame, root: str, settings: Settings) -> None:
    """Add a load of raw items and rebuild every day it touches. (For streams see ``deltas``.)

    No item is too late: it goes to its own day, and that day is rebuilt. Running a batch again
    gives the same tables, since touched days come from the batch and not from what was new in it.
    """
    spark = batch.sparkSession
    # the day of a row is that of its landing, so a stream that runs for long files new items under their own day
    as_of, now = F.lit(settings.as_of), F.lit(settings.now)
    if "landed_at" in batch.columns:
        as_of = F.coalesce(F.to_date("landed_at"), as_of)
        now = F.coalesce(F.date_format(F.to_utc_timestamp("landed_at", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"), now)
    items = stage(first_per(batch, ["url_canonical"], "item_ord"), "batch")
    new = stage(drop_known(items, tables.read(spark, root, "url_cache")), "batch-new")
    if not new.isEmpty():
        derived = derive_articles(new, as_of, now, settings.top_terms, **settings.term_options()).drop("term_counts")
        tables.upsert_articles(stage(derived.dropDuplicates(["bucket_date", "article_key"]), "derived"), root)
        tables.upsert_articles(full_texts(new, as_of).dropDuplicates(["bucket_date", "article_key"]), root, "fulltext")
        seen = new.select(
            "url_canonical", art.article_id(F.col("source_id"), F.col("external_id")).alias("article_id"), as_of.alias("first_seen_date")
        )
        tables.append(seen, root, "url_cache")
    # calendar days only
    touched = items.select(art.bucket_date(F.col("published_at"), as_of).alias("d")).distinct().collect()
    process(spark, root, settings, [r.d for r in touched])
