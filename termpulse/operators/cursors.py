"""Incremental positions per source: cut at the last run's item, cap, next position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.operators.allocation import serve_in_order
from termpulse.session import stage


def cut_at_cursor(items: DataFrame, cursors: DataFrame, key: str = "external_id") -> DataFrame:
    """Items of each source before the first one the last run ended with.

    The cut position comes from an equality join on (source, key) and a minimum per source, so no
    source is ever ordered in one task, however large it is.
    """
    last = cursors.where(F.col("last_guid").isNotNull()).select("source_id", F.col("last_guid").alias(key))
    cuts = (
        items.select("source_id", key, "item_ord")
        .join(last, ["source_id", key])
        .groupBy("source_id")
        .agg(F.min("item_ord").alias("__cut"))
    )
    kept = items.join(cuts, "source_id", "left").where(F.col("__cut").isNull() | (F.col("item_ord") < F.col("__cut")))
    return kept.select(*items.columns)


def cap_per_source(items: DataFrame, max_items: int = fixed.MAX_ITEMS_PER_SOURCE) -> DataFrame:
    """The first ``max_items`` items of each source in feed order."""
    order = W.partitionBy("source_id").orderBy("item_ord")
    return (
        items.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= max_items).drop("__rank")
    )


def cap_in_order(items: DataFrame, max_items: int = fixed.MAX_ITEMS_PER_SOURCE, ready: DataFrame | None = None) -> DataFrame:
    """The items that a run over the sources one after another emits: ``source_id, item_ord``.

    ``items``: ``source_id, item_ord, url_canonical, any_url`` of all sources, narrow; the first element of ``item_ord`` is
    the place of the source. A source skips URLs that an earlier one of the run has emitted, without using up its limit;
    it may emit one URL twice. Sources whose items have ``any_url`` (posts) skip none, but later sources skip theirs, and
    those of ``ready`` (``item_ord, url_canonical``), which are emitted already.
    """
    rows = stage(items.select("source_id", "item_ord", "url_canonical", "any_url", F.get("item_ord", F.lit(0)).alias("taker")), "candidates")
    free = stage(cap_per_source(rows.where("any_url"), max_items), "free-items")
    owned = free.select("url_canonical", "taker")
    if ready is not None:
        owned = owned.unionByName(ready.select("url_canonical", F.get("item_ord", F.lit(0)).alias("taker")))
    first = owned.where("url_canonical IS NOT NULL").groupBy("url_canonical").agg(F.min("taker").alias("__first"))
    asking = rows.where("NOT any_url").join(first, "url_canonical", "left")
    asking = asking.where(F.col("__first").isNull() | (F.col("__first") >= F.col("taker")))
    wishes = asking.select("taker", F.col("item_ord").alias("pos"), F.col("url_canonical").alias("target"))
    granted = serve_in_order(stage(wishes, "wishes"), max_items)
    emitted = rows.where("NOT any_url").join(granted.select(F.col("pos").alias("item_ord")), "item_ord", "left_semi")
    return free.select("source_id", "item_ord").unionByName(emitted.select("source_id", "item_ord"))


def next_cursors(emitted: DataFrame, fetched_at: str) -> DataFrame:
    """The first emitted item of each source becomes its position."""
    return emitted.groupBy("source_id").agg(F.min_by("external_id", "item_ord").alias("last_guid")).select(
        "source_id",
        "last_guid",
        F.lit(fetched_at).alias("last_fetched_at"),
        F.lit(None).cast("string").alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
    )
