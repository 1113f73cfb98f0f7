"""Source adapters by type. Add one by putting a ``Scan`` or a function ``Landed -> DataFrame`` in ``ADAPTERS``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termpulse.operators.cursors import cap_in_order
from termpulse.session import stage
from termpulse.sources import archive, feeds
from termpulse.sources.landed import Landed
from termpulse.sources.tweets import tweet_api_items


class Scan(NamedTuple):
    """An adapter in two steps, whose sources share their limits with all others of a run.

    ``candidates(landed)``: ``source_id, item_ord, url_canonical``, narrow. ``items(landed, kept)``: the raw items of those
    that are kept. ``any_url``: whether URLs that an earlier source has emitted count as well.
    """

    candidates: Callable[[Landed], DataFrame]
    items: Callable[[Landed, DataFrame], DataFrame]
    any_url: bool = False


def _letters(landed: Landed) -> DataFrame:
    return feeds.rss_candidates(landed, "newsletter")


def _letters_kept(landed: Landed, kept: DataFrame) -> DataFrame:
    return feeds.rss_kept(landed, kept, "newsletter")


ADAPTERS = {
    "rss": (Scan(feeds.rss_candidates, feeds.rss_kept),),
    "newsletter": (Scan(_letters, _letters_kept),),
    "twitter": (Scan(feeds.tweet_feed_candidates, feeds.tweet_feed_kept, any_url=True), tweet_api_items),
    "archive": (Scan(archive.archive_candidates, archive.archive_kept),),
}


def emitted(landed: Landed, adapters: dict | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """(source_id and item_ord of what the scans of a run emit, staged; the items of adapters that are plain functions)."""
    every = [scan for scans in (adapters or ADAPTERS).values() for scan in scans]
    ready = [stage(scan(landed), "adapter-items") for scan in every if not isinstance(scan, Scan)]
    narrow = [s.candidates(landed).withColumn("any_url", F.lit(s.any_url)) for s in every if isinstance(s, Scan)]
    if not narrow:
        return landed.sources.sparkSession.createDataFrame([], "source_id string, item_ord array<bigint>"), ready
    taken = reduce(DataFrame.unionByName, [df.select("item_ord", "url_canonical") for df in ready]) if ready else None
    return stage(cap_in_order(reduce(DataFrame.unionByName, narrow), landed.max_items, taken), "emitted"), ready


def raw_items(landed: Landed, adapters: dict | None = None) -> DataFrame:
    """All sources' items in one shape, as if they were read one after another; sources of other types are left out."""
    kept, ready = emitted(landed, adapters)
    every = [scan for scans in (adapters or ADAPTERS).values() for scan in scans if isinstance(scan, Scan)]
    return reduce(DataFrame.unionByName, [scan.items(landed, kept) for scan in every] + ready)


def unknown_sources(landed: Landed, adapters: dict | None = None) -> DataFrame:
    """Catalog entries whose type has no adapter."""
    known = list(adapters or ADAPTERS)
    return landed.sources.where(F.col("source_type").isNull() | ~F.col("source_type").isin(known))
