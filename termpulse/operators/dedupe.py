"""First-wins de-duplication and anti-joins on URLs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions import urls


def first_per(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The first row of each key by ``order``; the limit also runs before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= 1).drop("__rank")


def first_by_key(df: DataFrame, items: str) -> DataFrame:
    """Keep the first entry of each key of an ``array<struct<key, pos, ...>>`` column, in ``pos`` order.

    Works inside the row: sorting makes equal keys neighbours, so n links take n log n steps.
    """
    others = [c for c in df.columns if c != items]
    ordered = df.select(*others, F.sort_array(items).alias("__ordered"))
    firsts = ordered.select(
        *others,
        F.filter(
            "__ordered", lambda x, i: (i == 0) | (F.get("__ordered", i - 1)["key"] != x["key"])
        ).alias("__firsts"),
    )
    by_pos = F.sort_array(F.transform("__firsts", lambda x: F.struct(x["pos"].alias("pos"), x.alias("item"))))
    return firsts.select(*others, F.transform(by_pos, lambda x: x["item"]).alias(items))


def known_urls(url_cache: DataFrame) -> DataFrame:
    """URLs of the cache that led to an article."""
    return url_cache.where(F.col("article_id").isNotNull()).select("url_canonical")


def drop_known(items: DataFrame, url_cache: DataFrame) -> DataFrame:
    """Items whose canonical URL has no article yet."""
    return items.join(known_urls(url_cache), "url_canonical", "left_anti")


def should_follow(
    links: DataFrame,
    url_cache: DataFrame,
    url: str = "url",
    blocked_hosts: Iterable[str] = fixed.BLOCKED_HOSTS,
) -> DataFrame:
    """Add ``canonical`` and ``follow``: usable, not blocked and not in the cache."""
    checked = links.withColumn("canonical", urls.canonical(F.col(url)))
    seen = url_cache.select(F.col("url_canonical").alias("canonical")).distinct().withColumn("__seen", F.lit(True))
    ok = F.col("canonical").isNotNull() & F.col("__seen").isNull() & ~urls.is_blocked(F.col("canonical"), blocked_hosts)
    return (
        checked.join(seen, "canonical", "left")
        .withColumn("follow", F.coalesce(ok, F.lit(False)))
        .drop("__seen")
    )


def drop_blocked(links: DataFrame, blocklist: DataFrame, canonical: str = "canonical") -> DataFrame:
    """Anti-join against a block list of any size: host suffixes meet blocked hosts on equality."""
    hosts = links.select(canonical).distinct().withColumn("__host", urls.host(F.col(canonical)))
    suffix = hosts.select(canonical, F.explode(urls.host_suffixes(F.col("__host"))).alias("host"))
    bad = suffix.join(blocklist.select("host"), "host", "left_semi").select(canonical).distinct()
    return links.where(~urls.is_blocked(F.col(canonical), ())).join(bad, canonical, "left_anti")
