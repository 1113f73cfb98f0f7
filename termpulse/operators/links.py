"""Outbound links of pages and the exact link budget of newsletter issues."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions import html as htm
from termpulse.functions import urls
from termpulse.functions.common import let
from termpulse.operators.allocation import serve_in_order
from termpulse.operators.dedupe import drop_known, first_by_key, first_per
from termpulse.session import stage, unstage


def _with_links(pages: DataFrame, html: Column, resolve_on: Column | None) -> DataFrame:
    keep = pages.columns
    found = pages.select(*keep, htm.hrefs(html).alias("__hrefs"))

    def entry(h: Column, i: Column) -> Column:
        target = h if resolve_on is None else urls.resolve(resolve_on, h)
        return F.struct(target.alias("href"), i.alias("pos"))

    targets = found.select(*keep, F.transform("__hrefs", entry).alias("__targets"))
    keyed = F.transform(
        "__targets",
        lambda x: F.struct(
            urls.canonical_or_raw(x["href"]).alias("key"),
            x["pos"].alias("pos"),
            x["href"].alias("href"),
        ),
    )
    return targets.select(*keep, keyed.alias("links"))


def outbound_links(pages: DataFrame, html: Column) -> DataFrame:
    """One row per page and distinct link: the page's columns, ``pos, href, canonical``.

    Links count as equal when their canonical forms are; the first raw one is kept. ``canonical``
    is NULL for links that are no http(s) URL.
    """
    keep = [c for c in pages.columns if c != "html"]
    linked = first_by_key(_with_links(pages, html, None).select(*keep, "links"), "links")
    rows = linked.select(*keep, F.inline_outer("links")).where(F.col("pos").isNotNull())
    return rows.select(*keep, "pos", "href", urls.canonical(F.col("href")).alias("canonical"))


def issue_urls(archives: DataFrame, base: Column, html: Column, prefix: Column) -> DataFrame:
    """Links of an archive page on its own host whose path starts with ``prefix``, resolved.

    Rows: the archive's columns, ``pos, url, canonical`` (the raw URL where there is no canonical).
    """
    keep = [c for c in archives.columns if c != "html"]
    at = archives.select(*archives.columns, urls.host(base).alias("__host"), prefix.alias("__prefix"))
    linked = _with_links(at, html, base)
    own = F.filter(
        "links",
        lambda x: let(urls.host(x["href"]), lambda h: (h == "") | (F.col("__host") == "") | (h == F.col("__host")))
        & urls.path(x["href"]).startswith(F.col("__prefix")),
    )
    kept = first_by_key(linked.select(*keep, own.alias("links")), "links")
    return (
        kept.select(*keep, F.inline_outer("links"))
        .where(F.col("pos").isNotNull())
        .select(*keep, "pos", F.col("href").alias("url"), F.col("key").alias("canonical"))
    )


def issue_bodies(issues: DataFrame, pages: DataFrame) -> DataFrame:
    """``item_ord, url_canonical, html`` of newsletter issues: the HTML kept with the item, else its page, else ''.

    ``pages``: ``url, html``, one row for a URL. Pages of issues that have their HTML take no part.
    """
    kept = F.coalesce("content_html", F.lit(""))
    bare = issues.where(kept == "").select("item_ord", "url_canonical", "url")
    wanted = pages.join(bare.select("url").distinct(), "url", "left_semi")
    looked_up = bare.join(wanted, "url", "left").select("item_ord", "url_canonical", F.coalesce("html", F.lit("")).alias("html"))
    return issues.where(kept != "").select("item_ord", "url_canonical", F.col("content_html").alias("html")).unionByName(looked_up)


def follow_candidates(
    links: DataFrame, own_url: Column, blocked_hosts: Iterable[str] = fixed.BLOCKED_HOSTS
) -> DataFrame:
    """Usable links that are not blocked and lead away from the issue's own host."""
    away = urls.authority_of_canonical(F.col("canonical")) != F.coalesce(urls.authority_of_canonical(own_url), F.lit(""))
    return links.where(F.col("canonical").isNotNull() & ~urls.is_blocked(F.col("canonical"), blocked_hosts) & away)


def place_links(
    issues: DataFrame,
    links: DataFrame,
    fetched: DataFrame,
    url_cache: DataFrame,
    budget: int = fixed.LINKS_PER_ISSUE,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The result of serving the issues one after another, computed in parallel rounds.

    ``issues``: ``item_ord, url_canonical`` of all items in serving order. ``links``: ``item_ord,
    pos, canonical``. ``fetched``: ``canonical`` of pages that have text. An item is skipped, with
    its links, when its URL has an article already: from before, from an earlier item, or as an
    earlier issue's link. A link costs budget only when its page has text.

    Returns (``live`` items, ``placed`` links ``canonical, item_ord, pos``, ``failed`` links
    ``canonical, item_ord``). ``item_ord`` may be of any type that orders, also a struct.
    """
    items = stage(
        first_per(drop_known(issues.select("item_ord", "url_canonical"), url_cache), ["url_canonical"], "item_ord"), "items"
    )
    has_page = fetched.select("canonical").distinct().withColumn("has_page", F.lit(True))
    new = links.select("item_ord", "pos", "canonical").join(
        url_cache.select(F.col("url_canonical").alias("canonical")), "canonical", "left_anti"
    )
    new = stage(new.join(has_page, "canonical", "left").withColumn("has_page", F.coalesce("has_page", F.lit(False))), "links")
    taken, stale = None, []
    while True:
        live = items if taken is None else items.join(taken, "item_ord", "left_anti")
        owners = live.select(F.col("url_canonical").alias("canonical"), F.col("item_ord").alias("__owner"))
        open_links = stage(
            new.join(live.select("item_ord"), "item_ord", "left_semi")
            .join(owners, "canonical", "left")
            .where(F.col("__owner").isNull() | (F.col("__owner") > F.col("item_ord")))
            .drop("__owner"),
            "open-links",
        )
        wishes = open_links.where("has_page").select(F.col("item_ord").alias("taker"), "pos", F.col("canonical").alias("target"))
        granted = serve_in_order(wishes, budget)
        placed = granted.select(F.col("target").alias("canonical"), F.col("taker").alias("item_ord"), "pos")
        earlier = placed.select(F.col("canonical").alias("url_canonical"), F.col("item_ord").alias("__by"))
        now_taken = stage(
            items.join(earlier, "url_canonical").where(F.col("__by") < F.col("item_ord")).select("item_ord"), "taken"
        )
        before = now_taken.limit(0) if taken is None else taken
        changed = now_taken.join(before, "item_ord", "left_anti").unionByName(before.join(now_taken, "item_ord", "left_anti"))
        if changed.isEmpty():
            break
        taken = now_taken
        # this round's tables are not read again; the items that it took are, by the next
        unstage(open_links, granted, *stale)
        stale = [now_taken]
    full = (
        placed.groupBy("item_ord")
        .agg(F.count(F.lit(1)).alias("__n"), F.max("pos").alias("__end"))
        .where(F.col("__n") >= budget)
    )
    failed = (
        open_links.where(~F.col("has_page"))
        .join(full, "item_ord", "left")
        .where(F.col("__end").isNull() | (F.col("pos") < F.col("__end")))
        .groupBy("canonical")
        .agg(F.min("item_ord").alias("item_ord"))
    )
    return live, placed, failed


def linked_items(placed: DataFrame, links: DataFrame, issues: DataFrame, pages: DataFrame) -> DataFrame:
    """Raw items for placed links: they inherit the issue's source and publish time.

    ``pages``: ``canonical, title, text``. The raw link stands in for a missing title.
    """
    raw = links.select("item_ord", "canonical", "href")
    return (
        placed.join(raw, ["item_ord", "canonical"])
        .join(issues.select("item_ord", "source_id", "source_type", "published_at"), "item_ord")
        .join(pages.select("canonical", "title", "text"), "canonical")
        .select(
            "source_id",
            "source_type",
            "item_ord",
            F.col("canonical").alias("external_id"),
            F.col("canonical").alias("url"),
            F.col("canonical").alias("url_canonical"),
            F.coalesce(F.nullif("title", F.lit("")), "href").alias("title"),
            F.lit(None).cast("string").alias("author"),
            "published_at",
            F.col("text").alias("content_text"),
            F.lit("article").alias("kind"),
            F.col("source_id").alias("via_source_id"),
        )
    )
