"""Sitemaps and archive pages as raw items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions import html as htm
from termpulse.functions import urls
from termpulse.functions.common import blank_to_null, strip, xml_text
from termpulse.operators.cursors import cut_at_cursor
from termpulse.operators.dedupe import drop_known, first_per
from termpulse.operators.links import issue_urls
from termpulse.session import stage
from termpulse.sources.feeds import _as_items, _first, _ordered, capped, only_kept
from termpulse.sources.landed import Landed, newest_pages, page_facts, readable_pages

_LOC = r".*?<loc\b[^>]*>\s*(?:<!\[CDATA\[)?([^<\]]*)"
_CHILD = r"(?is)<sitemap\b[^>]*>" + _LOC
_LEAF = r"(?is)<url\b[^>]*>" + _LOC


def _sitemap_entries(sitemaps: DataFrame) -> DataFrame:
    """``loc, group, pos, target``: what each sitemap lists, child maps as group 0 and pages as group 1."""

    def listed(pattern: str, group: int):
        hits = F.regexp_extract_all("content", F.lit(pattern), F.lit(1))
        return F.transform(hits, lambda raw, pos: F.struct(F.lit(group).cast("bigint").alias("group"), pos.cast("bigint").alias("pos"), strip(xml_text(raw)).alias("target")))

    both = sitemaps.select("loc", F.inline(F.concat(listed(_CHILD, 0), listed(_LEAF, 1))))
    return both.where((F.col("group") == 1) | (F.col("target") != ""))


def sitemap_urls(roots: DataFrame, sitemaps: DataFrame, depth: int | None = fixed.SITEMAP_DEPTH) -> DataFrame:
    """Issue URLs of each source's sitemap tree: ``source_id, item_ord, url``.

    ``roots``: ``source_id, prefix, loc``. Child sitemaps come before a map's own URLs; the order key is the path down the
    tree. A level is read as long as the one above names maps, down to ``depth`` levels. With ``depth`` None the tree may
    be as deep as it is, and a map is not read again below itself, so a cycle ends.

    Sitemaps are parsed once; only narrow rows of maps go from level to level, and the pages join at the end.
    """
    entries = stage(_sitemap_entries(sitemaps), "sitemap-entries")
    children = entries.where("group = 0").select("loc", "pos", "target")
    none = F.array().cast("array<bigint>")
    frontier, levels = roots.select("source_id", "prefix", "loc", none.alias("key"), F.array("loc").alias("trail")), []
    while depth is None or len(levels) < depth:
        frontier = stage(frontier, "sitemap-level")
        if levels and frontier.isEmpty():
            break
        levels.append(frontier)
        below = frontier.join(children, "loc")
        if depth is None:
            below = below.where(~F.array_contains("trail", F.col("target")))
        step = F.concat("key", F.array(F.lit(0).cast("bigint"), F.col("pos")))
        frontier = below.select("source_id", "prefix", F.col("target").alias("loc"), step.alias("key"), F.concat("trail", F.array("target")).alias("trail"))
    maps = reduce(DataFrame.unionByName, levels)
    pages = maps.join(entries.where("group = 1").select("loc", "pos", "target"), "loc")
    pages = pages.where(urls.path(F.col("target")).startswith(F.col("prefix")))
    return pages.select("source_id", F.concat("key", F.array(F.lit(1).cast("bigint"), F.col("pos"))).alias("item_ord"), F.col("target").alias("url"))


def archive_issue_urls(landed: Landed) -> DataFrame:
    """``source_id, item_ord, url, url_canonical`` of each archive: its sitemap, else its archive page."""
    page = _first(F.col("archive_url"), F.col("url"))
    guess = F.when(
        urls.host(page) != "", F.concat(urls.scheme(page), F.lit("://"), urls.host(page), F.lit("/sitemap.xml"))
    )
    sources = landed.of_type("archive").select(
        "source_id",
        _first(F.col("issue_path_prefix"), F.lit(fixed.ISSUE_PATH_PREFIX)).alias("prefix"),
        page.alias("page"),
        _first(F.col("sitemap_url"), guess).alias("loc"),
    ).where(F.col("page").isNotNull())
    mapped = sitemap_urls(sources, landed.sitemaps).withColumn("url_canonical", urls.canonical_or_raw(F.col("url")))
    mapped = first_per(mapped, ["source_id", "url_canonical"], "item_ord")
    # one row per catalog source
    scraped_sources = sources.join(mapped.select("source_id").distinct(), "source_id", "left_anti")
    archives = scraped_sources.join(
        newest_pages(landed.pages).where(F.col("status") == 200).select(F.col("url").alias("page"), "html"), "page"
    )
    scraped = issue_urls(archives, F.col("page"), F.col("html"), F.col("prefix")).select(
        "source_id", F.array(F.col("pos").cast("bigint")).alias("item_ord"), "url", F.col("canonical").alias("url_canonical")
    )
    return mapped.select(*scraped.columns).unionByName(scraped)


def _issues(landed: Landed) -> DataFrame:
    """New issues, with the place of their source in ``item_ord``; known URLs leave first, so the cursor only sees new ones."""
    if "issues" not in landed.held:
        landed.held["issues"] = stage(archive_issue_urls(landed), "archive-issues")
    issues = landed.held["issues"].withColumn("external_id", F.col("url_canonical"))
    sources = landed.of_type("archive").select("source_id", "source_type", "source_ord", "author")
    return cut_at_cursor(drop_known(issues, landed.url_cache), landed.cursors).join(sources, "source_id").withColumn("item_ord", _ordered())


def archive_candidates(landed: Landed) -> DataFrame:
    """``source_id, item_ord, url_canonical`` of new issues whose page has a text or a title; no page takes part in the joins."""
    told = (htm.text_nodes(F.col("html")) != "") | (htm.title(F.col("html")) != "")
    facts = page_facts(landed.pages, told=told).where("told")
    return _issues(landed).join(facts, "url").select("source_id", "item_ord", "url_canonical")


def archive_kept(landed: Landed, kept: DataFrame) -> DataFrame:
    """Raw items of the kept issues; only their pages are read into text."""
    rows = only_kept(_issues(landed), kept)
    pages = landed.pages.join(rows.select("url").distinct(), "url", "left_semi")
    paged = (
        rows.join(readable_pages(pages), "url")
        .withColumn("content_text", htm.text_nodes(F.col("html")))
        .withColumn("title", strip(F.coalesce(blank_to_null(htm.title(F.col("html"))), F.col("url"))))
    )
    return _as_items(
        paged,
        url=F.col("url"),
        author=F.col("author"),
        published=F.coalesce(htm.published(F.col("html"), landed.now()), landed.now()),
        kind="article",
        html=F.col("html"),
    )


def archive_items(landed: Landed) -> DataFrame:
    """Raw items of archive sources, each cut at its own limit."""
    return archive_kept(landed, stage(capped(landed, archive_candidates(landed)), "emitted"))
