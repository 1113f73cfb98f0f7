"""RSS and Atom feeds, newsletters and tweet feeds as raw items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions import html as htm
from termpulse.functions import urls
from termpulse.functions.common import blank_to_null, strip
from termpulse.functions.dates import to_utc_iso
from termpulse.operators.cursors import cap_per_source, cut_at_cursor
from termpulse.operators.dedupe import drop_known
from termpulse.session import stage
from termpulse.sources.landed import ITEM_COLUMNS, Landed, file_order, page_facts, readable_pages

_ITEM = (
    "struct<guid:string,link:string,title:string,author:string,`dc:creator`:string,pubDate:string,`dc:date`:string,"
    "description:string,`content:encoded`:string>"
)
_ENTRY = (
    "struct<id:string,link:array<struct<_href:string,_rel:string>>,title:string,author:struct<name:string>,"
    "published:string,updated:string,summary:string,content:string>"
)
_FEED = f"channel struct<item:array<{_ITEM}>>, item array<{_ITEM}>, entry array<{_ENTRY}>"


def _first(*values: Column) -> Column:
    return F.coalesce(*[blank_to_null(v) for v in values])


def _rss_entry(i: Column) -> Column:
    return F.struct(
        _first(i["guid"], i["link"]).alias("guid"),
        _first(i["link"], i["guid"]).alias("link"),
        strip(F.coalesce(i["title"], F.lit(""))).alias("title"),
        _first(i["author"], i["dc:creator"]).alias("author"),
        _first(i["pubDate"], i["dc:date"]).alias("date"),
        _first(i["content:encoded"], i["description"]).alias("body"),
        _first(i["description"]).alias("summary"),
    )


def _atom_entry(e: Column) -> Column:
    link = F.get(
        F.filter(e["link"], lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"), F.lit(0)
    )["_href"]
    return F.struct(
        _first(e["id"], link).alias("guid"),
        _first(link, e["id"]).alias("link"),
        strip(F.coalesce(e["title"], F.lit(""))).alias("title"),
        _first(e["author"]["name"]).alias("author"),
        _first(e["published"], e["updated"]).alias("date"),
        _first(e["content"], e["summary"]).alias("body"),
        _first(e["summary"]).alias("summary"),
    )


def _entry_rows(feeds: DataFrame) -> DataFrame:
    """A row for each entry, and one without ``item_ord`` for a feed that holds none."""
    parsed = feeds.select("source_id", file_order(feeds).alias("place"), F.from_xml("content", _FEED, {"mode": "PERMISSIVE"}).alias("f"))
    none = F.array().cast("array<struct<guid:string,link:string,title:string,author:string,date:string,body:string,summary:string>>")
    entries = F.concat(
        F.coalesce(F.transform("f.channel.item", _rss_entry), none),
        F.coalesce(F.transform("f.item", _rss_entry), none),
        F.coalesce(F.transform("f.entry", _atom_entry), none),
    )
    rows = parsed.select("source_id", "place", F.posexplode_outer(entries).alias("pos", "e"))
    place = F.when(F.col("pos").isNotNull(), F.concat("place", F.array(F.col("pos").cast("bigint"))))
    return rows.select("source_id", place.alias("item_ord"), "e.*")


def parse_feeds(feeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries in feed order, newest file first; ``source_id`` of feeds that hold none or are no well-formed XML).

    Entries: ``source_id, item_ord, guid, link, title, author, date, body, summary``.
    """
    rows = _entry_rows(feeds)
    return rows.where(F.col("item_ord").isNotNull()), rows.where(F.col("item_ord").isNull()).select("source_id")


def read_feeds(landed: Landed) -> tuple[DataFrame, DataFrame]:
    """``parse_feeds`` of a run: parsed once and staged, whatever reads it."""
    if "feeds" not in landed.held:
        landed.held["feeds"] = stage(_entry_rows(landed.feeds), "feed-entries")
    rows = landed.held["feeds"]
    return rows.where(F.col("item_ord").isNotNull()), rows.where(F.col("item_ord").isNull()).select("source_id")


# Every scan is in two steps: narrow candidates, which are cut, compared with known URLs and ranked without any text, and
# then the items of those that are kept.


def _ordered(source_ord: str = "source_ord", item_ord: str = "item_ord") -> Column:
    return F.concat(F.array(source_ord), F.col(item_ord)).alias("item_ord")


def only_kept(rows: DataFrame, kept: DataFrame, *, placed_in_source: bool = False) -> DataFrame:
    """``rows`` (wide) whose source and place are among ``kept`` (narrow), whose places begin with that of the source."""
    place = F.slice("item_ord", F.lit(2), F.size("item_ord")).alias("item_ord") if placed_in_source else F.col("item_ord")
    return rows.join(kept.select("source_id", place), ["source_id", "item_ord"], "left_semi")


def capped(landed: Landed, candidates: DataFrame) -> DataFrame:
    return cap_per_source(candidates, landed.max_items)


def _rss_sources(landed: Landed, types: tuple[str, ...]) -> DataFrame:
    sources = landed.of_type(*(types or ("rss",))).where(F.coalesce("feed", F.lit("")) != "")
    return sources.select("source_id", "source_type", "source_ord", F.col("author").alias("__author"), F.col("name").alias("__name"))


def _inline(body: Column) -> Column:
    return F.when(body.isNotNull(), htm.text_nodes(body)).otherwise("")


def rss_candidates(landed: Landed, *types: str) -> DataFrame:
    """``source_id, item_ord, url_canonical`` of new entries that have a text or a title.

    Bodies and pages are looked at where they stand: only whether they hold text takes part in joins and ranks.
    """
    told = ((F.col("title") != "") | (_inline(F.col("body")) != "")).alias("told")
    entries = read_feeds(landed)[0].where(F.col("guid").isNotNull())
    narrow = entries.select("source_id", "item_ord", F.col("guid").alias("external_id"), "link", told)
    narrow = narrow.join(_rss_sources(landed, types).select("source_id", "source_ord"), "source_id")
    fresh = cut_at_cursor(narrow, landed.cursors)
    fresh = drop_known(fresh.withColumn("url_canonical", urls.canonical_or_raw(F.col("link"))), landed.url_cache)
    facts = page_facts(landed.pages, has_text=htm.text_nodes(F.col("html")) != "").withColumnRenamed("url", "link")
    kept = fresh.join(facts, "link", "left").where(F.col("told") | F.coalesce("has_text", F.lit(False)))
    return kept.select("source_id", _ordered(), "url_canonical")


def rss_kept(landed: Landed, kept: DataFrame, *types: str) -> DataFrame:
    """Raw items of the kept entries. The body is the page's text, else the text inlined in the feed."""
    rows = only_kept(read_feeds(landed)[0], kept, placed_in_source=True).join(_rss_sources(landed, types), "source_id")
    rows = rows.withColumn("item_ord", _ordered())
    pages = landed.pages.join(rows.select(F.col("link").alias("url")).distinct(), "url", "left_semi")
    paged = rows.join(readable_pages(pages).withColumnRenamed("url", "link"), "link", "left")
    page_text = F.when(F.col("html").isNotNull(), htm.text_nodes(F.col("html")))
    full = paged.withColumn("content_text", F.coalesce(blank_to_null(page_text), _inline(F.col("body"))))
    full = full.withColumns({"external_id": F.col("guid"), "url_canonical": urls.canonical_or_raw(F.col("link"))})
    return _as_items(
        full,
        url=F.col("link"),
        author=_first(F.col("author"), F.col("__author"), F.col("__name")),
        published=to_utc_iso(F.col("date"), landed.now()),
        kind="article",
        html=F.col("html"),
    )


def rss_items(landed: Landed, *types: str) -> DataFrame:
    """Raw items of RSS and Atom sources, each cut at its own limit."""
    return rss_kept(landed, stage(capped(landed, rss_candidates(landed, *types)), "emitted"), *types)


def newsletter_items(landed: Landed) -> DataFrame:
    return rss_items(landed, "newsletter")


def _tweet_sources(landed: Landed) -> DataFrame:
    sources = landed.of_type("twitter").where(
        ~F.col("x_api") & ((F.coalesce("nitter_feed", F.lit("")) != "") | (F.coalesce("handle", F.lit("")) != ""))
    )
    return sources.select("source_id", "source_type", "source_ord", "handle", "name", "exclude_replies")


def _tweet_fields() -> tuple[Column, Column]:
    """(id, text) of a post's entry."""
    # the link of a feed entry falls back to its guid, but a tweet without a link has none
    status = F.regexp_extract(F.coalesce("link", F.lit("")), r"/status/(\d+)", 1)
    text = F.when(F.col("summary").isNotNull(), htm.text_nodes(F.col("summary"), " ")).otherwise(F.col("title"))
    return _first(status, F.col("guid"), F.col("link")), text


def _tweet_url() -> Column:
    own = F.concat(F.lit("https://x.com/"), F.col("handle"), F.lit("/status/"), F.col("external_id"))
    numbered = (F.coalesce("handle", F.lit("")) != "") & F.col("external_id").rlike(r"^\d+$")
    return F.when(numbered, own).otherwise(urls.canonical_or_raw(F.col("link")))


def tweet_feed_candidates(landed: Landed) -> DataFrame:
    """``source_id, item_ord, url_canonical`` of new posts; a like threshold is not known there and not applied."""
    external_id, text = _tweet_fields()
    narrow = read_feeds(landed)[0].select(
        "source_id", "item_ord", "link", external_id.alias("external_id"), (text != "").alias("told"), F.ltrim(text).startswith("@").alias("reply")
    )
    fresh = cut_at_cursor(narrow.join(_tweet_sources(landed), "source_id"), landed.cursors)
    fresh = fresh.where(F.col("told") & ~(F.col("exclude_replies") & F.col("reply")))
    return fresh.withColumn("url_canonical", _tweet_url()).select("source_id", _ordered(), "url_canonical")


def tweet_feed_kept(landed: Landed, kept: DataFrame) -> DataFrame:
    external_id, text = _tweet_fields()
    rows = only_kept(read_feeds(landed)[0], kept, placed_in_source=True).join(_tweet_sources(landed), "source_id")
    rows = rows.withColumns({"external_id": external_id, "content_text": text, "item_ord": _ordered()})
    return _as_items(
        rows.withColumns({"url_canonical": _tweet_url(), "title": F.substring("content_text", 1, fixed.TWEET_TITLE_CHARS)}),
        url=F.col("url_canonical"),
        author=_first(F.col("name"), F.col("handle")),
        published=to_utc_iso(F.col("date"), landed.now()),
        kind="tweet",
        html=F.lit(None).cast("string"),
    )


def tweet_feed_items(landed: Landed) -> DataFrame:
    """Raw items of tweet feeds, each cut at its own limit."""
    return tweet_feed_kept(landed, stage(capped(landed, tweet_feed_candidates(landed)), "emitted"))


def _as_items(rows: DataFrame, *, url: Column, author: Column, published: Column, kind: str, html: Column) -> DataFrame:
    return rows.select(
        "source_id",
        "source_type",
        "item_ord",
        "external_id",
        url.alias("url"),
        "url_canonical",
        "title",
        author.alias("author"),
        published.alias("published_at"),
        "content_text",
        F.lit(kind).alias("kind"),
        F.lit(None).cast("string").alias("via_source_id"),
        html.alias("content_html"),
    ).select(*ITEM_COLUMNS)
