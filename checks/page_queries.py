"""Queries on URLs, pages, links, incremental positions and the link budget."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from termpulse.functions import html as htm
from termpulse.functions import urls
from termpulse.operators import cursors, dedupe, links
from termpulse.session import spread


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(t.table(spark, sf_dir, "pages"), "page_id")


def url_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page URL, and once more with a tracking parameter added before the fragment."""
    p = pages(spark, sf_dir).select("page_id", F.lit(0).alias("variant"), "url")
    bare, fragment = F.substring_index("url", "#", 1), F.regexp_extract("url", "(#.*)$", 1)
    mark = F.when(bare.contains("?"), "&utm_source=dup").otherwise("?utm_source=dup")
    return p.unionByName(p.select("page_id", F.lit(1).alias("variant"), F.concat(bare, mark, fragment).alias("url")))


def canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_variants(spark, sf_dir).withColumn("canonical", urls.canonical(F.col("url")))


def blocked_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block test by host, parent host and file extension."""
    return pages(spark, sf_dir).select(
        "page_id", urls.is_blocked(F.col("url"), t.BLOCKED, (".html", ".pdf")).alias("blocked")
    )


def unblocked_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join form of the block test, for block lists of any size."""
    blocklist = spark.createDataFrame([(h,) for h in t.BLOCKED], "host string")
    p = pages(spark, sf_dir).select("page_id", urls.canonical(F.col("url")).alias("canonical"))
    return dedupe.drop_blocked(p, blocklist).select("page_id", "canonical")


def url_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first item of each canonical URL."""
    v = canonical_urls(spark, sf_dir)
    return dedupe.first_per(v, ["canonical"], "variant", "page_id").select("canonical", "page_id", "variant")


def _cache(spark: SparkSession, sf_dir: str, language: str) -> DataFrame:
    """URL cache of the pages in one language, as if fetched earlier."""
    known = pages(spark, sf_dir).where(F.col("url").contains(f"/{language}/"))
    return known.select(
        urls.canonical(F.col("url")).alias("url_canonical"), F.col("page_id").cast("string").alias("article_id")
    )


def should_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = dedupe.should_follow(url_variants(spark, sf_dir), _cache(spark, sf_dir, "fr"), blocked_hosts=t.BLOCKED)
    return asked.select("page_id", "variant", "canonical", "follow")


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select(
        "page_id", htm.title(F.col("html")).alias("title"), htm.text_nodes(F.col("html")).alias("text")
    )


def outbound_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages whose addresses are made absolute; every page names each link once more with a tracking parameter."""
    p = pages(spark, sf_dir)
    root = F.regexp_extract("url", "^(https?://[^/?#]*)", 1)
    own = F.replace(F.col("html"), F.lit('href="/'), F.concat(F.lit('href="'), root, F.lit("/")))
    marked = F.regexp_replace(own, r'href="(https?://[^"?#]*)"', 'href="$1?utm_source=again"')
    found = links.outbound_links(p.select("page_id", F.concat(own, marked).alias("html")), F.col("html"))
    return found.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href", "canonical")


def archive_issue_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as an archive: links on its own host under a path prefix, resolved."""
    found = links.issue_urls(
        pages(spark, sf_dir).select("page_id", "url", "html"), F.col("url"), F.col("html"), F.lit("/t")
    )
    return found.select("page_id", F.col("pos").cast("bigint").alias("pos"), F.col("canonical"))


def published_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish times put in the pages' heads in the form that their language uses here."""
    day = F.lpad((F.length("html") % 28 + 1).cast("string"), 2, "0")
    iso = F.concat(F.lit("2024-01-"), day, F.lit("T10:00:00+02:00"))
    mail = F.concat(day, F.lit(" Jan 2024 10:00:00 GMT"))
    tag = (
        F.when(F.col("url").contains("/en/"), F.concat(F.lit('<meta property="article:published_time" content="'), iso, F.lit('">')))
        .when(F.col("url").contains("/fr/"), F.concat(F.lit('<meta content="'), mail, F.lit('" name="article:published"/>')))
        .when(F.col("url").contains("/de/"), F.concat(F.lit('<time class="d" datetime="'), iso, F.lit('">')))
        .otherwise("")
    )
    marked = pages(spark, sf_dir).select("page_id", F.replace(F.col("html"), F.lit("<head>"), F.concat(F.lit("<head>"), tag)).alias("html"))
    return marked.select("page_id", htm.published(F.col("html"), F.lit(t.FETCHED_AT)).alias("published_at"))


def known_url_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose URL has no article yet; short posts are known from earlier."""
    items = t.raw_items(spark, sf_dir)
    cache = items.where(F.col("kind") == "tweet").select("url_canonical", "article_id")
    return dedupe.drop_known(items, cache).select("article_id", "url_canonical")


def _feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as feed entries of their source, newest first."""
    return t.raw_items(spark, sf_dir).withColumn("item_ord", -F.col("external_id").cast("bigint"))


def cursor_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries newer than each source's last position: here, its longest entry."""
    items = _feed_items(spark, sf_dir)
    longest = F.max_by("external_id", F.struct(F.length("content_text"), F.col("external_id").cast("bigint")))
    last = items.groupBy("source_id").agg(longest.alias("last_guid"))
    return cursors.cut_at_cursor(items, last).select("source_id", "external_id")


def source_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cursors.cap_per_source(_feed_items(spark, sf_dir), 25).select("source_id", "external_id")


def next_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    emitted = cursors.cap_per_source(_feed_items(spark, sf_dir), 25)
    return cursors.next_cursors(emitted, t.FETCHED_AT).select("source_id", "last_guid", "last_fetched_at")


def issue_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(issues, links, fetched pages, URL cache): every page is an issue that names 15 pages."""
    p = pages(spark, sf_dir).select("page_id", "url", urls.canonical(F.col("url")).alias("url_canonical"))
    n = p.count()
    issues = p.select(F.col("page_id").alias("item_ord"), "url_canonical")
    named = p.select(
        F.col("page_id").alias("item_ord"),
        F.col("url_canonical").alias("own"),
        F.explode(F.sequence(F.lit(0), F.lit(14))).alias("pos"),
    ).withColumn("target", (F.col("item_ord") * 7 + F.col("pos") * 13) % n)
    targets = p.select(F.col("page_id").alias("target"), F.col("url_canonical").alias("canonical"))
    found = named.join(targets, "target")
    wanted = links.follow_candidates(found, F.col("own"), t.BLOCKED).select("item_ord", "pos", "canonical")
    fetched = p.where(~F.col("url").contains("/de/")).select(F.col("url_canonical").alias("canonical"))
    return issues, wanted, fetched, _cache(spark, sf_dir, "es")


def link_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links that each issue gets, as if the issues were served one after another."""
    _, placed, _ = links.place_links(*issue_links(spark, sf_dir), budget=4)
    return placed.select("canonical", "item_ord")


QUERIES = {
    f.__name__: f
    for f in (
        canonical_urls, blocked_urls, unblocked_by_join, url_dedupe, should_follow, page_text, outbound_links,
        archive_issue_urls, published_meta, known_url_anti, cursor_cut, source_cap, next_cursors, link_budget,
    )
}
