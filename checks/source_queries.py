"""Queries on landed bytes: feeds, replies, sitemaps and JSON files built from the tables, and the jobs that read them."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from termpulse.functions import article as art
from termpulse.operators.places import placed
from termpulse.plans import jobs
from termpulse.session import shared_dir, stage
from termpulse.sources import catalog, feeds, imports, registry, tables, tweets
from termpulse.sources.archive import sitemap_urls
from termpulse.sources.landed import Landed

NOW = "2024-01-30T06:00:00+00:00"
ALL = 1 << 30
#: Entries of a landed file.
PER_FILE = 20
#: Articles of a JSON file.
PER_IMPORT = 200


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _xml(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _plain(text: Column) -> Column:
    """Text that is no markup: neither tags nor character references."""
    return F.regexp_replace(text, "[<&]", "+")


def _landed(spark: SparkSession, sources: list[dict], **parts: DataFrame) -> Landed:
    empty = {
        "feeds": "source_id string, content string",
        "api": "source_id string, content string",
        "sitemaps": "loc string, content string",
        "pages": "url string, status int, content_type string, html string",
        "cursors": "source_id string, last_guid string",
        "url_cache": tables.SCHEMAS["url_cache"],
    }
    frames = {k: parts.get(k, spark.createDataFrame([], v)) for k, v in empty.items()}
    return Landed(sources=catalog.sources_frame(spark, sources), as_of=NOW, max_items=ALL, **frames)


def _names(spark: SparkSession, sf_dir: str, column: str = "source", name: str = "documents") -> list[str]:
    """The sources of a table: a catalog's worth of names."""
    rows = t.table(spark, sf_dir, name).where(F.col(column).isNotNull()).select(column).distinct()
    return sorted(r[0] for r in rows.collect())


def _blogs(spark: SparkSession, sf_dir: str) -> list[dict]:
    return [{"id": s, "type": "rss", "name": f"Blog {s[3:]}", "feed": "f"} for s in _names(spark, sf_dir)]


def _feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as RSS files of at most twenty entries, each file landed a minute before the one with smaller ids."""
    d = t.table(spark, sf_dir, "documents")
    entry = F.struct(
        "doc_id",
        F.concat(
            F.lit("<item><guid>"), F.col("doc_id").cast("string"), F.lit("</guid><link>https://"), "source", F.lit(".example.com/p/"),
            F.col("doc_id").cast("string"), F.lit("</link><title>Title "), F.col("doc_id").cast("string"),
            F.lit("</title><pubDate>Tue, 02 Jan 2024 10:00:00 GMT</pubDate><description>"), _xml(_plain(F.col("text"))), F.lit("</description></item>"),
        ).alias("xml"),
    )
    files = d.groupBy("source", F.floor(F.col("doc_id") / (PER_FILE * 20)).alias("n")).agg(F.sort_array(F.collect_list(entry)).alias("e"))
    content = F.concat(F.lit("<rss><channel>"), F.array_join(F.transform("e", lambda x: x["xml"]), ""), F.lit("</channel></rss>"))
    return files.select(
        F.col("source").alias("source_id"), content.alias("content"), F.concat_ws("-", "source", "n").alias("file"),
        F.timestamp_seconds(F.lit(1706000000) - 60 * F.col("n")).alias("landed_at"),
    )


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of landed feeds with the text inlined in them, in the order of their source."""
    items = feeds.rss_items(_landed(spark, _blogs(spark, sf_dir), feeds=_feed_files(spark, sf_dir)))
    # texts are hashed before their rows are placed
    columns = ("source_id", "item_ord", "external_id", "url", "url_canonical", "title", "author", "published_at", "kind")
    narrow = stage(items.select(*columns, F.sha2("content_text", 256).alias("text_sha256")), "hashed-items")
    found = placed(narrow, ["source_id"], ["item_ord", "external_id"])
    return found.withColumn("place", F.col("place") + 1).drop("item_ord")


def atom_newsletter_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as Atom entries of newsletters."""
    d, n = t.table(spark, sf_dir, "documents"), F.col("doc_id").cast("string")
    entry = F.struct(
        "doc_id",
        F.concat(
            F.lit("<entry><id>tag:"), n, F.lit('</id><title type="html">Issue '), n, F.lit('</title><link rel="self" href="https://self.example/"/>'),
            F.lit('<link rel="alternate" href="https://'), "source", F.lit(".example.com/p/"), n,
            F.lit('"/><updated>2024-01-02T10:00:00Z</updated><author><name>Ed </name></author><content type="html">'), _xml(_plain(F.col("text"))),
            F.lit("</content></entry>"),
        ).alias("xml"),
    )
    files = d.groupBy("source", F.floor(F.col("doc_id") / (PER_FILE * 20)).alias("n")).agg(F.sort_array(F.collect_list(entry)).alias("e"))
    content = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), F.array_join(F.transform("e", lambda x: x["xml"]), ""), F.lit("</feed>"))
    sources = [{"id": s, "type": "newsletter", "feed": "f"} for s in _names(spark, sf_dir)]
    items = feeds.newsletter_items(_landed(spark, sources, feeds=files.select(F.col("source").alias("source_id"), content.alias("content"))))
    return items.select("source_id", "source_type", "external_id", "url", "title", "author", "published_at", F.sha2("content_text", 256).alias("text_sha256"))


def tweet_feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as entries of tweet feeds; answers to others are left out."""
    c = t.table(spark, sf_dir, "conversations").withColumn("id", (F.col("conv_id") * 1000 + F.col("turn")).cast("string"))
    text = F.concat(F.when(F.col("conv_id") % 3 == 0, "@ann ").otherwise(""), _plain(F.col("text")))
    entry = F.concat(
        F.lit("<item><title>t</title><link>https://tweets.example/"), "role", F.lit("/status/"), "id", F.lit("#m</link><pubDate>Wed, 03 Jan 2024 01:00:00 GMT</pubDate><description>"),
        _xml(text), F.lit("</description></item>"),
    )
    files = c.groupBy("role", F.floor(F.col("conv_id") / 8).alias("n")).agg(F.array_join(F.collect_list(entry), "").alias("e"))
    content = F.concat(F.lit("<rss><channel>"), "e", F.lit("</channel></rss>"))
    sources = [{"id": r, "type": "twitter", "handle": r, "name": r.upper(), "exclude_replies": True, "min_likes": 9} for r in _names(spark, sf_dir, "role", "conversations")]
    items = feeds.tweet_feed_items(_landed(spark, sources, feeds=files.select(F.col("role").alias("source_id"), content.alias("content"))))
    return items.select("source_id", "external_id", "url", "author", "published_at", "kind", F.sha2("content_text", 256).alias("text_sha256"))


def catalog_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources by type: how many items each adapter gives, and the sources that none reads."""
    kinds = ["rss", "newsletter", "podcast", "archive"]
    sources = [{"id": s, "type": kinds[k % 4], "feed": "f"} for k, s in enumerate(_names(spark, sf_dir))]
    landed = _landed(spark, sources, feeds=_feed_files(spark, sf_dir))
    given = registry.raw_items(landed).groupBy("source_id", "source_type").agg(F.count(F.lit(1)).alias("n"))
    return given.unionByName(registry.unknown_sources(landed).select("source_id", "source_type", F.lit(0).cast("long").alias("n")))


def tweet_api_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as tweet replies in many files of a source; those with few likes are left out."""
    c = t.table(spark, sf_dir, "conversations").withColumn("id", F.concat_ws("-", "conv_id", "turn"))
    tweet = F.struct("id", "text", F.lit("2024-01-03T00:00:00.000Z").alias("created_at"), F.struct((F.col("conv_id") % 7).alias("like_count")).alias("public_metrics"))
    files = c.groupBy("role", F.floor(F.col("conv_id") / 8).alias("n")).agg(F.to_json(F.struct(F.collect_list(tweet).alias("data"))).alias("content"))
    sources = [{"id": r, "type": "twitter", "handle": r, "x_api": True, "min_likes": 3} for r in _names(spark, sf_dir, "role", "conversations")]
    items = tweets.tweet_api_items(_landed(spark, sources, api=files.select(F.col("role").alias("source_id"), "content")))
    return items.select("source_id", "external_id", "url", F.sha2("content_text", 256).alias("text_sha256"), "kind", "title")


def _bare(url: str = "url") -> Column:
    return F.substring_index(F.substring_index(url, "#", 1), "?", 1)


#: Entries of a sitemap.
PER_MAP = 50


def _sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page URLs in a tree of maps: leaves of fifty pages, two levels of indexes over fifty maps each, and a root.

    Every index of the lower level also names the root, so the tree has cycles.
    """
    site, lines = "https://s.example/", t.table(spark, sf_dir, "pages").select(F.col("page_id").alias("n"), _bare().alias("loc"))
    maps = None
    for level, (outer, inner) in enumerate((("urlset", "url"), ("sitemapindex", "sitemap"), ("sitemapindex", "sitemap"))):
        line = F.concat(F.lit(f"<{inner}><loc>"), _xml(F.col("loc")), F.lit(f"</loc></{inner}>"))
        back = f"<sitemap><loc>{site}sitemap.xml</loc></sitemap>" if level == 1 else ""
        listed = lines.select(F.floor(F.col("n") / PER_MAP).alias("m"), F.struct("n", line.alias("x")).alias("e")).groupBy("m").agg(F.sort_array(F.collect_list("e")).alias("e"))
        content = F.concat(F.lit(f"<{outer}>{back}"), F.array_join("e.x", ""), F.lit(f"</{outer}>"))
        own = listed.select(F.col("m").alias("n"), F.concat(F.lit(f"{site}map-{level}-"), F.col("m").cast("string"), F.lit(".xml")).alias("loc"), content.alias("content"))
        lines = own.select("n", "loc")
        maps = own.select("loc", "content") if maps is None else maps.unionByName(own.select("loc", "content"))
    # one map for every 125,000 pages is named by the root
    last = F.sort_array(F.collect_list(F.struct("n", F.concat(F.lit("<sitemap><loc>"), "loc", F.lit("</loc></sitemap>")).alias("x"))))
    root = lines.agg(F.array_join(F.transform(last, lambda e: e["x"]), "").alias("l"))
    return maps.unionByName(root.select(F.lit(f"{site}sitemap.xml").alias("loc"), F.concat(F.lit("<sitemapindex>"), "l", F.lit("</sitemapindex>")).alias("content")))


def sitemap_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs in a tree of sitemaps of four levels with cycles; those under one path are issues."""
    roots = spark.createDataFrame([("mapped", "/en/", "https://s.example/sitemap.xml")], "source_id string, prefix string, loc string")
    found = sitemap_urls(roots, _sitemaps(spark, sf_dir), depth=None)
    return found.groupBy("source_id", "url").agg(F.count(F.lit(1)).alias("n"))


def word_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed word list: comments, blank lines, capitals and repeats."""
    path = _folder(spark, "words")
    d = t.table(spark, sf_dir, "documents").select("source", "lang").distinct()
    lines = d.select(F.explode(F.array(F.concat(F.lit(" "), F.upper("source"), F.lit(" ")), F.lit(""), F.concat(F.lit("# "), "lang"), F.concat_ws(" ", "lang", "source"))))
    lines.write.text(path)
    return spark.createDataFrame([(w,) for w in catalog.load_word_list(spark, path)], "word string")


def _day(n: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), (n % 30).cast("int"))


def json_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article files in day folders; a file holds an array of articles."""
    path, n = _folder(spark, "json-articles"), F.col("doc_id")
    d = t.table(spark, sf_dir, "documents").select(
        _day(n).cast("string").alias("day"),
        F.floor(n / (PER_IMPORT * 30)).alias("n"),
        F.to_json(
            F.struct(
                art.article_id(F.col("source"), n.cast("string")).alias("article_id"), F.col("source").alias("source_id"), F.lit("article").alias("kind"),
                art.content_chars(F.col("text")).alias("content_chars"), art.content_hash(F.col("text")).alias("content_sha256"), F.col("text").alias("snippet"),
                F.array(F.array(F.col("lang"), F.lit("3"))).alias("top_terms"),
            )
        ).alias("value"),
    )
    files = d.groupBy("day", "n").agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value"))
    # one file for each array, all days in one write
    files.select("day", "value").write.partitionBy("day").option("maxRecordsPerFile", 1).format("text").save(path)
    # the writer's own names end in .txt
    raw = imports.read_articles(spark, path, pattern="*.txt")
    return raw.select("article_id", "source_id", "kind", "content_chars", "content_sha256", F.sha2("snippet", 256).alias("snippet_sha256"), F.get("top_terms", F.lit(0))["term"].alias("top_term"), F.get("top_terms", F.lit(0))["tf"].alias("top_tf"), "bucket_date")


def _stats_files(spark: SparkSession, sf_dir: str) -> str:
    path = _folder(spark, "json-stats")
    d = t.table(spark, sf_dir, "documents").select(_day(F.col("doc_id")).alias("date"), "source", "lang", F.col("doc_id").cast("string").alias("id"))
    per = d.groupBy("date", "source").agg(F.count(F.lit(1)).alias("tf"), F.countDistinct("lang").alias("df"))
    stat = F.map_from_entries(F.collect_list(F.struct("source", F.struct("tf", "df", F.array("source").alias("articles")))))
    days = per.groupBy("date").agg(stat.alias("terms"), F.sum("tf").alias("document_count"))
    days.select(F.to_json(F.struct(F.col("date").cast("string").alias("date"), "document_count", "terms")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path


def json_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-stats files: terms with the size of their day."""
    terms, days = imports.read_stats(spark, _stats_files(spark, sf_dir), pattern="*.txt")
    return terms.join(days, "date").select("date", "term", "tf", "df", F.array_join("article_ids", ",").alias("article_ids"), "document_count")


def json_elections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elected-day files with one candidate each."""
    path = _folder(spark, "json-elections")
    d = t.table(spark, sf_dir, "documents").groupBy(_day(F.col("doc_id")).alias("date")).agg(F.max("source").alias("word"), F.count(F.lit(1)).alias("n"))
    one = F.struct(F.col("word").alias("term"), (F.col("n") / 4).alias("score"), F.col("n").alias("tf_today"))
    d.select(F.to_json(F.struct(F.col("date").cast("string").alias("date"), "word", (F.col("n") / 4).alias("score"), F.array(one).alias("candidates"), F.array("word").alias("evidence_article_ids"))).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    found = imports.read_elections(spark, path, pattern="*.txt")
    return found.select("date", "word", "score", F.get("candidates", F.lit(0))["tf_today"].alias("tf_today"), F.array_join("evidence_article_ids", ",").alias("evidence"))


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    root = _folder(spark, "ingested")
    settings = jobs.Settings(as_of=dt.date.fromisoformat(t.AS_OF), now=t.FETCHED_AT, stopwords=t.stopwords())
    jobs.ingest(spark, root, _landed(spark, _blogs(spark, sf_dir), feeds=_feed_files(spark, sf_dir)), settings)
    return root


def ingest_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article table after a run over landed feeds."""
    rows = tables.read(spark, _ingested(spark, sf_dir), "articles")
    return rows.select("article_id", "article_key", "source_id", "url_canonical", "title", "content_chars", "content_sha256", "bucket_date")


def url_cache_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known URLs after a run."""
    return tables.url_cache(spark, _ingested(spark, sf_dir)).select("url_canonical", "article_id", "first_seen_date", "status")


def cursor_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each source stands after a run: the first entry of its newest file."""
    return tables.cursors(spark, _ingested(spark, sf_dir)).select("source_id", "last_guid", "last_fetched_at")


QUERIES = {
    f.__name__: f
    for f in (
        feed_items, atom_newsletter_items, tweet_feed_items, catalog_dispatch, tweet_api_items, sitemap_issues, word_list, json_articles, json_stats, json_elections, ingest_articles, url_cache_state,
        cursor_state,
    )
}
