import json
import re

import pytest
from pyspark.sql import functions as F

from termpulse.operators.cursors import cut_at_cursor
from termpulse.sources import catalog, feeds, registry
from termpulse.sources.archive import archive_candidates, sitemap_urls
from termpulse.sources.landed import Landed, read_documents
from termpulse.sources.tables import SCHEMAS

NOW = "2026-04-14T06:00:00+00:00"
RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/" xmlns:dc="http://purl.org/dc/elements/1.1/">
<channel><title>F</title>
<item><title> New post </title><link>https://blog.ai/new?utm_source=rss</link><guid isPermaLink="false">g3</guid>
 <pubDate>Mon, 13 Apr 2026 10:00:00 GMT</pubDate><description>&lt;p&gt;Short&lt;/p&gt;</description>
 <content:encoded><![CDATA[<p>Full <b>body</b></p>]]></content:encoded><dc:creator>Ann</dc:creator></item>
<item><title>No guid nor link</title></item>
<item><title>Paged</title><link>https://blog.ai/paged</link><pubDate>bad date</pubDate><description>inline</description></item>
<item><title></title><link>https://blog.ai/empty</link></item>
<item><title>Known</title><link>https://blog.ai/known</link><description>x</description></item>
<item><title>Last run</title><link>https://blog.ai/last</link><guid>g1</guid></item>
<item><title>Older</title><link>https://blog.ai/older</link><guid>g0</guid></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>A</title>
<entry><id>tag:1</id><title type="html">One</title><link rel="self" href="https://n.ai/self"/><link rel="alternate" href="https://n.ai/one"/>
<updated>2026-04-12T08:00:00Z</updated><author><name>Bo</name></author><content type="html">&lt;p&gt;Hello&lt;/p&gt;</content></entry></feed>"""
TWEETS = """<rss><channel>
<item><title>t</title><link>https://nitter.net/bob/status/222#m</link><guid>https://nitter.net/bob/status/222#m</guid>
 <pubDate>Tue, 14 Apr 2026 01:00:00 GMT</pubDate><description>&lt;p&gt;Agents &lt;a href="x"&gt;rock&lt;/a&gt;&lt;/p&gt;</description></item>
<item><title>r</title><link>https://nitter.net/bob/status/221</link><description>@ann hi</description></item>
<item><title>Only a title</title><link>https://nitter.net/bob/other</link><guid>odd</guid></item>
</channel></rss>"""
API = json.dumps({"data": [
    {"id": "9", "text": "big news", "created_at": "2026-04-13T00:00:00.000Z", "public_metrics": {"like_count": 50}},
    {"id": "8", "text": "quiet", "public_metrics": {"like_count": 1}},
    {"id": "7", "text": "seen", "public_metrics": {"like_count": 60}},
    {"id": "6", "text": "old", "public_metrics": {"like_count": 60}},
]})
PAGE = "<html><head><title>{t}</title><meta property='article:published_time' content='2026-04-11T00:00:00Z'></head><body><p>{b}</p></body></html>"
SITEMAP = """<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">
<url><loc>https://s.ai/p/b</loc></url><url><loc> https://s.ai/p/a </loc></url><url><loc>https://s.ai/about</loc></url>
<url><loc>https://s.ai/p/b?utm_source=z</loc></url><url><loc>https://s.ai/p/doc</loc></url></urlset>"""
SOURCES = [
    {"id": "blog", "type": "rss", "name": "Blog", "feed": "f"},
    {"id": "news", "type": "newsletter", "name": "News", "feed": "f"},
    {"id": "bob", "type": "twitter", "handle": "bob", "name": "Bob", "exclude_replies": True, "min_likes": 1000},
    {"id": "api", "type": "twitter", "handle": "al", "x_api": True, "min_likes": 10},
    {"id": "mapped", "type": "archive", "url": "https://s.ai/", "archive_url": "https://s.ai/archive", "author": "S"},
    {"id": "scraped", "type": "archive", "archive_url": "https://h.ai/archive"},
    {"id": "odd", "type": "podcast"},
    {"id": "blog", "type": "rss", "name": "Again", "feed": "g"},
]


def landed_of(spark, **changes):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    html = "text/html; charset=utf-8"
    parts = dict(
        sources=catalog.sources_frame(spark, SOURCES),
        feeds=frame([("blog", RSS), ("news", ATOM), ("bob", TWEETS), ("broken", "<rss><channel>")], "source_id string, content string"),
        api=frame([("api", API)], "source_id string, content string"),
        sitemaps=frame([("https://s.ai/sitemap.xml", SITEMAP)], "loc string, content string"),
        pages=frame(
            [
                ("https://blog.ai/paged", 200, html, PAGE.format(t="P", b="page text")),
                ("https://blog.ai/new?utm_source=rss", 200, "application/pdf", "%PDF"),
                ("https://s.ai/p/a", 200, html, PAGE.format(t="A", b="alpha")),
                ("https://s.ai/p/b", 200, html, PAGE.format(t="", b="beta")),
                ("https://s.ai/p/doc", 200, "application/pdf", "x"),
                ("https://h.ai/archive", 200, html, '<a href="/p/1">1</a><a href="/p/2">2</a><a href="/q/3">3</a>'),
                ("https://h.ai/p/1", 200, html, "<title>One</title>"),
                ("https://h.ai/p/2", 404, html, "gone"),
            ],
            "url string, status int, content_type string, html string",
        ),
        cursors=frame([("blog", "g1"), ("api", "7")], "source_id string, last_guid string"),
        url_cache=frame([("https://blog.ai/known", "blog--1", None, None)], SCHEMAS["url_cache"]),
        as_of=NOW,
    )
    return Landed(**{**parts, **changes})


@pytest.fixture(scope="module")
def items(spark):
    rows = registry.raw_items(landed_of(spark)).collect()
    out = {}
    for r in sorted(rows, key=lambda r: r.item_ord):
        out.setdefault(r.source_id, []).append(r)
    return out


def test_rss(items):
    new, paged = items["blog"]
    assert (new.external_id, new.url, new.url_canonical, new.title, new.author) == (
        "g3", "https://blog.ai/new?utm_source=rss", "https://blog.ai/new", "New post", "Ann"
    )
    assert (new.content_text, new.published_at, new.kind) == ("Full\nbody", "2026-04-13T10:00:00+00:00", "article")
    assert (paged.external_id, paged.author, paged.published_at) == ("https://blog.ai/paged", "Blog", NOW)
    assert "page text" in paged.content_text and paged.content_html.startswith("<html>")


def test_atom_newsletter(items):
    (one,) = items["news"]
    assert (one.external_id, one.url, one.title, one.author, one.content_text, one.published_at, one.source_type) == (
        "tag:1", "https://n.ai/one", "One", "Bo", "Hello", "2026-04-12T08:00:00+00:00", "newsletter"
    )


def test_tweet_feed(items):
    first, odd = items["bob"]
    assert (first.external_id, first.url, first.content_text, first.title, first.author, first.kind) == (
        "222", "https://x.com/bob/status/222", "Agents rock", "Agents rock", "Bob", "tweet"
    )
    assert (odd.external_id, odd.url, odd.content_text) == ("odd", "https://nitter.net/bob/other", "Only a title")


def test_tweet_api(items):
    (t,) = items["api"]
    assert (t.external_id, t.url, t.author, t.published_at) == ("9", "https://x.com/al/status/9", "al", "2026-04-13T00:00:00+00:00")


def test_archives(items):
    b, a = items["mapped"]
    assert (b.external_id, b.title, a.title, a.author, a.published_at) == (
        "https://s.ai/p/b", "https://s.ai/p/b", "A", "S", "2026-04-11T00:00:00+00:00"
    )
    (one,) = items["scraped"]
    assert (one.title, one.external_id, one.published_at) == ("One", "https://h.ai/p/1", NOW)


def test_item_cap(spark):
    rows = registry.raw_items(landed_of(spark, max_items=1)).collect()
    assert sorted(r.source_id for r in rows) == ["api", "blog", "bob", "mapped", "news", "scraped"]


def test_unknown_types_and_bad_feeds(spark):
    landed = landed_of(spark)
    assert [r.source_id for r in registry.unknown_sources(landed).collect()] == ["odd"]
    _, bad = feeds.parse_feeds(landed.feeds)
    assert [r.source_id for r in bad.collect()] == ["broken"]


def test_added_adapter(spark):
    def podcasts(landed):
        return feeds.newsletter_items(landed).withColumn("source_id", F.lit("odd"))

    rows = registry.raw_items(landed_of(spark), {"podcast": (podcasts,)}).collect()
    assert [r.source_id for r in rows] == ["odd"]


def test_sitemap_tree(spark):
    index = "<sitemapindex><sitemap><loc>{}</loc></sitemap><sitemap><loc>{}</loc></sitemap></sitemapindex>"
    own = "<url><loc>https://z/p/top</loc></url>"
    leaf = "<urlset><url><lastmod>1</lastmod><loc><![CDATA[https://z/p/{}]]></loc></url></urlset>"
    maps = [
        ("r", index.format("m1", "m2").replace("</sitemapindex>", own + "</sitemapindex>")), ("m1", leaf.format(1)),
        ("m2", index.format("m3", "m1")), ("m3", index.format("m4", "m1")), ("m4", leaf.format(4)),
    ]
    sitemaps = spark.createDataFrame(maps, "loc string, content string")
    roots = spark.createDataFrame([("s", "/p/", "r")], "source_id string, prefix string, loc string")
    got = [r.url for r in sitemap_urls(roots, sitemaps).orderBy("item_ord").collect()]
    # m3 is on the third level: its own children are not read
    assert got == ["https://z/p/1", "https://z/p/1", "https://z/p/top"]


def test_sitemap_trees_of_any_depth_end_at_cycles(spark):
    leaf = "<urlset><url><loc>https://z/p/{}</loc></url></urlset>"
    below = lambda *locs: "<sitemapindex>" + "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in locs) + "</sitemapindex>"
    maps = [("r", below("a", "r")), ("a", below("b", "a")), ("b", below("c", "r", "x")), ("c", below("d", "a")), ("d", leaf.format(1)), ("x", leaf.format(2)), ("lost", leaf.format(3))]
    sitemaps = spark.createDataFrame(maps, "loc string, content string")
    roots = spark.createDataFrame([("s", "/p/", "r"), ("none", "/p/", "missing")], "source_id string, prefix string, loc string")
    got = [(r.source_id, r.url) for r in sitemap_urls(roots, sitemaps, depth=None).orderBy("item_ord").collect()]
    assert got == [("s", "https://z/p/1"), ("s", "https://z/p/2")]
    assert sitemap_urls(roots, sitemaps).count() == 0 and sitemap_urls(roots.limit(0), sitemaps, depth=None).count() == 0


def test_urls_of_earlier_sources_leave_places_to_later_items(spark):
    shared, own = feed_of("s1", "s2"), feed_of("s1", "s2", "s1", "own1", "own2", "own3")
    sources = [{"id": k, "type": "rss", "name": k, "feed": "f"} for k in ("first", "second")] + [{"id": "posts", "type": "twitter", "handle": "", "nitter_feed": "n"}, {"id": "last", "type": "rss", "name": "l", "feed": "f"}]
    files = spark.createDataFrame([("first", shared), ("second", own), ("posts", own), ("last", own)], "source_id string, content string")
    landed = landed_of(spark, sources=catalog.sources_frame(spark, sources), feeds=files, cursors=spark.createDataFrame([], "source_id string, last_guid string"), max_items=2)
    found = {}
    for r in sorted(registry.raw_items(landed).collect(), key=lambda r: r.item_ord):
        found.setdefault(r.source_id, []).append(r.external_id)
    # posts skip no URL of others, and the last source skips theirs
    assert found == {"first": ["s1", "s2"], "second": ["own1", "own2"], "posts": ["s1", "s2"], "last": ["own3"]}


def test_pages_take_no_part_in_ranks(spark):
    """Neither texts nor HTML are in the plans that choose what a run emits."""
    landed = landed_of(spark)
    for candidates in (feeds.rss_candidates(landed), archive_candidates(landed)):
        assert candidates.columns == ["source_id", "item_ord", "url_canonical"]
        plan = spark._jvm.PythonSQLUtils.explainString(candidates._jdf.queryExecution(), "formatted")
        moved = re.findall(r"\(\d+\) \w*Exchange.*\nInput \[\d+\]: \[(.*)\]", plan)
        assert moved and not any(re.search(r"\b(html|body|content|summary)#", columns) for columns in moved)


def test_catalog(spark, tmp_path):
    path = tmp_path / "sources.json"
    path.write_text(json.dumps({"version": 1, "sources": SOURCES}))
    assert catalog.load_sources(str(path)) == SOURCES
    assert catalog.sources_frame(spark, SOURCES).where("source_id = 'blog'").first().name == "Blog"
    with pytest.raises(ValueError):
        catalog.parse_sources({"version": 2})
    with pytest.raises(ValueError):
        catalog.parse_sources({"version": 1, "sources": {"a": 1}})
    words = tmp_path / "words.txt"
    words.write_text("# note\nThe\n\n of \nthe\n")
    assert catalog.load_word_list(spark, str(words)) == ("of", "the")


def test_landed_files(spark, tmp_path):
    folder = tmp_path / "source_id=blog"
    folder.mkdir()
    (folder / "feed.xml").write_text(RSS)
    (row,) = read_documents(spark, str(tmp_path)).collect()
    assert (row.source_id, row.content) == ("blog", RSS)


def feed_of(*guids):
    items = "".join(f"<item><guid>{g}</guid><link>https://blog.ai/{g}</link><title>{g}</title></item>" for g in guids)
    return f"<rss><channel>{items}</channel></rss>"


def test_several_files_of_a_source_have_one_order(spark):
    import datetime as dt

    old, new = dt.datetime(2026, 4, 13), dt.datetime(2026, 4, 14)
    files = spark.createDataFrame(
        [("blog", feed_of("g3", "g4"), "b.xml", old), ("blog", feed_of("g1", "g2"), "a.xml", new), ("blog", feed_of("g5"), "c.xml", old)],
        "source_id string, content string, file string, landed_at timestamp",
    )
    rows, _ = feeds.parse_feeds(files)
    places = sorted((r.item_ord, r.guid) for r in rows.collect())
    assert [g for _, g in places[:2]] == ["g1", "g2"] and len({tuple(p) for p, _ in places}) == 5
    cursors = spark.createDataFrame([("blog", "g2")], "source_id string, last_guid string")
    assert [r.external_id for r in cut_at_cursor(rows.withColumnRenamed("guid", "external_id"), cursors).collect()] == ["g1"]


def test_a_page_that_landed_twice_counts_once(spark, items):
    landed = landed_of(spark)
    twice = registry.raw_items(landed_of(spark, pages=landed.pages.union(landed.pages))).collect()
    assert {s: sum(r.source_id == s for r in twice) for s in items} == {s: len(rows) for s, rows in items.items()}


def test_tweets_of_a_source_share_one_limit(spark):
    reply = lambda *ids: json.dumps({"data": [{"id": i, "text": f"t{i}", "public_metrics": {"like_count": 50}} for i in ids]})
    api = spark.createDataFrame([("api", reply("90", "91")), ("api", reply("92", "93"))], "source_id string, content string")
    rows = [r for r in registry.raw_items(landed_of(spark, api=api, max_items=3)).collect() if r.source_id == "api"]
    assert len(rows) == 3


def test_block_lists_may_be_long(spark, tmp_path):
    (tmp_path / "hosts.txt").write_text("# note\n" + "\n".join(f"H{k}.example" for k in range(100_100)) + "\nh1.example\n")
    assert catalog.load_block_list(spark, str(tmp_path / "hosts.txt")).count() == 100_100
