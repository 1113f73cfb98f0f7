import random

import pytest
from pyspark.sql import functions as F

from termpulse.operators import dedupe, links


def serve_one_by_one(issues, wanted, fetched, cache, budget):
    """issues: [(ord, url)] in order; wanted: {ord: [url]}; fetched: set; cache: {url: article or None}."""
    cache = dict(cache)
    live, placed, failed = set(), set(), set()
    for ord_, url in issues:
        if cache.get(url):
            continue
        cache[url] = "main"
        live.add(ord_)
        used = 0
        for pos, link in enumerate(wanted.get(ord_, [])):
            if used >= budget:
                break
            if link in cache:
                continue
            if link not in fetched:
                cache[link] = None
                failed.add((link, ord_))
                continue
            cache[link] = "link"
            placed.add((link, ord_, pos))
            used += 1
    return live, placed, failed


def place(spark, issues, wanted, fetched, cache, budget):
    i = spark.createDataFrame(issues, "item_ord bigint, url_canonical string")
    rows = [(o, p, u) for o, us in wanted.items() for p, u in enumerate(us)]
    w = spark.createDataFrame(rows, "item_ord bigint, pos int, canonical string")
    f = spark.createDataFrame([(u,) for u in fetched], "canonical string")
    c = spark.createDataFrame(list(cache.items()), "url_canonical string, article_id string")
    live, placed, failed = links.place_links(i, w, f, c, budget)
    return (
        {r.item_ord for r in live.collect()},
        {(r.canonical, r.item_ord, r.pos) for r in placed.collect()},
        {(r.canonical, r.item_ord) for r in failed.collect()},
    )


def case(seed):
    rng = random.Random(seed)
    pool = [f"u{i}" for i in range(rng.choice([6, 14, 25]))]
    n = rng.randrange(2, 9)
    issues = [(i, rng.choice(pool) if rng.random() < 0.6 else f"issue{i}") for i in range(n)]
    wanted = {i: rng.sample(pool, rng.randrange(0, len(pool))) for i in range(n) if rng.random() < 0.85}
    fetched = {u for u in pool if rng.random() < 0.75}
    cache = {u: rng.choice(["old", None]) for u in pool if rng.random() < 0.15}
    return issues, wanted, fetched, cache


@pytest.mark.parametrize("budget", [1, 2, 3])
def test_parallel_rounds_equal_the_serial_loop(spark, budget):
    """Forty random cases side by side, each with its own URLs and its own stretch of the order."""
    issues, wanted, fetched, cache = [], {}, set(), {}
    expect = [set(), set(), set()]
    for seed in range(40):
        i, w, f, c = case(seed)
        i = [(seed * 100 + o, f"{seed}/{u}") for o, u in i]
        w = {seed * 100 + o: [f"{seed}/{u}" for u in us] for o, us in w.items()}
        f, c = {f"{seed}/{u}" for u in f}, {f"{seed}/{u}": a for u, a in c.items()}
        for whole, part in zip(expect, serve_one_by_one(i, w, f, c, budget)):
            whole |= part
        issues, wanted, fetched, cache = issues + i, {**wanted, **w}, fetched | f, {**cache, **c}
    assert list(place(spark, issues, wanted, fetched, cache, budget)) == expect


def test_target_named_by_every_issue(spark):
    """All issues name the same targets in the same order: each gets the next two."""
    pool = [f"u{i}" for i in range(6)]
    issues = [(i, f"issue{i}") for i in range(5)]
    given = (issues, {i: pool for i in range(5)}, set(pool), {}, 2)
    assert place(spark, *given) == serve_one_by_one(*given)


def test_outbound_links_collapse_variants(spark):
    html = (
        '<a href="https://a.com/x?utm_source=1">1</a><a href="https://a.com/x?utm_source=2">2</a>'
        '<a href="#t">t</a><a href="mailto:z@z">m</a><a href="/rel">r</a><a href="https://b.com/">b</a>'
    )
    df = spark.createDataFrame([(1, html), (2, "")], "id int, html string")
    rows = links.outbound_links(df, F.col("html")).orderBy("pos").collect()
    assert [(r.id, r.href, r.canonical) for r in rows] == [
        (1, "https://a.com/x?utm_source=1", "https://a.com/x"), (1, "/rel", None), (1, "https://b.com/", "https://b.com/"),
    ]


def test_follow_candidates(spark):
    rows = [("https://own.com/1",), ("https://x.com/a",), ("https://h.com/a.pdf",), (None,), ("https://h.com/ok",)]
    df = spark.createDataFrame(rows, "canonical string").withColumn("own", F.lit("https://own.com/issue"))
    assert [r.canonical for r in links.follow_candidates(df, F.col("own")).collect()] == ["https://h.com/ok"]


def test_archive_issue_urls(spark):
    html = (
        '<a href="/subscribe">s</a><a href="/p/issue-42">42</a><a href="/p/issue-41">41</a>'
        '<a href="https://news.ai/p/issue-41?utm_source=x">dup</a><a href="/p/issue-40">40</a><a href="https://twitter.com/p/x">t</a>'
    )
    df = spark.createDataFrame([("https://news.ai/archive", html), ("https://x.ai/", "")], "page string, html string")
    rows = links.issue_urls(df, F.col("page"), F.col("html"), F.lit("/p/")).orderBy("pos").collect()
    assert [r.url for r in rows] == [f"https://news.ai/p/issue-{n}" for n in (42, 41, 40)]


def test_should_follow(spark):
    cache = spark.createDataFrame([("https://example.com/a", "x--1")], "url_canonical string, article_id string")
    asked = spark.createDataFrame(
        [("https://example.com/a?utm_source=q",), ("https://example.com/b",), ("https://x.com/c",), ("mailto:a",)], "url string"
    )
    got = {r.url: (r.follow, r.canonical) for r in dedupe.should_follow(asked, cache).collect()}
    assert got == {
        "https://example.com/a?utm_source=q": (False, "https://example.com/a"),
        "https://example.com/b": (True, "https://example.com/b"),
        "https://x.com/c": (False, "https://x.com/c"),
        "mailto:a": (False, None),
    }


def test_block_list_join_equals_block_test(spark):
    hosts = ["example.org", "spam.net"]
    urls_ = ["https://example.org/", "https://a.b.example.org/x", "https://notexample.org/", "https://spam.net/y", "https://ok.com/z"]
    df = spark.createDataFrame([(u,) for u in urls_], "canonical string")
    blocklist = spark.createDataFrame([(h,) for h in hosts], "host string")
    assert sorted(r.canonical for r in dedupe.drop_blocked(df, blocklist).collect()) == ["https://notexample.org/", "https://ok.com/z"]
