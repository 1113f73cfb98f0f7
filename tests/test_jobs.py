import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from termpulse.plans import api, jobs, presentation
from termpulse.sources import imports, tables
from termpulse.sources.export import export_all
from termpulse.streaming import daily
from tests.test_links import serve_one_by_one
from tests.test_sources import NOW, landed_of

DAY = dt.date(2026, 4, 13)
SETTINGS = jobs.Settings(as_of=dt.date(2026, 4, 14), now="2026-04-14T06:00:00Z")


def raw(spark, rows):
    """rows: (source, guid, published, text)"""
    data = [
        (s, [i], g, f"https://{s}.com/{g}", f"https://{s}.com/{g}", "", "Ann", p, t, "article", None)
        for i, (s, g, p, t) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data,
        "source_id string, item_ord array<bigint>, external_id string, url string, url_canonical string, title string, "
        "author string, published_at string, content_text string, kind string, via_source_id string",
    )


DAYS = [
    ("a", f"g{d}-{i}", f"2026-04-{d:02d}T12:00:00+00:00", f"MCP is now supported by agents number {d} {'mcp ' * (5 if d == 13 else 1)}")
    for d in (11, 12, 13)
    for i in range(2)
]


def fill(spark, root, rows=DAYS):
    daily.write_batch(raw(spark, rows), root, SETTINGS)


def snapshot(spark, root, name, *columns):
    return sorted(map(repr, tables.read(spark, root, name).select(*columns).collect()))


def test_process_elect_export_and_read(spark, tmp_path):
    root, out = str(tmp_path / "data"), str(tmp_path / "out")
    fill(spark, root)
    assert jobs.elect_days(spark, root, SETTINGS, backfill=True) == [dt.date(2026, 4, d) for d in (11, 12, 13)]
    counts = jobs.export(spark, root, out)
    assert counts["articles"] == 6 and counts["elections"] == 3
    c = api.Corpus.at(spark, out, SETTINGS.as_of)
    assert c.articles(since="2026-04-12", until="2026-04-12").count() == 2
    assert c.articles(source="a", author="Ann", kind="article").count() == 6
    assert c.articles(source=[]).count() == 0 and c.articles(source=["zz"]).count() == 0
    assert [r.tf for r in c.terms(term="mcp").collect()] == [12, 4, 4]
    assert c.elections(on="2026-04-13").first().word.startswith("mcp")
    assert [r.date for r in c.elections(since="2d").collect()] == ["2026-04-13", "2026-04-12"]
    top = c.trending(2, "7d").collect()
    assert (top[0].term, top[0].total_tf, top[0].days) == ("mcp", 20, 3)
    assert api.register_views(spark, out, {"elections": "elected"}) == ["articles", "terms", "elected"]
    assert spark.sql("SELECT max(word) AS w FROM elected").first().w is not None


def files_of(path):
    return {p.relative_to(path).as_posix(): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_exports_and_builds_write_changed_days_alone(spark, tmp_path):
    root, out = str(tmp_path / "data"), tmp_path / "out"
    fill(spark, root)
    jobs.elect_days(spark, root, SETTINGS, backfill=True)
    jobs.export(spark, root, str(out))
    jobs.build(spark, root, str(out / "site"))
    first = files_of(out)
    assert jobs.export(spark, root, str(out))["articles"] == 6
    assert {k: v for k, v in files_of(out).items() if "site" not in k} == {k: v for k, v in first.items() if "site" not in k}
    # a new article of one day, and another day that is lost
    fill(spark, root, [("b", "new", "2026-04-12T10:00:00+00:00", "agents and mcp")])
    jobs.elect_days(spark, root, SETTINGS, [dt.date(2026, 4, 12)])
    tables.drop_days(spark, root, "articles", [dt.date(2026, 4, 11)])
    jobs.reprocess(spark, root, SETTINGS, dt.date(2026, 4, 11), dt.date(2026, 4, 11), out=str(out))
    jobs.build(spark, root, str(out / "site"))
    after = files_of(out)
    kept = {k for k in first if "day=2026-04-13" in k}
    assert kept and all(after[k] == first[k] for k in kept)
    assert not any("day=2026-04-11" in k for k in after) and any("day=2026-04-12" in k and k not in first for k in after)
    c = api.Corpus.at(spark, str(out), SETTINGS.as_of)
    assert c.articles().count() == 5 and c.elections().count() == 2 and "day" not in c.terms().columns
    assert spark.read.parquet(str(out / "site" / "day_articles")).count() == 5


def test_nothing_published_yet(spark, tmp_path):
    assert jobs.export(spark, str(tmp_path / "none"), str(tmp_path / "out")) == {"articles": 0, "terms": 0, "elections": 0}
    assert api.Corpus.at(spark, str(tmp_path / "out"), SETTINGS.as_of).terms().count() == 0


def test_processing_again_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "data")
    fill(spark, root)
    before = [snapshot(spark, root, n, *cols) for n, cols in (("terms", ("date", "term", "tf", "df")), ("articles", ("article_id",)))]
    fill(spark, root)
    after = [snapshot(spark, root, n, *cols) for n, cols in (("terms", ("date", "term", "tf", "df")), ("articles", ("article_id",)))]
    assert before == after


def test_reprocess_removes_days_that_ended_empty(spark, tmp_path):
    root = str(tmp_path / "data")
    fill(spark, root)
    jobs.elect_days(spark, root, SETTINGS, backfill=True)
    before = snapshot(spark, root, "terms", "date", "term", "tf")
    tables.drop_days(spark, root, "articles", [dt.date(2026, 4, 12)])
    # a plain run over an empty day keeps its old stats
    assert jobs.process(spark, root, SETTINGS, [dt.date(2026, 4, 12)]) == []
    assert snapshot(spark, root, "terms", "date", "term", "tf") == before
    jobs.reprocess(spark, root, SETTINGS, dt.date(2026, 4, 11), dt.date(2026, 4, 12))
    left = {r.date for r in tables.read(spark, root, "terms").select("date").distinct().collect()}
    assert left == {dt.date(2026, 4, 11), DAY}
    assert {r.date for r in tables.read(spark, root, "elections").collect()} == left
    log = {r.date: r.reprocessed for r in tables.processed_days(spark, root).collect()}
    assert log[dt.date(2026, 4, 12)] is True
    with pytest.raises(ValueError):
        jobs.reprocess(spark, root, SETTINGS, DAY, DAY - dt.timedelta(days=1))


def test_lost_text_falls_back_to_stored_terms(spark, tmp_path):
    root = str(tmp_path / "data")
    fill(spark, root)
    before = snapshot(spark, root, "terms", "date", "term", "tf", "df")
    tables.drop_days(spark, root, "fulltext", [dt.date(2026, 4, d) for d in (11, 12, 13)])
    jobs.process(spark, root, SETTINGS, backfill=True)
    assert snapshot(spark, root, "terms", "date", "term", "tf", "df") == before  # fewer than 20 terms each


def test_migrate_buckets(spark, tmp_path):
    root = str(tmp_path / "data")
    fill(spark, root)
    moved = tables.read(spark, root, "articles").withColumn("bucket_date", F.lit(DAY))
    texts = tables.read(spark, root, "fulltext").withColumn("bucket_date", F.lit(DAY))
    other = str(tmp_path / "other")
    tables.append(moved, other, "articles")
    tables.append(texts, other, "fulltext")
    assert jobs.migrate_buckets(spark, other, SETTINGS) == 4
    for name in ("articles", "fulltext"):
        assert snapshot(spark, other, name, "article_id", "bucket_date") == snapshot(spark, root, name, "article_id", "bucket_date")
    assert jobs.migrate_buckets(spark, other, SETTINGS) == 0


def test_late_and_implausible_dates(spark, tmp_path):
    root = str(tmp_path / "data")
    fill(spark, root)
    late = [("b", "late", "2026-04-11T01:00:00Z", "late mcp news"), ("b", "epoch", "1970-01-01T00:00:00Z", "odd mcp")]
    daily.write_batch(raw(spark, late + [DAYS[0]]), root, SETTINGS)
    days = {r.date: r.document_count for r in tables.read(spark, root, "days").collect()}
    assert days[dt.date(2026, 4, 11)] == 3 and days[SETTINGS.as_of] == 1


def test_blurbs(spark, tmp_path):
    root = str(tmp_path / "data")
    fill(spark, root)
    jobs.elect_days(spark, root, SETTINGS, backfill=True)
    (row,) = jobs.describe(spark, root).collect()
    assert row.date == DAY and "WORD OF THE DAY: mcp" in row.prompt and "excerpt: MCP is now" in row.prompt

    def answer(day, summary, why="w"):
        reply = json.dumps({"summary": summary, "why": why, "definition": "d"})
        return spark.createDataFrame([(day, reply, "m", NOW)], "date date, reply string, model string, generated_at string")

    def summary():
        return {r.date: r.llm and r.llm.summary for r in tables.read(spark, root, "elections").collect()}[DAY]

    jobs.attach(spark, root, answer(DAY, "no reason", ""))
    assert summary() is None
    jobs.attach(spark, root, answer(DAY, "first"))
    jobs.attach(spark, root, answer(DAY, "second"))
    assert summary() == "first" and jobs.describe(spark, root).count() == 0
    jobs.attach(spark, root, answer(DAY, "second"), force=True)
    assert summary() == "second" and jobs.describe(spark, root, force=True).count() == 1
    assert tables.read(spark, root, "elections").count() == 3
    feed = presentation.feed_rows(tables.read(spark, root, "elections")).collect()
    assert feed[0].description == "w" and feed[1].description.startswith("Word of the day: ")


LETTER = '<a href="https://n.ai/self">me</a><a href="https://x.com/q">x</a>' + "".join(
    f'<a href="https://t{i}.ai/a?utm_source=n">l</a>' for i in range(14)
) + '<a href="https://blog.ai/paged">p</a>'


def ingest_once(spark, root):
    landed = landed_of(spark)
    pages = [("https://n.ai/one", 200, "text/html", f"<title>L</title><p>letter</p>{LETTER}")]
    pages += [(f"https://t{i}.ai/a", 200, "text/html", f"<title>T{i}</title><p>target {i} text</p>") for i in range(14) if i != 3]
    schema = "url string, status int, content_type string, html string"
    landed.pages = landed.pages.unionByName(spark.createDataFrame(pages, schema))
    landed.cursors, landed.url_cache = tables.cursors(spark, root), tables.read(spark, root, "url_cache")
    return jobs.ingest(spark, root, landed, SETTINGS)


def test_ingest(spark, tmp_path):
    root = str(tmp_path / "data")
    result = ingest_once(spark, root)
    # the blog has no earlier run here, so all of its entries with text or title count
    assert result["per_source"] == {"blog": 5, "news": 11, "bob": 2, "api": 3, "mapped": 2, "scraped": 1}
    articles = tables.read(spark, root, "articles")
    linked = articles.where("via_source_id is not null").collect()
    assert {r.url for r in linked} == {f"https://t{i}.ai/a" for i in range(11) if i != 3}
    assert {(r.source_id, r.author, r.published_at[:10], r.title) for r in linked if r.url == "https://t0.ai/a"} == {("news", None, "2026-04-12", "T0")}
    cache = {r.url_canonical: r for r in tables.url_cache(spark, root).collect()}
    assert cache["https://t3.ai/a"].status == "fetch_failed" and cache["https://t3.ai/a"].article_id is None
    assert "https://t12.ai/a" not in cache
    cursors = {r.source_id: r.last_guid for r in tables.cursors(spark, root).collect()}
    assert cursors["blog"] == "g3" and cursors["news"] == "tag:1"
    assert sorted(r.source_id for r in tables.read(spark, root, "rejects").collect()) == ["broken", "odd"]
    assert tables.read(spark, root, "fulltext").count() == articles.count() == 24
    again = ingest_once(spark, root)
    assert again["new_articles"] == 0
    assert tables.read(spark, root, "articles").count() == 24


def test_full_run(spark, tmp_path):
    root, out = str(tmp_path / "data"), str(tmp_path / "out")
    landed = landed_of(spark)
    result = jobs.run(spark, root, landed, SETTINGS, out)
    assert result["new_articles"] > 0
    assert spark.read.parquet(f"{out}/tables/articles").count() == result["new_articles"]
    assert spark.read.parquet(f"{out}/site/days").count() <= 1


def test_imports(spark, tmp_path):
    day = tmp_path / "articles" / "2026-04-13"
    day.mkdir(parents=True)
    (tmp_path / "articles" / "notes").mkdir()
    article = {"article_id": "a--1", "source_id": "a", "title": "T", "content_chars": 3, "top_terms": [["mcp", 2], ["rag", 1]], "author": None}
    (day / "a--1.json").write_text(json.dumps(article, indent=2))
    (tmp_path / "articles" / "notes" / "x.json").write_text("{}")
    (row,) = imports.read_articles(spark, str(tmp_path / "articles")).collect()
    assert (row.article_id, row.bucket_date, [(t.term, t.tf) for t in row.top_terms]) == ("a--1", DAY, [("mcp", 2), ("rag", 1)])
    assert imports.read_articles(spark, str(tmp_path / "articles"), "2026-04-13").count() == 1
    stats = tmp_path / "stats"
    stats.mkdir()
    terms = {"mcp": {"tf": 3, "df": 2, "articles": ["a--1"], "authors": []}}
    (stats / "2026-04-13.json").write_text(json.dumps({"date": "2026-04-13", "document_count": 2, "article_ids": ["a--1"], "terms": terms}))
    t, d = imports.read_stats(spark, str(stats))
    assert [(r.term, r.tf, r.df, r.article_ids) for r in t.collect()] == [("mcp", 3, 2, ["a--1"])]
    assert d.first().document_count == 2
    elected = tmp_path / "elected"
    elected.mkdir()
    e = {"date": "2026-04-13", "word": "mcp", "score": 3.14, "candidates": [{"term": "mcp"}, {"term": "agents"}], "evidence_article_ids": []}
    (elected / "2026-04-13.json").write_text(json.dumps(e))
    out = str(tmp_path / "out")
    counts = export_all(
        imports.read_articles(spark, str(tmp_path / "articles")), t, imports.read_elections(spark, str(elected)), out
    )
    assert counts == {"articles": 1, "terms": 1, "elections": 1}
    assert spark.read.parquet(f"{out}/elections").first().candidate_terms == ["mcp", "agents"]


def test_serial_model_of_links():
    """The model used to check the link budget skips an item taken as a link, with its links."""
    live, placed, _ = serve_one_by_one([(0, "i0"), (1, "u")], {0: ["u"], 1: ["v"]}, {"u", "v"}, {}, 2)
    assert live == {0} and placed == {("u", 0, 0)}


def test_articles_that_share_a_short_id_are_all_kept(spark, tmp_path):
    root = str(tmp_path / "data")
    rows = [("blog", g, "2026-04-13T12:00:00+00:00", f"agents number {g} agents") for g in ("14233", "53489", "1")]
    fill(spark, root, rows)
    fill(spark, root, rows[:2])
    articles = tables.read(spark, root, "articles").collect()
    assert len(articles) == 3 and len({r.article_id for r in articles}) == 2 and len({r.article_key for r in articles}) == 3
    assert tables.read(spark, root, "fulltext").count() == 3
    assert tables.read(spark, root, "days").first().document_count == 3
    assert {r.term: r.tf for r in tables.read(spark, root, "terms").collect()}["agents"] == 6


def test_feeds_that_cannot_be_read_are_logged(spark, tmp_path):
    jobs.ingest(spark, str(tmp_path), landed_of(spark), SETTINGS)
    logged = {(r.source_id, r.reason[:10]) for r in tables.read(spark, str(tmp_path), "rejects").collect()}
    assert ("broken", "no entries") in logged and ("odd", "unknown so") in logged


def test_a_long_stream_files_items_under_the_day_they_landed(spark, tmp_path):
    root = str(tmp_path / "data")
    first, later = dt.datetime(2026, 4, 14, 9), dt.datetime(2026, 4, 16, 9)
    for landed, guid, published in ((first, "g1", "2026-04-13T12:00:00+00:00"), (later, "g2", "2026-04-16T01:00:00+00:00"), (later, "g3", "bad"), (later, "g4", "2026-04-13T18:00:00+00:00")):
        batch = raw(spark, [("a", guid, published, "agents agents")]).withColumn("landed_at", F.lit(landed))
        daily.write_batch(batch, root, SETTINGS)
    days = {r.url_canonical[-2:]: (str(r.bucket_date), r.fetched_at[:10]) for r in tables.read(spark, root, "articles").collect()}
    assert days == {"g1": ("2026-04-13", "2026-04-14"), "g2": ("2026-04-16", "2026-04-16"), "g3": ("2026-04-16", "2026-04-16"), "g4": ("2026-04-13", "2026-04-16")}
    # the late item is counted in its own day
    assert {str(r.date): r.document_count for r in tables.read(spark, root, "days").collect()} == {"2026-04-13": 2, "2026-04-16": 2}
    assert {r.term: str(r.first_seen) for r in tables.term_first_seen(spark, root).collect()}["agents"] == "2026-04-13"
