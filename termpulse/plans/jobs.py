"""Batch jobs over the tables in one folder. The run date is always passed in."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions import article as art
from termpulse.functions import html as htm
from termpulse.operators import daystats, daytotals, evidence, scoring
from termpulse.operators.derive import derive_articles, full_texts
from termpulse.operators.cursors import next_cursors
from termpulse.operators.links import follow_candidates, issue_bodies, linked_items, outbound_links, place_links
from termpulse.plans import presentation
from termpulse.session import stage
from termpulse.sources import tables
from termpulse.sources.export import DAY, export_changed, new_changes, note_published, write_days
from termpulse.sources.feeds import read_feeds
from termpulse.sources.landed import Landed, newest_pages
from termpulse.sources.registry import raw_items, unknown_sources


@dataclass
class Settings:
    as_of: dt.date
    now: str
    baseline_days: int = fixed.BASELINE_DAYS
    links_per_issue: int = fixed.LINKS_PER_ISSUE
    # None keeps everything
    max_terms: int | None = fixed.MAX_TERMS_PER_DAY
    max_articles: int | None = fixed.MAX_ARTICLES_PER_TERM
    max_authors: int | None = fixed.MAX_AUTHORS_PER_TERM
    top_terms: int | None = fixed.TOP_TERMS_PER_ARTICLE
    rerank_input: int = fixed.RERANK_INPUT
    candidates_kept: int = fixed.CANDIDATES_KEPT
    evidence_kept: int = fixed.EVIDENCE_KEPT
    blocked_hosts: tuple = fixed.BLOCKED_HOSTS
    stopwords: tuple = fixed.STOPWORDS
    allowlist: tuple = fixed.ALLOWLIST
    adapters: dict | None = field(default=None)

    def term_options(self) -> dict:
        return {"stopwords": self.stopwords, "allowlist": self.allowlist}


def ingest(spark: SparkSession, root: str, landed: Landed, settings: Settings) -> dict:
    """Landed bytes to articles: scan, drop known, follow newsletter links, derive, write.

    The URL log and cursors are written last, so a run that dies is repeated as a whole; articles
    written twice replace themselves.
    """
    as_of = F.lit(settings.as_of)
    items = stage(raw_items(landed, settings.adapters), "raw-items")
    issues = items.select("item_ord", "source_id", "source_type", "url", "url_canonical", "published_at", "content_html")
    letters = issues.where(F.col("source_type") == "newsletter")
    pages = newest_pages(landed.pages).where((F.col("status") == 200) & (F.coalesce("html", F.lit("")) != "")).select("url", "html")
    bodies = issue_bodies(letters, pages)
    links = stage(
        follow_candidates(outbound_links(bodies, F.col("html")), F.col("url_canonical"), settings.blocked_hosts).select(
            "item_ord", "pos", "href", "canonical"
        ),
        "links",
    )
    # only pages that a link names are read into text; their canonical form is the request address
    wanted = links.select(F.col("canonical").alias("url")).distinct()
    fetched = stage(
        pages.join(wanted, "url", "left_semi")
        .select(F.col("url").alias("canonical"), htm.title(F.col("html")).alias("title"), htm.text_nodes(F.col("html")).alias("text"))
        .where(F.col("text") != ""),
        "linked-pages",
    )
    live, placed, failed = place_links(issues, links, fetched, landed.url_cache, settings.links_per_issue)
    main = items.join(live.select("item_ord"), "item_ord", "left_semi")
    followed = linked_items(placed, links, issues, fetched)
    new = stage(main.drop("content_html").unionByName(followed), "new-items")
    derived = derive_articles(new, as_of, F.lit(settings.now), settings.top_terms, **settings.term_options()).drop("term_counts")
    derived = stage(derived.dropDuplicates(["bucket_date", "article_key"]), "derived")
    tables.upsert_articles(derived, root)
    tables.upsert_articles(full_texts(new, as_of).dropDuplicates(["bucket_date", "article_key"]), root, "fulltext")
    seen = new.select("url_canonical", art.article_id(F.col("source_id"), F.col("external_id")).alias("article_id"))
    tables.append(seen.withColumn("first_seen_date", as_of), root, "url_cache")
    tables.append(
        failed.select(F.col("canonical").alias("url_canonical"), as_of.alias("first_seen_date"), F.lit("fetch_failed").alias("status")),
        root,
        "url_cache",
    )
    tables.append(next_cursors(items, settings.now), root, "cursors")
    _, unread = read_feeds(landed)
    unread = unread.select("source_id", F.lit("no entries, or no well-formed XML").alias("reason"), F.lit(settings.now).alias("run_at"))
    tables.append(unread, root, "rejects")
    rejects = unknown_sources(landed, settings.adapters)
    tables.append(
        rejects.select("source_id", F.lit("unknown source type").alias("reason"), F.lit(settings.now).alias("run_at")),
        root,
        "rejects",
    )
    per_source = ingest_metrics(new)
    # one row per catalog source
    counts = {r.source_id: r.new_articles for r in per_source.collect()}
    return {"new_articles": sum(counts.values()), "per_source": counts}


def ingest_metrics(new: DataFrame) -> DataFrame:
    return new.groupBy("source_id").agg(F.count(F.lit(1)).alias("new_articles"))


def _target_days(spark: SparkSession, root: str, source: str, settings: Settings, days, backfill: bool) -> list[dt.date]:
    """Explicit days, every day of ``source``, or the run date; a calendar's worth at most."""
    if days:
        return list(days)
    if not backfill:
        return [settings.as_of]
    return [r.date for r in tables.days_of(spark, root, source).orderBy("date").collect()]


def day_stats(spark: SparkSession, root: str, days: list[dt.date], settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(terms, day headers) of the given days from articles and full texts."""
    articles = tables.read(spark, root, "articles").where(F.col("bucket_date").isin(days))
    texts = tables.read(spark, root, "fulltext").where(F.col("bucket_date").isin(days) & (F.col("content_text") != ""))
    keyed = articles.select(
        F.col("bucket_date").alias("date"), "article_id", "article_key", F.nullif("author", F.lit("")).alias("author"), "title", "top_terms"
    )
    joined = keyed.join(texts.select(F.col("bucket_date").alias("date"), "article_key", "content_text"), ["date", "article_key"], "left")
    whole = F.when(F.col("content_text").isNotNull(), art.title_and_text(F.col("title"), F.col("content_text")))
    # read for totals and for lists
    rows = daytotals.by_day(joined.withColumn("text", whole), "date", "article_id", "author", "text", "top_terms")
    headers = stage(daystats.day_headers(keyed), "day-headers")
    stored = rows.where(F.col("text").isNull() & (F.size("top_terms") > 0)).select("date", "article_id", "author", F.col("top_terms").alias("term_counts"))
    terms = daytotals.day_terms(
        rows.where(F.col("text").isNotNull()),
        F.col("text"),
        headers,
        stored,
        max_terms=settings.max_terms,
        max_articles=settings.max_articles,
        max_authors=settings.max_authors,
        **settings.term_options(),
    )
    return terms, headers


def process(spark: SparkSession, root: str, settings: Settings, days=None, backfill: bool = False) -> list[dt.date]:
    """Build stats of one day, the run date, or every article day. A day without articles keeps its old stats."""
    targets = _target_days(spark, root, "articles", settings, days, backfill)
    if not targets:
        return []
    terms, headers = day_stats(spark, root, targets, settings)
    built = [r.date for r in headers.select("date").orderBy("date").collect()]
    if built:
        terms = stage(terms, "day-terms")
        # a day can lose all of its terms: clear it first, as an overwrite leaves it in place
        termless = headers.join(terms.select("date").distinct(), "date", "left_anti")
        tables.drop_days(spark, root, "terms", [r.date for r in termless.collect()])
        tables.overwrite_days(terms, root, "terms")
        tables.overwrite_days(headers, root, "days")
        tables.append(terms.groupBy("term").agg(F.min("date").alias("first_seen")), root, "term_first_seen")
        log = headers.withColumn("processed_at", F.lit(settings.now)).withColumn("reprocessed", F.lit(False))
        tables.append(log, root, "processed_days")
    return built


def elect_days(
    spark: SparkSession, root: str, settings: Settings, days=None, backfill: bool = False, rerank: DataFrame | None = None
) -> list[dt.date]:
    """Elect the word of one day, the run date, or every stats day, all days in one pass."""
    targets = _target_days(spark, root, "days", settings, days, backfill)
    if not targets:
        return []
    first = min(targets) - dt.timedelta(days=settings.baseline_days)
    span = F.col("date").between(F.lit(first), F.lit(max(targets)))
    terms, headers = tables.read(spark, root, "terms").where(span), tables.read(spark, root, "days").where(span)
    scored = scoring.score_terms(
        terms.select("date", "term", "tf", "df"), headers, allowlist=settings.allowlist, baseline_days=settings.baseline_days
    ).where(F.col("date").isin(targets))
    head = scoring.rank_candidates(scored, max(settings.rerank_input, settings.candidates_kept))
    # at most that many rows per calendar day
    lists = terms.where(F.col("date").isin(targets)).select("date", "term", "article_ids")
    head = lists.join(F.broadcast(head), ["date", "term"])
    result = scoring.elect(
        head,
        headers.where(F.col("date").isin(targets)),
        rerank,
        candidates_kept=settings.candidates_kept,
        rerank_input=settings.rerank_input,
        evidence_kept=settings.evidence_kept,
    )
    result = stage(result, "elections")
    done = [r.date for r in result.select("date").orderBy("date").collect()]
    if done:
        tables.overwrite_days(result, root, "elections")
    return done


def reprocess(
    spark: SparkSession, root: str, settings: Settings, first: dt.date, last: dt.date, steps: str = "process+elect", out: str | None = None
) -> None:
    """Rebuild stats and elections of a range; range days that end up empty are removed."""
    if last < first:
        raise ValueError(f"reprocess: last day {last} is before first day {first}")
    if steps not in ("process", "elect", "process+elect", "all"):
        raise ValueError(f"reprocess: unknown steps {steps!r}")
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    if steps != "elect":
        built = set(process(spark, root, settings, days))
        gone = [d for d in days if d not in built]
        for name in ("terms", "days"):
            tables.drop_days(spark, root, name, gone)
        log = spark.createDataFrame([(d,) for d in days], "date date").withColumn("processed_at", F.lit(settings.now))
        tables.append(log.withColumn("reprocessed", F.lit(True)), root, "processed_days")
    if steps != "process":
        done = set(elect_days(spark, root, settings, days))
        tables.drop_days(spark, root, "elections", [d for d in days if d not in done])
    if out:
        export(spark, root, out)


def rebucketed(articles: DataFrame, as_of) -> DataFrame:
    """Articles with the ``bucket_date`` they should have; one that would collide stays where it is.

    Unusable dates keep the article in place. Of several that move to one place, the first by old
    bucket moves.
    """
    target = F.coalesce(art.rebucket_date(F.col("published_at"), F.col("fetched_at"), as_of), F.col("bucket_date"))
    aimed = articles.withColumn("__to", target)
    movers = aimed.where(F.col("__to") != F.col("bucket_date"))
    here = articles.select("article_key", F.col("bucket_date").alias("__to"))
    free = movers.select("article_key", "bucket_date", "__to").join(here, ["article_key", "__to"], "left_anti")
    moves = free.groupBy("article_key", "__to").agg(F.min("bucket_date").alias("bucket_date"))
    return articles.join(moves, ["article_key", "bucket_date"], "left").withColumn(
        "bucket_date", F.coalesce("__to", "bucket_date")
    ).select(*articles.columns)


def migrate_buckets(spark: SparkSession, root: str, settings: Settings) -> int:
    """Move articles, and their full texts, to the bucket their dates call for; returns the moves."""
    old = tables.read(spark, root, "articles")
    keyed = old.withColumn("__old", F.col("bucket_date"))
    new = stage(rebucketed(keyed, F.lit(settings.as_of)), "rebucketed")
    moves = new.where(F.col("bucket_date") != F.col("__old")).select("article_key", F.col("__old").alias("old"), F.col("bucket_date").alias("new"))
    moves = stage(moves, "moves")
    moved = moves.count()
    if not moved:
        return 0
    # calendar days only
    touched = [r.d for r in moves.select(F.explode(F.array("old", "new")).alias("d")).distinct().collect()]
    texts = tables.read(spark, root, "fulltext").where(F.col("bucket_date").isin(touched))
    shift = moves.select("article_key", F.col("old").alias("bucket_date"), F.col("new").alias("__new"))
    texts = texts.join(shift, ["article_key", "bucket_date"], "left").withColumn("bucket_date", F.coalesce("__new", "bucket_date"))
    for df, name in ((new.where(F.col("bucket_date").isin(touched)), "articles"), (texts, "fulltext")):
        rows = stage(df.drop("__old", "__new"), name)
        tables.overwrite_days(rows, root, name)
        left = {r.bucket_date for r in rows.select("bucket_date").distinct().collect()}
        tables.drop_days(spark, root, name, [d for d in touched if d not in left])
    return moved


def describe(spark: SparkSession, root: str, date: str | None = None, force: bool = False) -> DataFrame:
    """Prompts of the days to describe; answer them elsewhere and pass the replies to ``attach``."""
    days = evidence.blurb_targets(tables.read(spark, root, "elections"), date, force)
    return evidence.blurb_prompts(days, tables.read(spark, root, "articles"), tables.read(spark, root, "fulltext"))


def attach(spark: SparkSession, root: str, answers: DataFrame, force: bool = False) -> None:
    """Add the blurbs of ``answers(date, reply, model, generated_at)`` to their elections."""
    new = stage(evidence.blurbs(answers), "blurbs")
    named = tables.read(spark, root, "elections").join(F.broadcast(new.select("date")), "date", "left_semi")
    tables.overwrite_days(stage(evidence.attach_blurbs(named, new, force), "described"), root, "elections")


def export(spark: SparkSession, root: str, out: str) -> dict[str, int]:
    """Publish the days that have changed since the last export to ``out``; the row counts of the whole tables."""
    return export_changed(spark, root, out)


def build(spark: SparkSession, root: str, out: str) -> None:
    """Write the presentation tables: of the pages only days whose election or articles have changed.

    The lists of days have a row for each calendar day and are written whole.
    """
    elections, articles = tables.read(spark, root, "elections"), tables.read(spark, root, "articles")
    days, noted = new_changes(spark, root, out, "pages", "elections", "articles")
    pages = presentation.day_pages(elections.where(F.col("date").isin(days)), articles)
    for name in ("evidence", "day_articles"):
        write_days(pages[name].withColumn(DAY, F.col("date")), days, f"{out}/{name}", "article_id")
    lists = {"days": presentation.with_neighbours(elections), "archive": presentation.archive_list(elections), "feed": presentation.feed_rows(elections)}
    for name, df in lists.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")
    if days:
        note_published(noted, out)


def run(spark: SparkSession, root: str, landed: Landed, settings: Settings, out: str, answers: DataFrame | None = None) -> dict:
    """Ingest, process, elect, attach blurbs, export and build for the run date."""
    result = ingest(spark, root, landed, settings)
    process(spark, root, settings)
    elect_days(spark, root, settings)
    if answers is not None:
        attach(spark, root, answers)
    export(spark, root, f"{out}/tables")
    build(spark, root, f"{out}/site")
    return result
