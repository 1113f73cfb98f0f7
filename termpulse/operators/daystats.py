"""Per-day term rollup: totals, culling, caps, and the bounded article and author lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.operators import toplists
from termpulse.session import stage, stage_buckets

# Sub-groups per day in the first step of a top-k, so one large day is cut by many tasks.
DAY_SPLITS = 64
# Wanted terms that are sent to all tasks at most.
SENT_TERMS = 1 << 20


def article_terms(counts: DataFrame, *keep: str) -> DataFrame:
    """One row per article and term from the in-row counts arrays."""
    return counts.select(*keep, F.inline_outer("term_counts")).where(F.col("term").isNotNull())


def text_or_stored_counts(has_text: Column, from_text: Column, stored: Column) -> Column:
    """Counts of the full text, or the stored top terms where there is no text."""
    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    return F.coalesce(F.when(has_text, from_text).otherwise(stored), empty)


def day_headers(articles: DataFrame) -> DataFrame:
    """``date, document_count`` for every day that has an article, with or without terms.

    Articles count by ``article_key``, or by ``article_id`` in a frame that has no other name for them.
    """
    key = "article_key" if "article_key" in articles.columns else "article_id"
    return articles.groupBy("date").agg(F.countDistinct(key).alias("document_count"))


def day_articles(articles: DataFrame) -> DataFrame:
    """The article ids of each day as rows: a day may be too large for one array."""
    return articles.select("date", "article_id").distinct()


def _with_day_size(df: DataFrame, days: DataFrame) -> DataFrame:
    # one fixed-width row per calendar date, so the table is small whatever the corpus size
    return df.join(F.broadcast(days.select("date", "document_count")), "date")


def _culled(totals: DataFrame, days: DataFrame) -> DataFrame:
    return _with_day_size(totals, days).where((F.col("document_count") < 2) | (F.col("df") >= 2))


def day_totals(terms: DataFrame, days: DataFrame) -> DataFrame:
    """``date, term, tf, df, document_count`` after dropping single-article terms.

    A day with one article keeps all of its terms. The one shuffle is on (date, term)
    with map-side sums, so a very frequent term arrives as one row per task.
    """
    totals = terms.groupBy("date", "term").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))
    return _culled(totals, days)


def cap_terms(totals: DataFrame, max_terms: int | None = fixed.MAX_TERMS_PER_DAY) -> DataFrame:
    """The ``max_terms`` most frequent terms of each day, by (-tf, term); all of them for None.

    ``totals`` is read twice, so pass a table or a staged frame: the different counts of a day give the least that is kept.
    Terms of that count tie, so each day is then cut in sub-groups; the last step sees a bounded number of rows.
    """
    if max_terms is None:
        return totals
    order = [F.desc("tf"), F.asc("term")]
    above = W.partitionBy("date").orderBy(F.desc("tf")).rowsBetween(W.unboundedPreceding, -1)
    sizes = totals.groupBy("date", "tf").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(above), F.lit(0))).where(F.col("__before") < max_terms)
    # one row per calendar date
    totals = totals.join(F.broadcast(before.groupBy("date").agg(F.min("tf").alias("__least"))), "date")
    totals = totals.where(F.col("tf") >= F.col("__least")).drop("__least")
    split = F.pmod(F.xxhash64("term"), F.lit(DAY_SPLITS))
    part = W.partitionBy("date", "__split").orderBy(*order)
    whole = W.partitionBy("date").orderBy(*order)
    return (
        totals.withColumn("__split", split)
        .withColumn("__rank", F.row_number().over(part))
        .where(F.col("__rank") <= max_terms)
        .withColumn("__rank", F.row_number().over(whole))
        .where(F.col("__rank") <= max_terms)
        .drop("__split", "__rank")
    )


def met_terms(counts: DataFrame, wanted: DataFrame, *keep: str) -> DataFrame:
    """``date, keep, terms``: which of the wanted (date, term) of a table each article has, found inside its row.

    As long as they are few, the wanted terms are sent to all tasks.
    """
    named = wanted.groupBy("date").agg(F.collect_set("term").alias("__wanted"))
    named = F.broadcast(named) if wanted.count() <= SENT_TERMS else named
    met = F.array_intersect(F.col("term_counts.term"), F.col("__wanted"))
    return counts.join(named, "date").select("date", *keep, met.alias("terms"))


def met_counts(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``date, article_id, author, term_counts`` of the wanted (date, term) alone, without their counts."""
    met = met_terms(counts, wanted, "article_id", "author")
    named = F.transform("terms", lambda w: F.struct(w.alias("term"), F.lit(0).cast("bigint").alias("tf")))
    return met.select("date", "article_id", "author", named.alias("term_counts"))


def occurrences(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``date, term, article_id`` of the wanted (date, term) of a table."""
    return met_terms(counts, wanted, "article_id").select("date", F.explode("terms").alias("term"), "article_id")


def term_articles(terms: DataFrame, max_articles: int | None = fixed.MAX_ARTICLES_PER_TERM) -> DataFrame:
    """The ``max_articles`` smallest article ids of each (date, term), sorted; all of them for None.

    Ranked before collecting, and the rank limit also runs before the shuffle, so a term
    found in every article sends at most ``max_articles`` rows per task.
    """
    first = W.partitionBy("date", "term").orderBy("article_id")
    if max_articles is None:
        return terms.groupBy("date", "term").agg(F.sort_array(F.collect_list("article_id")).alias("article_ids"))
    return (
        terms.select("date", "term", "article_id")
        .withColumn("__rank", F.row_number().over(first))
        .where(F.col("__rank") <= max_articles)
        .groupBy("date", "term")
        .agg(F.sort_array(F.collect_list("article_id")).alias("article_ids"))
    )


def term_authors(terms: DataFrame, max_authors: int | None = fixed.MAX_AUTHORS_PER_TERM) -> DataFrame:
    """Up to ``max_authors`` distinct authors of each (date, term), first in article order, sorted; all for None."""
    first = W.partitionBy("date", "term").orderBy("__first", "author")
    named = terms.where(F.coalesce(F.col("author"), F.lit("")) != "").groupBy("date", "term", "author").agg(F.min("article_id").alias("__first"))
    if max_authors is None:
        return named.groupBy("date", "term").agg(F.sort_array(F.collect_list("author")).alias("authors"))
    return (
        named.withColumn("__rank", F.row_number().over(first))
        .where(F.col("__rank") <= max_authors)
        .groupBy("date", "term")
        .agg(F.sort_array(F.collect_list("author")).alias("authors"))
    )


def with_lists(
    wanted: DataFrame,
    terms: DataFrame,
    *,
    max_articles: int | None = fixed.MAX_ARTICLES_PER_TERM,
    max_authors: int | None = fixed.MAX_AUTHORS_PER_TERM,
) -> DataFrame:
    """Attach ``article_ids`` and ``authors`` to the wanted (date, term) rows (a table or staged).

    Occurrences of other terms are dropped first; how the two sides meet is left to the optimizer, which knows their sizes.
    """
    terms = terms.join(wanted.select("date", "term"), ["date", "term"], "left_semi")
    none = F.array().cast("array<string>")
    return (
        wanted.join(term_articles(terms, max_articles), ["date", "term"], "left")
        .join(term_authors(terms, max_authors), ["date", "term"], "left")
        .withColumn("article_ids", F.coalesce("article_ids", none))
        .withColumn("authors", F.coalesce("authors", none))
    )


def listed_terms(states: DataFrame, days: DataFrame, max_terms: int | None = fixed.MAX_TERMS_PER_DAY) -> DataFrame:
    """``date, term, tf, df, article_ids, authors`` of merged states (``toplists``), culled and capped.

    The states stay where their merge has put them: the cap ranks three narrow columns, and its keys meet the rows in place.
    """
    culled = _culled(states, days).drop("document_count")
    if max_terms is None:
        return toplists.published(culled)
    rows = stage_buckets(culled, "day-states", "date", "term")
    kept = cap_terms(rows.select("date", "term", "tf"), max_terms).select("date", "term")
    return toplists.published(rows.join(kept, ["date", "term"], "left_semi"))


def day_terms(
    counts: DataFrame,
    days: DataFrame,
    totals: DataFrame | None = None,
    *,
    max_terms: int | None = fixed.MAX_TERMS_PER_DAY,
    max_articles: int | None = fixed.MAX_ARTICLES_PER_TERM,
    max_authors: int | None = fixed.MAX_AUTHORS_PER_TERM,
) -> DataFrame:
    """The full rollup ``date, term, tf, df, article_ids, authors``; a cap of None keeps everything.

    ``counts`` holds ``date, article_id, author, term_counts`` per article. It is read once and has one exchange on
    (date, term), of partial states; those of whole lists are as large as the lists. With a cap and the ``totals`` of the
    same articles, a table or staged (``daytotals``), only terms that stay have states.
    """
    if totals is not None and max_terms is not None:
        kept = stage(cap_terms(totals, max_terms).select("date", "term", "tf", "df"), "kept-terms")
        lists = toplists.merged(toplists.states(met_counts(counts, kept), max_articles, max_authors), max_articles, max_authors)
        return toplists.published(lists.drop("tf", "df").join(kept, ["date", "term"]))
    states = toplists.merged(toplists.states(counts, max_articles, max_authors), max_articles, max_authors)
    return listed_terms(states, days, max_terms)
