"""Tables behind a published site: day pages, archive list and feed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.operators.evidence import day_article_rows, evidence_rows


def elected_days(elections: DataFrame) -> DataFrame:
    """Days that have a word; order by date, descending, to present."""
    return elections.where(F.coalesce("word", F.lit("")) != "")


def with_neighbours(elections: DataFrame) -> DataFrame:
    """Elected days with the previous and next elected date.

    One row per calendar day and only two columns go through the ordered window; the wide row
    is joined back.
    """
    days = elected_days(elections)
    # dates of elected days only: a few thousand narrow rows, whatever the corpus size
    order = W.partitionBy(F.lit(0)).orderBy("date")
    near = days.select("date").select(
        "date", F.lag("date").over(order).alias("prev_date"), F.lead("date").over(order).alias("next_date")
    )
    return days.join(near, "date")


def day_pages(elections: DataFrame, articles: DataFrame) -> dict[str, DataFrame]:
    """``days``, ``evidence`` and ``day_articles``: rows of every day page, keyed by date."""
    days = elected_days(elections)
    return {
        "days": with_neighbours(elections),
        "evidence": evidence_rows(days, articles),
        "day_articles": day_article_rows(days, articles),
    }


def archive_list(elections: DataFrame) -> DataFrame:
    return elected_days(elections).select("date", "word").orderBy(F.desc("date"))


def newest_day(elections: DataFrame) -> DataFrame:
    return elected_days(elections).orderBy(F.desc("date")).limit(1)


def feed_rows(elections: DataFrame, limit: int = fixed.FEED_DAYS) -> DataFrame:
    """Feed entries of the latest elected days."""
    why = F.col("llm.why") if "llm" in elections.columns else F.lit(None).cast("string")
    return (
        elected_days(elections)
        .orderBy(F.desc("date"))
        .limit(limit)
        .select(
            "date",
            F.concat("word", F.lit(" ("), F.col("date").cast("string"), F.lit(")")).alias("title"),
            F.coalesce(F.nullif(why, F.lit("")), F.concat(F.lit("Word of the day: "), "word")).alias("description"),
        )
    )
