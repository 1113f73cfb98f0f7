"""Read API over the published tables. Every function returns a lazy DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termpulse.functions.dates import local_date, resolve_since
from termpulse.sources.export import published
from termpulse.sources.tables import exists

Since = str | dt.date | dt.datetime | None
TABLES = ("articles", "terms", "elections")


class Corpus:
    """Filtered reads of the ``articles``, ``terms`` and ``elections`` tables of one folder.

    ``as_of`` is the day that relative dates such as ``'7d'`` count from.
    """

    def __init__(self, articles: DataFrame, terms: DataFrame, elections: DataFrame, as_of: dt.date | None = None):
        self._articles, self._terms, self._elections = articles, terms, elections
        self.as_of = as_of or dt.datetime.now(dt.timezone.utc).date()

    @classmethod
    def at(cls, spark: SparkSession, path: str, as_of: dt.date | None = None) -> Corpus:
        return cls(*[published(spark, path, name) for name in TABLES], as_of=as_of)

    def _days(self, since: Since, until: Since) -> tuple[dt.date | None, dt.date | None]:
        return resolve_since(since, self.as_of), resolve_since(until, self.as_of)

    def _on_days(self, df: DataFrame, since: Since, until: Since) -> DataFrame:
        """Bound the ``date`` column in its own type, so that the scan can skip files by it."""
        low, high = self._days(since, until)
        text = dict(df.dtypes)["date"] == "string"
        if low is not None:
            df = df.where(F.col("date") >= F.lit(low.isoformat() if text else low))
        if high is not None:
            df = df.where(F.col("date") <= F.lit(high.isoformat() if text else high))
        return df

    def articles(
        self,
        *,
        source: str | Iterable[str] | None = None,
        author: str | None = None,
        since: Since = None,
        until: Since = None,
        kind: str | None = None,
    ) -> DataFrame:
        """Articles matching all given filters, newest first; dates are those of ``published_at``."""
        df = self._articles
        low, high = self._days(since, until)
        # ISO text sorts by day: the text bounds reach the scan, the exact test follows
        if low is not None:
            df = df.where(F.col("published_at") >= low.isoformat())
        if high is not None:
            df = df.where(F.col("published_at") < (high + dt.timedelta(days=1)).isoformat())
        day = local_date(F.col("published_at"))
        if low is not None:
            df = df.where(day >= F.lit(low))
        if high is not None:
            df = df.where(day <= F.lit(high))
        if source is not None:
            df = df.where(F.col("source_id").isin([source] if isinstance(source, str) else list(source)))
        if author:
            df = df.where(F.col("author") == author)
        if kind:
            df = df.where(F.col("kind") == kind)
        return df.orderBy(F.desc_nulls_first("published_at"))

    def terms(self, *, term: str | None = None, since: Since = None, until: Since = None) -> DataFrame:
        """Day terms, newest day and highest count first."""
        df = self._on_days(self._terms, since, until)
        if term:
            df = df.where(F.col("term") == term)
        return df.orderBy(F.desc("date"), F.desc("tf"), "term")

    def elections(self, *, on: Since = None, since: Since = None) -> DataFrame:
        """Elected days, newest first; without arguments every day."""
        df = self._on_days(self._elections, since, None)
        if on is not None:
            df = self._on_days(df, on, on)
        return df.orderBy(F.desc("date"))

    def trending(self, n: int = 10, since: Since = "7d") -> DataFrame:
        """The n terms with the highest total count (a term has one row a day); ``'7d'`` covers eight calendar days."""
        rows = self._on_days(self._terms, since, None)
        return (
            rows.groupBy("term")
            .agg(F.sum("tf").alias("total_tf"), F.sum("df").alias("total_df"), F.count(F.lit(1)).alias("days"))
            .orderBy(F.desc("total_tf"), "term")
            .limit(int(n))
        )


def register_views(spark: SparkSession, path: str, names: dict[str, str] | None = None) -> list[str]:
    """Temp views for ad-hoc SQL over the tables that exist; ``names`` renames a table's view."""
    made = []
    for name in TABLES:
        if exists(spark, f"{path}/{name}"):
            view = (names or {}).get(name, name)
            published(spark, path, name).createOrReplaceTempView(view)
            made.append(view)
    return made


def term_first_seen(terms: DataFrame) -> DataFrame:
    """The first day each term occurs."""
    return terms.groupBy("term").agg(F.min("date").alias("first_seen"))
