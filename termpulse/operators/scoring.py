"""Trailing baseline, scores and the daily election."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed


def _day_no(date: Column) -> Column:
    return F.datediff(date, F.lit("1970-01-01").cast("date"))


def baseline_day_counts(days: DataFrame, baseline_days: int = fixed.BASELINE_DAYS) -> DataFrame:
    """For each day, how many earlier days inside its baseline have stats."""
    later = F.explode(F.sequence(F.date_add("date", 1), F.date_add("date", baseline_days)))
    seen = days.select(later.alias("date")).groupBy("date").agg(F.count(F.lit(1)).alias("baseline_size"))
    return (
        days.select("date", "document_count")
        .join(seen, "date", "left")
        .withColumn("baseline_size", F.coalesce("baseline_size", F.lit(0)))
    )


def with_baseline(terms: DataFrame, days: DataFrame, baseline_days: int = fixed.BASELINE_DAYS) -> DataFrame:
    """Add ``avg_tf_baseline`` and ``ever_present`` to every (date, term) row.

    The mean is over the days of the frame on which the term occurs. A term is ever-present
    when it occurs on every day of the frame that has stats. A partition holds one term, hence
    at most one row per calendar day.
    """
    frame = W.partitionBy("term").orderBy("__day").rangeBetween(-baseline_days, -1)
    sized = baseline_day_counts(days, baseline_days)
    return (
        terms.drop("document_count")
        .withColumn("__day", _day_no(F.col("date")))
        .withColumn("avg_tf_baseline", F.coalesce(F.avg("tf").over(frame), F.lit(0.0)))
        .withColumn("__present", F.count(F.lit(1)).over(frame))
        # one fixed-width row per calendar date
        .join(F.broadcast(sized), "date")
        .withColumn(
            "ever_present", (F.col("baseline_size") > 0) & (F.col("__present") == F.col("baseline_size"))
        )
        .drop("__day", "__present", "baseline_size")
    )


def score(allowlist: Iterable[str] = fixed.ALLOWLIST) -> Column:
    """The trending score over ``tf, df, document_count, avg_tf_baseline, ever_present, term``."""
    docs = F.greatest(F.col("document_count"), F.lit(1))
    trend = F.col("tf") / F.greatest(F.col("avg_tf_baseline"), F.lit(fixed.BASELINE_FLOOR))
    # Spark's ln can be one digit off in its last place, which would break exact ties of scores;
    # this logarithm rounds as the C library does
    log = F.java_method(F.lit("java.lang.Math"), F.lit("log"), (1.0 + F.col("tf")).cast("double")).cast("double")
    raw = log * trend * (0.5 + F.col("df") / docs)
    allow = sorted(set(allowlist))
    listed = F.col("term").isin(allow) if allow else F.lit(False)
    return (
        raw
        * F.when(listed, fixed.ALLOWLIST_BOOST).otherwise(1.0)
        * F.when(F.col("ever_present"), fixed.EVER_PRESENT_FACTOR).otherwise(1.0)
    )


def score_terms(
    terms: DataFrame,
    days: DataFrame,
    *,
    allowlist: Iterable[str] = fixed.ALLOWLIST,
    baseline_days: int = fixed.BASELINE_DAYS,
) -> DataFrame:
    """Score the eligible terms of all days in one pass over a trailing frame."""
    least = F.when(F.col("document_count") >= 2, 2).otherwise(1)
    return (
        with_baseline(terms, days, baseline_days)
        .where(F.col("df") >= least)
        .withColumn("score", score(allowlist))
    )


def rank_candidates(scored: DataFrame, limit: int | None = None) -> DataFrame:
    """Add ``rank`` within the day by (-score, term); a day holds at most the term cap."""
    order = W.partitionBy("date").orderBy(F.desc("score"), F.asc("term"))
    ranked = scored.withColumn("rank", F.row_number().over(order))
    return ranked if limit is None else ranked.where(F.col("rank") <= limit)


def elect(
    ranked: DataFrame,
    days: DataFrame,
    rerank: DataFrame | None = None,
    *,
    rerank_by: str = "external",
    rerank_model: str | None = None,
    candidates_kept: int = fixed.CANDIDATES_KEPT,
    rerank_input: int = fixed.RERANK_INPUT,
    evidence_kept: int = fixed.EVIDENCE_KEPT,
) -> DataFrame:
    """One election per day with stats.

    ``ranked`` holds ``date, rank, term, score, tf, df, avg_tf_baseline, article_ids`` down to at
    least rank ``rerank_input``. ``rerank(date, top)`` optionally names an external order of terms:
    only names among the first ``rerank_input`` candidates count, and the first of them becomes the
    word. A day without candidates keeps a row with a NULL word.
    """
    head = ranked.where(F.col("rank") <= max(rerank_input, candidates_kept))
    entry = F.struct(
        F.col("rank"),
        F.col("term"),
        F.col("score"),
        F.col("tf").alias("tf_today"),
        F.col("df").alias("df_today"),
        F.col("avg_tf_baseline"),
        F.col("article_ids").alias("articles"),
    )
    # bounded: at most rerank_input entries per day
    grouped = head.groupBy("date").agg(F.sort_array(F.collect_list(entry)).alias("__head"))
    base = days.select("date").join(grouped, "date", "left")
    if rerank is None:
        base = base.withColumn("__top", F.lit(None).cast("array<string>"))
    else:
        base = base.join(rerank.select("date", F.col("top").alias("__asked")), "date", "left")
        known = F.transform(F.slice("__head", 1, rerank_input), lambda c: c["term"])
        valid = F.filter("__asked", lambda t: F.array_contains(known, t))
        base = base.withColumn("__known", known).withColumn("__top", F.when(F.size(valid) > 0, valid)).drop(
            "__known", "__asked"
        )
    word = F.coalesce(F.get("__top", F.lit(0)), F.get("__head", F.lit(0))["term"])
    chosen = F.get(F.filter("__head", lambda c: c["term"] == F.col("word")), F.lit(0))
    shown = F.transform(
        F.slice("__head", 1, candidates_kept),
        lambda c: F.struct(
            c["term"].alias("term"),
            F.round(c["score"], 6).alias("score"),
            c["tf_today"].alias("tf_today"),
            c["df_today"].alias("df_today"),
            F.round(c["avg_tf_baseline"], 4).alias("avg_tf_baseline"),
            c["articles"].alias("articles"),
        ),
    )
    rerank_info = F.when(
        F.col("__top").isNotNull(),
        F.struct(F.lit(rerank_by).alias("by"), F.lit(rerank_model).cast("string").alias("model"), F.col("__top").alias("top")),
    )
    return (
        base.withColumn("word", word)
        .withColumn("__chosen", chosen)
        .select(
            "date",
            "word",
            F.coalesce(F.round(F.col("__chosen")["score"], 6), F.lit(0.0)).alias("score"),
            F.coalesce(shown, F.array().cast("array<struct<term:string,score:double,tf_today:bigint,df_today:bigint,avg_tf_baseline:double,articles:array<string>>>")).alias("candidates"),
            F.coalesce(
                F.slice(F.array_distinct(F.col("__chosen")["articles"]), 1, evidence_kept),
                F.array().cast("array<string>"),
            ).alias("evidence_article_ids"),
            rerank_info.alias("rerank"),
        )
    )
