"""Elections joined with their articles; prompts, replies and blurbs of elected days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions import replies

_LLM = "struct<summary:string,why:string,model:string,generated_at:string,definition:struct<text:string,references:array<string>>>"


def evidence_rows(elections: DataFrame, articles: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per elected day and known evidence article, with the list position kept."""
    ids = F.col("evidence_article_ids") if limit is None else F.slice("evidence_article_ids", 1, limit)
    wanted = elections.select("date", F.posexplode_outer(ids).alias("pos", "article_id")).where(F.col("pos").isNotNull())
    return wanted.join(articles, "article_id")


def day_article_rows(elections: DataFrame, articles: DataFrame) -> DataFrame:
    """All articles in the bucket of each elected day; order by date and article id to present."""
    return elections.select("date").join(articles, F.col("date") == F.col("bucket_date"))


def latest_elected(elections: DataFrame) -> DataFrame:
    """The newest day that has a word, as a one-row ``date``."""
    return elections.where(F.coalesce("word", F.lit("")) != "").agg(F.max("date").alias("date"))


def blurb_targets(elections: DataFrame, date: str | None = None, force: bool = False) -> DataFrame:
    """The day to describe: the given one, else the latest elected; none when it has a summary."""
    if date is None:
        day = elections.join(F.broadcast(latest_elected(elections)), "date", "left_semi")
    else:
        day = elections.where(F.col("date") == F.lit(date).cast("date"))
    day = day.where(F.coalesce("word", F.lit("")) != "")
    return day if force else day.where(F.coalesce(F.col("llm.summary"), F.lit("")) == "")


def rerank_prompts(ranked: DataFrame, limit: int = fixed.RERANK_INPUT) -> DataFrame:
    """One prompt per day from its first ``limit`` ranked candidates."""
    entry = F.struct("rank", "term", F.col("tf").alias("tf_today"), F.col("df").alias("df_today"))
    head = ranked.where(F.col("rank") <= limit).groupBy("date").agg(F.sort_array(F.collect_list(entry)).alias("c"))
    return head.select("date", replies.rerank_prompt(F.col("c"), limit).alias("prompt"))


def rerank_orders(answers: DataFrame) -> DataFrame:
    """``date, top`` from ``date, reply`` rows whose reply names terms."""
    return answers.select("date", replies.parse_rerank(F.col("reply")).alias("top")).where(F.col("top").isNotNull())


def blurb_prompts(elections: DataFrame, articles: DataFrame, fulltext: DataFrame) -> DataFrame:
    """One prompt per elected day: word, candidates, and up to eight evidence articles.

    Articles are joined by the few evidence ids; a text is joined only where the snippet is blank.
    """
    evidence = evidence_rows(
        elections, articles.select("article_id", "source_id", "title", "url", "snippet"), fixed.BLURB_EVIDENCE
    )
    texts = fulltext.select("article_id", "content_text").join(
        evidence.where(F.coalesce("snippet", F.lit("")) == "").select("article_id").distinct(), "article_id", "left_semi"
    )
    entry = F.struct("pos", "source_id", "title", "url", "snippet", "content_text")
    # bounded: at most eight articles per day
    grouped = evidence.join(texts, "article_id", "left").groupBy("date").agg(
        F.sort_array(F.collect_list(entry)).alias("evidence")
    )
    none = F.array().cast("array<struct<pos:int,source_id:string,title:string,url:string,snippet:string,content_text:string>>")
    return (
        elections.where(F.coalesce("word", F.lit("")) != "")
        .join(grouped, "date", "left")
        .select(
            "date",
            replies.blurb_prompt(F.col("word"), F.col("candidates"), F.coalesce("evidence", none)).alias("prompt"),
        )
    )


def blurbs(answers: DataFrame) -> DataFrame:
    """``date, llm`` from ``date, reply, model, generated_at``; a blurb needs summary and why."""
    parsed = answers.select("date", "model", "generated_at", replies.parse_blurb(F.col("reply")).alias("p"))
    llm = F.struct("p.summary", "p.why", "model", "generated_at", "p.definition").cast(_LLM)
    return parsed.where(F.col("p.summary").isNotNull() & F.col("p.why").isNotNull()).select("date", llm.alias("llm"))


def attach_blurbs(elections: DataFrame, new: DataFrame, force: bool = False) -> DataFrame:
    """Add blurbs to elected days; one that is there stays unless ``force``."""
    if "llm" not in elections.columns:
        elections = elections.withColumn("llm", F.lit(None).cast(_LLM))
    joined = elections.join(new.select("date", F.col("llm").alias("__new")), "date", "left")
    usable = F.when(F.coalesce("word", F.lit("")) != "", F.col("__new"))
    has_one = F.coalesce(F.col("llm.summary"), F.lit("")) != ""
    merged = F.coalesce(usable, F.col("llm")) if force else F.when(has_one, F.col("llm")).otherwise(F.coalesce(usable, F.col("llm")))
    return joined.withColumn("llm", merged).select(*elections.columns)
