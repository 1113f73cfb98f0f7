"""Queries on the read API, exports, presentation, model prompts and replies, jobs and streaming."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import corpus_queries as corpus
from checks import tables as t
from termpulse import fixed_values as fixed
from termpulse.functions import article as art
from termpulse.functions import replies
from termpulse.functions import text as txt
from termpulse.operators import daystats, evidence, scoring
from termpulse.operators.daytotals import text_totals
from termpulse.plans import api, jobs, presentation
from termpulse.session import shared_dir, stage
from termpulse.sources import export, tables
from termpulse.streaming import deltas

AS_OF = dt.date.fromisoformat(t.AS_OF)


def _settings() -> jobs.Settings:
    return jobs.Settings(as_of=AS_OF, now=t.FETCHED_AT, stopwords=t.stopwords())


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article rows without term columns; the text is only read where a query needs it."""
    return corpus.derived(spark, sf_dir).drop("term_counts")


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published terms without their lists."""
    none = F.lit(None).cast("array<string>")
    return export.terms_table(t.totals(spark, sf_dir).withColumn("article_ids", none).withColumn("authors", none))


def api_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = export.articles_table(_articles(spark, sf_dir))
    c = api.Corpus(articles, None, None, AS_OF)
    found = c.articles(source=["src1", "src2", "src3"], since="20d", until="2024-01-25", kind="article")
    return found.select("article_id", "source_id", "kind", "author", "published_at", "content_chars", "content_tokens")


def api_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = api.Corpus(None, _terms(spark, sf_dir), None, AS_OF)
    return c.terms(since="2024-01-10", until="10d").select("date", "term", "tf", "df")


def api_elections(spark: SparkSession, sf_dir: str) -> DataFrame:
    # totals are counted when they are asked for, so the API gets the one table that is read
    elections = corpus.elections(spark, sf_dir).withColumn("llm", F.lit(None).cast(evidence._LLM))
    found = api.Corpus(None, None, export.elections_table(elections), AS_OF).elections(since="14d")
    return found.select(
        "date", "word", "score", F.array_join("evidence_article_ids", ",").alias("evidence_article_ids"),
        F.array_join("candidate_terms", ",").alias("candidate_terms"), "llm_summary",
    )


def trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.Corpus(None, _terms(spark, sf_dir), None, AS_OF).trending(25, "7d")


def term_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.term_first_seen(t.totals(spark, sf_dir))


def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over registered views of exported tables."""
    root = f"{shared_dir(spark)}/adhoc-{uuid.uuid4().hex}"
    _terms(spark, sf_dir).write.parquet(f"{root}/terms")
    api.register_views(spark, root, {"terms": "published_terms"})
    return spark.sql(
        "SELECT date, COUNT(*) AS n_terms, SUM(tf) AS total_tf, MAX(df) AS max_df FROM published_terms GROUP BY date"
    )


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all three tables, written and read back, with the count that the export reports."""
    out = f"{shared_dir(spark)}/export-{uuid.uuid4().hex}"
    days = stage(t.days(spark, sf_dir), "day-headers")
    # elections come from the terms and their lists, so the texts are counted once
    terms = stage(t.day_terms(spark, sf_dir, headers=days), "day-terms")
    ranked = scoring.rank_candidates(scoring.score_terms(terms.select("date", "term", "tf", "df"), days), fixed.RERANK_INPUT)
    head = ranked.join(terms.select("date", "term", "article_ids"), ["date", "term"], "left")
    elections = scoring.elect(head, days).withColumn("llm", F.lit(None).cast(evidence._LLM))
    counts = export.export_all(_articles(spark, sf_dir), terms, elections, out)


    def rows(name: str, a: str, b: str, n: str, more: Column) -> DataFrame:
        return spark.read.parquet(f"{out}/{name}").select(
            F.lit(name).alias("table"), F.lit(counts[name]).cast("bigint").alias("exported"), F.col(a).alias("a"), F.col(b).alias("b"), F.expr(n).cast("bigint").alias("n"), more.alias("more")
        )

    articles = rows("articles", "article_id", "content_sha256", "content_chars", F.col("url"))
    terms = rows("terms", "date", "term", "tf", F.array_join("article_ids", ","))
    return articles.unionByName(terms).unionByName(rows("elections", "date", "word", "size(candidate_terms)", F.array_join("candidate_terms", ",")))


def evidence_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence articles of every elected day, in evidence order."""
    wanted = _articles(spark, sf_dir).select("article_id", "source_id", "kind", "url")
    rows = evidence.evidence_rows(corpus.elections(spark, sf_dir), wanted)
    return rows.select("date", F.col("pos").cast("bigint").alias("pos"), "article_id", "source_id", "kind", "url")


def day_page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All articles in the bucket of each elected day."""
    articles = t.raw_items(spark, sf_dir).select("article_id", "url", F.col("date").alias("bucket_date"))
    elections = corpus.elect_daily(spark, sf_dir)
    return evidence.day_article_rows(presentation.elected_days(elections), articles).select("date", "article_id", "url")


def prev_next_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one row a day, read by both sides of a join
    return presentation.with_neighbours(stage(corpus.elect_daily(spark, sf_dir), "elected")).select("date", "word", "prev_date", "next_date")


def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentation.feed_rows(corpus.elect_daily(spark, sf_dir), 20)


def _ranked(spark: SparkSession, sf_dir: str, limit: int) -> DataFrame:
    days = stage(t.days(spark, sf_dir), "day-headers")
    return scoring.rank_candidates(scoring.score_terms(t.totals(spark, sf_dir, days), days), limit)


def rerank_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External orders that name an unknown term, then the third and second candidate of each day."""
    days = stage(t.days(spark, sf_dir), "day-headers")
    rows = t.texts(spark, sf_dir)
    head = corpus.leaders(spark, sf_dir, days, rows)
    ranked = head.where(F.col("rank") <= 3)
    named = ranked.groupBy("date").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("c"))
    asked = named.select("date", F.concat(F.array(F.lit("zz not there")), F.reverse(F.transform(F.slice("c", 2, 2), lambda x: x["term"]))).alias("top"))
    done = corpus.elections(spark, sf_dir, asked, head, days, rows)
    return done.select(
        "date", "word", "score", F.array_join("rerank.top", ",").alias("top"), F.get("candidates", F.lit(0))["term"].alias("first_candidate"),
        F.array_join("evidence_article_ids", ",").alias("evidence_article_ids"),
    )


def rerank_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.rerank_prompts(_ranked(spark, sf_dir, 40))


def blurb_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    # read for the evidence ids and for the words
    elected = stage(corpus.elections(spark, sf_dir), "elections")
    wanted = elected.select(F.explode("evidence_article_ids").alias("article_id")).distinct()
    items = stage(t.raw_items(spark, sf_dir).join(wanted, "article_id", "left_semi"), "evidence-items")
    articles = items.select("article_id", "source_id", "title", "url", art.snippet(F.col("content_text")).alias("snippet"))
    return evidence.blurb_prompts(elected, articles, items.select("article_id", "content_text"))


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns wrapped as model replies: plain, fenced, inside prose, or broken off."""
    c = t.table(spark, sf_dir, "conversations")
    body = F.to_json(
        F.struct(
            txt.tokens(F.col("text")).alias("top"),
            F.concat(F.lit(" "), "text", F.lit(" ")).alias("summary"),
            F.col("role").alias("why"),
            F.struct(F.col("role").alias("text"), F.array("role", F.lit(" ")).alias("references")).alias("definition"),
        )
    )
    form = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(4))
    reply = (
        F.when(form == 0, body)
        .when(form == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(form == 2, F.concat(F.lit("Sure: "), body, F.lit(" Done.")))
        .otherwise(F.substring_index(body, '"why"', 1))
    )
    return c.select("conv_id", "turn", reply.alias("reply"))


def parse_rerank_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _replies(spark, sf_dir)
    return r.select("conv_id", "turn", F.array_join(replies.parse_rerank(F.col("reply")), ",").alias("top"))


def parse_blurb_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _replies(spark, sf_dir).select("conv_id", "turn", replies.parse_blurb(F.col("reply")).alias("p"))
    return p.select(
        "conv_id", "turn", F.length("p.summary").cast("bigint").alias("summary_chars"), "p.why",
        F.col("p.definition.text").alias("definition"), F.array_join("p.definition.references", ",").alias("refs"),
    )


def attach_blurbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies for every elected day; those without a reason are no blurb. Some days have one from before, which stays, or
    is replaced by force."""
    elected = stage(corpus.elect_daily(spark, sf_dir), "elected")

    def answers(before_day: int, said: str) -> DataFrame:
        why = F.when(F.dayofmonth("date") < before_day, F.concat(F.lit(f"{said} "), F.col("word"))).otherwise("")
        reply = F.to_json(F.struct(F.col("word").alias("summary"), why.alias("why")))
        return elected.select("date", reply.alias("reply"), F.lit(said).alias("model"), F.lit(t.FETCHED_AT).alias("generated_at"))

    earlier = stage(evidence.attach_blurbs(elected, evidence.blurbs(answers(10, "first"))), "earlier")
    later = evidence.blurbs(answers(20, "about"))
    kept, forced = evidence.attach_blurbs(earlier, later), evidence.attach_blurbs(earlier, later, force=True)
    told = kept.select("date", "word", F.col("llm.summary").alias("llm_summary"), F.col("llm.why").alias("llm_why"), F.col("llm.model").alias("llm_model"))
    return told.join(forced.select("date", F.col("llm.why").alias("forced_why")), "date")


def mixed_day_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day totals where the text of short posts is gone and their stored top terms stand in."""
    items, short = t.raw_items(spark, sf_dir), F.coalesce(F.col("kind") == "tweet", F.lit(True))
    days = stage(daystats.day_headers(items.select("date", "article_key")), "day-headers")
    counted = txt.with_term_counts(items.where(short), F.col("content_text"), keep=("date",), stopwords=t.stopwords())
    stored = daystats.article_terms(counted.select("date", txt.top_terms(F.col("term_counts")).alias("term_counts")), "date")
    found = text_totals(items.where(~short), F.col("content_text"), days, stored, stopwords=t.stopwords())
    return found.select("date", "term", "tf", "df")


def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.ingest_metrics(t.raw_items(spark, sf_dir))


def latest_elected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.latest_elected(corpus.elect_daily(spark, sf_dir))


def migrate_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles filed under the fetch day move to their own day, unless a copy is there already."""
    items = t.raw_items(spark, sf_dir).select("article_id", "article_key", "published_at", "kind", F.lit(t.FETCHED_AT).alias("fetched_at"))
    filed = items.withColumn("bucket_date", t.as_of_date())
    copies = items.where(F.col("kind") == "tweet").withColumn("bucket_date", art.bucket_date(F.col("published_at"), t.as_of_date()))
    both = filed.unionByName(copies.where(F.col("bucket_date") != t.as_of_date()))
    return jobs.rebucketed(both, t.as_of_date()).select("article_id", "kind", "bucket_date")


def _filled(spark: SparkSession, sf_dir: str) -> str:
    """A table folder with all documents ingested as articles and full texts."""
    root = f"{shared_dir(spark)}/root-{uuid.uuid4().hex}"
    items = t.raw_items(spark, sf_dir).drop("article_id", "article_key")
    tables.append(_articles(spark, sf_dir), root, "articles")
    from termpulse.operators.derive import full_texts

    tables.append(full_texts(items, t.as_of_date()), root, "fulltext")
    return root


def reprocess_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables after processing all days and rebuilding a range of them."""
    root = _filled(spark, sf_dir)
    jobs.process(spark, root, _settings(), backfill=True)
    jobs.elect_days(spark, root, _settings(), backfill=True)
    jobs.reprocess(spark, root, _settings(), dt.date(2024, 1, 5), dt.date(2024, 1, 12))
    terms = tables.read(spark, root, "terms").select("date", "term", "tf", "df", F.array_join("article_ids", ",").alias("article_ids"))
    return terms.join(tables.read(spark, root, "elections").select("date", "word", F.round("score", 4).alias("score")), "date")


def processed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _filled(spark, sf_dir)
    jobs.process(spark, root, _settings(), backfill=True)
    return tables.processed_days(spark, root).select("date", "document_count")


#: Loads of the stream and the day of the first; each lands a day later.
LOADS, FIRST_LOAD = 3, "2024-01-28"


def _load(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """Load ``k``: a third of the documents, many of them late for their day; some twice, and copies of earlier URLs."""
    docs = t.table(spark, sf_dir, "documents")
    n = F.col("doc_id")
    landed_at = F.timestamp_seconds(F.unix_timestamp(F.lit(FIRST_LOAD), "yyyy-MM-dd") + k * 86400 + 6 * 3600)
    own, again = n % LOADS == k, (n % LOADS < k) & (n % 5 == 0)
    # a document is read once for all of its items
    marks = F.when(own & (n % 7 == 0), F.array(F.lit(""), F.lit("twin"))).when(own, F.array(F.lit(""))).when(again, F.array(F.lit("again")))
    rows = docs.where(own | again).withColumn("mark", F.explode(marks))
    item = t.as_raw_items(rows, "mark").drop("article_id", "article_key", "date")
    marked = F.col("mark") != ""
    order = F.when(F.col("mark") == "twin", F.array(F.lit(9).cast("bigint"))).otherwise(
        F.array(F.when(marked, 0).otherwise(1).cast("bigint"), F.col("external_id").cast("bigint"))
    )
    other = {
        "item_ord": order,
        "external_id": F.concat("mark", "external_id"),
        "content_text": F.when(marked, F.concat("mark", F.lit(" "), "content_text")).otherwise(F.col("content_text")),
    }
    return item.withColumns(other).drop("mark").withColumn("landed_at", landed_at)


def _part(external_id: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(external_id), F.lit(parts)).cast("int")


def _parts(spark: SparkSession, sf_dir: str) -> int:
    """Files of a load: one for each split of the documents, or one in all if a load has none for some file."""
    docs = t.table(spark, sf_dir, "documents")
    parts = max(docs.rdd.getNumPartitions(), 1)
    own = docs.select((F.col("doc_id") % LOADS).alias("load"), _part(F.col("doc_id").cast("string"), parts).alias("part")).where("load >= 0")
    found = own.groupBy("load").agg(F.countDistinct("part").alias("n")).collect()
    return parts if len(found) == LOADS and all(r.n == parts for r in found) else 1


def _streamed(spark: SparkSession, sf_dir: str, one_run: bool) -> str:
    """A table folder fed by the stream: all loads as micro-batches of one run, or a restart from the checkpoint before each."""
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    parts = _parts(spark, sf_dir)
    schema = _load(spark, sf_dir, 0).withColumn("part", F.lit(0)).schema
    for k in range(LOADS):
        # one file for each part, however the tasks get them
        load = _load(spark, sf_dir, k).withColumn("part", _part(F.col("external_id"), parts))
        load.repartition(parts, "part").write.mode("append").partitionBy("part").parquet(f"{root}/landing")
        if not one_run or k == LOADS - 1:
            # a load is so many files, and a micro-batch
            reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", parts)
            items = reader.parquet(f"{root}/landing").drop("part")
            deltas.start(items, root, _settings(), f"{root}/checkpoint", available_now=True).awaitTermination()
    return root


def stream_daily_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stats after three micro-batches with late items and items of the next days: sums of what each batch adds."""
    terms = tables.read(spark, _streamed(spark, sf_dir, True), "terms")
    return terms.select("date", "term", "tf", "df", F.array_join("article_ids", ",").alias("article_ids"), F.array_join("authors", ",").alias("authors"))


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files with a stop and a restart from the checkpoint after each, and the batches merged into one at the end."""
    root = _streamed(spark, sf_dir, False)
    deltas.compact(spark, root, _settings())
    terms, headers = deltas.day_stats(spark, root, _settings())
    return terms.join(headers, "date").select("date", "term", "tf", "df", F.array_join("article_ids", ",").alias("article_ids"), "document_count")


def stream_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article that each URL of the stream leads to, and the day of its load."""
    return tables.url_cache(spark, _streamed(spark, sf_dir, True)).select("url_canonical", "article_id", "first_seen_date")


QUERIES = {
    f.__name__: f
    for f in (
        api_articles, api_terms, api_elections, trending, term_first_seen, adhoc_sql, export_roundtrip, evidence_join,
        day_page_articles, prev_next_day, feed_rows, rerank_override, rerank_prompt, blurb_prompt, parse_rerank_replies,
        parse_blurb_replies, attach_blurbs, mixed_day_terms, ingest_metrics, latest_elected, migrate_buckets,
        reprocess_range, processed_days, stream_daily_terms, stream_restart, stream_first_wins,
    )
}
