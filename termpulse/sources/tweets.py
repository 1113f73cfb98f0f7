"""Tweet API replies as raw items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions.dates import to_utc_iso
from termpulse.operators.cursors import cap_per_source, cut_at_cursor
from termpulse.sources.feeds import _as_items, _first
from termpulse.sources.landed import Landed, file_order

_REPLY = "data array<struct<id:string,text:string,created_at:string,public_metrics:struct<like_count:bigint>>>"


def tweet_api_items(landed: Landed) -> DataFrame:
    """Tweets of landed API replies that have enough likes, down to the last run's tweet.

    Only the first ``max_items`` of a source are looked at, over all of its reply files, and a tweet under the threshold
    never ends the scan. Answers are left out where the catalog says so.
    """
    sources = landed.of_type("twitter").where(F.col("x_api") & (F.coalesce("handle", F.lit("")) != ""))
    replies = landed.api.select("source_id", file_order(landed.api).alias("place"), F.from_json("content", _REPLY).alias("r"))
    tweets = (
        replies.select("source_id", "place", F.posexplode_outer("r.data").alias("pos", "t"))
        .where(F.col("pos").isNotNull())
        .select(
            "source_id", F.concat("place", F.array(F.col("pos").cast("bigint"))).alias("item_ord"), F.col("t.id").alias("external_id"), "t"
        )
    )
    answers = F.col("exclude_replies") & F.ltrim(F.coalesce("t.text", F.lit(""))).startswith("@")
    told = tweets.join(
        sources.select("source_id", "source_type", "source_ord", "handle", "name", "min_likes", "exclude_replies"), "source_id"
    ).where(~F.coalesce(answers, F.lit(False)))
    liked = cap_per_source(told, landed.max_items).where(F.coalesce("t.public_metrics.like_count", F.lit(0)) >= F.col("min_likes"))
    text = F.coalesce("t.text", F.lit(""))
    url = F.concat(F.lit("https://x.com/"), F.col("handle"), F.lit("/status/"), F.col("external_id"))
    rows = (
        cut_at_cursor(liked, landed.cursors)
        .withColumn("content_text", text)
        .withColumn("title", F.substring("content_text", 1, fixed.TWEET_TITLE_CHARS))
        .withColumn("url_canonical", url)
        .withColumn("item_ord", F.concat(F.array("source_ord"), F.col("item_ord")))
    )
    return _as_items(
        rows,
        url=F.col("url_canonical"),
        author=_first(F.col("name"), F.col("handle")),
        published=to_utc_iso(F.col("t.created_at"), landed.now()),
        kind="tweet",
        html=F.lit(None).cast("string"),
    )
