"""Fields of an article derivative as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions.common import SPACE, let
from termpulse.functions.dates import local_date


def article_id(source_id: Column, external_id: Column) -> Column:
    """Source id and eight digits of the hash."""
    digest = F.sha2(F.concat(source_id, F.lit("\x00"), external_id), 256)
    return F.concat(source_id, F.lit("--"), F.substring(digest, 1, 8))


def article_key(source_id: Column, external_id: Column) -> Column:
    """Source id and the whole hash: what tables and joins know an article by. ``article_id`` is shown, but two articles
    of a large source may share it."""
    return F.concat(source_id, F.lit("--"), F.sha2(F.concat(source_id, F.lit("\x00"), external_id), 256))


def content_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def content_chars(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit(""))).cast("bigint")


def estimate_tokens(text: Column) -> Column:
    n = content_chars(text)
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(n / fixed.CHARS_PER_TOKEN))).cast("bigint")


def snippet(text: Column, max_chars: int = fixed.SNIPPET_CHARS) -> Column:
    """White space collapsed; longer text is cut, at a late space if there is one, and marked."""

    def shorten(t: Column) -> Column:
        cut = F.substring(t, 1, max_chars)
        from_end = F.locate(" ", F.reverse(cut))
        last_space = F.lit(max_chars) - from_end
        worded = F.when(
            (from_end > 0) & (last_space > max_chars * fixed.SNIPPET_WORD_SHARE), F.substring(cut, F.lit(1), last_space)
        ).otherwise(cut)
        ended = F.regexp_replace(worded, r"[ ,.;:\-]+$", "")
        return F.when(F.length(t) <= max_chars, t).otherwise(F.concat(ended, F.lit("…")))

    collapsed = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), rf"(?U){SPACE}+", " "))
    return let(collapsed, shorten)


def bucket_date(published_at: Column, as_of: Column, earliest: str = fixed.EARLIEST_DATE) -> Column:
    """The publish date when it is plausible, else the run date."""
    pub = local_date(published_at)
    return F.when(pub.between(F.lit(earliest).cast("date"), as_of), pub).otherwise(as_of)


def rebucket_date(published_at: Column, fetched_at: Column, as_of: Column, earliest: str = fixed.EARLIEST_DATE) -> Column:
    """As ``bucket_date``, but falls back to the fetch date; NULL when neither is usable."""
    pub = local_date(published_at)
    return F.when(pub.between(F.lit(earliest).cast("date"), as_of), pub).otherwise(local_date(fetched_at))


def title_and_text(title: Column, text: Column) -> Column:
    """Title and body in one text, so that headline terms count once more."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")))
