"""Date and time parsing without use of the session time zone."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from termpulse.functions.common import blank_to_null, let, strip

_ISO = (
    r"^(\d{4}-\d{2}-\d{2})(?:[T ]((?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:[.,]\d+)?)?)?)"
    r" ?(Z|z|UTC|GMT|[+-]\d{2}(?::?\d{2})?)?)?$"
)
# Readable date layouts after the weekday is dropped and a zone is added.
_LAYOUTS = (
    "d MMM yyyy H:mm:ss Z",
    "d MMM yyyy H:mm Z",
    "d MMM yyyy Z",
    "d MMMM yyyy H:mm:ss Z",
    "d MMMM yyyy H:mm Z",
    "d MMMM yyyy Z",
    "MMM d yyyy H:mm:ss Z",
    "MMM d yyyy H:mm Z",
    "MMM d yyyy h:mm a Z",
    "MMM d yyyy Z",
    "MMMM d yyyy H:mm:ss Z",
    "MMMM d yyyy H:mm Z",
    "MMMM d yyyy h:mm a Z",
    "MMMM d yyyy Z",
    "yyyy/M/d H:mm:ss Z",
    "yyyy/M/d Z",
    "M/d/yyyy H:mm:ss Z",
    "M/d/yyyy Z",
)


def iso_string(ts: Column) -> Column:
    """UTC ISO text of a timestamp, to the second, whatever the session time zone is."""
    wall = F.timestamp_add("SECOND", F.unix_seconds(ts), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.concat(F.replace(wall.cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))


def _iso_timestamp(text: Column) -> Column:
    day = F.regexp_extract(text, _ISO, 1)
    digits = F.rpad(F.regexp_replace(F.regexp_replace(F.regexp_extract(text, _ISO, 2), "[.,].*$", ""), ":", ""), 6, "0")
    zone = F.upper(F.regexp_extract(text, _ISO, 3))
    offset = (
        F.when(zone.isin("", "Z", "UTC", "GMT"), "+00:00")
        .when(F.length(zone) == 3, F.concat(zone, F.lit(":00")))
        .otherwise(F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(F.replace(zone, F.lit(":")), 4, 2)))
    )
    full = F.concat(
        day, F.lit("T"), F.substring(digits, 1, 2), F.lit(":"), F.substring(digits, 3, 2), F.lit(":"),
        F.substring(digits, 5, 2), offset,
    )
    return F.when(day != "", full.try_cast("timestamp"))


def _readable_timestamp(text: Column) -> Column:
    # drop the weekday and commas; a missing or named zone counts as UTC
    bare = F.regexp_replace(F.regexp_replace(text, r"^[A-Za-z]{3,9},\s*|^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*\s+", ""), ",", " ")
    bare = F.regexp_replace(F.regexp_replace(bare, r"\s+", " "), r"(?<=\d) ?(?!AM$|PM$|am$|pm$)[A-Z]{1,5}$", "")
    bare = F.regexp_replace(bare, r"([+-]\d{2}):(\d{2})$", "$1$2")
    zoned = F.when(bare.rlike(r" [+-]\d{4}$"), bare).otherwise(F.concat(bare, F.lit(" +0000")))
    return let(zoned, lambda z: F.coalesce(*[F.try_to_timestamp(z, F.lit(p)) for p in _LAYOUTS]))


def to_utc_iso(text: Column, as_of: Column) -> Column:
    """UTC ISO text of a date in ISO, mail or plain English form; ``as_of`` when missing or bad.

    A time without zone counts as UTC.
    """
    parsed = let(
        strip(text), lambda t: F.coalesce(_iso_timestamp(t), F.when(~t.rlike(_ISO), _readable_timestamp(t)))
    )
    return F.when(blank_to_null(text).isNull(), as_of).otherwise(F.coalesce(iso_string(parsed), as_of))


_ISO_LOCAL = (
    r"^\d{4}-\d{2}-\d{2}(?:[T ](?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:[.,]\d+)?)?)?"
    r"(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?)?)?$"
)


def local_date(iso: Column) -> Column:
    """The calendar date written in an ISO timestamp, without any zone shift; NULL when malformed."""
    return F.when(iso.rlike(_ISO_LOCAL), F.substring(iso, 1, 10).try_cast("date"))


def resolve_since(since: str | dt.date | dt.datetime | None, as_of: dt.date) -> dt.date | None:
    """``'7d'`` means seven days before ``as_of``; dates and ISO strings stand for themselves."""
    if since is None:
        return None
    if isinstance(since, dt.datetime):
        return since.date()
    if isinstance(since, dt.date):
        return since
    if not isinstance(since, str):
        raise TypeError(f"since: unexpected type {type(since).__name__}")
    relative = re.fullmatch(r"(\d+)d", since.strip())
    if relative:
        return as_of - dt.timedelta(days=int(relative.group(1)))
    return dt.date.fromisoformat(since)
