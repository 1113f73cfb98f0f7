"""URL parts, canonical form, blocking and resolution as column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions.common import let, strip

SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def _clean(url: Column) -> Column:
    return F.regexp_replace(strip(url), r"[\t\r\n]", "")


def _authority(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def _split_authority(authority: Column) -> Column:
    """``struct<host, port>`` of an authority; user info goes, brackets of IPv6 hosts go."""
    return let(
        F.regexp_extract(authority, r"([^@]*)$", 1),
        lambda a: F.when(
            a.startswith("["),
            F.struct(
                F.lower(F.regexp_extract(a, r"^\[([^\]]*)", 1)).alias("host"),
                F.regexp_extract(a, r"\]:(.*)$", 1).alias("port"),
            ),
        ).otherwise(
            F.struct(
                F.lower(F.regexp_extract(a, r"^([^:]*)", 1)).alias("host"),
                F.regexp_extract(a, r"^[^:]*:(.*)$", 1).alias("port"),
            )
        ),
    )


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(_clean(url), SCHEME, 1))


def host(url: Column) -> Column:
    """Lowercase host, or '' when the URL has none."""
    return _split_authority(_authority(_clean(url)))["host"]


def path(url: Column) -> Column:
    return F.regexp_extract(_clean(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def authority_of_canonical(url: Column) -> Column:
    """Third slash-separated piece: host and port of a canonical URL."""
    return F.get(F.split(url, "/"), F.lit(2))


def _decode(piece: Column) -> Column:
    # a percent sign that starts no escape is kept as it is
    return F.try_url_decode(F.regexp_replace(piece, r"%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(piece: Column) -> Column:
    # the form encoding here keeps ~ and escapes *
    return F.replace(F.replace(F.url_encode(piece), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _clean_query(query: Column, tracking: list[str]) -> Column:
    pairs = F.transform(
        F.split(query, "&"),
        lambda p: F.struct(
            _decode(F.regexp_extract(p, r"^([^=]*)=", 1)).alias("k"),
            _decode(F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1)).alias("v"),
        ),
    )
    kept = F.filter(pairs, lambda p: (p["v"] != "") & ~F.lower(p["k"]).isin(tracking))
    return F.array_join(F.transform(kept, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")


def canonical(url: Column, tracking: Iterable[str] = fixed.TRACKING_PARAMS) -> Column:
    """Canonical https URL, or NULL when the input is no usable http(s) URL.

    Host in lower case, no user info, default port, fragment, tracking or blank parameter, and no
    trailing slash except for the root.
    """
    drop = sorted(tracking)

    def build(u: Column) -> Column:
        parts = F.struct(
            F.lower(F.regexp_extract(u, SCHEME, 1)).alias("scheme"),
            _split_authority(_authority(u)).alias("at"),
            F.regexp_extract(u, r"^[^/?#]*//[^/?#]*([^?#]*)", 1).alias("path"),
            F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1).alias("query"),
        )

        def join(p: Column) -> Column:
            at = p["at"]
            port = at["port"].try_cast("int")
            bad_port = (at["port"] != "") & (~at["port"].rlike(r"^[0-9]+$") | port.isNull() | (port > 65535))
            default = ((p["scheme"] == "http") & (port == 80)) | ((p["scheme"] == "https") & (port == 443))
            shown_port = F.when(
                (at["port"] != "") & (port != 0) & ~default, F.concat(F.lit(":"), port.cast("string"))
            ).otherwise("")
            trimmed = F.when(F.length(p["path"]) > 1, F.regexp_replace(p["path"], r"/+$", "")).when(
                p["path"] == "", "/"
            ).otherwise(p["path"])
            query = F.when(p["query"] != "", _clean_query(p["query"], drop)).otherwise("")
            usable = p["scheme"].isin("http", "https") & (at["host"] != "") & ~bad_port
            return F.when(
                usable,
                F.concat(
                    F.lit("https://"),
                    at["host"],
                    shown_port,
                    trimmed,
                    let(query, lambda q: F.when(q != "", F.concat(F.lit("?"), q)).otherwise("")),
                ),
            )

        return let(parts, join)

    return let(_clean(url), build)


def canonical_or_raw(url: Column) -> Column:
    return F.coalesce(canonical(url), url)


def host_suffixes(hostname: Column) -> Column:
    """The host and each of its parent domains: a.b.c -> [a.b.c, b.c, c]."""
    return let(
        F.split(hostname, r"\."),
        lambda labels: F.transform(
            F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
        ),
    )


def is_blocked(
    url: Column,
    blocked_hosts: Iterable[str] = fixed.BLOCKED_HOSTS,
    extensions: Iterable[str] = fixed.BLOCKED_EXTENSIONS,
) -> Column:
    """True for a blocked host or one of its subdomains, a blocked file extension, or no host."""
    hosts = sorted(set(blocked_hosts))
    ends = "|".join(re.escape(e) for e in sorted(extensions))
    listed = (
        let(host(url), lambda h: F.exists(host_suffixes(h), lambda s: s.isin(hosts))) if hosts else F.lit(False)
    )
    return (host(url) == "") | listed | F.lower(path(url)).rlike(rf"(?:{ends})$")


def has_content_type_text(content_type: Column) -> Column:
    """True for HTML, XML and text/* content types."""
    c = F.lower(F.coalesce(content_type, F.lit("")))
    return c.contains("html") | c.contains("xml") | c.startswith("text/")


def _no_dots(p: Column) -> Column:
    """Remove ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(p, "/")
    last = F.element_at(segments, -1)
    start = F.array().cast("array<string>")
    walked = F.aggregate(
        segments,
        start,
        lambda done, s: F.when(s == ".", done)
        .when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(s))),
    )
    closed = F.when(last.isin(".", ".."), F.concat(walked, F.array(F.lit("")))).otherwise(walked)
    return F.array_join(closed, "/")


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` found on the page ``base``."""
    base_scheme = F.regexp_extract(base, SCHEME, 1)
    base_root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    base_path = path(base)
    folder = F.regexp_extract(base_path, r"^(.*/)", 1)
    tail = F.regexp_extract(href, r"([?#].*)$", 1)
    href_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    base_query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    return (
        F.when(href == "", base)
        .when(href.rlike(SCHEME), href)
        .when(href.startswith("//"), F.concat(base_scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(base_root, _no_dots(href_path), tail))
        .when(href.startswith("?"), F.concat(base_root, base_path, href))
        .when(href.startswith("#"), F.concat(base_root, base_path, base_query, href))
        .otherwise(
            F.concat(
                base_root, _no_dots(F.concat(F.when(folder == "", "/").otherwise(folder), href_path)), tail
            )
        )
    )
