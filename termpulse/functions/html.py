"""Text, links and publish times from page HTML as column expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions.common import blank_to_null, first_match, let, strip
from termpulse.functions.dates import to_utc_iso

BREAK = "\x02"
_SKIPPED = r"(?is)<!--.*?(?:-->|\z)|<(script|style|noscript)\b[^>]*>.*?(?:</\1\s*>|\z)"
_TAG = r"""<[A-Za-z/!?](?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""


def _entities(below: int) -> Column:
    """Name to character of the named references under a code point, as one literal."""
    names = {name: chr(point) for name, point in sorted(name2codepoint.items()) if point < below}
    pairs = "\x03".join(f"{name}\x04{char}" for name, char in {**names, "apos": "'"}.items())
    return F.str_to_map(F.lit(pairs), F.lit("\x03"), F.lit("\x04"))


def _code_point(number: Column) -> Column:
    return F.when(
        (number > 0) & (number <= 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    ).otherwise("\ufffd")


def unescape(text: Column) -> Column:
    """Resolve character references once, from left to right."""

    def piece(p: Column) -> Column:
        name = F.regexp_extract(p, r"^(#[xX][0-9A-Fa-f]+|#[0-9]+|[A-Za-z][A-Za-z0-9]*)", 1)
        # any number of zeros in front; what is too large is no character
        hexed = F.regexp_extract(name, r"^#[xX]0*([0-9A-Fa-f]*)$", 1)
        hexed = F.when(F.length(hexed) <= 8, F.conv(F.concat(F.lit("0"), hexed), 16, 10).try_cast("bigint")).otherwise(1 << 40)
        plain = F.regexp_extract(name, r"^#0*([0-9]*)$", 1)
        plain = F.when(F.length(plain) <= 10, F.concat(F.lit("0"), plain).try_cast("bigint")).otherwise(1 << 40)
        value = (
            F.when(name.rlike("^#[xX]"), _code_point(hexed))
            .when(name.startswith("#"), _code_point(plain))
            .when(p.startswith(F.concat(name, F.lit(";"))), F.try_element_at(_entities(0x110000), name))
            # without a semicolon only the old Latin-1 names count
            .otherwise(F.try_element_at(_entities(0x100), name))
        )
        rest = F.regexp_replace(p, r"^(?:#[xX][0-9A-Fa-f]+|#[0-9]+|[A-Za-z][A-Za-z0-9]*);?", "")
        return F.when((name == "") | value.isNull(), F.concat(F.lit("&"), p)).otherwise(F.concat(value, rest))

    def whole(t: Column) -> Column:
        parts = F.split(t, "&")
        return F.concat(
            F.get(parts, F.lit(0)),
            F.array_join(F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), piece), ""),
        )

    return F.when(text.contains("&"), whole(text)).otherwise(text)


def visible_markup(html: Column) -> Column:
    """The HTML without comments, scripts and styles."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), _SKIPPED, BREAK)


def text_nodes(html: Column, separator: str = "\n") -> Column:
    """The text nodes of a page, stripped, without empty ones, joined by ``separator``."""
    marked = F.regexp_replace(visible_markup(html), _TAG, BREAK)
    nodes = F.transform(F.split(marked, BREAK), lambda n: strip(unescape(n)))
    return F.array_join(F.filter(nodes, lambda n: n != ""), separator)


def title(html: Column) -> Column:
    """The stripped content of the first title element, or ''."""
    inner = F.regexp_extract(visible_markup(html), r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)
    return strip(unescape(inner))


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, unquoted, with its references; NULL when the tag lacks it."""
    pattern = rf"""(?is)^<[a-z]+\b[^>]*?\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
    raw = F.regexp_extract(tag, pattern, 1)
    return F.when(raw != "", F.regexp_replace(raw, r"""^["']|["']$""", ""))


def hrefs(html: Column) -> Column:
    """``href`` of every anchor in document order, stripped, without empty, # and mailto: ones."""
    anchors = F.regexp_extract_all(
        visible_markup(html),
        F.lit(r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""),
        F.lit(1),
    )
    values = F.transform(anchors, lambda a: strip(unescape(F.regexp_replace(a, r"""^["']|["']$""", ""))))
    return F.filter(values, lambda v: (v != "") & ~v.startswith("#") & ~v.startswith("mailto:"))


def published(html: Column, as_of: Column) -> Column:
    """Publish time from meta properties, else the first time element; NULL when there is none."""
    page = visible_markup(html)
    tags = F.regexp_extract_all(page, F.lit(r"(?is)(<meta\b[^>]*>)"), F.lit(1))
    metas = F.transform(
        tags,
        lambda t: F.struct(
            _attribute(t, "property").alias("property"),
            _attribute(t, "name").alias("name"),
            _attribute(t, "content").alias("content"),
        ),
    )

    def content_of(m: Column, prop: str) -> Column:
        by_property = first_match(m, lambda x: x["property"] == prop)
        by_name = first_match(m, lambda x: x["name"] == prop)
        return blank_to_null(F.when(by_property.isNotNull(), by_property["content"]).otherwise(by_name["content"]))

    def pick(m: Column) -> Column:
        found = [content_of(m, prop) for prop in fixed.PUBLISHED_PROPERTIES]
        times = F.regexp_extract_all(page, F.lit(r"(?is)(<time\b[^>]*\sdatetime\s*=[^>]*>)"), F.lit(1))
        found.append(blank_to_null(_attribute(F.get(times, F.lit(0)), "datetime")))
        return F.coalesce(*found)

    text = unescape(let(metas, pick))
    return F.when(text.isNotNull(), to_utc_iso(text, as_of))
