"""SQL for the queries on URLs, pages, links, incremental positions and the link budget."""

from __future__ import annotations

from checks import tables as t
from checks.corpus_sql import DOCS, SPACES, quoted, with_
from termpulse import fixed_values as fixed

TRACKING = quoted(fixed.TRACKING_PARAMS)
BLOCKED = quoted(t.BLOCKED)


def canonical(url: str) -> str:
    """Canonical form of the page URLs, which hold no user info, port or escapes."""
    bare = f"split_part({url}, '#', 1)"
    rest = f"regexp_extract(split_part({bare}, '?', 1), '^https?://([^/]*)(.*)$', 2)"
    host = f"lower(regexp_extract({bare}, '^https?://([^/?]*)', 1))"
    kept = (
        f"array_to_string(list_filter(string_split(split_part({bare}, '?', 2), '&'), "
        f"lambda p: lower(split_part(p, '=', 1)) NOT IN ({TRACKING}) AND split_part(p, '=', 2) <> ''), '&')"
    )
    return (
        f"'https://' || {host} || CASE WHEN length({rest}) > 1 THEN rtrim({rest}, '/') WHEN {rest} = '' THEN '/' ELSE {rest} END"
        f" || CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END"
    )


PAGES = f"p AS (SELECT page_id, url, html, {canonical('url')} AS canonical FROM pages)"
VARIANTS = f"""
raw AS (
  SELECT page_id, 0 AS variant, url FROM pages
  UNION ALL SELECT page_id, 1, split_part(url, '#', 1) || CASE WHEN split_part(url, '#', 1) LIKE '%?%' THEN '&' ELSE '?' END
    || 'utm_source=dup' || regexp_extract(url, '(#.*)$', 1) FROM pages),
v AS (SELECT page_id, variant, url, {canonical('url')} AS canonical FROM raw)"""


def host(url: str) -> str:
    return f"lower(regexp_extract({url}, '^https?://([^/?#]*)', 1))"


def blocked(url: str) -> str:
    tests = [f"{host(url)} = '{b}' OR {host(url)} LIKE '%.{b}'" for b in t.BLOCKED]
    return f"({' OR '.join(tests)})"


# Pages without comments, scripts and styles; then text nodes between marks.
SHOWN = """
shown AS (SELECT page_id, url, regexp_replace(html,
  '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<noscript\\b[^>]*>.*?</noscript\\s*>', chr(2), 'g') AS html FROM pages)"""
TAG = """<[A-Za-z/!?](?:[^<>"'']|"[^"]*"|''[^'']*'')*>"""


def plain(text: str) -> str:
    steps = text
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">")):
        steps = f"regexp_replace({steps}, '&{name};', '{char}', 'g')"
    return f"regexp_replace({steps}, '&amp;|&amp\\b', '&', 'g')"


def stripped(text: str) -> str:
    edge = SPACES[:-1] + "+"
    return f"regexp_replace({text}, '^{edge}|{edge}$', '', 'g')"


HREFS = """
hrefs AS (
  SELECT page_id, url, unnest(found) AS href, generate_subscripts(found, 1) - 1 AS pos FROM (
    SELECT page_id, url, regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1) AS found FROM shown)),
links AS (SELECT page_id, url, """ + plain("href") + """ AS href, pos FROM hrefs)"""

FEED = """
items AS (SELECT source_id, external_id, -doc_id AS item_ord, length(text) AS n, doc_id FROM docs)"""

SQL = {
    "canonical_urls": with_(VARIANTS) + " SELECT page_id, variant, url, canonical FROM v",
    "blocked_urls": f"""SELECT page_id, {blocked('url')} OR lower(split_part(split_part(url, '#', 1), '?', 1)) LIKE '%.html'
  OR lower(split_part(split_part(url, '#', 1), '?', 1)) LIKE '%.pdf' AS blocked FROM pages""",
    "unblocked_by_join": with_(PAGES) + f" SELECT page_id, canonical FROM p WHERE NOT {blocked('url')}",
    "url_dedupe": with_(VARIANTS) + """ SELECT canonical, page_id, variant FROM (
  SELECT *, row_number() OVER (PARTITION BY canonical ORDER BY variant, page_id) AS rn FROM v) WHERE rn = 1""",
    "should_follow": with_(VARIANTS) + f""" SELECT page_id, variant, canonical, NOT {blocked('url')}
  AND NOT ({" OR ".join(f"lower(split_part(canonical, '?', 1)) LIKE '%{e}'" for e in fixed.BLOCKED_EXTENSIONS)})
  AND canonical NOT IN (SELECT canonical FROM v WHERE url LIKE '%/fr/%') AS follow FROM v""",
    "page_text": with_(SHOWN, f"""
marked AS (SELECT page_id, regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title\\s*>', 1) AS title,
  string_split(regexp_replace(html, '{TAG}', chr(2), 'g'), chr(2)) AS nodes FROM shown)""") + f"""
SELECT page_id, {stripped(plain('title'))} AS title,
  array_to_string(list_filter(list_transform(nodes, lambda n: {stripped(plain('n'))}), lambda n: n <> ''), chr(10)) AS text FROM marked""",
    "outbound_links": with_("""
own AS (SELECT page_id, url, replace(html, 'href="/', 'href="' || regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/') AS html FROM pages)""",
        SHOWN.replace("FROM pages", """FROM (
  SELECT page_id, url, html || regexp_replace(html, 'href="(https?://[^"?#]*)"', 'href="\\1?utm_source=again"', 'g') AS html FROM own)"""), HREFS, f"""
keyed AS (SELECT page_id, pos, href, {canonical('href')} AS canonical FROM links)""")
    + """ SELECT page_id, pos, href, canonical FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id, canonical ORDER BY pos) AS rn FROM keyed) WHERE rn = 1""",
    "archive_issue_urls": with_(SHOWN, HREFS, """
full_links AS (SELECT page_id, pos, regexp_extract(url, '^(https?://[^/?#]*)', 1) || href AS url FROM links WHERE href LIKE '/t%'),
keyed AS (SELECT page_id, pos, """ + canonical("url") + """ AS canonical FROM full_links)""")
    + """ SELECT page_id, pos, canonical FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id, canonical ORDER BY pos) AS rn FROM keyed) WHERE rn = 1""",
    "published_meta": """
SELECT page_id, CASE WHEN url LIKE '%/en/%' OR url LIKE '%/de/%' THEN '2024-01-' || day || 'T08:00:00+00:00'
  WHEN url LIKE '%/fr/%' THEN '2024-01-' || day || 'T10:00:00+00:00' END AS published_at
FROM (SELECT *, lpad(CAST(length(html) % 28 + 1 AS VARCHAR), 2, '0') AS day FROM pages)""",
    "known_url_anti": with_(DOCS) + " SELECT article_id, url AS url_canonical FROM docs WHERE kind <> 'tweet'",
    "cursor_cut": with_(DOCS, FEED, """
cut AS (SELECT source_id, item_ord AS at FROM (
  SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY n DESC, doc_id DESC) AS rn FROM items) WHERE rn = 1)""").replace("item_ord AS at", "item_ord AS cut_ord")
    + " SELECT i.source_id, i.external_id FROM items i JOIN cut c ON i.source_id = c.source_id WHERE i.item_ord < c.cut_ord",
    "source_cap": with_(DOCS, FEED) + """ SELECT source_id, external_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY item_ord) AS rn FROM items) WHERE rn <= 25""",
    "next_cursors": with_(DOCS, FEED)
    + f" SELECT source_id, arg_min(external_id, item_ord) AS last_guid, '{t.FETCHED_AT}' AS last_fetched_at FROM items GROUP BY source_id",
    # One step per issue in serving order; the list of used URLs goes from step to step.
    "link_budget": "WITH RECURSIVE " + PAGES + f""",
n AS (SELECT COUNT(*) AS n FROM pages),
named AS (
  SELECT page_id, canonical AS own, pos, (page_id * 7 + pos * 13) % (SELECT n FROM n) AS target
  FROM p, (SELECT unnest(range(15)) AS pos)),
usable AS (
  SELECT m.page_id, m.pos, q.canonical, q.url NOT LIKE '%/de/%' AS has_page
  FROM named m JOIN p q ON q.page_id = m.target
  WHERE NOT {blocked('q.url')} AND {host('q.url')} <> {host('m.own')}
    AND NOT ({" OR ".join(f"lower(split_part(q.canonical, '?', 1)) LIKE '%{e}'" for e in fixed.BLOCKED_EXTENSIONS)})),
asked AS (
  SELECT p.page_id, p.canonical AS own, COALESCE(l.wanted, []) AS wanted FROM p LEFT JOIN (
    SELECT page_id, list(canonical ORDER BY pos) FILTER (has_page) AS wanted FROM usable GROUP BY page_id) l ON l.page_id = p.page_id),
served AS (
  SELECT CAST(-1 AS BIGINT) AS issue, (SELECT list(canonical) FROM p WHERE url LIKE '%/es/%') AS used, CAST([] AS VARCHAR[]) AS got
  UNION ALL
  SELECT a.page_id, CASE WHEN list_contains(s.used, a.own) THEN s.used ELSE list_concat(s.used, [a.own], a.got) END,
         CASE WHEN list_contains(s.used, a.own) THEN CAST([] AS VARCHAR[]) ELSE a.got END
  FROM (SELECT s.issue, k.page_id, k.own, list_slice(list_filter(k.wanted, lambda u: NOT list_contains(s.used, u) AND u <> k.own), 1, 4) AS got
        FROM served s JOIN asked k ON k.page_id = s.issue + 1) a JOIN served s ON s.issue = a.issue)
SELECT unnest(got) AS canonical, issue AS item_ord FROM served""",
}
