"""SQL for the queries on landed bytes: straight on the tables that the bytes were built from."""

from __future__ import annotations

from checks import tables as t
from checks.corpus_sql import SPACES

EDGE = SPACES[:-1] + "+"
PLAIN = f"regexp_replace(regexp_replace(text, '[<&]', '+', 'g'), '^{EDGE}|{EDGE}$', '', 'g')"
DAY = "CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS DATE)"
KEY = "sha256(source || chr(0) || CAST(doc_id AS VARCHAR))"
ID = f"source || '--' || substr({KEY}, 1, 8)"
URL = "'https://' || source || '.example.com/p/' || CAST(doc_id AS VARCHAR)"

SQL = {
    "feed_items": f"""
SELECT row_number() OVER (PARTITION BY source ORDER BY doc_id) AS place, source AS source_id, CAST(doc_id AS VARCHAR) AS external_id, {URL} AS url,
  {URL} AS url_canonical, 'Title ' || CAST(doc_id AS VARCHAR) AS title, 'Blog ' || substr(source, 4) AS author,
  '2024-01-02T10:00:00+00:00' AS published_at, sha256({PLAIN}) AS text_sha256, 'article' AS kind FROM documents""",
    "atom_newsletter_items": f"""
SELECT source AS source_id, 'newsletter' AS source_type, 'tag:' || CAST(doc_id AS VARCHAR) AS external_id, {URL} AS url, 'Issue ' || CAST(doc_id AS VARCHAR) AS title,
  'Ed' AS author, '2024-01-02T10:00:00+00:00' AS published_at, sha256({PLAIN}) AS text_sha256 FROM documents""",
    "tweet_feed_items": f"""
SELECT role AS source_id, id AS external_id, 'https://x.com/' || role || '/status/' || id AS url, upper(role) AS author, '2024-01-03T01:00:00+00:00' AS published_at,
  'tweet' AS kind, sha256({PLAIN}) AS text_sha256
FROM (SELECT *, CAST(conv_id * 1000 + turn AS VARCHAR) AS id FROM conversations) WHERE conv_id % 3 <> 0 AND role IS NOT NULL AND {PLAIN} <> ''""",
    "catalog_dispatch": """
WITH s AS (SELECT source AS source_id, ['rss', 'newsletter', 'podcast', 'archive'][(row_number() OVER (ORDER BY source) - 1) % 4 + 1] AS source_type
  FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL))
SELECT source_id, source_type, COUNT(*) AS n FROM s JOIN documents d ON d.source = s.source_id WHERE source_type IN ('rss', 'newsletter') GROUP BY ALL
UNION ALL SELECT source_id, source_type, 0 FROM s WHERE source_type = 'podcast'""",
    "tweet_api_items": """
SELECT role AS source_id, id AS external_id, 'https://x.com/' || role || '/status/' || id AS url, sha256(text) AS text_sha256, 'tweet' AS kind, substr(text, 1, 80) AS title
FROM (SELECT *, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id FROM conversations) WHERE conv_id % 7 >= 3 AND role IS NOT NULL""",
    "sitemap_issues": """
SELECT 'mapped' AS source_id, bare AS url, COUNT(*) AS n FROM (SELECT split_part(split_part(url, '#', 1), '?', 1) AS bare FROM pages)
WHERE regexp_matches(bare, '^https?://[^/]*/en/') GROUP BY bare""",
    "word_list": "SELECT lower(source) AS word FROM documents UNION SELECT lower(lang || ' ' || source) FROM documents",
    "json_articles": f"""
SELECT {ID} AS article_id, source AS source_id, 'article' AS kind, length(text) AS content_chars, sha256(text) AS content_sha256, sha256(text) AS snippet_sha256,
  lang AS top_term, 3 AS top_tf, {DAY} AS bucket_date FROM documents""",
    "json_stats": f"""
WITH per AS (SELECT {DAY} AS date, source, COUNT(*) AS tf, COUNT(DISTINCT lang) AS df FROM documents GROUP BY ALL)
SELECT date, source AS term, tf, df, source AS article_ids, CAST(SUM(tf) OVER (PARTITION BY date) AS BIGINT) AS document_count FROM per""",
    "json_elections": f"""
SELECT {DAY} AS date, max(source) AS word, COUNT(*) / 4.0 AS score, COUNT(*) AS tf_today, max(source) AS evidence FROM documents GROUP BY 1""",
    "ingest_articles": f"""
SELECT {ID} AS article_id, source || '--' || {KEY} AS article_key, source AS source_id, {URL} AS url_canonical, 'Title ' || CAST(doc_id AS VARCHAR) AS title,
  length({PLAIN}) AS content_chars, sha256({PLAIN}) AS content_sha256, DATE '2024-01-02' AS bucket_date FROM documents""",
    "url_cache_state": f"""
SELECT {URL} AS url_canonical, {ID} AS article_id, DATE '{t.AS_OF}' AS first_seen_date, CAST(NULL AS VARCHAR) AS status FROM documents""",
    "cursor_state": f"""
SELECT source AS source_id, CAST(min(doc_id) AS VARCHAR) AS last_guid, '{t.FETCHED_AT}' AS last_fetched_at FROM documents GROUP BY source""",
}
