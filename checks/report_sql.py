"""SQL for the queries on the read API, exports, presentation, prompts, replies, jobs and streaming."""

from __future__ import annotations

from checks import tables as t
from checks.corpus_sql import (
    BUCKET, CORPUS, DAYS, DOCS, RANKED, SCORED, TOKENS, TOP, baseline, lists, snippet, totals, with_,
)

ELECTED = (*CORPUS, totals(), baseline(), SCORED, RANKED)
EVIDENCE = """
evid AS (
  SELECT date, article_id, rn - 1 AS pos FROM (
    SELECT o.date, o.article_id, row_number() OVER (PARTITION BY o.date ORDER BY o.article_id) AS rn
    FROM occ o JOIN ranked r ON o.date = r.date AND o.term = r.term AND r.rank = 1)
  WHERE rn <= 10)"""
# The corpus with every article under the bucket of its publish time.
BUCKETED = (DOCS, f"bucketed AS (SELECT * REPLACE ({BUCKET} AS date) FROM docs)")
ON_BUCKETS = tuple(part.replace("FROM docs", "FROM bucketed") for part in (TOKENS, DAYS))
TERMS = with_(*CORPUS, totals())
# A third of the documents lands on each of three days; an implausible date is replaced by that of the landing.
LANDED = "CAST(DATE '2024-01-28' + CAST(doc_id % 3 AS INTEGER) AS DATE)"
STREAMED = (DOCS, f"bucketed AS (SELECT * REPLACE ({BUCKET.replace(f"DATE '{t.AS_OF}'", LANDED)} AS date) FROM docs)", *ON_BUCKETS)
FORM = "(conv_id + turn) % 4"
EDGES = r"^[\s\x{a0}]+|[\s\x{a0}]+$"

SQL = {
    "api_articles": with_(DOCS) + """ SELECT article_id, source_id, kind, author, published_at, length(text) AS content_chars,
  CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, length(text) // 4) END AS content_tokens FROM docs
WHERE source_id IN ('src1', 'src2', 'src3') AND kind = 'article' AND published_at <> ''
  AND CAST(substr(published_at, 1, 10) AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-25'""",
    "api_terms": TERMS + """ SELECT CAST(date AS VARCHAR) AS date, term, tf, df FROM totals
WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
    "api_elections": with_(*ELECTED, EVIDENCE) + """ SELECT CAST(r.date AS VARCHAR) AS date, r.term AS word, round(r.score, 6) AS score,
  (SELECT string_agg(article_id, ',' ORDER BY pos) FROM evid e WHERE e.date = r.date) AS evidence_article_ids,
  (SELECT string_agg(term, ',' ORDER BY rank) FROM ranked c WHERE c.date = r.date AND c.rank <= 10) AS candidate_terms,
  CAST(NULL AS VARCHAR) AS llm_summary
FROM ranked r WHERE r.rank = 1 AND r.date >= DATE '2024-01-16'""",
    "trending": TERMS + """ SELECT term, CAST(SUM(tf) AS BIGINT) AS total_tf, CAST(SUM(df) AS BIGINT) AS total_df, COUNT(DISTINCT date) AS days
FROM totals WHERE date >= DATE '2024-01-23' GROUP BY term ORDER BY total_tf DESC, term LIMIT 25""",
    "term_first_seen": TERMS + " SELECT term, MIN(date) AS first_seen FROM totals GROUP BY term",
    "adhoc_sql": TERMS + """ SELECT CAST(date AS VARCHAR) AS date, COUNT(*) AS n_terms, CAST(SUM(tf) AS BIGINT) AS total_tf, MAX(df) AS max_df
FROM totals GROUP BY date""",
    "export_roundtrip": with_(*ELECTED, lists(50, 10)) + """
SELECT 'articles' AS "table", (SELECT COUNT(*) FROM docs) AS exported, article_id AS a, sha256(text) AS b, length(text) AS n, url AS more FROM docs
UNION ALL SELECT 'terms', (SELECT COUNT(*) FROM totals), CAST(t.date AS VARCHAR), t.term, t.tf, i.article_ids
  FROM totals t JOIN ids i ON i.date = t.date AND i.term = t.term
UNION ALL SELECT 'elections', (SELECT COUNT(*) FROM days), CAST(date AS VARCHAR), max(term) FILTER (rank = 1), COUNT(*), string_agg(term, ',' ORDER BY rank)
  FROM ranked WHERE rank <= 10 GROUP BY date""",
    "evidence_join": with_(*ELECTED, EVIDENCE)
    + " SELECT e.date, e.pos, e.article_id, d.source_id, d.kind, d.url FROM evid e JOIN docs d ON d.article_id = e.article_id",
    "day_page_articles": with_(*ELECTED) + " SELECT d.date, d.article_id, d.url FROM docs d JOIN ranked r ON r.date = d.date AND r.rank = 1",
    "prev_next_day": with_(*ELECTED) + """ SELECT date, term AS word, lag(date) OVER (ORDER BY date) AS prev_date,
  lead(date) OVER (ORDER BY date) AS next_date FROM ranked WHERE rank = 1""",
    "feed_rows": with_(*ELECTED) + """ SELECT date, term || ' (' || CAST(date AS VARCHAR) || ')' AS title, 'Word of the day: ' || term AS description
FROM ranked WHERE rank = 1 ORDER BY date DESC LIMIT 20""",
    "rerank_override": with_(*ELECTED, """
chosen AS (SELECT * FROM ranked r WHERE rank = least(3, (SELECT MAX(rank) FROM ranked m WHERE m.date = r.date))),
evid AS (
  SELECT date, string_agg(article_id, ',' ORDER BY article_id) AS evidence_article_ids FROM (
    SELECT o.date, o.article_id, row_number() OVER (PARTITION BY o.date ORDER BY o.article_id) AS rn
    FROM occ o JOIN chosen r ON o.date = r.date AND o.term = r.term) WHERE rn <= 10 GROUP BY date)""")
    + """ SELECT c.date, c.term AS word, round(c.score, 6) AS score, (SELECT string_agg(term, ',' ORDER BY rank DESC) FROM ranked r
  WHERE r.date = c.date AND r.rank IN (2, 3)) AS top, (SELECT term FROM ranked r WHERE r.date = c.date AND r.rank = 1) AS first_candidate,
  e.evidence_article_ids FROM chosen c JOIN evid e ON e.date = c.date""",
    "rerank_prompt": with_(*ELECTED) + """ SELECT date, 'Candidate terms for today''s Word of the Day:' || chr(10) || chr(10) || string_agg(
  '- ' || CASE WHEN term LIKE '%''%' THEN '"' || term || '"' ELSE '''' || term || '''' END || ' (tf=' || CAST(tf AS VARCHAR) || ', df=' || CAST(df AS VARCHAR) || ')',
  chr(10) ORDER BY rank) AS prompt FROM ranked WHERE rank <= 40 GROUP BY date""",
    "blurb_prompt": with_(*ELECTED, EVIDENCE, f"""
shown AS (SELECT e.date, e.pos, '  - [' || d.source_id || '] ' || chr(10) || '    url: ' || d.url ||
    CASE WHEN {snippet('d.text')} <> '' THEN chr(10) || '    excerpt: ' || {snippet('d.text')} ELSE '' END AS line
  FROM evid e JOIN docs d ON d.article_id = e.article_id WHERE e.pos < 8)""") + """
SELECT r.date, 'WORD OF THE DAY: ' || r.term || chr(10) || chr(10) || 'Top candidates (term, tf_today, df_today):' || chr(10) ||
  (SELECT string_agg('  - ' || term || ' (tf=' || CAST(tf AS VARCHAR) || ', df=' || CAST(df AS VARCHAR) || ')', chr(10) ORDER BY rank)
   FROM ranked c WHERE c.date = r.date AND c.rank <= 10) || chr(10) || chr(10) || 'Evidence articles:' || chr(10) ||
  (SELECT string_agg(line, chr(10) ORDER BY pos) FROM shown s WHERE s.date = r.date) AS prompt
FROM ranked r WHERE r.rank = 1""",
    "parse_rerank_replies": f"""
SELECT conv_id, turn, CASE WHEN {FORM} <> 3 AND len(found) > 0 THEN array_to_string(list_transform(found, lambda x: lower(x)), ',') END AS top
FROM (SELECT *, regexp_extract_all(text, '[A-Za-z][A-Za-z0-9''\\-]*[A-Za-z0-9]|[A-Za-z]') AS found FROM conversations)""",
    "parse_blurb_replies": f"""
SELECT conv_id, turn, CASE WHEN {FORM} <> 3 AND s <> '' THEN length(s) END AS summary_chars, CASE WHEN {FORM} <> 3 THEN role END AS why,
  CASE WHEN {FORM} <> 3 THEN role END AS definition, CASE WHEN {FORM} <> 3 THEN role END AS refs
FROM (SELECT *, regexp_replace(text, '{EDGES}', '', 'g') AS s FROM conversations)""",
    "attach_blurbs": with_(*ELECTED) + """ SELECT date, term AS word, CASE WHEN day(date) < 20 THEN term END AS llm_summary,
  CASE WHEN day(date) < 10 THEN 'first ' || term WHEN day(date) < 20 THEN 'about ' || term END AS llm_why,
  CASE WHEN day(date) < 10 THEN 'first' WHEN day(date) < 20 THEN 'about' END AS llm_model,
  CASE WHEN day(date) < 20 THEN 'about ' || term END AS forced_why FROM ranked WHERE rank = 1""",
    "mixed_day_terms": with_(*CORPUS, TOP, """
mixed AS (
  SELECT o.date, o.article_id, o.term, o.tf FROM occ o JOIN docs d ON d.article_id = o.article_id WHERE d.kind <> 'tweet'
  UNION ALL SELECT d.date, p.article_id, p.term, p.tf FROM top p JOIN docs d ON d.article_id = p.article_id WHERE d.kind = 'tweet' AND p.rank <= 20)""")
    + """ SELECT m.date, m.term, CAST(SUM(m.tf) AS BIGINT) AS tf, COUNT(*) AS df FROM mixed m JOIN days d ON d.date = m.date
GROUP BY m.date, m.term, d.document_count HAVING d.document_count < 2 OR COUNT(*) >= 2""",
    "ingest_metrics": with_(DOCS) + " SELECT source_id, COUNT(*) AS new_articles FROM docs GROUP BY source_id",
    "latest_elected": with_(*ELECTED) + " SELECT MAX(date) AS date FROM ranked WHERE rank = 1",
    "migrate_buckets": with_(*BUCKETED) + f"""
SELECT article_id, kind, CASE WHEN kind = 'tweet' THEN DATE '{t.AS_OF}' WHEN published_at = '' OR published_at LIKE '2030%' THEN DATE '{t.AS_OF}'
  ELSE date END AS bucket_date FROM bucketed
UNION ALL SELECT article_id, kind, date FROM bucketed WHERE kind = 'tweet' AND date <> DATE '{t.AS_OF}'""",
    "reprocess_range": with_(*BUCKETED, *ON_BUCKETS, totals(), baseline(), SCORED, RANKED, lists(50, 10)) + """
SELECT t.date, t.term, t.tf, t.df, i.article_ids, r.term AS word, round(round(r.score, 6), 4) AS score
FROM totals t JOIN ids i ON i.date = t.date AND i.term = t.term JOIN ranked r ON r.date = t.date AND r.rank = 1""",
    "processed_days": with_(*BUCKETED, *ON_BUCKETS) + " SELECT date, document_count FROM days",
    "stream_daily_terms": with_(*STREAMED, totals(), lists(50, 10)) + """
SELECT t.date, t.term, t.tf, t.df, i.article_ids, COALESCE(a.authors, '') AS authors FROM totals t JOIN ids i ON i.date = t.date AND i.term = t.term
LEFT JOIN auth a ON a.date = t.date AND a.term = t.term""",
    "stream_restart": with_(*STREAMED, totals(), lists(50, 10)) + """
SELECT t.date, t.term, t.tf, t.df, i.article_ids, t.document_count FROM totals t JOIN ids i ON i.date = t.date AND i.term = t.term""",
    "stream_first_wins": with_(DOCS) + f" SELECT url AS url_canonical, article_id, {LANDED} AS first_seen_date FROM docs",
}
