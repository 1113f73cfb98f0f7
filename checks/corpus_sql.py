"""SQL for the queries on terms, day rollups, scores, elections and article fields."""

from __future__ import annotations

from checks import tables as t
from termpulse import fixed_values as fixed


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(words)))


TOKEN = fixed.TOKEN_PATTERN.replace("'", "''")
STOP = quoted(t.stopwords())
ALLOW = quoted(fixed.ALLOWLIST)

DOCS = """
docs AS (
  SELECT doc_id, source AS source_id, CAST(doc_id AS VARCHAR) AS external_id,
         source || '--' || substr(sha256(source || chr(0) || CAST(doc_id AS VARCHAR)), 1, 8) AS article_id,
         source || '--' || sha256(source || chr(0) || CAST(doc_id AS VARCHAR)) AS article_key,
         CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS DATE) AS date,
         'https://' || source || '.example.com/p/' || CAST(doc_id AS VARCHAR) AS url,
         CASE WHEN doc_id % 10 <> 0 THEN 'author-' || CAST(doc_id % 50 AS VARCHAR) END AS author,
         CASE WHEN doc_id % 97 = 0 THEN '' WHEN doc_id % 89 = 0 THEN '2030-01-01T00:00:00+00:00'
              ELSE CAST(CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS DATE) AS VARCHAR) || 'T12:00:00+00:00' END AS published_at,
         CASE WHEN n_chars <= 280 THEN 'tweet' ELSE 'article' END AS kind, text
  FROM documents)"""

TOKENS = f"""
tok AS (
  SELECT article_id, date, author, unnest(found) AS raw, generate_subscripts(found, 1) AS pos
  FROM (SELECT article_id, date, author, regexp_extract_all(text, '{TOKEN}') AS found FROM docs)),
flagged AS (
  SELECT article_id, date, author, pos, lower(raw) AS a, length(raw) >= 2 AS la, lower(raw) IN ({STOP}) AS sa FROM tok),
led AS (
  SELECT *, lead(a, 1) OVER w AS b, lead(la, 1) OVER w AS lb, lead(sa, 1) OVER w AS sb,
         lead(a, 2) OVER w AS c, lead(la, 2) OVER w AS lc, lead(sa, 2) OVER w AS sc
  FROM flagged WINDOW w AS (PARTITION BY article_id ORDER BY pos)),
grams AS (
  SELECT article_id, date, author, a AS term, la AND NOT sa AS good FROM led
  UNION ALL SELECT article_id, date, author, a || ' ' || b, la AND lb AND NOT (sa AND sb) FROM led WHERE b IS NOT NULL
  UNION ALL SELECT article_id, date, author, a || ' ' || b || ' ' || c, la AND lb AND lc AND NOT (sa AND sb AND sc)
  FROM led WHERE c IS NOT NULL),
occ AS (
  SELECT article_id, date, author, term, COUNT(*) AS tf FROM grams
  WHERE good OR term IN ({ALLOW}) GROUP BY article_id, date, author, term)"""

DAYS = """
days AS (SELECT date, COUNT(DISTINCT article_key) AS document_count FROM docs GROUP BY date)"""


def totals(cap: int = fixed.MAX_TERMS_PER_DAY) -> str:
    return f"""
rolled AS (SELECT date, term, CAST(SUM(tf) AS BIGINT) AS tf, COUNT(*) AS df FROM occ GROUP BY date, term),
totals AS (
  SELECT * FROM (
    SELECT r.date, r.term, r.tf, r.df, d.document_count,
           row_number() OVER (PARTITION BY r.date ORDER BY r.tf DESC, r.term) AS rn
    FROM rolled r JOIN days d ON r.date = d.date WHERE d.document_count < 2 OR r.df >= 2)
  WHERE rn <= {cap})"""


def baseline(n: int = fixed.BASELINE_DAYS) -> str:
    return f"""
based AS (
  SELECT date, term, tf, df, document_count, COALESCE(avg_tf, 0.0) AS avg_tf_baseline,
         size > 0 AND present = size AS ever_present
  FROM (
    SELECT t.*, AVG(tf) OVER w AS avg_tf, COUNT(*) OVER w AS present,
           (SELECT COUNT(*) FROM days p WHERE p.date < t.date AND p.date >= t.date - {n}) AS size
    FROM totals t WINDOW w AS (PARTITION BY term ORDER BY date RANGE BETWEEN INTERVAL {n} DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)))"""


SCORED = f"""
scored AS (
  SELECT *, ln(1.0 + tf) * (tf / greatest(avg_tf_baseline, 0.5)) * (0.5 + df / document_count)
            * CASE WHEN term IN ({ALLOW}) THEN 1.5 ELSE 1.0 END * CASE WHEN ever_present THEN 0.5 ELSE 1.0 END AS score
  FROM based WHERE df >= CASE WHEN document_count >= 2 THEN 2 ELSE 1 END)"""

RANKED = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY score DESC, term) AS rank FROM scored)"""


def lists(articles: int, authors: int) -> str:
    return f"""
ids AS (
  SELECT date, term, string_agg(article_id, ',' ORDER BY article_id) AS article_ids FROM (
    SELECT date, term, article_id, row_number() OVER (PARTITION BY date, term ORDER BY article_id) AS rn FROM occ)
  WHERE rn <= {articles} GROUP BY date, term),
auth AS (
  SELECT date, term, string_agg(author, ',' ORDER BY author) AS authors FROM (
    SELECT date, term, author, row_number() OVER (PARTITION BY date, term ORDER BY first_id, author) AS rn FROM (
      SELECT date, term, author, MIN(article_id) AS first_id FROM occ WHERE author IS NOT NULL GROUP BY date, term, author))
  WHERE rn <= {authors} GROUP BY date, term)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)


CORPUS = (DOCS, TOKENS, DAYS)


def _day_terms(cap: int, articles: int, authors: int) -> str:
    return with_(*CORPUS, totals(cap), lists(articles, authors)) + """
SELECT t.date, t.term, t.tf, t.df, COALESCE(i.article_ids, '') AS article_ids, COALESCE(a.authors, '') AS authors
FROM totals t LEFT JOIN ids i ON t.date = i.date AND t.term = i.term
LEFT JOIN auth a ON t.date = a.date AND t.term = a.term"""


# Spaces as the engine's regular expressions name them, with the separators Python also strips.
SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def snippet(text: str) -> str:
    flat = f"trim(regexp_replace({text}, '{SPACES}', ' ', 'g'))"
    return f"""(SELECT CASE WHEN length(s) <= 280 THEN s ELSE rtrim(
      CASE WHEN strpos(reverse(substr(s, 1, 280)), ' ') > 0 AND 280 - strpos(reverse(substr(s, 1, 280)), ' ') > 168
           THEN substr(s, 1, 280 - strpos(reverse(substr(s, 1, 280)), ' ')) ELSE substr(s, 1, 280) END, ' ,.;:-') || '…' END
      FROM (SELECT {flat} AS s))"""


BUCKET = f"""CASE WHEN published_at <> '' AND CAST(substr(published_at, 1, 10) AS DATE) BETWEEN DATE '2015-01-01' AND DATE '{t.AS_OF}'
       THEN CAST(substr(published_at, 1, 10) AS DATE) ELSE DATE '{t.AS_OF}' END"""

TOP = """
top AS (SELECT article_id, term, tf, row_number() OVER (PARTITION BY article_id ORDER BY tf DESC, term) AS rank FROM occ),
tops AS (
  SELECT article_id, string_agg(term || ':' || CAST(tf AS VARCHAR), ',' ORDER BY rank) AS top_terms
  FROM top WHERE rank <= 20 GROUP BY article_id)"""

SQL = {
    "tokenize_counts": with_(DOCS, TOKENS) + " SELECT a AS token, COUNT(*) AS n FROM flagged GROUP BY a",
    "ngram_terms": with_(DOCS, TOKENS) + " SELECT article_id, term, tf FROM occ",
    "article_top_terms": with_(DOCS, TOKENS, TOP) + " SELECT article_id, rank, term, tf FROM top WHERE rank <= 20",
    "day_terms": _day_terms(fixed.MAX_TERMS_PER_DAY, fixed.MAX_ARTICLES_PER_TERM, fixed.MAX_AUTHORS_PER_TERM),
    "day_terms_capped": _day_terms(200, 5, 3),
    "day_headers": with_(DOCS, DAYS) + " SELECT date, document_count FROM days",
    "day_articles": with_(DOCS) + " SELECT DISTINCT date, article_id FROM docs",
    "baseline_window": with_(*CORPUS, totals(), baseline(7))
    + " SELECT date, term, round(avg_tf_baseline, 4) AS avg_tf_baseline, ever_present FROM based",
    "term_scores": with_(*CORPUS, totals(), baseline(), SCORED) + " SELECT date, term, tf, df, round(score, 4) AS score FROM scored",
    "elect_daily": with_(*CORPUS, totals(), baseline(), SCORED, RANKED)
    + """ SELECT d.date, r.term AS word, r.tf, r.df, COALESCE(round(r.score, 6), 0.0) AS score
FROM days d LEFT JOIN ranked r ON d.date = r.date AND r.rank = 1""",
    "elect_candidates": with_(*CORPUS, totals(), baseline(), SCORED, RANKED, lists(50, 10), """
evid AS (
  SELECT date, string_agg(article_id, ',' ORDER BY article_id) AS evidence_article_ids FROM (
    SELECT a.date, a.article_id, row_number() OVER (PARTITION BY a.date ORDER BY a.article_id) AS rn
    FROM occ a JOIN ranked r ON a.date = r.date AND a.term = r.term AND r.rank = 1)
  WHERE rn <= 10 GROUP BY date)""")
    + """ SELECT r.date, r.rank, r.term, round(r.score, 6) AS score, r.tf AS tf_today, r.df AS df_today,
  round(r.avg_tf_baseline, 4) AS avg_tf_baseline, i.article_ids AS articles, e.evidence_article_ids
FROM ranked r JOIN ids i ON r.date = i.date AND r.term = i.term JOIN evid e ON e.date = r.date WHERE r.rank <= 10""",
    "event_type_trend": with_("""
docs AS (SELECT CAST(ts AS DATE) AS date, event_type AS term, CAST(user_id AS VARCHAR) AS article_id, CAST(user_id AS VARCHAR) AS article_key FROM events)""", DAYS, """
occ AS (SELECT date, article_id, term, COUNT(*) AS tf FROM docs GROUP BY date, article_id, term)""", totals(10**9), baseline(10), SCORED)
    + " SELECT date, term, tf, df, round(score, 4) AS score FROM scored",
    "article_ids": with_(DOCS) + " SELECT source_id, external_id, article_id FROM docs",
    "article_keys": with_(DOCS) + " SELECT source_id, external_id, article_id, article_key FROM docs",
    "day_terms_uncapped": _day_terms(10**12, 10**12, 10**12),
    "snippets": with_(DOCS) + f" SELECT article_id, {snippet('text')} AS snippet FROM docs",
    "bucket_dates": with_(DOCS) + f" SELECT article_id, {BUCKET} AS bucket_date FROM docs",
    "derivatives": with_(DOCS, TOKENS, TOP)
    + f""" SELECT d.article_id, source_id, CAST(NULL AS VARCHAR) AS via_source_id, kind, url, url AS url_canonical, '' AS title, d.author,
  published_at, '{t.FETCHED_AT}' AS fetched_at, sha256(text) AS content_sha256, length(text) AS content_chars,
  CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, length(text) // 4) END AS content_tokens,
  {snippet('text')} AS snippet, COALESCE(p.top_terms, '') AS top_terms, {BUCKET} AS bucket_date, d.article_key
FROM docs d LEFT JOIN tops p ON d.article_id = p.article_id""",
    "conversation_posts": f"""
SELECT role || '--' || substr(sha256(role || chr(0) || ext), 1, 8) AS article_id, ext AS external_id, sha256(text) AS content_sha256,
  length(text) AS content_chars, CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, length(text) // 4) END AS content_tokens,
  {snippet('text')} AS snippet, substr(text, 1, 80) AS title
FROM (SELECT *, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS ext FROM conversations)""",
}
