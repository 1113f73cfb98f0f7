"""SQL of the conversation repair and of the Merkle manifest."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    zeros = ", ".join(["0"] * 8)
    octets = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    step = f"list_reduce(list_concat([xor(r, o)], CAST([{zeros}] AS BIGINT[])), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {octets}), lambda r, o: {step}))"


# ---- conversations

_KEY = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"

#: States of the grammar: 0 start, 1 after system, 2 after user, 3 after assistant.
REPAIR = rf"""
WITH RECURSIVE hashed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32(_KEY)} % 20 AS k FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE k <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
    sha256(strlen(role) || ':' || role || text)) AS p FROM damaged),
marked AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core, substr(role, 1, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS again, lead(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY p) AS following,
    p = max(p) OVER (PARTITION BY conv_id) AS is_last FROM placed),
turns AS MATERIALIZED (SELECT conv_id, turn, role, text, p, initial, CASE WHEN core = '' THEN 'blank' WHEN again THEN 'duplicate'
    WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    NOT is_last AND (initial || following) NOT IN ('su', 'ua', 'au') AS illegal FROM marked),
step(state, after, initial) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (2, 3, 'a'), (3, 2, 'u')),
inserts(state, after, cost, edits, roles) AS (SELECT state, state, 0, '', '' FROM step UNION SELECT state, after, 5, 'I', initial FROM step WHERE initial <> 's'
  UNION SELECT a.state, b.after, 10, 'II', a.initial || b.initial FROM step a JOIN step b ON b.state = a.after WHERE a.initial <> 's' AND b.initial <> 's'),
-- edits of a row in every state: roles has k for a kept role, d for a deleted row
moves AS (SELECT i.state, x.after, i.cost + x.cost AS cost, i.edits || x.edit AS edits, i.roles || x.role AS roles, x.edit, x.initial
  FROM inserts i JOIN (SELECT state, state AS after, 2 AS cost, 'D' AS edit, 'd' AS role, '' AS initial FROM step
    UNION SELECT state, after, 0, 'K', 'k', initial FROM step UNION SELECT state, after, 1, 'R', initial, '' FROM step WHERE initial <> 's') x ON x.state = i.after),
search AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS p, 0 AS state, {{'cost': 0, 'edits': '', 'roles': ''}} AS best FROM turns
  UNION ALL SELECT t.conv_id, t.p, m.after, min({{'cost': s.best.cost + m.cost + CASE WHEN t.fault = 'truncated' AND m.edit <> 'D' THEN 5 ELSE 0 END,
      'edits': s.best.edits || m.edits, 'roles': s.best.roles || m.roles}})
    FROM search s JOIN turns t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.p = s.p + 1 JOIN moves m ON m.state = s.state
    WHERE m.edit = 'D' OR t.fault IN ('', 'truncated') AND (m.edit = 'R' OR m.initial = t.initial) GROUP BY t.conv_id, t.p, m.after),
sizes AS (SELECT conv_id, max(p) AS n, sum(CAST(fault = 'blank' AS INT)) AS blank, sum(CAST(fault = 'duplicate' AS INT)) AS duplicate,
    sum(CAST(fault = 'truncated' AS INT)) AS truncated, sum(CAST(illegal AS INT)) AS illegal, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM turns GROUP BY conv_id),
ended AS (SELECT s.conv_id, min({{'cost': s.best.cost + i.cost, 'edits': s.best.edits || i.edits, 'roles': s.best.roles || i.roles}}) AS best
  FROM search s JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM s.conv_id AND z.n = s.p JOIN inserts i ON i.state = s.state WHERE i.after IN (0, 3) GROUP BY s.conv_id),
letters AS (SELECT conv_id, unnest(string_split(best.edits, '')) AS edit, unnest(string_split(best.roles, '')) AS role, generate_subscripts(string_split(best.edits, ''), 1) AS pos
  FROM ended WHERE best.edits <> ''),
rowed AS (SELECT *, sum(CAST(edit <> 'I' AS INT)) OVER (PARTITION BY conv_id ORDER BY pos) AS p FROM letters),
repaired AS (SELECT r.conv_id, string_agg(CASE r.role WHEN 'k' THEN t.role WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN r.edit = 'I' THEN '' ELSE t.text END,
    chr(10) ORDER BY r.pos) AS text FROM rowed r LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM r.conv_id AND t.p = r.p WHERE r.edit <> 'D' GROUP BY r.conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(e.best.cost, 0) AS BIGINT) AS cost,
  coalesce(e.best.edits, '') AS audit, sha256(coalesce(r.text, '')) AS repaired_sha256
FROM ids i LEFT JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM i.conv_id"""


# ---- manifest


#: Levels of 16 children that the SQL has: 4 thousand million leaves of a group.
LEVELS = 8


def _leaf(text: str) -> str:
    part = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    return "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, key: str) -> str:
    """Levels ``name``_0 .. of (key, i, h), runs of each, and roots."""
    out = []
    for k in range(LEVELS):
        runs = f"SELECT {key}, i // 16 AS i, list(h ORDER BY i) AS run FROM {name}_{k} WHERE n > 1 GROUP BY {key}, i // 16"
        out.append(f"{name}_run_{k} AS MATERIALIZED ({runs})")
        out.append(f"{name}_{k + 1} AS (SELECT {key}, i, sha256(array_to_string(run, '')) AS h, count(*) OVER (PARTITION BY {key}) AS n FROM {name}_run_{k})")
    roots = " UNION ALL ".join(f"SELECT {key}, h FROM {name}_{k} WHERE n = 1" for k in range(LEVELS + 1))
    return ",\n".join([*out, f"{name}_root AS MATERIALIZED ({roots})"])


def _climb(rows: str, name: str, key: str, start: int) -> str:
    """Siblings and folded digest of ``rows``_0 (key, i, cur, proof), one level after another."""
    out = []
    for k in range(LEVELS):
        a, b = f"{rows}_{start + k}", f"{rows}_{start + k + 1}"
        others = "array_to_string(list_filter(r.run, lambda x, j: j <> a.i % 16 + 1), '')"
        own = "sha256(array_to_string(list_transform(r.run, lambda x, j: CASE WHEN j = a.i % 16 + 1 THEN a.cur ELSE x END), ''))"
        kept = "a.doc_id, a.leaf, a.k, a.place, a.top"
        out.append(
            f"{b} AS (SELECT {kept}, a.i // 16 AS i, CASE WHEN r.run IS NULL THEN a.cur ELSE {own} END AS cur, a.proof || coalesce({others}, '') AS proof"
            f" FROM {a} a LEFT JOIN {name}_run_{k} r ON r.{key} = a.{key} AND r.i = a.i // 16)"
        )
    return ",\n".join(out)


MERKLE = f"""
WITH g_leaf AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS k, {_leaf('text')} AS h,
    CASE WHEN {crc32("coalesce(CAST(doc_id AS VARCHAR), '0')")} % 5 = 0 AND doc_id IS NOT NULL THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS tampered FROM documents),
g_placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY k) AS n FROM g_leaf),
g_0 AS (SELECT k, i, h, n FROM g_placed),
{_tree("g", "k")},
t_0 AS MATERIALIZED (SELECT 0 AS top, k, h, row_number() OVER (ORDER BY encode(k)) - 1 AS i, count(*) OVER () AS n FROM g_root),
{_tree("t", "top")},
d_0 AS (SELECT doc_id, h AS leaf, k, i, 0 AS place, 0 AS top, coalesce(tampered, h) AS cur, '' AS proof FROM g_placed),
{_climb("d", "g", "k", 0)},
d_top AS (SELECT d.* EXCLUDE (i), t.i, t.h AS subroot FROM d_{LEVELS} d JOIN t_0 t USING (k)),
e_0 AS (SELECT doc_id, leaf, k, subroot AS place, top, i, cur, proof FROM d_top),
{_climb("e", "t", "top", 0)}
SELECT doc_id, leaf, place AS subroot, r.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = r.h AS verified FROM e_{LEVELS} CROSS JOIN t_root r"""
