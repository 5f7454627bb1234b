"""DuckDB twin of op11_conversations: CRC-32 by bits, then a recursion from the last row to the
first that keeps, per state, cost, audit and text of the best way to the end."""

from __future__ import annotations

_WS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''),
    lambda ch: [CAST(ord(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda acc, b: CASE WHEN b >= 0 THEN xor(acc, b) ELSE xor(acc >> 1, (acc & 1) * 3988292384) END))"""
#: Next state and role of a turn that fits: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
_NEXT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}


def _way(cost, edit, line, to):
    tail = f"{to}.r" if line is None else f"{line} || CASE WHEN {to}.r = '' THEN '' ELSE chr(10) || {to}.r END"
    return f"{{'c': {cost} + {to}.c, 'a': '{edit}' || {to}.a, 'r': {tail}}}"


def _row_edits(s):
    to, role = _NEXT[s]
    ways = [_way(4, "D", None, f"s{s}"), _way("3 + x", "R", f"'{role}:' || text", f"s{to}")]
    ways += [_way(f"CASE WHEN cls = '{cls}' THEN x ELSE 1000000 END", "K", "role || ':' || text", f"s{t}")
             for cls, (a, t) in (("s", (0, 1)), ("u", (0, 2)), ("u", (1, 2)), ("u", (3, 2)), ("a", (2, 3))) if a == s]
    return f"list_min([{', '.join(ways)}]) AS b{s}"


def _inserts(s):
    one, r1 = _NEXT[s]
    two, r2 = _NEXT[one]
    return (f"list_min([b{s}, {_way(3, 'I', repr(r1 + ':'), f'b{one}')}, "
            f"{{'c': 6 + b{two}.c, 'a': 'II' || b{two}.a, 'r': '{r1}:' || chr(10) || '{r2}:' || CASE WHEN b{two}.r = '' THEN '' ELSE chr(10) || b{two}.r END}}]) AS s{s}")


OP11_SQL = f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE k <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM d),
f AS (SELECT *, left(role, 1) AS cls, coalesce(left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1), '') AS prev,
    CASE WHEN trim(text, {_WS}) = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(rtrim(text, {_WS}), 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM o),
facts AS (SELECT conv_id, count(*) AS n, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND prev || cls NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
p AS (SELECT conv_id, n AS i, {{'c': 0, 'a': '', 'r': ''}} AS s0, {{'c': 6, 'a': 'II', 'r': 'user:' || chr(10) || 'assistant:'}} AS s1,
    {{'c': 3, 'a': 'I', 'r': 'assistant:'}} AS s2, {{'c': 0, 'a': '', 'r': ''}} AS s3 FROM facts
  UNION ALL
  SELECT conv_id, i - 1, {', '.join(_inserts(s) for s in range(4))} FROM (
    SELECT conv_id, i, {', '.join(_row_edits(s) for s in range(4))} FROM (
      SELECT p.*, f.role, f.text, f.cls, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000 WHEN fault = 'truncated' THEN 3 ELSE 0 END AS x
      FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i)))
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(s0.c, 0) AS BIGINT) AS cost, coalesce(s0.a, '') AS audit, sha256(coalesce(s0.r, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM e.conv_id
  LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM e.conv_id AND p.i = 0
"""
