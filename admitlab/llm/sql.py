"""DuckDB SQL for the operators whose results SQL can express."""

from __future__ import annotations

from .chat_format import ChatTemplate
from .queries import EXTRA_CONVERSATION, URL_RULES


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op10() -> str:
    t = ChatTemplate()
    conv, roles, text = EXTRA_CONVERSATION
    extra = " UNION ALL ".join(f"SELECT {conv}, {i}, {_lit(r)}, {_lit(text)}" for i, r in enumerate(roles))
    marks = len(t.open) + len(t.body) + len(t.close)
    added = "length({0}) + (length({0}) - length(replace({0}, '\\', ''))) + (length({0}) - length(replace({0}, '<', '')))"
    moves = " ".join(f"WHEN state = {_lit(a)} AND role = {_lit(r)} THEN {_lit(b)}" for a, r, b in t.moves)
    return f"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL {extra})),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS n, {_lit(t.start)} AS state FROM turns
  UNION ALL
  SELECT w.conv_id, t.n, CASE {moves} END FROM walk w JOIN turns t ON t.conv_id = w.conv_id AND t.n = w.n + 1),
verdict AS (
  SELECT conv_id, bool_and(state IS NOT NULL) AND arg_max(state, n) IN ({', '.join(map(_lit, sorted(t.final)))}) AS valid
  FROM walk GROUP BY conv_id),
digest AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
         coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
         sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
         sum({marks} + {added.format('role')} + {added.format('text')})::BIGINT AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, coalesce(valid, false) AS valid
FROM digest JOIN verdict USING (conv_id)"""


def _op9() -> str:
    bad = "x IS NULL OR NOT isfinite(x)"
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: {bad})) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM comp LEFT JOIN n USING (vec_id)"""


def _op12() -> str:
    rules = ", ".join(f"({_lit(h)}, {_lit(p)}, {_lit(v)})" for h, p, v in URL_RULES)
    return f"""
WITH rules(rh, rp, rv) AS (VALUES {rules}),
rest AS (
  SELECT row_number() OVER () AS k, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages),
parts AS (
  SELECT k, page_id, regexp_extract(r, '^[^/?#]*') AS h, regexp_extract(regexp_replace(r, '^[^/?#]*', ''), '^[^?#]*') AS path
  FROM rest),
low AS (
  SELECT k, page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts),
best AS (
  SELECT k, arg_max((rh || rp, rv), length(rh || rp)) AS b
  FROM low JOIN rules ON starts_with(path, rp) AND (host = rh OR ends_with(host, '.' || rh)) GROUP BY k)
SELECT page_id, host, path, b[1] AS rule, coalesce(b[2], 'allow') AS verdict FROM low LEFT JOIN best USING (k)"""


def oracle_sql() -> dict[str, str]:
    return {"op9_ego_join": _op9(), "op10_chat": _op10(), "op12_url_filters": _op12()}
