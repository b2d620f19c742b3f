"""DuckDB SQL for the queries over `conversations`: a recursion over rows in place of the search, prefixes in place of tries."""

from __future__ import annotations

# CRC-32 of ASCII strings, as DuckDB has none: its table, and the function as a fold over code points.
_CRC = """crc AS MATERIALIZED (SELECT list(list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i))"""


def _crc32(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"


def _add(value: str, cost: str, edit: str) -> str:
    """A solution, six digits of cost and the audit, with one edit more; the least string is the best."""
    return f"(lpad((({value})[:6]::INT + {cost})::VARCHAR, 6, '0') || ({value})[7:] || '{edit}')"


def _repair() -> str:
    keep = "CASE r.fault WHEN 'f' THEN 0 WHEN 't' THEN 5 END"

    def kept(initial: str, *before: str) -> str:
        found = [f"CASE WHEN r.initial = '{initial}' THEN {_add(x, keep, 'K')} END" for x in before]
        if initial != "s":
            found += [_add(x, f"({keep} + 1)", "R") for x in before]
        return ", ".join(found)

    after = {
        "n0": _add("s0", "2", "D"),
        "n1": f"least({_add('s1', '2', 'D')}, {kept('s', 's0')})",
        "n2": f"least({_add('s2', '2', 'D')}, {kept('u', 's0', 's1', 's3')})",
        "n3": f"least({_add('s3', '2', 'D')}, {kept('a', 's2')})",
    }
    open_user = f"least(n2, {', '.join(_add(x, '5', 'I') for x in ('n0', 'n1', 'n3'))})"
    first_user = _add("'000000'", "5", "I")
    return f"""WITH RECURSIVE {_CRC},
d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations, crc),
e AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM d WHERE k <> 0),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy) AS i FROM e),
g AS (SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
  CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE 'f' END AS fault FROM f),
h AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
  count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
  count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
  list({{'fault': fault, 'initial': initial, 'role': role, 'text': text}} ORDER BY i) AS rows FROM g GROUP BY conv_id),
dp AS (SELECT conv_id, rows, 0 AS i, '000000' AS s0, NULL::VARCHAR AS s1, {first_user} AS s2, {_add(first_user, "5", "I")} AS s3 FROM h
  UNION ALL
  SELECT conv_id, rows, i, n0, n1, {open_user}, least(n3, {_add(open_user, "5", "I")})
  FROM (SELECT conv_id, rows, i + 1 AS i, {", ".join(f"{v} AS {k}" for k, v in after.items())}
    FROM (SELECT *, rows[i + 1] AS r FROM dp WHERE i < len(rows)))),
best AS (SELECT conv_id, rows, least(s0, s3)[:6]::BIGINT AS cost, least(s0, s3)[7:] AS audit FROM dp WHERE i = len(rows)),
edits AS (SELECT *, audit[p] AS edit, length(replace(audit[:p], 'I', '')) AS nth, length(replace(audit[:p], 'D', '')) AS place,
  length(replace(audit, 'D', '')) AS total FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS p FROM best)),
texts AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN rows[nth].role WHEN place % 2 <> total % 2 THEN 'user' ELSE 'assistant' END
  || ':' || CASE WHEN edit = 'I' THEN '' ELSE rows[nth].text END, chr(10) ORDER BY p) AS body FROM edits WHERE edit <> 'D' GROUP BY conv_id)
SELECT c.conv_id, coalesce(h.gaps, 0) AS gaps, coalesce(h.blank, 0) AS blank, coalesce(h.duplicate, 0) AS duplicate,
  coalesce(h.truncated, 0) AS truncated, coalesce(h.illegal, 0) AS illegal, coalesce(b.cost, 0) AS cost,
  coalesce(b.audit, '') AS audit, sha256(coalesce(t.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN h ON c.conv_id IS NOT DISTINCT FROM h.conv_id LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN texts t ON c.conv_id IS NOT DISTINCT FROM t.conv_id"""


_TRIE = f"""WITH {_CRC},
t AS (SELECT conv_id, strlen(coalesce(text, '')) AS bytes, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS code,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, code) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t), crc),
r AS (SELECT c.conv_id, pos, code, bytes FROM c JOIN t ON t.conv_id = c.base AND pos < h
  UNION ALL SELECT c.conv_id, pos, code, bytes FROM c JOIN t ON t.conv_id = c.conv_id AND pos >= h),
s AS (SELECT c.conv_id, coalesce(list(code ORDER BY pos) FILTER (code IS NOT NULL), []) AS codes,
  list(bytes ORDER BY pos) FILTER (code IS NOT NULL) AS sizes FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, d AS depth, md5(array_to_string(codes[:d], ',')) AS key, CASE WHEN d > 0 THEN md5(array_to_string(codes[:d - 1], ',')) END AS above,
  CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS bytes, d = len(codes) AS ends
  FROM (SELECT *, unnest(range(len(codes) + 1)) AS d FROM s)),
n AS (SELECT key, depth, above, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
  string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends) AS ids FROM p GROUP BY key, depth, above),
k AS (SELECT above AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY above),
u AS (SELECT a.key, a.depth, count(*) FILTER (k.key IS NULL) AS n_leaves, sum((x.n_convs - 1) * x.bytes)::BIGINT AS saved_tokens
  FROM n x JOIN p a ON a.conv_id = x.conv_id AND a.depth <= x.depth LEFT JOIN k ON k.key = x.key GROUP BY a.key, a.depth)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, u.n_leaves, u.saved_tokens,
  sha256(coalesce(n.ids, '')) AS ends_sha256
FROM n JOIN u USING (key, depth) LEFT JOIN k ON k.key = n.key LEFT JOIN n m ON m.key = n.above AND m.depth = n.depth - 1"""


ORACLES = {"op11_dialogue_repair": _repair(), "op12_prefix_trie": _TRIE}
