"""DuckDB SQL for the registered queries that SQL can express. Values are written out, not taken from the operators."""

from __future__ import annotations

from sievelake.llm import oracle_conversations
from sievelake.llm.licenses import RULES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_INK = r"'[^\x20\x09-\x0D]+'"
_SPACE = r"'[\x20\x09-\x0D]+'"


def _mixing(rounds: int = 10, alpha: float = 0.7, fraction: float = 0.9, turns: int = 8) -> str:
    parts = [
        f"""docs AS (SELECT doc_id, source, lang, coalesce(source, '') AS s, coalesce(lang, '') AS l,
  CASE WHEN len(regexp_extract_all(t, ' \\| ')) >= 5 THEN 'list'
       WHEN len(regexp_extract_all(t, '[#*$%&<>{{}}]')) >= 20 THEN 'symbols'
       WHEN contains(lower(t), 'licens') THEN 'licensed'
       WHEN length(t) < 600 THEN 'short prose' ELSE 'prose' END AS p,
  len(regexp_extract_all(t, {_INK}))::BIGINT AS n
  FROM (SELECT *, coalesce(text, '') AS t FROM documents))""",
        "c0 AS MATERIALIZED (SELECT s, l, p, sum(n)::BIGINT AS n, sum(n)::DOUBLE AS r FROM docs GROUP BY ALL)",
    ]
    for m in "slp":
        parts.append(
            f"""g{m} AS MATERIALIZED (SELECT {m}, pow(t, {alpha}) * sum(t) OVER () / sum(pow(t, {alpha})) OVER () AS goal
  FROM (SELECT {m}, sum(n)::DOUBLE AS t FROM c0 GROUP BY {m}) WHERE t > 0)"""
        )
    k = 0
    for _ in range(rounds):
        for m in "slp":
            parts.append(
                f"""c{k + 1} AS MATERIALIZED (SELECT c.s, c.l, c.p, c.n,
  c.r * coalesce(CASE WHEN f.now > 0 THEN g.goal / f.now ELSE 1 END, 1) AS r
  FROM c{k} c LEFT JOIN g{m} g USING ({m}) LEFT JOIN (SELECT {m}, sum(r) AS now FROM c{k} GROUP BY {m}) f USING ({m}))"""
            )
            k += 1
    parts.append(f"w AS MATERIALIZED (SELECT s, l, p, n, CASE WHEN n > 0 THEN r / n ELSE 1 END AS w FROM c{k})")
    parts.append(f"k0 AS MATERIALIZED (SELECT {fraction}::DOUBLE AS k)")
    for i in range(turns):
        parts.append(
            f"""k{i + 1} AS MATERIALIZED (SELECT CASE WHEN coalesce(sum(CASE WHEN w * k >= 1 THEN 0 ELSE n * w END), 0) = 0 THEN max(k)
  ELSE ({fraction} * sum(n) - sum(CASE WHEN w * k >= 1 THEN n ELSE 0 END)) / sum(CASE WHEN w * k >= 1 THEN 0 ELSE n * w END) END AS k
  FROM w, k{i})"""
        )
    return f"""WITH {", ".join(parts)}
SELECT doc_id, source, lang, p AS topic, n AS n_tokens, round(w, 6) AS weight, round(least(1, w * k), 6) AS probability,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < least(1, w * k) AS selected
FROM (SELECT d.*, w.w, k.k FROM docs d JOIN w USING (s, l, p), k{turns} k)"""


_COUNTS = rf"""docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  coalesce(text, '') AS t FROM documents),
words AS (SELECT row, generate_subscripts(w, 1) AS i, unnest(w) AS word
  FROM (SELECT row, regexp_extract_all(t, {_INK}) AS w FROM docs)),
windows AS (SELECT row, i, string_agg(word, ' ') OVER ahead AS g, count(*) OVER ahead AS size FROM words
  WINDOW ahead AS (PARTITION BY row ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
twice AS (SELECT row, i FROM windows WHERE size = 8 QUALIFY count(*) OVER (PARTITION BY row, g) >= 2),
covered AS (SELECT row, count(DISTINCT i + k)::BIGINT AS n FROM twice, range(8) AS o(k) GROUP BY row),
lines AS (SELECT row, count(*) AS n, (count(*) - count(DISTINCT line))::BIGINT AS d
  FROM (SELECT row, unnest(string_split(t, chr(10))) AS line FROM docs) WHERE regexp_matches(line, {_INK}) GROUP BY row),
counts AS (SELECT doc_id, lang, source, len(regexp_extract_all(t, {_INK}))::BIGINT AS n_words,
  length(regexp_replace(t, {_SPACE}, '', 'g'))::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
  coalesce(l.d, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS n_lines,
  len(regexp_extract_all(t, '[A-Z]')) AS n_capitals, len(regexp_extract_all(t, '\|')) AS n_bars
  FROM docs LEFT JOIN covered c USING (row) LEFT JOIN lines l USING (row))"""

_RATES = {
    "symbols": ("n_symbols", "n_words", 60),
    "dup_lines": ("n_dup_lines", "n_lines", 300),
    "repeats": ("n_repeat_words", "n_words", 150),
    "word_length": ("word_chars", "n_words", 2500),
    "capitals": ("n_capitals", "word_chars", 300),
    "bars": ("n_bars", "n_words", 60),
}


def _quality() -> str:
    rates = ", ".join(
        f"CASE WHEN {b} > 0 THEN ({a} * 1000) // {b} ELSE 0 END AS m_{m}" for m, (a, b, _) in _RATES.items()
    )
    binned = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS m, CASE WHEN m_{m} <= 0 THEN 0 ELSE ceil(ln(m_{m}) / ln(1.04))::BIGINT + 1 END AS bin FROM rated"
        for m in _RATES
    )
    slack = "CASE m " + " ".join(f"WHEN '{m}' THEN {s}" for m, (_, _, s) in _RATES.items()) + " END"
    levels = []
    for level, (l, s) in enumerate((("lang", "source"), ("lang", "NULL"), ("NULL", "NULL"))):
        levels.append(
            f"""SELECT {level} AS level, {l} AS lang, {s} AS source, m, sum(n) AS total, list(bin ORDER BY bin) AS bins, list(upto ORDER BY bin) AS upto
  FROM (SELECT {l} AS lang, {s} AS source, m, bin, sum(n) AS n,
    sum(sum(n)) OVER (PARTITION BY {l}, {s}, m ORDER BY bin) AS upto FROM binned GROUP BY {l}, {s}, m, bin)
  GROUP BY lang, source, m {"HAVING sum(n) >= 200" if level < 2 else ""}"""
        )
    quantile = "bins[list_position(list_transform(upto, lambda x: x >= ceil(total * {})), true)]"
    value = "CASE WHEN {0} = 0 THEN 0 ELSE pow(1.04, {0} - 1) * (2 / 2.04) END"
    fails = ", ".join(
        f"CASE WHEN m_{m} > coalesce(f0['{m}'], f1['{m}'], f2['{m}']) THEN '{m}' END" for m in _RATES
    )
    base = "(n_words < 20 OR 100 * n_repeat_words > 30 * n_words)"
    return f"""WITH {_COUNTS},
rated AS (SELECT *, {rates} FROM counts),
binned AS (SELECT lang, source, m, bin, count(*) AS n FROM ({binned}) GROUP BY ALL),
steps AS ({" UNION ALL ".join(levels)}),
ends AS (SELECT level, lang, source, m, {quantile.format(0.25)} AS b1, {quantile.format(0.75)} AS b3 FROM steps),
quartiles AS (SELECT level, lang, source, m, {value.format("b1")} AS q1, {value.format("b3")} AS q3 FROM ends),
fences AS (SELECT level, lang, source, map_from_entries(list((m, q3 + 6.0 * (q3 - q1) + {slack}))) AS f
  FROM quartiles GROUP BY level, lang, source),
verdicts AS (SELECT r.*, {base} AS base_failed, list_filter([{fails}], lambda x: x IS NOT NULL) AS failed
  FROM (SELECT r.*, a.f AS f0, b.f AS f1, c.f AS f2 FROM rated r
    LEFT JOIN (FROM fences WHERE level = 0) a ON a.lang = r.lang AND a.source = r.source
    LEFT JOIN (FROM fences WHERE level = 1) b ON b.lang = r.lang
    LEFT JOIN (FROM fences WHERE level = 2) c ON true) r)
SELECT doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  array_to_string(failed, ',') AS failed, NOT base_failed AND len(failed) = 0 AS kept FROM verdicts"""


# Lines, paragraphs and sentences written from what they are: runs up to a line feed, up to empty lines, up to marks.
_SUBSTRING = rf"""WITH cuts(unit, least) AS (VALUES ('line', 1), ('paragraph', 1), ('sentence', 5)),
found AS (SELECT unit, least, doc_id, text, generate_subscripts(u, 1) AS i, unnest(u) AS body FROM (
  SELECT unit, least, doc_id, text, CASE unit WHEN 'line' THEN regexp_extract_all(low, '[^\n]*\n|[^\n]+')
    WHEN 'paragraph' THEN regexp_extract_all(low, '(?:[^\n]+\n?)+\n*|\n+')
    ELSE regexp_extract_all(low, '[^\n.!?]*[.!?]+[ \t]*\n?|[^\n.!?]+\n?|\n') END AS u
  FROM (SELECT *, {_LOWER.format("text")} AS low FROM documents), cuts)),
placed AS (SELECT unit, least, doc_id, text, sum(length(body)) OVER (PARTITION BY unit, doc_id, text ORDER BY i) AS "end", length(body) AS size,
  regexp_extract_all(body, {_INK}) AS w FROM found),
ranked AS (SELECT unit, doc_id, "end" - size AS start, "end", len(w) AS n_words,
  rank() OVER same AS place, first_value(doc_id) OVER same AS first_doc_id, first_value("end" - size) OVER same AS first_start
  FROM placed WHERE len(w) >= least
  WINDOW same AS (PARTITION BY unit, array_to_string(w, ' ') ORDER BY doc_id NULLS LAST, "end" - size))
SELECT unit, doc_id, start::BIGINT AS start, "end"::BIGINT AS "end", n_words::BIGINT AS n_words, first_doc_id,
  first_start::BIGINT AS first_start FROM ranked WHERE place > 1"""

_LINES = rf"""WITH lines AS (SELECT doc_id, generate_subscripts(u, 1) - 1 AS no, unnest(u) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS u FROM documents)),
plain AS (SELECT doc_id, no, trim(regexp_replace({_LOWER.format("line")}, {_SPACE}, ' ', 'g')) AS line
  FROM lines WHERE regexp_matches(line, {_INK})),
windows AS (SELECT doc_id, list(no) OVER ahead AS covers, list(line) OVER ahead AS key FROM plain
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY no ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)),
later AS (SELECT doc_id, unnest(covers) AS no FROM (
  SELECT doc_id, covers, rank() OVER (PARTITION BY key ORDER BY doc_id NULLS LAST, covers[1]) AS place
  FROM windows WHERE len(covers) = 3) WHERE place > 1),
once AS (SELECT DISTINCT doc_id, no FROM later),
runs AS (SELECT doc_id, min(no) AS a, max(no) AS b FROM (
  SELECT doc_id, no, no - row_number() OVER (PARTITION BY doc_id ORDER BY no) AS run FROM once) GROUP BY doc_id, run)
SELECT doc_id, sum(b - a + 1)::BIGINT AS n_removed, string_agg(a || '-' || b, ',' ORDER BY a) AS removed_lines
FROM runs GROUP BY doc_id"""

_MINHASH = rf"""WITH RECURSIVE words AS MATERIALIZED (SELECT doc_id,
  coalesce(regexp_extract_all({_LOWER.format("text")}, {_INK}), []) AS w FROM documents),
shingles AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM words),
sizes AS MATERIALIZED (SELECT w.doc_id, count(s.s) AS n FROM (SELECT doc_id FROM words) w LEFT JOIN shingles s USING (doc_id) GROUP BY w.doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT s.doc_id, s.n::BIGINT AS n_shingles, min(r.b) AS component_id, s.doc_id = min(r.b) AS kept
FROM sizes s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.n"""

_NGRAMS = rf"""WITH RECURSIVE words AS MATERIALIZED (SELECT doc_id,
  coalesce(regexp_extract_all({_LOWER.format("text")}, {_INK}), []) AS w FROM documents),
shingles AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words),
sizes AS MATERIALIZED (SELECT w.doc_id, count(s.s) AS n FROM words w LEFT JOIN shingles s USING (doc_id) GROUP BY w.doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT s.doc_id, s.n::BIGINT AS n_shingles, min(r.b) AS component_id
FROM sizes s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.n"""

_WARC = """WITH records AS (SELECT page_id, coalesce(html, '') AS p, sha1(coalesce(html, '')) AS sha FROM pages),
first AS (SELECT p, min(page_id) AS id FROM records GROUP BY p)
SELECT page_id, octet_length(encode(p)) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(sha, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN id IS NULL OR id IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN id IS DISTINCT FROM page_id THEN id END AS refers_to
FROM records JOIN first USING (p)"""

def _licenses() -> str:
    """The rules are the operator's own list; how they are matched and resolved is written anew."""
    rules = ", ".join(f"({r.no}, '{r.label}', {r.tier}, '{r.keyword}', '{r.pattern}')" for r in RULES)
    phrases = ("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")
    base = " UNION ALL ".join(
        f"SELECT row, '{label}' AS label, i FROM words, range(len(w)) AS o(i) WHERE w[i + 1:i + {len(p.split())}] = string_split('{p}', ' ')"
        for p, label in phrases
    )
    return rf"""WITH words AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id,
  regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
base AS MATERIALIZED (SELECT row, count(*) AS n, min(i) AS a, max(i) AS b, list(DISTINCT label) AS labels FROM ({base}) GROUP BY row),
rules(no, label, tier, keyword, pattern) AS (VALUES {rules}),
tried AS MATERIALIZED (SELECT DISTINCT row, no, label, tier, regexp_extract_all(canon, pattern) AS m, string_split_regex(canon, pattern) AS p
  FROM (SELECT row, w, ' ' || array_to_string(w, '  ') || ' ' AS canon FROM words) JOIN rules ON list_contains(w, keyword)),
hits AS MATERIALIZED (SELECT row, no, label, tier, s, s + length(m[i]) AS e FROM (SELECT *,
  list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s
  FROM tried, range(1, len(m) + 1) AS o(i))),
kept AS (SELECT * FROM hits a WHERE NOT EXISTS (SELECT 1 FROM hits b WHERE a.row = b.row AND b.tier <= a.tier AND b.s <= a.s AND b.e >= a.e
  AND (b.s < a.s OR b.e > a.e OR b.tier < a.tier OR b.no < a.no))),
method AS (SELECT row, count(*) AS n, min(tier) AS best, list(DISTINCT label) AS labels FROM kept GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, base.a AS first_word, base.b AS last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, method.labels))), ','), '') AS labels,
  coalesce(method.n, 0)::BIGINT AS n_detections, coalesce([1.0, 0.9, 0.6, 0.3][best + 1], 0)::DOUBLE AS score
FROM words LEFT JOIN base USING (row) LEFT JOIN method USING (row)"""


ORACLES = {
    "op1_mixing": _mixing(),
    "op2_license_scan": _licenses(),
    "op3_minhash_dedup": _MINHASH,
    "op5_quality_rules": _quality(),
    "op6_substring_dedup": _SUBSTRING,
    "op7_warc_bundles": _WARC,
    "op10_line_dedup": _LINES,
    **oracle_conversations.ORACLES,
    "op13_ngram_join": _NGRAMS,
}
