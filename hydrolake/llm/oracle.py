"""DuckDB SQL of those queries that SQL can express."""

from __future__ import annotations

import math

from hydrolake.llm import quality_rules
from hydrolake.llm.queries import URL_RULES

FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACE_WORD = r"[^\x20\x09-\x0D]+"

# secrets ----------------------------------------------------------------------------------------------------------
_ASSIGN = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
_KINDS = (("assign", _ASSIGN, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24), ("pem", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 1))


def _kind(i: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""SELECT rid, {i} AS o, '{kind}' AS kind, s, s + length(m[i]) AS e FROM (
  SELECT rid, m, own, i, list_sum(list_transform(parts[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s FROM (
    SELECT rid, m, own, parts, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT rid, regexp_extract_all(text, '{pattern}') AS m, regexp_extract_all(text, '{pattern}', {group}) AS own, regexp_split_to_array(text, '{pattern}') AS parts FROM d)))
  WHERE length(own[i]) >= {least}"""


_SAID = "concat(kind, ':', CAST(s AS BIGINT), ':', CAST(e AS BIGINT))"
SECRETS = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents)
, f AS ({' UNION ALL '.join(_kind(i, *k) for i, k in enumerate(_KINDS))})
, a AS (SELECT rid, count(*) FILTER (WHERE o = 0) AS n_assign, count(*) FILTER (WHERE o = 1) AS n_access, count(*) FILTER (WHERE o = 2) AS n_hex,
  coalesce(string_agg({_SAID}, ',' ORDER BY s, o) FILTER (WHERE o < 3), '') AS base, string_agg({_SAID}, ',' ORDER BY s, o) AS spans FROM f GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (rid)"""

# quality rules ----------------------------------------------------------------------------------------------------
_GROWTH = f"{math.log(quality_rules.GROWTH)!r}e0"
_ZERO = f"({quality_rules.ZERO_BIN})"
_RULE_NAMES = [r.name for r in quality_rules.RULES]


def _quartiles(name: str, by: str) -> str:
    """Per ``by`` and rule: n, and the edges of the bins where the quartiles lie."""
    edge = "CASE WHEN {0} > " + _ZERO + " THEN pow(" + repr(quality_rules.GROWTH) + "e0, {0} - {1}) ELSE 0e0 END"
    return f"""{name} AS (SELECT {by}, rule, total AS n, {edge.format('low_bin', 1)} AS low, {edge.format('high_bin', 0)} AS high FROM (
  SELECT {by}, rule, max(total) AS total, min(bin) FILTER (WHERE 1000 * upto >= 750 * total) AS high_bin, min(bin) FILTER (WHERE 1000 * upto >= 250 * total) AS low_bin FROM (
    SELECT *, sum(n) OVER (PARTITION BY {by}, rule ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {by}, rule) AS total FROM (SELECT {by}, rule, bin, sum(n) AS n FROM bins GROUP BY ALL)) GROUP BY {by}, rule))"""


_SPREADS = ", ".join(f"('{r.name}', {r.spread!r}e0)" for r in quality_rules.RULES)
_WIDTH = f"{quality_rules.REACH!r}e0 * greatest({{0}} - {{1}}, spread)"
_LEAN = "({0}.n * {0}.{2} + 100 * {1}.{2}) / ({0}.n + 100e0)"


QUALITY = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{SPACE_WORD}') AS w FROM documents)
, win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS times FROM (SELECT rid, i, array_to_string(w[i:i + 2], ' ') AS k FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)))
, rep AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + 3)) AS j FROM win WHERE times > 1) GROUP BY 1)
, m AS (SELECT rid, doc_id, lang, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{SPACE_WORD}')) AS lines, coalesce(rep.n, 0) AS n_repeat_words FROM d LEFT JOIN rep USING (rid))
, r AS (SELECT * EXCLUDE (lines), len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    coalesce(n_symbols / nullif(word_chars, 0), 0e0) AS symbol_ratio, coalesce((len(lines) - len(list_distinct(lines))) / nullif(len(lines), 0), 0e0) AS dup_line_ratio, coalesce(n_repeat_words / nullif(n_words, 0), 0e0) AS repeat_ratio, coalesce(word_chars / nullif(n_words, 0), 0e0) AS mean_word FROM m)
, long AS ({' UNION ALL '.join(f"SELECT rid, lang, source, base_failed, '{n}' AS rule, {n} AS x FROM r" for n in _RULE_NAMES)})
, bins AS (SELECT lang, source, 1 AS one, rule, CASE WHEN x > 0 THEN CAST(ceil(ln(x) / {_GROWTH}) AS INT) ELSE {_ZERO} END AS bin, count(*) AS n FROM long WHERE NOT base_failed GROUP BY ALL)
, {_quartiles('a', 'lang, source')}, {_quartiles('b', 'lang')}, {_quartiles('c0', 'one')}, sp(rule, spread) AS (VALUES {_SPREADS})
, c AS (SELECT *, low - width AS lo, high + width AS hi FROM (SELECT *, {_WIDTH.format('high', 'low')} AS width FROM c0 JOIN sp USING (rule)))
, b1 AS (SELECT b.lang, b.rule, spread, {_LEAN.format('b', 'c', 'low')} AS low, {_LEAN.format('b', 'c', 'high')} AS high, c.lo, c.hi, c.width AS before FROM b JOIN c ON b.rule = c.rule)
, b2 AS (SELECT lang, rule, spread, low, high, width, greatest(low - width, lo - before) AS lo, least(high + width, hi + before) AS hi FROM (SELECT *, {_WIDTH.format('high', 'low')} AS width FROM b1))
, a1 AS (SELECT a.lang, a.source, a.rule, spread, {_LEAN.format('a', 'b2', 'low')} AS ql, {_LEAN.format('a', 'b2', 'high')} AS qh, b2.lo, b2.hi, b2.width AS before FROM a JOIN b2 ON a.lang IS NOT DISTINCT FROM b2.lang AND a.rule = b2.rule)
, f AS (SELECT lang, source, rule, greatest(ql - width, lo - before) AS low, least(qh + width, hi + before) AS high FROM (SELECT *, {_WIDTH.format('qh', 'ql')} AS width FROM a1))
, bad AS (SELECT DISTINCT rid FROM long l JOIN f ON l.lang IS NOT DISTINCT FROM f.lang AND l.source IS NOT DISTINCT FROM f.source AND l.rule = f.rule WHERE x > high OR (l.rule = 'mean_word' AND x < low))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.rid IS NULL AS kept FROM r LEFT JOIN bad USING (rid)"""

# near copies ------------------------------------------------------------------------------------------------------
JACCARD = f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({FOLD.format("coalesce(text, '')")}, '{SPACE_WORD}') AS w FROM documents)
, s AS (SELECT DISTINCT rid, array_to_string(w[i:i + 3], ' ') AS k FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0))
, n AS (SELECT rid, count(*) AS n FROM s GROUP BY 1)
, e AS (SELECT x.a, x.b FROM (SELECT p.rid AS a, q.rid AS b, count(*) AS same FROM s p JOIN s q ON p.k = q.k AND p.rid < q.rid GROUP BY 1, 2) x JOIN n ON n.rid = x.a JOIN n m ON m.rid = x.b WHERE 100 * same >= 85 * (n.n + m.n - same))
, g AS (SELECT a, b FROM e UNION SELECT b, a FROM e)
, r(a, b) AS (SELECT rid, rid FROM d UNION SELECT r.a, g.b FROM r JOIN g ON r.b = g.a)
, c AS (SELECT r.a AS rid, min(d.doc_id) AS component_id FROM r JOIN d ON d.rid = r.b GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM d LEFT JOIN n USING (rid) JOIN c USING (rid)"""

# archives ---------------------------------------------------------------------------------------------------------
_BASE32 = "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT), 1)), '')"
WARC = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM p"""

# URLs -------------------------------------------------------------------------------------------------------------
_RULES = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)
URLS = f"""WITH r(h, p, v) AS (VALUES {_RULES})
, u AS (SELECT row_number() OVER () AS rid, page_id, {FOLD.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
, f AS (SELECT rid, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN f USING (rid)"""

# benchmark windows --------------------------------------------------------------------------------------------------
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOWS = f"""WITH it AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({FOLD.format('text')}, '{_WORDS}') AS w FROM benchmark WHERE text IS NOT NULL)
, win AS (SELECT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS k FROM (SELECT item_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM (SELECT *, least(len(w), 13) AS l FROM it WHERE len(w) > 0)))
, d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({FOLD.format("coalesce(text, '')")}, '{_WORDS}') AS w FROM documents)
, dk AS (SELECT rid, l, i, array_to_string(w[i:i + l - 1], ' ') AS k FROM (SELECT rid, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM win) WHERE len(w) >= l))
, hit AS (SELECT rid, i, l, item_id FROM dk JOIN win USING (l, k))
, n AS (SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(i, i + l)) AS x FROM (SELECT DISTINCT rid, i, l FROM hit)) GROUP BY 1)
, m AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS said FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(said, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN n USING (rid) LEFT JOIN m USING (rid)"""

ORACLE: dict[str, str] = {"op1_secrets": SECRETS, "op2_quality_rules": QUALITY, "op4_jaccard_join": JACCARD, "op5_warc": WARC, "op8_url_filter": URLS, "op9_decontaminate": WINDOWS}
