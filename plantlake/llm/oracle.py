"""DuckDB SQL of the queries that SQL can express, written from the contracts, not from the operators."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP2 = f"""
WITH item AS (SELECT item_id, {_ALNUM_WORDS} AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM item WHERE len(ws) > 0)),
doc AS (SELECT doc_id, row_number() OVER () AS rid, {_ALNUM_WORDS} AS ws FROM documents),
piece AS (
  SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win)
        WHERE len(ws) >= n)),
hit AS (SELECT rid, i, n, item_id FROM piece JOIN win USING (n, w)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""


def _letters(word: str) -> str:
    """``word`` in either case, without RE2's folding of non-ASCII letters."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(map(_letters, ("password", "passwd", "secret", "token"))) + "|" + \
    _letters("api") + "_?" + _letters("key")
_HEAD = f"(?:{_KEYS})[\"'']?\\x20*[:=]\\x20*[\"'']?"
#: kind, order, pattern, head, least length behind the head
_KINDS = (
    ("assign", 1, _HEAD + "[A-Za-z0-9+/_.=-]+", _HEAD, 12),
    ("access", 2, "AKIA[A-Z0-9]+", "", 18),
    ("hex", 3, "[0-9a-f]+", "", 16),
    ("private_key", 4, "-----BEGIN [A-Z ]*PRIVATE KEY-----([A-Za-z0-9+/=:,.\\x09\\x0A\\x0D\\x20]*"
                       "-----END [A-Z ]*PRIVATE KEY-----)?", "", 1),
    ("code_host", 5, "gh[pousr]_[A-Za-z0-9]+", "", 40),
    ("chat", 6, "xox[abprs]-[A-Za-z0-9-]+", "", 15),
    ("jwt", 7, "eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", "", 30),
)


def _kind_sql(kind, order, pattern, head, least) -> str:
    value = f"length(m) - length(regexp_extract(m, '^{head}'))" if head else "length(m)"
    return f"""
  SELECT rid, '{kind}' AS kind, {order} AS o, e - length(m) AS s, e FROM (
    SELECT rid, m, sum(length(b) + length(m)) OVER (PARTITION BY rid ORDER BY k) AS e FROM (
      SELECT rid, unnest(regexp_extract_all(t, '(?s)(.*?)({pattern})', 1)) AS b,
             unnest(regexp_extract_all(t, '(?s)(.*?)({pattern})', 2)) AS m,
             unnest(range(len(regexp_extract_all(t, '(?s)(.*?)({pattern})', 2)))) AS k
      FROM doc WHERE regexp_matches(t, '{pattern}'))) WHERE {value} >= {least}"""


_OP4 = f"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
span AS ({" UNION ALL ".join(_kind_sql(*k) for k in _KINDS)}),
one AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c,
         count(*) FILTER (kind = 'hex') AS h,
         string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, o) FILTER (o <= 3) AS base,
         string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, o) AS spans
  FROM (SELECT rid, kind, o, s::BIGINT AS s, e::BIGINT AS e FROM span) GROUP BY rid)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(c, 0)::BIGINT AS n_access,
       coalesce(h, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN one USING (rid)
"""

_WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"
_PHRASES = "|".join(("all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service",
                     "enable javascript", "click here", "subscribe to our newsletter", "sign up for", "log in to",
                     "powered by", "skip to content", "share on"))
_CLOSED = "regexp_matches(tr, '[.!?\\x{2026}\\x{3002}\\x{FF01}\\x{FF1F}][\"'')\\]\\x{201D}\\x{2019}\\x{BB}]*$')"
_SEPARATORS = "len(regexp_extract_all(tr, '[|\\x{BB}\\x{203A}\\x{B7}\\x{2022}>]'))"

_OP3 = f"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
word AS (SELECT doc_id, rid, t, {_WORDS.format('t')} AS ws FROM doc),
gram AS (
  SELECT rid, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM word WHERE len(ws) >= 3)),
twice AS (SELECT rid, a, b, c FROM gram GROUP BY ALL HAVING count(*) > 1),
rep AS (
  SELECT rid, count(DISTINCT p) AS n_rep
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM gram JOIN twice USING (rid, a, b, c)) GROUP BY rid),
line AS (
  SELECT rid, l, trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS tr, len({_WORDS.format('l')}) AS n
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM doc)),
lines AS (
  SELECT rid, count(*) - count(DISTINCT l) AS n_dup,
         sum(n) FILTER (CASE WHEN {_SEPARATORS} < 2 THEN {_CLOSED} OR n >= 5 ELSE 3 * {_SEPARATORS} < n AND {_CLOSED} END
                        AND 2 * len(regexp_extract_all(tr, '[#*$%&|<>]')) <= n
                        AND NOT regexp_matches(lower(tr), '{_PHRASES}')) AS n_clean
  FROM line WHERE n > 0 GROUP BY rid),
base AS (
  SELECT doc_id, len(ws) AS n_words, list_sum(list_transform(ws, lambda w: length(w))) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
         coalesce(n_rep, 0) AS n_repeat_words, coalesce(n_clean, 0) AS n_clean_words
  FROM word LEFT JOIN lines USING (rid) LEFT JOIN rep USING (rid))
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_clean_words::BIGINT AS n_clean_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND NOT 100 * (n_words - n_clean_words) > 50 * n_words AS kept
FROM base
"""

_OP5 = """
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
url AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS rid
  FROM cut),
rule AS (
  SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                        ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS r(verdict, h, p)),
fit AS (
  SELECT rid, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM url JOIN rule ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM url LEFT JOIN fit USING (rid)
"""

_OP6 = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, source, coalesce(len({_WORDS.format('text')}), 0) AS size,
         md5(concat('20:', coalesce(doc_id::VARCHAR, '-'), ':', md5(coalesce(text, '')))) AS key FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM doc GROUP BY source),
level(step, rest, total, clamped) AS (
  SELECT 0, 1.5::DOUBLE * sum(source_size), sum(w)::DOUBLE, 0 FROM src
  UNION ALL
  SELECT step + 1, b - c, t, n FROM (
    SELECT step, any_value(clamped) AS was, 1.5::DOUBLE * sum(source_size) AS b,
           coalesce(sum(2.0::DOUBLE * source_size) FILTER (2 * source_size <= w * rest / total), 0) AS c,
           coalesce(sum(w) FILTER (2 * source_size > w * rest / total), 0)::DOUBLE AS t,
           count(*) FILTER (2 * source_size <= w * rest / total) AS n
    FROM level, src WHERE total > 0 GROUP BY step) WHERE n > was),
last AS (SELECT rest, total FROM level ORDER BY step DESC LIMIT 1),
goal AS (
  SELECT source, source_size, CASE WHEN total > 0 THEN least(2.0 * source_size, w * rest / total)
                                   ELSE 2.0 * source_size END::DOUBLE AS target FROM src, last),
part AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM goal),
unit AS (SELECT source, key, sum(size) AS n FROM doc GROUP BY source, key),
pick AS (
  SELECT source, key, sum(n) OVER (PARTITION BY source ORDER BY key) - n / 2.0 AS middle FROM unit)
SELECT d.doc_id, d.size::BIGINT AS size, p.source_size, p.target,
       (d.size * (p.whole + CASE WHEN p.target - p.whole * p.source_size > 0 AND k.middle <= p.target - p.whole * p.source_size
                                 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM doc d JOIN part p ON d.source IS NOT DISTINCT FROM p.source
     JOIN pick k ON d.source IS NOT DISTINCT FROM k.source AND d.key = k.key
"""

_OP8 = """
WITH page AS (
  SELECT page_id, coalesce(html, '') AS p, sha1(coalesce(html, '')) AS h FROM pages),
first AS (SELECT p, min(page_id) AS first FROM page GROUP BY p),
five AS (SELECT page_id, p, list_transform(range(8), lambda g: ('0x' || substr(h, 5 * g::INT + 1, 5))::BIGINT) AS v FROM page)
SELECT page_id, strlen(p)::BIGINT AS payload_bytes,
       array_to_string(list_transform(v, lambda x: concat(
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x // 32768 % 32 + 1)::INT, 1),
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x // 1024 % 32 + 1)::INT, 1),
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x // 32 % 32 + 1)::INT, 1),
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x % 32 + 1)::INT, 1))), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM five JOIN first USING (p)
"""

_UNITS = "regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+')"

_OP11 = f"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, {_UNITS} AS u,
         sha256(concat('42:', coalesce(doc_id::VARCHAR, ''))) AS d FROM documents),
draw AS (
  SELECT *, len(u) AS n, list_transform(range(4), lambda g: ('0x' || substr(d, 8 * g::INT + 1, 8))::BIGINT) AS h FROM doc),
cut AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS p, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS m,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 50
              THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM draw),
part AS (
  SELECT *, array_to_string(u[1:p], '') AS pre, array_to_string(u[p + 1:m], '') AS mid,
         array_to_string(u[m + 1:n], '') AS suf FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', pre, '<S>', suf, '<M>', mid)
                        ELSE concat('<S>', suf, '<P>', pre, '<M>', mid) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM part
"""

ORACLE = {
    "op11_fill_middle": _OP11,
    "op3_quality_rules": _OP3,
    "op5_url_filter": _OP5,
    "op6_mixing": _OP6,
    "op8_warc": _OP8,
    "op2_decontaminate": _OP2,
    "op4_secret_scan": _OP4,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
