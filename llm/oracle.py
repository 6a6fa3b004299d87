"""SQL for the queries of this package that SQL can express (DuckDB, over the same tables).

The other queries rest on hashes, tokenizers or models that SQL does not have; tests hold them against brute force.
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]"

_QUALITY = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
word AS (
  SELECT *, regexp_extract_all(t, '{_WORD}+') AS w, string_split(t, chr(10)) AS lines,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS worded,
         len(regexp_extract_all(t, '\p{{Lu}}')) AS upper_case, len(regexp_extract_all(t, '\p{{L}}')) AS letters
  FROM doc),
place AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM word),
window3 AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS copies FROM place),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM window3, (VALUES (0), (1), (2)) AS v(k) WHERE copies > 1 GROUP BY r),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(worded) - len(list_distinct(worded)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines, upper_case, letters
  FROM word LEFT JOIN covered USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (
         n_symbols * 10 > n_words OR word_chars NOT BETWEEN n_words * 2 AND n_words * 20
         OR (n_dup_lines >= 3 AND n_dup_lines * 10 > n_lines * 3)
         OR upper_case * 2 > letters OR letters * 2 < word_chars) AS kept
FROM judged"""

# Each hex digit as four bits, then five bits for each base32 letter.
_BITS = "sha1(coalesce(html, ''))"
for _digit in "0123456789abcdef":
    _BITS = f"replace({_BITS}, '{_digit}', '{''.join('IO'[int(b)] for b in format(int(_digit, 16), '04b'))}')"

_WARC = f"""
WITH page AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, translate({_BITS}, 'IO', '01') AS bits FROM pages),
named AS (
  SELECT page_id, payload_bytes,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + list_sum(list_transform(range(5), lambda j: substr(bits, (1 + 5 * i + j)::INTEGER, 1)::INTEGER << (4 - j)::INTEGER))::INTEGER, 1)), '') AS payload_digest
  FROM page),
best AS (SELECT *, max(page_id) OVER (PARTITION BY payload_bytes, payload_digest) AS largest FROM named)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM best"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DIVERGENCE = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
grp AS (SELECT DISTINCT lang, source FROM doc),
per_doc AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM doc) GROUP BY ALL),
counted AS (SELECT lang, source, term, sum(n)::BIGINT AS n, count(*) AS docs FROM per_doc GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::BIGINT AS n FROM counted GROUP BY ALL HAVING sum(docs) >= 3),
of_lang AS (SELECT lang, sum(n)::BIGINT AS total, count(*) AS v FROM kept GROUP BY lang),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS in_lang
  FROM grp g JOIN kept k USING (lang) LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
of_group AS (SELECT lang, source, sum(n)::BIGINT AS total FROM dense GROUP BY ALL),
shares AS (
  SELECT d.lang, d.source, d.term, d.n, 1 + 1000000000 * (d.n + 1) // (g.total + l.v) AS p, 1 + 1000000000 * (d.in_lang + 1) // (l.total + l.v) AS q
  FROM dense d JOIN of_group g ON g.lang = d.lang AND g.source = d.source JOIN of_lang l ON l.lang = d.lang),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
own AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM own))
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200"""

_CONTAMINATION = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
part AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS words
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
place AS (
  SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, (SELECT DISTINCT size FROM part))),
met AS (SELECT r, i, size, item FROM place JOIN part USING (size, words)),
hit AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + size)) AS place FROM met) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM met GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN items USING (r)"""

ORACLE: dict[str, str] = {
    "op4_warc": _WARC,
    "op5_quality_rules": _QUALITY,
    "op11_source_divergence": _DIVERGENCE,
    "op13_decontamination": _CONTAMINATION,
}
