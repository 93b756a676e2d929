"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS text, {_WORDS} AS w FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS times
  FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d))
), repeats AS (
  SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM windows WHERE times > 1) GROUP BY doc_id
), raw_lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM raw_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), lines AS (
  SELECT DISTINCT d.doc_id, host, text, trim(regexp_replace(regexp_replace(lower(line), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g')) AS line
  FROM raw_lines JOIN d USING (doc_id)
), distinct_lines AS (
  SELECT host, text, line, len(string_split(line, ' ')) AS n, min(doc_id) AS first_id FROM lines WHERE line <> '' GROUP BY host, text, line
), often AS (
  SELECT host, line, min_by(text, first_id) AS keeper FROM distinct_lines GROUP BY host, line HAVING count(*) > 20
), shares AS (
  SELECT l.host, l.text, sum(CASE WHEN o.line IS NOT NULL AND o.keeper <> l.text THEN n ELSE 0 END) AS lost, sum(n) AS total
  FROM distinct_lines l LEFT JOIN often o ON o.host = l.host AND o.line = l.line GROUP BY l.host, l.text
), base AS (
  SELECT d.doc_id, d.host, d.text, len(w) AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN repeats USING (doc_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(lost > 0.8 * total, false) AS kept
FROM judged LEFT JOIN shares USING (host, text)
"""

DEDUP = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), roots AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM roots LEFT JOIN sizes USING (doc_id)
"""

REVISITS = r"""
WITH raw AS (
  SELECT page_id, url, page_id * 60 AS "at", md5(coalesce(html, '')) AS tag, sha1(coalesce(html, '')) AS digest,
    'day ' || (page_id // 1000)::VARCHAR AS changed,
    regexp_extract(regexp_replace(trim(url), '#.*$', ''), '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)\??(.*)$', ['scheme', 'host', 'path', 'query']) AS u
  FROM pages
), p AS (
  SELECT *, lower(u.scheme) || '://'
    || CASE lower(u.scheme) WHEN 'http' THEN regexp_replace(lower(u.host), ':80$', '') WHEN 'https' THEN regexp_replace(lower(u.host), ':443$', '') ELSE lower(u.host) END
    || CASE WHEN u.path = '' THEN '/' ELSE u.path END
    || CASE WHEN args = '' THEN '' ELSE '?' || args END AS canonical_url
  FROM (SELECT *, coalesce(array_to_string(list_sort(list_filter(string_split(u.query, '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_'))), '&'), '') AS args FROM raw)
), pairs AS (
  SELECT r.page_id, r.canonical_url, r."at" + 3600 AS "at", r.tag AS own_tag, r.changed AS own_changed, r.page_id % 4 AS role, f.page_id AS found, f."at" AS found_at, f.tag, f.changed, f.digest
  FROM p r JOIN p f ON f.canonical_url = r.canonical_url AND f."at" < r."at" + 3600
  QUALIFY row_number() OVER (PARTITION BY r.page_id ORDER BY f."at" DESC, f.page_id DESC) = 1
), s AS (
  SELECT *, CASE role WHEN 0 THEN CASE WHEN own_tag = tag THEN 'resolved' ELSE 'mismatch' END WHEN 1 THEN 'mismatch'
    WHEN 2 THEN CASE WHEN own_changed = changed THEN 'resolved' ELSE 'mismatch' END ELSE 'unchecked' END AS status FROM pairs
)
SELECT page_id * 2 + 1 AS record_id, canonical_url, "at", found * 2 AS response_id, found_at AS response_at, digest, status,
  CASE WHEN status = 'mismatch' THEN
    'content-type: text/plain' || chr(10) || 'date: ' || "at"
      || CASE role WHEN 0 THEN chr(10) || 'etag: W/"' || own_tag || '"' WHEN 1 THEN chr(10) || 'etag: "other"' ELSE '' END
      || chr(10) || 'expires: ' || ("at" + 60) || CASE role WHEN 2 THEN chr(10) || 'last-modified: ' || own_changed ELSE '' END
  ELSE
    'content-type: text/html' || chr(10) || 'date: ' || "at" || chr(10) || 'etag: ' || CASE role WHEN 0 THEN 'W/"' || own_tag || '"' ELSE '"' || tag || '"' END
      || chr(10) || 'expires: ' || ("at" + 60) || chr(10) || 'last-modified: ' || changed || chr(10) || 'server: one'
  END AS headers
FROM s
"""

#: crc32 byte by byte: the change that each value of a byte makes. A step needs ``texts (id, t)``.
_CRC = """
bits(k, v, s) AS (
  SELECT i, i, 0 FROM range(256) AS r(i)
  UNION ALL SELECT k, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, s + 1 FROM bits WHERE s < 8
), changes AS (
  SELECT k, v FROM bits WHERE s = 8
), bytes(t, x, i, v) AS (
  SELECT t, hex(encode(t)), 0, 4294967295 FROM texts
  UNION ALL
  SELECT t, x, i + 1, xor(b.v >> 8, c.v) FROM bytes b JOIN changes c ON c.k = xor(b.v, ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT) & 255
  WHERE i < strlen(t)
), crc AS (
  SELECT t, xor(v, 4294967295) AS h FROM bytes WHERE i = strlen(t)
)"""

TRIE = f"""
WITH RECURSIVE texts AS (
  SELECT DISTINCT conv_id::VARCHAR AS t FROM conversations WHERE conv_id IS NOT NULL
), {_CRC}, turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(md5(role || chr(1) || text) ORDER BY turn NULLS FIRST, role, text) AS x, list(strlen(text) ORDER BY turn NULLS FIRST, role, text) AS b
  FROM turns GROUP BY conv_id
), whole AS (
  SELECT o.conv_id, list_concat(coalesce(f.x, [])[1:h % 9], o.x[h % 9 + 1:]) AS x, list_concat(coalesce(f.b, [])[1:h % 9], o.b[h % 9 + 1:]) AS b
  FROM own o JOIN crc ON t = o.conv_id::VARCHAR LEFT JOIN own f ON f.conv_id = o.conv_id - o.conv_id % 5
), prefixes AS (
  SELECT conv_id, d, x[1:d] AS p, CASE WHEN d > 0 THEN b[d] ELSE 0 END AS last, d = len(x) AS ends
  FROM (SELECT *, unnest(range(0, len(x) + 1)) AS d FROM whole)
), nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(last) AS saved, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends) AS ids
  FROM prefixes GROUP BY p, d
), children AS (
  SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), known AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (p)
), subtrees AS (
  SELECT p[1:a] AS p, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM known) GROUP BY 1
)
SELECT k.conv_id, k.d AS depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
  sha256(coalesce(k.ids, '')) AS ends_sha256
FROM known k JOIN subtrees s ON s.p = k.p LEFT JOIN nodes u ON k.d > 0 AND u.p = k.p[1:k.d - 1]
"""

SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL
), texts AS (
  SELECT DISTINCT coalesce(doc_id::VARCHAR, '') || ':' || run AS t FROM runs WHERE length(run) >= 5
), {_CRC}, vocabulary AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, sum(n)::BIGINT AS n
  FROM runs JOIN crc ON t = coalesce(doc_id::VARCHAR, '') || ':' || run GROUP BY 1 HAVING sum(n) >= 3 AND length(word) >= 5
), gaps AS (
  SELECT word, n, word[1:i - 1] || '_' || word[i + 1:] AS gap FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
  UNION ALL
  SELECT word, n, word[1:i - 1] || '_' || word[i:] AS gap FROM (SELECT *, unnest(range(1, length(word) + 2)) AS i FROM vocabulary)
), near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b USING (gap) WHERE a.word <> b.word
), best AS (
  SELECT word, n, count(*) OVER (PARTITION BY word) AS n_near, other, other_n FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1
), forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form, CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)
), paths(word, seen) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT p.word, f.form FROM paths p JOIN forms f ON f.word = p.seen WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, p.seen AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN paths p ON p.word = f.word JOIN forms r ON r.word = p.seen AND r.form IS NULL
"""

ORACLES = {
    "op1_line_frequency": QUALITY,
    "op2_setsketch_dedup": DEDUP,
    "op8_revisit_resolution": REVISITS,
    "op11_hash_trie": TRIE,
    "op13_gram_spelling": SPELLING,
}
