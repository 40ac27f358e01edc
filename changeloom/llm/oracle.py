"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from changeloom.llm import licenses

# Spans of one kind: pieces between matches and matches give the positions.
_SPANS = """
  {kind}_hits AS (
    SELECT doc_id, n, regexp_extract_all(body, {pattern}, 0) AS hit, regexp_split_to_array(body, {pattern}) AS gap
    FROM body WHERE regexp_matches(body, {pattern})
  ),
  {kind}_spans AS (
    SELECT doc_id, n, {place} AS place, '{kind}' AS kind, word,
           list_sum([length(g) for g in gap[1:i]])::BIGINT + list_sum([length(h) for h in hit[1:i]])::BIGINT - length(word) AS a,
           list_sum([length(g) for g in gap[1:i]])::BIGINT + list_sum([length(h) for h in hit[1:i]])::BIGINT AS b
    FROM (SELECT doc_id, n, gap, hit, unnest(hit) AS word, generate_subscripts(hit, 1) AS i FROM {kind}_hits)
  )"""

_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
    "[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)

SECRETS = f"""
WITH body AS (SELECT doc_id, row_number() OVER () AS n, coalesce(text, '') AS body FROM documents),
{_SPANS.format(kind="assign", place=0, pattern=f"'{_ASSIGN}'")},
{_SPANS.format(kind="access", place=1, pattern="'AKIA[A-Z0-9]+'")},
{_SPANS.format(kind="hex", place=2, pattern="'[0-9a-f]+'")},
{_SPANS.format(kind="pem", place=3, pattern="'-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----'")},
{_SPANS.format(kind="github", place=4, pattern="'gh[pousr]_[A-Za-z0-9]{36,}'")},
spans AS (
  SELECT n, place, kind, a, b FROM assign_spans WHERE length(regexp_extract(word, '{_ASSIGN}', 2)) >= 6
  UNION ALL SELECT n, place, kind, a, b FROM access_spans WHERE length(word) >= 20
  UNION ALL SELECT n, place, kind, a, b FROM hex_spans WHERE length(word) >= 24
  UNION ALL SELECT n, place, kind, a, b FROM pem_spans
  UNION ALL SELECT n, place, kind, a, b FROM github_spans
),
listed AS (
  SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place) FILTER (place < 3) AS base,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place) AS spans
  FROM spans GROUP BY n
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM body LEFT JOIN listed USING (n)
"""

_NOTICES = ", ".join(f"('{label}', string_split('{text}', ' '))" for label, text in licenses.NOTICES)
_PHRASES = ", ".join(f"('{label}', string_split('{phrase}', ' '))" for phrase, label in licenses.PHRASES.items())

# Every phrase at every word, every notice in every one of its blocks.
LICENSES = f"""
WITH body AS (
  SELECT doc_id, row_number() OVER () AS n,
         regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
),
phrases(label, phrase) AS (VALUES {_PHRASES}),
notices(label, notice) AS (VALUES {_NOTICES}),
places AS (
  SELECT n, label, spot - 1 AS spot
  FROM (SELECT n, words, unnest(range(1, len(words) + 1)) AS spot FROM body) AS word, phrases
  WHERE words[spot] = phrase[1] AND words[spot:spot + len(phrase) - 1] = phrase
),
blocks AS (
  SELECT n, label, notice, words, unnest(range(0, len(words), len(notice))) AS spot FROM body, notices
),
met AS (
  SELECT n, label, len(list_intersect(words[spot + 1:spot + 2 * len(notice)], notice)) / len(list_distinct(notice)) AS share FROM blocks
),
more AS (SELECT n, label, share FROM met WHERE share >= {licenses.CONTAINMENT} - 1e-9),
labelled AS (SELECT n, label FROM places UNION SELECT n, label FROM more),
based AS (
  SELECT n, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM places GROUP BY n
),
total AS (SELECT n, string_agg(label, ',' ORDER BY label) AS labels FROM labelled GROUP BY n),
best AS (SELECT n, max(share) AS share FROM more GROUP BY n)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM body LEFT JOIN based USING (n) LEFT JOIN total USING (n) LEFT JOIN best USING (n)
"""

# CRC-32 goes byte by byte over all different features at once; its table comes from the polynomial.
RESAMPLED = f"""
WITH RECURSIVE shifted(code, step, v) AS (
  SELECT code, 0, code FROM range(256) AS r(code)
  UNION ALL
  SELECT code, step + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM shifted WHERE step < 8
),
crc_table AS (SELECT code, v FROM shifted WHERE step = 8),
body AS (SELECT 'd' AS side, row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents
         UNION ALL SELECT 'b', row_number() OVER (), NULL, coalesce(text, '') FROM benchmark),
cut AS (
  SELECT side, n, doc_id,
         regexp_extract_all(translate(text, '{licenses.UPPER}', '{licenses.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM body
),
word AS (SELECT side, n, words, unnest(range(1, len(words) + 1)) AS i FROM cut),
runs AS (
  SELECT side, n, array_to_string(words[i:i + k], ' ') AS feature FROM word, range(3) AS r(k) WHERE i + k <= len(words)
),
counted AS (SELECT side, n, feature, count(*) AS c FROM runs GROUP BY ALL),
different AS (SELECT feature, hex(encode(feature)) AS h, octet_length(encode(feature)) AS size FROM (SELECT DISTINCT feature FROM counted)),
crc(feature, h, size, k, c) AS (
  SELECT feature, h, size, 0, 4294967295 FROM different
  UNION ALL
  SELECT feature, h, size, k + 1, xor(c // 256, v)
  FROM crc JOIN crc_table ON code = xor(c % 256, ('0x' || substr(h, 2 * k + 1, 2))::BIGINT)
  WHERE k < size
),
bucket AS (SELECT feature, xor(c, 4294967295) % 10000 AS b FROM crc WHERE k = size),
placed AS (SELECT side, n, b, sum(c)::BIGINT AS c FROM counted JOIN bucket USING (feature) GROUP BY ALL),
shares AS (
  SELECT b, coalesce(sum(c) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(c) FILTER (side = 'b'), 0)::DOUBLE AS t FROM placed GROUP BY b
),
total AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM shares),
gain AS (SELECT b, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS g FROM shares, total),
weight AS (SELECT n, sum(c)::BIGINT AS n_features, sum(c * g)::BIGINT AS weight FROM placed JOIN gain USING (b) WHERE side = 'd' GROUP BY n),
scored AS (
  SELECT n, doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                   / 4294967296::DOUBLE)))::BIGINT AS score
  FROM cut LEFT JOIN weight USING (n) WHERE side = 'd'
),
placed_rows AS (
  SELECT n, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS able FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * able // 100 THEN place END AS rank
FROM scored LEFT JOIN placed_rows USING (n)
"""

ORACLE_SQL = {"op1_secret_scan": SECRETS, "op11_resample": RESAMPLED, "op13_license_scan": LICENSES}
