"""SQL (DuckDB) for the queries that SQL can express."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

HOST_RULES = rf"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS text, {WORDS} AS w FROM documents
), lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)),
    lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words
), starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3
), grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM starts
), spots AS (
  SELECT DISTINCT doc_id, i + k AS at FROM grams, range(3) AS r(k) WHERE n > 1
), repeated AS (
  SELECT doc_id, count(*) AS n_repeat_words FROM spots GROUP BY doc_id
), m AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM words JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)
), rules AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
      OR word_chars < 3 * n_words OR word_chars > 10 * n_words AS soft_failed
  FROM m
), hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed OR soft_failed) AS f
  FROM rules WHERE source IS NOT NULL GROUP BY source
), prior AS (
  SELECT sum(f) / sum(n) AS m, avg((f / n) * (f / n)) AS q, avg(f / n) AS p FROM hosts
), fitted AS (
  SELECT m, q - 2 * p * m + m * m AS v FROM prior
), shrunk AS (
  SELECT source, CASE WHEN v <= 1e-12 THEN m ELSE
    (f + m * greatest(1.0, m * (1 - m) / v - 1)) / (n + greatest(1.0, m * (1 - m) / v - 1)) END AS rate
  FROM hosts, fitted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (coalesce(rate > 0.5, false) AND soft_failed) AS kept
FROM rules LEFT JOIN shrunk USING (source)
"""

DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size,
    array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size
), hits AS (
  SELECT doc_id, i, p.size, item_id
  FROM places p JOIN windows x ON x.size = p.size AND x.gram = array_to_string(w[i : i + p.size - 1], ' ')
), spots AS (
  SELECT DISTINCT doc_id, i + k AS at FROM hits, range(13) AS r(k) WHERE k < size
), n AS (
  SELECT doc_id, count(*) AS n_hit FROM spots GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN items USING (doc_id)
"""

REVISITS = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), o AS (
  SELECT payload_digest, max(page_id) AS original FROM p GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to
FROM p JOIN o USING (payload_digest)
"""

FILTER_AUDIT = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {WORDS} AS w FROM documents
), fails AS (
  SELECT doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM w
), marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, [a, b, c, d, e] AS bad, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    count(*) AS n
  FROM fails LEFT JOIN marks USING (doc_id) GROUP BY ALL
), orders AS (
  SELECT '' AS o UNION ALL
  SELECT o || x FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS v(x) WHERE NOT contains(o, x)
), steps AS (
  SELECT o, k, ascii(o[k]) - 64 AS own, [ascii(x) - 64 FOR x IN string_split(o[1 : k - 1], '') IF x <> ''] AS before
  FROM orders, range(1, 6) AS r(k) WHERE length(o) = 5
), m AS (
  SELECT part, o, k, own, n, good, toxic, bad[own] AS here,
    len([1 FOR x IN before IF bad[x]]) > 0 AS gone, len([1 FOR x IN bad IF x]) = 1 AS once
  FROM steps, f
), found AS (
  SELECT part, o AS filter_order, CAST(k AS INTEGER) AS step, own,
    CAST(coalesce(sum(n) FILTER (NOT gone AND NOT here), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (NOT gone AND here), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (gone AND here), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (here AND once), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n) FILTER (NOT gone AND here AND good), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(n) FILTER (NOT gone AND here AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM m GROUP BY part, o, k, own
)
SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM found
"""


def counted(column: str) -> str:
    """A field as the manifest hashes it."""
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


MERKLE = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {counted('lang')} AS tree,
    {counted('doc_id')} || {counted('source')} || {counted('lang')} AS head, {counted('text')} AS tail,
    CAST(n_chars AS HUGEINT) AS n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      [CAST(ascii(x) AS BIGINT) FOR x IN string_split(coalesce(CAST(doc_id AS VARCHAR), ''), '') IF x <> '']),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) AS crc
  FROM documents
), leaves AS (
  SELECT *, sha256(head || {counted('n')} || tail) AS leaf,
    CASE WHEN crc % 7 = 0 THEN sha256(head || {counted('(n + 1)')} || tail)
      ELSE sha256(head || {counted('n')} || tail) END AS claimed
  FROM d
), places AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), levels AS (
  SELECT tree, lang, 0 AS h, list(leaf ORDER BY pos) AS l FROM places GROUP BY tree, lang
  UNION ALL
  SELECT tree, lang, h + 1, [sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], '')) FOR i IN range((len(l) + 1) // 2)]
  FROM levels WHERE len(l) > 1
), subroots AS (
  SELECT tree, l[1] AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS rank
  FROM levels WHERE len(l) = 1
), top AS (
  SELECT 0 AS h, list(subroot ORDER BY rank) AS l FROM subroots
  UNION ALL
  SELECT h + 1, [sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], '')) FOR i IN range((len(l) + 1) // 2)]
  FROM top WHERE len(l) > 1
), steps AS (
  SELECT tree, pos, 0 AS part, h, pos >> h AS spot, l FROM places JOIN levels USING (tree) WHERE len(l) > 1
  UNION ALL
  SELECT tree, pos, 1, h, rank >> h, l FROM places JOIN subroots USING (tree), top WHERE len(l) > 1
), proofs AS (
  SELECT tree, pos, list(CASE WHEN spot % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(l[xor(spot, 1) + 1], '')
    ORDER BY part, h) AS p FROM steps GROUP BY tree, pos
), found AS (
  SELECT doc_id, leaf, subroot, (SELECT l[1] FROM top WHERE len(l) = 1) AS root,
    sha256(array_to_string([x[2:] FOR x IN coalesce(p, [])], '')) AS proof_sha256,
    list_reduce(list_prepend(claimed, coalesce(p, [])),
      lambda a, x: sha256(CASE WHEN x[1] = 'L' THEN x[2:] || a ELSE a || x[2:] END)) AS folded_root
  FROM places JOIN subroots USING (tree) LEFT JOIN proofs USING (tree, pos)
)
SELECT *, folded_root = root AS verified FROM found
"""
