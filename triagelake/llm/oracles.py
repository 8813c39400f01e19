"""DuckDB SQL for the queries it can express, written apart from the operators."""

ORACLES: dict[str, str] = {}

# Runs of 50 words: every line pair is a candidate start and end, the shortest are kept.
LINE_DEDUP = """
WITH raw AS (
  SELECT doc_id, string_split(coalesce({text}, ''), chr(10)) AS ls FROM {source}
), l AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS no FROM raw
), worded AS (
  SELECT doc_id, no, line, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS p,
    len(list_filter(string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS w
  FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), summed AS (
  SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY p) AS s FROM worded
), spans AS (
  SELECT a.doc_id, a.p AS i, b.p AS e, a.no AS first, b.no AS last, b.s - a.s + a.w AS words, a.w AS w0, b.w AS w1
  FROM summed a JOIN summed b ON a.doc_id = b.doc_id AND b.p BETWEEN a.p AND a.p + 49
), shortest AS (
  SELECT DISTINCT doc_id, i, e, first, last FROM spans
  WHERE words >= 50 AND (words - w1 < 50 OR words - w0 < 50)
), content AS (
  SELECT s.doc_id, s.first, s.last, list(x.line ORDER BY x.p) AS lines
  FROM shortest s JOIN worded x ON s.doc_id = x.doc_id AND x.p BETWEEN s.i AND s.e
  GROUP BY s.doc_id, s.i, s.e, s.first, s.last
), later AS (
  SELECT doc_id, first, last, row_number() OVER (PARTITION BY lines ORDER BY doc_id, first) AS r FROM content
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS no FROM later WHERE r > 1
)
SELECT l.doc_id, count(*) AS n_lines, count(g.no) AS n_removed,
  coalesce(string_agg(l.line, chr(10) ORDER BY l.no) FILTER (g.no IS NULL), '') AS text
FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.no = g.no
GROUP BY l.doc_id
"""
ORACLES["op2_line_dedup"] = LINE_DEDUP.format(text="text", source="documents")

# Counts and verdict of the quality rules; {columns} picks what is returned.
QUALITY = """
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents
), grams AS (
  SELECT doc_id, i, list_aggregate(ws[i:i+4], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id
), counts AS (
  SELECT d.doc_id, lang, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (length(t) - length(regexp_replace(t, '\\p{Lu}', '', 'g')))::BIGINT AS n_capitals,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id
), base AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
), v AS (
  SELECT doc_id, lang, base_failed,
    CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS symbols,
    CASE WHEN word_chars > 0 THEN n_capitals / word_chars ELSE 0 END AS capitals,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_lines,
    CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeats
  FROM base
), q AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), cuts(t, c1, c2, c3, c4) AS (VALUES
  (0, 0.9::DOUBLE, 0.95::DOUBLE, 0.95::DOUBLE, 0.2::DOUBLE), (1, 0.7, 0.9, 0.9, 0.195), (2, 0.5, 0.85, 0.85, 0.19),
  (3, 0.4, 0.8, 0.8, 0.185), (4, 0.3, 0.75, 0.75, 0.18), (5, 0.25, 0.7, 0.7, 0.175), (6, 0.2, 0.65, 0.65, 0.17),
  (7, 0.15, 0.6, 0.6, 0.165), (8, 0.1, 0.55, 0.55, 0.16), (9, 0.075, 0.5, 0.5, 0.155), (10, 0.05, 0.45, 0.45, 0.15),
  (11, 0.03, 0.4, 0.4, 0.145), (12, 0.02, 0.35, 0.35, 0.14)
), hit AS (
  SELECT v.*, t, symbols >= c1 OR capitals >= c2 OR dup_lines >= c3 OR repeats >= c4 AS x FROM v, cuts
), steps AS (
  SELECT lang, t, count(*) FILTER (quality > 0) AS n, count(*) FILTER (quality > 0 AND x) AS k,
    count(*) FILTER (quality <= 0 AND x) AS bad
  FROM hit JOIN q USING (doc_id) WHERE NOT base_failed GROUP BY lang, t
), tests AS (
  SELECT *, CASE WHEN k >= n * 0.02 THEN false ELSE list_sum(list_transform(range(0, k + 1), lambda j:
      exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.02) + (n - j) * ln(0.98))))
    <= 0.05 / (SELECT count(DISTINCT coalesce(lang, '')) FROM steps) END AS ok FROM steps
), chain AS (SELECT *, bool_and(ok) OVER (PARTITION BY lang ORDER BY t) AS passes FROM tests
), best AS (
  SELECT lang, t FROM chain WHERE passes AND bad > k QUALIFY row_number() OVER (PARTITION BY lang ORDER BY bad - k DESC, t) = 1
), rejects AS (
  SELECT DISTINCT hit.doc_id FROM hit JOIN best b ON hit.lang IS NOT DISTINCT FROM b.lang AND hit.t = b.t AND x
)
SELECT {columns} FROM base LEFT JOIN rejects r ON base.doc_id = r.doc_id
"""
ORACLES["op9_quality_rules"] = QUALITY.replace(
    "{columns}", "base.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, "
    "NOT base_failed AND r.doc_id IS NULL AS kept")

# Near-duplicate components: shared shingles give intersections, labels spread to a fixed point.
ORACLES["op10_minhash_near_dedup"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * shared >= 75 * (x.n + y.n - shared)
), ends AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(a, b) AS (SELECT a, b FROM ends UNION SELECT r.a, e.b FROM reach r JOIN ends e ON r.b = e.a
), c AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(c.b, w.doc_id)) AS component_id,
  w.doc_id <= coalesce(c.b, w.doc_id) AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN c ON w.doc_id = c.a
"""

ORACLES["op6_decontamination"] = """
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents
), b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM benchmark
), runs AS (
  SELECT DISTINCT item_id, array_to_string(ws[i:i+9], ' ') AS g, least(len(ws), 10) AS n
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT n FROM runs
), places AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i+n-1], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n)
), hits AS (SELECT doc_id, i, p.n, item_id FROM places p JOIN runs r ON p.g = r.g AND p.n = r.n
), words AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(w.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
  sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(w.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words w ON d.doc_id = w.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id
"""

ORACLES["op13_ranked_search"] = """
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents
), worded AS (
  SELECT doc_id, r, ws, len(ws)::BIGINT AS n FROM words WHERE len(ws) > 0
), corpus AS (
  SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS l FROM worded
), tf AS (
  SELECT doc_id, r, n, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, r, n, unnest(ws) AS t FROM worded) GROUP BY ALL
), df AS (
  SELECT t, count(*)::BIGINT AS df FROM tf GROUP BY t
), weight AS (
  SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, corpus
), item AS (
  SELECT DISTINCT item_id, unnest(list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')) AS t FROM benchmark
), scored AS (
  SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // l))))::BIGINT AS score
  FROM item JOIN tf USING (t) JOIN weight USING (t), corpus GROUP BY item_id, doc_id, r
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""
