"""DuckDB SQL for the queries that SQL can express."""

# Fixed value: words between the blanks 0x20 and 0x09 to 0x0D.
WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

QUALITY_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {WORDS} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
           FROM documents),
win AS (SELECT r, i, [w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]] AS g
        FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest([0, 1, 2, 3, 4]) AS j) GROUP BY r),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             len(list_filter(w, lambda x: list_contains({{stops}}, lower(x)))) AS n_stops, len(l) AS n_lines,
             len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letters,
             len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*\z'))) AS n_ellipses,
             len(list_filter(l, lambda x: regexp_extract(x, '\A[\x20\x09-\x0D]*([^\x20\x09-\x0D])', 1) IN ({{bullets}}))) AS n_bullets
      FROM d LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND coalesce(word_chars / n_words BETWEEN 1.5 AND 25 AND n_symbols / n_words <= 0.1
                      AND n_stops / n_words >= 0.01 AND n_stops >= 2 AND n_dup_lines / n_lines <= 0.5
                      AND n_ellipses / n_lines <= 0.3 AND n_bullets / n_lines <= 0.9
                      AND n_letters / n_words >= 0.5 AND n_words <= 100000, true) AS kept
FROM m
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
      FROM s a JOIN shared USING (g) JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)),
two AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.node, two.b FROM reach JOIN two ON two.a = reach.seen)
SELECT node AS doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(seen) AS component_id, node = min(seen) AS kept
FROM reach LEFT JOIN n ON n.doc_id = node GROUP BY node, n.n
"""

LINE_DEDUP = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
h AS (SELECT doc_id, l, i, len(l) - 1 AS z, CAST('0x' || substr(md5(l[i + 1]), 1, 7) AS BIGINT) AS h
      FROM (SELECT doc_id, l, unnest(generate_series(0, len(l) - 1)) AS i FROM d WHERE text IS NOT NULL)),
r AS (SELECT *, (lag(h) OVER w * 31 + h) % 2147483647 AS before, (h * 31 + lead(h) OVER w) % 2147483647 AS after
      FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
b AS (SELECT doc_id, l, i, z,
             min(i) FILTER (WHERE i = z OR before % 4 <> 0) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ends,
             max(i) FILTER (WHERE i = 0 OR (after // 4) % 4 <> 0) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS begins
      FROM r),
c AS (SELECT doc_id, l, i AS x, least(ends, i + 15) AS y FROM b WHERE i < z
      UNION SELECT doc_id, l, greatest(begins, i - 15), i FROM b WHERE i > 0),
o AS (SELECT doc_id, x, y, (doc_id, x) <> min((doc_id, x)) OVER (PARTITION BY l[x + 1 : y + 1]) AS gone FROM c),
n AS (SELECT doc_id, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed FROM o GROUP BY doc_id),
g AS (SELECT DISTINCT doc_id, unnest(generate_series(x, y)) AS i FROM o WHERE gone),
t AS (SELECT h.doc_id, string_agg(l[h.i + 1], chr(10) ORDER BY h.i) FILTER (g.i IS NULL) AS text, count(*) AS n_lines, count(g.i) AS n_gone
      FROM h LEFT JOIN g ON g.doc_id = h.doc_id AND g.i = h.i GROUP BY h.doc_id)
SELECT d.doc_id, coalesce(t.text, CASE WHEN d.text IS NOT NULL THEN '' END) AS text, CAST(coalesce(n_lines, 0) AS INT) AS n_lines,
       CAST(coalesce(n_chunks, 0) AS INT) AS n_chunks, CAST(coalesce(n_removed, 0) AS INT) AS n_removed_chunks, CAST(coalesce(n_gone, 0) AS INT) AS n_removed_lines
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN n USING (doc_id)
"""

WARC = r"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
l AS (SELECT d, max(page_id) AS lead FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN lead <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN lead <> page_id THEN lead END AS refers_to
FROM p LEFT JOIN l USING (d)
"""

NEAR_VECTORS = r"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS x,
         vec_id IS NOT NULL AND len(embedding) > 0 AND list_bool_and([y IS NOT NULL AND isfinite(y) FOR y IN embedding])
           AND list_bool_or([y <> 0 FOR y IN embedding]) AS ok
  FROM embeddings),
links AS (SELECT a.r AS a, b.r AS b, b.vec_id FROM v a JOIN v b ON a.r <> b.r AND len(a.x) = len(b.x)
          WHERE a.ok AND b.ok AND list_cosine_similarity(a.x, b.x) >= 0.95),
reach(r, seen) AS (SELECT r, r FROM v UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.seen),
least AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = seen GROUP BY reach.r),
n AS (SELECT a AS r, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, component_id, coalesce(v.vec_id = component_id, true) AS kept
FROM v JOIN least USING (r) LEFT JOIN n USING (r)
"""

FILL_IN_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l,
                  sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, CAST(len(l) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(l) + 1) AS x,
             CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(l) + 1) AS y, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS z FROM d),
c AS (SELECT *, array_to_string(l[1 : least(x, y)], '') AS p, array_to_string(l[least(x, y) + 1 : greatest(x, y)], '') AS m,
             array_to_string(l[greatest(x, y) + 1 : n], '') AS s,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                  WHEN z < 50 THEN 'spm' ELSE 'psm' END AS form FROM u)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""
