"""SQL (DuckDB) of the queries that SQL can express."""

WORDS = r"[x FOR x IN regexp_split_to_array(text, '[\x09-\x0D ]+') IF x <> '']"

TOP_K = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
)
SELECT query_id,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

FILTER_AUDIT = f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), counted AS (
  SELECT *, {WORDS} AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM docs
), failed AS (
  SELECT doc_id, part,
    CAST(len(words) < 100 AS INT)
    + 2 * CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INT)
    + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text) AS INT)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
    + 16 * CAST(coalesce(doc_id > first, false) AS INT) AS mask
  FROM counted
), marks AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good,
    coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), filters AS (
  SELECT substr('ABCDE', i + 1, 1) AS f, 1 << i AS bit FROM range(5) t(i)
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM filters a, filters b, filters c, filters d, filters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, CAST(step AS INT) AS step, bits[step] AS own,
    coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS before
  FROM orders, range(1, 6) t(step)
), summed AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN mask & (before | own) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & own > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed
"""

LINE_RULES = fr"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), worded AS (
  SELECT *, {WORDS} AS words,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x09-\x0D ]')] AS held
  FROM docs
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, words[i:i + 4]) AS n
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM worded)
), repeated AS (
  SELECT r, count(DISTINCT i + k) AS n FROM windows, range(5) t(k) WHERE n > 1 GROUP BY r
), base AS (
  SELECT r, doc_id, source, held, len(words) AS n_words,
    length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(held) - len(list_distinct(held)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5(text)) AS document
  FROM worded LEFT JOIN repeated USING (r)
), plain AS (
  SELECT r, source, document, x AS line, trim(regexp_replace(
    regexp_replace(lower(x), '[0-9]+', '0', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'
  )) AS p
  FROM (SELECT r, source, document, unnest(held) AS x FROM base)
), lines AS (
  SELECT r, source, document, CASE WHEN p = '' THEN line ELSE p END AS l,
    len([x FOR x IN regexp_split_to_array(line, '[\x09-\x0D ]+') IF x <> '']) AS w
  FROM plain
), hosts AS (
  SELECT source, count(DISTINCT document) AS of FROM base GROUP BY source
), frequent AS (
  SELECT t.source, l FROM (
    SELECT source, l, count(DISTINCT document) AS documents FROM lines GROUP BY source, l
  ) t JOIN hosts h ON t.source IS NOT DISTINCT FROM h.source
  WHERE documents > 10 AND documents > h.of * 0.01
), lost AS (
  SELECT r, sum(w) AS lost, count(DISTINCT lines.l) AS gone
  FROM lines JOIN frequent f ON lines.l = f.l AND lines.source IS NOT DISTINCT FROM f.source
  GROUP BY r
), judged AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    coalesce(gone, 0) AS n_lines_removed, CAST(n_words - coalesce(lost, 0) AS BIGINT) AS n_words_left,
    n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed
  FROM base LEFT JOIN lost USING (r)
)
SELECT *, NOT base_failed AND n_words_left >= 10 AND n_words_left >= n_words * 0.5 AS kept FROM judged
"""

_FIELDS = "concat({})".format(", ".join(
    f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    for c in ("doc_id", "source", "lang", "{n}", "text")
))
MANIFEST = f"""
WITH RECURSIVE hashed AS (
  SELECT lang, doc_id, sha256({_FIELDS.replace("{n}", "n_chars")}) AS leaf,
    sha256({_FIELDS.replace("{n}", "(n_chars + 1)")}) AS changed,
    xor(list_reduce(
      [4294967295] || flatten([
        [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]
        FOR c IN string_split(CAST(doc_id AS VARCHAR), '')
      ]),
      lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) ELSE xor(c >> 1, (c & 1) * 3988292384) END
    ), 4294967295) AS crc
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n
  FROM hashed
), nodes AS (
  SELECT lang, 0 AS lvl, i, leaf AS h, n FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY lang, lvl, i // 2, n
), langs AS (
  SELECT lang, h, lvl AS height, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i,
    count(*) OVER () AS n
  FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS lvl, i, h, n FROM langs
  UNION ALL
  SELECT lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2
  FROM upper WHERE n > 1 GROUP BY lvl, i // 2, n
), top AS (
  SELECT h AS root, lvl AS height FROM upper WHERE n = 1
), above AS (
  SELECT l.lang, list(CASE WHEN u.h IS NULL THEN '' WHEN (l.i >> s.lvl) & 1 = 0 THEN 'R' || u.h
    ELSE 'L' || u.h END ORDER BY s.lvl) AS path
  FROM langs l, (SELECT unnest(range(height)) AS lvl FROM top) s
  LEFT JOIN upper u ON u.lvl = s.lvl AND u.i = xor(l.i >> s.lvl, 1) GROUP BY l.lang
), beside AS (
  SELECT t.lang, t.i, list(CASE WHEN o.h IS NULL THEN '' WHEN (t.i >> t.lvl) & 1 = 0 THEN 'R' || o.h
    ELSE 'L' || o.h END ORDER BY t.lvl) AS path
  FROM (
    SELECT v.lang, v.i, unnest(range(g.height)) AS lvl
    FROM leaves v JOIN langs g ON v.lang IS NOT DISTINCT FROM g.lang
  ) t LEFT JOIN nodes o
    ON o.lang IS NOT DISTINCT FROM t.lang AND o.lvl = t.lvl AND o.i = xor(t.i >> t.lvl, 1)
  GROUP BY t.lang, t.i
), proofs AS (
  SELECT v.doc_id, v.leaf, g.h AS subroot, top.root,
    coalesce(b.path, []) || coalesce(a.path, []) AS path,
    CASE WHEN crc % 7 = 0 AND changed IS NOT NULL THEN changed ELSE leaf END AS start
  FROM leaves v CROSS JOIN top
  JOIN langs g ON v.lang IS NOT DISTINCT FROM g.lang
  LEFT JOIN beside b ON b.lang IS NOT DISTINCT FROM v.lang AND b.i = v.i
  LEFT JOIN above a ON a.lang IS NOT DISTINCT FROM v.lang
), folded AS (
  SELECT *, list_reduce([start] || path, lambda x, e: CASE WHEN e = '' THEN sha256(x)
    WHEN e[1] = 'L' THEN sha256(e[2:] || x) ELSE sha256(x || e[2:]) END) AS folded_root
  FROM proofs
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string([e[2:] FOR e IN path], '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM folded
"""

TWINS = {
    "op9_top_k": TOP_K,
    "op11_filter_audit": FILTER_AUDIT,
    "op12_line_rules": LINE_RULES,
    "op13_manifest": MANIFEST,
}
