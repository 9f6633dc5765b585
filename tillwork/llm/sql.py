"""The same rows in SQL, for the queries that SQL can express."""

ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), {ASCII}), '{pattern}')"


SPACED, ALNUM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Transitive closure of links (a, b) to the smallest id that each end reaches.
REACH = """reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
  low AS (SELECT a, least(a, min(b)) AS component FROM reach GROUP BY 1)"""

LINE_DEDUP = rf"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
    FROM documents),
  sets AS (SELECT doc_id, line_no, list_sort(list_distinct({words('line', SPACED)})) AS w FROM lines),
  full_ AS (SELECT *, len(w) AS n, row_number() OVER (ORDER BY doc_id, line_no) AS p FROM sets WHERE len(w) > 0),
  token AS (SELECT p, n, unnest(w) AS t FROM full_),
  often AS (SELECT t, count(*) AS c FROM token GROUP BY 1),
  ranked AS (SELECT p, n, t, row_number() OVER (PARTITION BY p ORDER BY c, t) AS r FROM token JOIN often USING (t)),
  lead_ AS (SELECT p, n, t FROM ranked WHERE r <= n - ceil(0.8 * n) + 1),
  pairs AS (SELECT DISTINCT a.p AS p, b.p AS q FROM lead_ a JOIN lead_ b ON a.t = b.t AND b.p < a.p AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
  found AS (SELECT p, x.w = y.w AS same FROM pairs JOIN full_ x USING (p) JOIN full_ y ON y.p = q
    WHERE 100 * len(list_intersect(x.w, y.w)) >= 80 * (x.n + y.n - len(list_intersect(x.w, y.w))))
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(n AS INTEGER) AS n_words, bool_or(same) AS exact FROM found JOIN full_ USING (p) GROUP BY ALL"""

_WINDOWS = "list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(list_slice(w, i, i + m - 1), ' '))"
DECONTAMINATE = rf"""WITH d AS (SELECT doc_id, {words('text', ALNUM)} AS w FROM documents),
  b AS (SELECT item_id, {words('text', ALNUM)} AS w, least(10, len(w)) AS m FROM benchmark),
  bw AS (SELECT DISTINCT item_id, m, unnest({_WINDOWS}) AS g FROM b WHERE len(w) > 0),
  dm AS (SELECT doc_id, w, m FROM d, (SELECT DISTINCT m FROM bw)),
  dw AS (SELECT doc_id, m, unnest({_WINDOWS}) AS g, unnest(range(1, len(w) - m + 2)) AS i FROM dm WHERE len(w) >= m),
  hit AS (SELECT doc_id, i, m, item_id FROM dw JOIN bw USING (g, m)),
  nh AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS q FROM hit) GROUP BY 1),
  ni AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS h
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(h, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN nh USING (doc_id) LEFT JOIN ni USING (doc_id)"""

MINHASH = rf"""WITH RECURSIVE d AS (SELECT doc_id, {words('text', SPACED)} AS w FROM documents),
  s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS s FROM d),
  x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
  links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
  {REACH}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id,
  coalesce(component, doc_id) = doc_id AS kept FROM s LEFT JOIN low ON a = doc_id"""

EMBEDDINGS = rf"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
  many AS (SELECT a, count(*) AS n FROM links GROUP BY 1),
  {REACH}
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN many ON many.a = vec_id LEFT JOIN low ON low.a = vec_id"""

FILTER_AUDIT = r"""WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  first_ AS (SELECT text, min(doc_id) AS first_id FROM t GROUP BY 1),
  lab AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY 1),
  d AS (SELECT t.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x
      WHEN 'A' THEN len(w) < 200
      WHEN 'B' THEN 100 * len(list_distinct(w)) < 50 * len(w)
      WHEN 'C' THEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text)
      WHEN 'D' THEN regexp_matches(text, '[#$%&*|]')
      ELSE coalesce(first_id < t.doc_id, false) END) AS fails
    FROM t JOIN first_ USING (text) LEFT JOIN lab ON lab.doc_id = t.doc_id),
  l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
  orders AS (SELECT a.x || b.x || c.x || e.x || f.x AS filter_order FROM l a, l b, l c, l e, l f
    WHERE len(list_distinct([a.x, b.x, c.x, e.x, f.x])) = 5),
  steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS one,
    string_split(filter_order[1:step - 1], '') AS before FROM orders, (SELECT unnest(range(1, 6)) AS step)),
  masks AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM d GROUP BY ALL),
  now AS (SELECT part, filter_order, step, one,
    sum(n) FILTER (NOT list_has_any(fails, before) AND NOT list_contains(fails, one)) AS kept,
    sum(n) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, one)) AS removed,
    sum(n) FILTER (list_has_any(fails, before) AND list_contains(fails, one)) AS redundant,
    sum(n) FILTER (fails = [one]) AS unique_fails,
    sum(g) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, one)) AS good_lost,
    sum(x) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, one)) AS toxic_lost
    FROM masks, steps GROUP BY ALL)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, one), 0) AS BIGINT) AS shapley FROM now"""

QUALITY_RULES = r"""WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
  g AS (SELECT r, unnest(list_transform(range(1, len(w) - 1), lambda i: {'i': i, 'g': w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]}), recursive := true) FROM t),
  rep AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS q
    FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1) GROUP BY 1),
  m AS (SELECT r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words FROM t LEFT JOIN rep USING (r)),
  v AS (SELECT r, lang, source, rule, CASE rule WHEN 'word_length' THEN 1000 * word_chars // n_words WHEN 'symbols' THEN 10000 * n_symbols // n_words
      WHEN 'repeated_lines' THEN 10000 * n_dup_lines // n_words ELSE 10000 * n_repeat_words // n_words END AS v
    FROM m, (SELECT unnest(['word_length', 'symbols', 'repeated_lines', 'repeated_words']) AS rule) WHERE n_words > 0),
  e AS (SELECT *, greatest(length(bin(v)) - 7, 0) AS e FROM v),
  b AS (SELECT lang, source, rule, 64 * e + (v >> e) AS b, CASE WHEN e = 0 THEN v ELSE (((v >> e) + 1) << e) - 1 END AS top FROM e),
  levels AS (SELECT 0 AS wide, lang, source, rule, b, top FROM b UNION ALL SELECT 1, lang, NULL, rule, b, top FROM b UNION ALL SELECT 2, NULL, NULL, rule, b, top FROM b),
  ranked AS (SELECT wide, lang, source, rule, top, row_number() OVER p AS upto, count(*) OVER (PARTITION BY wide, lang, source, rule) AS n
    FROM levels WINDOW p AS (PARTITION BY wide, lang, source, rule ORDER BY b)),
  q AS (SELECT wide, lang, source, rule, n, min(top) FILTER (4 * upto >= n) AS q1, min(top) FILTER (4 * upto >= 3 * n) AS q3 FROM ranked GROUP BY ALL),
  f AS (SELECT wide, lang, source, rule, n, CASE WHEN rule = 'word_length' THEN q1 - 3 * (q3 - q1) - 500 END AS low,
    q3 + 3 * (q3 - q1) + CASE rule WHEN 'word_length' THEN 500 WHEN 'symbols' THEN 1000 WHEN 'repeated_lines' THEN 500 ELSE 4000 END AS high FROM q),
  own AS (SELECT a.lang, a.source, a.rule, CASE WHEN a.n >= 100 THEN a.low WHEN l.n >= 100 THEN l.low ELSE o.low END AS low,
    CASE WHEN a.n >= 100 THEN a.high WHEN l.n >= 100 THEN l.high ELSE o.high END AS high
    FROM f a JOIN f l ON l.wide = 1 AND l.rule = a.rule AND l.lang IS NOT DISTINCT FROM a.lang JOIN f o ON o.wide = 2 AND o.rule = a.rule WHERE a.wide = 0),
  bad AS (SELECT DISTINCT r FROM v JOIN own ON own.rule = v.rule AND own.lang IS NOT DISTINCT FROM v.lang AND own.source IS NOT DISTINCT FROM v.source
    WHERE v > high OR v < low)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND bad.r IS NULL AS kept FROM m LEFT JOIN bad USING (r)"""

#: crc32 of the decimal id: each byte, then eight shifts (the -1), over the reflected polynomial.
PREFIX_TRIE = r"""WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL),
  s AS (SELECT c, count(*) AS own, c - c % 5 AS base,
    xor(list_reduce([4294967295] || flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 9 AS h FROM t GROUP BY 1),
  g AS (SELECT s.*, least(s.h, coalesce(b.own, 0)) AS given FROM s LEFT JOIN s b ON b.c = s.base),
  r AS (SELECT g.c, place AS d, role, text FROM g JOIN t ON t.c = g.base AND place <= given
    UNION ALL SELECT g.c, given + place - h, role, text FROM g JOIN t USING (c) WHERE place > h),
  m AS (SELECT c, d, strlen(text) AS bytes, sha256(string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d)) AS p FROM r
    UNION ALL SELECT c, 0, 0, 'root' FROM g),
  up AS (SELECT *, lag(p) OVER (PARTITION BY c ORDER BY d) AS above, lead(p) OVER (PARTITION BY c ORDER BY d) IS NULL AS is_end FROM m),
  n AS (SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, any_value(above) AS above, (count(*) - 1) * any_value(bytes) AS weight,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (is_end), '')) AS ends_sha256 FROM up GROUP BY 1, 2),
  kids AS (SELECT d - 1 AS d, above AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
  w AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (d, p)),
  tot AS (SELECT m.d, m.p, sum(weight) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM w JOIN m ON m.c = w.conv_id AND m.d <= w.d GROUP BY 1, 2)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, a.conv_id AS parent_conv_id, w.n_convs, CAST(w.n_children AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM w JOIN tot USING (d, p) LEFT JOIN n a ON a.d = w.d - 1 AND a.p = w.above"""
