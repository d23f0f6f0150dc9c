"""SQL for another engine, for the queries that SQL can state."""

OP7 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT row_id, [w FOR w IN string_split_regex(text, '[\x20\x09-\x0D]+') IF w <> ''] AS w FROM docs
), word_rows AS (
  SELECT row_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words
), windows AS (
  SELECT row_id, i, list(word) OVER (PARTITION BY row_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS win
  FROM word_rows
), starts AS (
  SELECT row_id, i FROM windows WHERE len(win) = 8
  QUALIFY count(*) OVER (PARTITION BY row_id, win) > 1
), steps AS (
  SELECT row_id, least(8, coalesce(lead(i) OVER (PARTITION BY row_id ORDER BY i) - i, 8)) AS step FROM starts
), repeats AS (
  SELECT row_id, CAST(sum(step) AS BIGINT) AS n_repeat_words FROM steps GROUP BY row_id
), lines AS (
  SELECT row_id, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS x FROM docs
), counted AS (
  SELECT d.row_id, d.doc_id, d.lang, d.source,
         CAST(len(w.w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(d.text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l.x) - len(list_distinct(l.x)) AS BIGINT) AS n_dup_lines,
         coalesce(r.n_repeat_words, 0) AS n_repeat_words,
         CAST(length(regexp_replace(d.text, '[^\p{Lu}]+', '', 'g')) AS BIGINT) AS n_upper
  FROM docs d JOIN words w USING (row_id) JOIN lines l USING (row_id) LEFT JOIN repeats r USING (row_id)
), long AS (
  SELECT row_id, lang, source, n_words, m.metric, m.value FROM (
    SELECT row_id, lang, source, n_words, unnest([
      {'metric': 'word_length', 'value': 1000 * word_chars // greatest(n_words, 1)},
      {'metric': 'symbol_share', 'value': 1000 * n_symbols // greatest(word_chars, 1)},
      {'metric': 'upper_share', 'value': 1000 * n_upper // greatest(word_chars, 1)},
      {'metric': 'dup_line_share', 'value': 1000 * n_dup_lines // greatest(n_words, 1)},
      {'metric': 'repeat_share', 'value': 1000 * n_repeat_words // greatest(n_words, 1)}]) AS m
    FROM counted)
), sketched AS (
  SELECT *, CASE WHEN value < 64 THEN value
                 ELSE (value // (1 << (length(bin(value)) - 6))) * (1 << (length(bin(value)) - 6)) END AS bucket
  FROM long WHERE n_words > 0
), of_group AS (
  SELECT lang, source, metric, bucket, count(*) AS n FROM sketched GROUP BY ALL
), of_lang AS (
  SELECT lang, metric, bucket, count(*) AS n FROM sketched GROUP BY ALL
), of_all AS (
  SELECT metric, bucket, count(*) AS n FROM sketched GROUP BY ALL
), mixed AS (
  SELECT g.lang, g.source, metric, a.bucket,
         sum(coalesce(o.n, 0)) OVER upto AS own, sum(coalesce(l.n, 0)) OVER upto AS of_lang, sum(a.n) OVER upto AS of_all,
         sum(coalesce(o.n, 0)) OVER whole AS own_n, sum(coalesce(l.n, 0)) OVER whole AS lang_n, sum(a.n) OVER whole AS all_n
  FROM (SELECT DISTINCT lang, source, metric FROM of_group) g
  JOIN of_all a USING (metric)
  LEFT JOIN of_group o ON o.metric = g.metric AND o.bucket = a.bucket AND o.lang IS NOT DISTINCT FROM g.lang
    AND o.source IS NOT DISTINCT FROM g.source
  LEFT JOIN of_lang l ON l.metric = g.metric AND l.bucket = a.bucket AND l.lang IS NOT DISTINCT FROM g.lang
  WINDOW upto AS (PARTITION BY g.lang, g.source, metric ORDER BY a.bucket),
         whole AS (PARTITION BY g.lang, g.source, metric)
), quartiles AS (
  SELECT lang, source, metric,
         min(bucket) FILTER (mass * 4 >= own_n + 50) AS q1, min(bucket) FILTER (mass * 4 >= 3 * (own_n + 50)) AS q3
  FROM (SELECT *, own + 50::DOUBLE * (of_lang + 50::DOUBLE * of_all / all_n) / (lang_n + 50) + 1e-6::DOUBLE AS mass FROM mixed)
  GROUP BY ALL
), slack(metric, slack, below) AS (
  VALUES ('word_length', 1500, true), ('symbol_share', 60, false), ('upper_share', 200, false),
         ('dup_line_share', 50, false), ('repeat_share', 250, false)
), chosen AS (
  SELECT lang, source, metric, slack, below, q1, q3 FROM quartiles JOIN slack USING (metric)
), outside AS (
  SELECT DISTINCT s.row_id FROM long s JOIN chosen c
    ON s.metric = c.metric AND s.lang IS NOT DISTINCT FROM c.lang AND s.source IS NOT DISTINCT FROM c.source
  WHERE s.value > c.q3 + 3 * (c.q3 - c.q1) + c.slack
     OR (c.below AND s.value < c.q1 - 3 * (c.q3 - c.q1) - c.slack)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND row_id NOT IN (SELECT row_id FROM outside) AS kept
FROM counted
"""

OP5 = r"""
WITH doc_rows AS (
  SELECT DISTINCT doc_id, text FROM documents
), docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         [w FOR w IN string_split_regex(spaced, '[^\p{L}\p{N}]+') IF w <> ''] AS w FROM (
    SELECT *, regexp_replace(lower(coalesce(text, '')), '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', ' \1 ', 'g') AS spaced FROM doc_rows)
), items AS (
  SELECT min(item_id) AS item_id, w FROM (
    SELECT item_id, [w FOR w IN string_split_regex(spaced, '[^\p{L}\p{N}]+') IF w <> ''] AS w
    FROM (SELECT item_id, regexp_replace(lower(coalesce(text, '')), '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', ' \1 ', 'g') AS spaced FROM benchmark))
  WHERE len(w) >= 1 GROUP BY w
), doc_words AS (
  SELECT row_id, doc_id, len(w) AS n_text, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs
), item_words AS (
  SELECT item_id, len(w) AS n_words, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM items
), aligned AS (
  SELECT row_id, doc_id, item_id, n_words, n_text, i - j AS shift, j,
         count(*) OVER (PARTITION BY row_id, item_id, i - j ORDER BY j RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS run
  FROM doc_words JOIN item_words USING (word)
), best AS (
  SELECT row_id, doc_id, item_id, n_words, n_text, shift, count(*) AS n_equal, max(run) AS window_equal
  FROM aligned GROUP BY ALL
)
SELECT doc_id, item_id, CAST(max(n_equal) AS INTEGER) AS n_equal, CAST(n_words AS INTEGER) AS n_words,
       CAST(max(window_equal) AS INTEGER) AS window_equal
FROM best
WHERE CASE WHEN n_words >= 13 THEN window_equal >= 11 WHEN n_words >= 8 THEN n_equal >= n_words - 1
           ELSE n_equal = n_words AND (n_words >= 4 OR n_text = n_words) END
GROUP BY row_id, doc_id, item_id, n_words
"""

OP8 = r"""
WITH rules(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), urls AS (
  SELECT row_number() OVER () AS row_id, page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT row_id, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls
), fits AS (
  SELECT row_id, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY row_id ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.row_id = p.row_id AND f.place = 1
"""

OP10 = r"""
WITH messages AS (
  SELECT DISTINCT conv_id, turn, role, coalesce(text, '') AS text, CAST(floor(turn / 64) AS BIGINT) AS block
  FROM conversations
), speakers AS (
  SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE role IS NOT NULL AND role <> 'system'
), rendered AS (
  SELECT m.conv_id, speaker, block, turn, role, text, coalesce(role = speaker, false) AS own,
         CASE WHEN role = 'system' THEN '<|system|>' || chr(10)
              WHEN role = speaker THEN '<|assistant|>' || chr(10)
              ELSE '<|user name=' || regexp_replace(coalesce(role, 'unknown'), '[|<>\r\n]', '_', 'g') || '|>' || chr(10)
         END AS head,
         replace(text, '<|', '<\|') || '<|end|>' AS body
  FROM messages m JOIN speakers s ON m.conv_id IS NOT DISTINCT FROM s.conv_id
), placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
           PARTITION BY conv_id, speaker, block ORDER BY turn NULLS FIRST, role NULLS FIRST, text
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start
  FROM rendered
)
SELECT conv_id, speaker, block, CAST(0 AS BIGINT) AS sub_block, count(*) AS n_messages,
       count(*) FILTER (own) AS n_own,
       CAST(sum(length(head) + length(body) + 1) AS BIGINT) AS n_chars,
       CAST(coalesce(sum(length(body)) FILTER (own), 0) AS BIGINT) AS n_target_chars,
       md5(string_agg(head || body || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text)) AS text_md5,
       coalesce(string_agg(CAST(start AS BIGINT) || '-' || CAST(start + length(body) AS BIGINT), ',' ORDER BY start)
         FILTER (own), '') AS targets
FROM placed GROUP BY conv_id, speaker, block
"""

OP11 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), found AS (
  SELECT row_id, lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30
), counts AS (
  SELECT lang, source, term, count(*) AS c FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), sources AS (
  SELECT g.lang, g.source, coalesce(s.v, 0) AS v, coalesce(n.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN sizes s ON s.lang = g.lang
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL) n ON n.lang = g.lang AND n.source = g.source
), shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.c, 0) AS c,
         1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 5) // CAST(s.n + 5 * s.v AS HUGEINT) AS p
  FROM sources s JOIN kept k ON k.lang = s.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), whole AS (
  SELECT k.lang, k.term, 1 + CAST(1000000000 AS HUGEINT) * (sum(c) + 5) // CAST(any_value(n) + 5 * any_value(v) AS HUGEINT) AS q
  FROM kept k JOIN counts c ON c.lang = k.lang AND c.term = k.term
  JOIN (SELECT lang, sum(n) AS n, any_value(v) AS v FROM sources GROUP BY lang) t ON t.lang = k.lang
  GROUP BY k.lang, k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
             FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) f
    ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), every AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, s.p - w.q FROM shares s JOIN whole w ON w.lang = s.lang AND w.term = s.term
  WHERE s.c > 0 AND s.p > w.q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
WHERE part = 'pair' OR rank <= 50
"""
