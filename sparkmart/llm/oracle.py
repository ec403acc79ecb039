"""DuckDB SQL that gives the rows of the registered queries, written from their contracts."""

from __future__ import annotations

from sparkmart.llm.quality_rules import BOILERPLATE

#: Phrases between blanks, in lines where each word has a blank of its own on both sides.
_PHRASES = "|".join(p.replace(" ", "  ") for p in sorted(BOILERPLATE, key=len, reverse=True))

QUALITY_RULES = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
parts AS (
  SELECT doc_id, body,
    list_filter(string_split_regex(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM parts),
grams AS (
  SELECT doc_id, p, word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w || ' ' || lead(word, 3) OVER w || ' '
    || lead(word, 4) OVER w || ' ' || lead(word, 5) OVER w || ' ' || lead(word, 6) OVER w || ' ' || lead(word, 7) OVER w AS gram
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
twice AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams WHERE gram IS NOT NULL),
covered AS (
  SELECT doc_id, sum(least(8, p - before)) AS n
  FROM (SELECT doc_id, p, lag(p, 1, -8) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM twice WHERE n > 1) GROUP BY doc_id),
judged AS (
  SELECT doc_id, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS solid,
    length(line) - length(regexp_replace(line, '[#*$%&|<>{{}}\[\]~^=_\\]', '', 'g')) AS noise,
    length(line) - length(regexp_replace(line, '[|»›•·]', '', 'g')) AS bars,
    len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n,
    len(list_filter(string_split(plain, ' '), lambda x: x <> '')) AS n_plain,
    len(list_filter(string_split(regexp_replace(plain, ' (?:{_PHRASES}) ', '', 'g'), ' '), lambda x: x <> '')) AS n_other
  FROM (
    SELECT doc_id, line, ' ' || replace(trim(regexp_replace(lower(line), '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g')), ' ', '  ') || ' ' AS plain
    FROM (SELECT doc_id, unnest(lines) AS line FROM parts))),
lost AS (
  SELECT doc_id, sum(solid) AS n FROM judged
  WHERE noise * 10 > solid * 3 OR (bars >= 3 AND n - bars <= 4 * (bars + 1)) OR n_plain > 2 * n_other GROUP BY doc_id),
counted AS (
  SELECT p.doc_id, len(words) AS n_words, length(list_aggregate(words, 'string_agg', '')) AS word_chars,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS lost
  FROM parts p LEFT JOIN covered c ON c.doc_id = p.doc_id LEFT JOIN lost l ON l.doc_id = p.doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND lost * 100 <= coalesce(word_chars, 0) * 50 AS kept
FROM counted
"""

DECONTAMINATION = r"""
WITH low AS (
  SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS body FROM documents
  UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark),
split AS (
  SELECT side, id, regexp_extract_all(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM low),
sized AS (SELECT side, id, words, len(words) AS n FROM split),
placed AS (SELECT side, id, n, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM sized),
ahead AS (
  SELECT side, id, n, p, list(word) OVER (PARTITION BY side, id ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS next
  FROM placed),
windows AS (
  SELECT DISTINCT id AS item_id, least(n, 10) AS k, array_to_string(next[1:least(n, 10)], ' ') AS gram
  FROM ahead WHERE side = 'b' AND len(next) >= least(n, 10)),
sizes AS (SELECT DISTINCT k FROM windows),
grams AS (
  SELECT a.id AS doc_id, a.p, s.k, array_to_string(next[1:s.k], ' ') AS gram
  FROM ahead a JOIN sizes s ON len(a.next) >= s.k WHERE a.side = 'd'),
hits AS (SELECT g.doc_id, g.p, g.k, w.item_id FROM grams g JOIN windows w ON w.k = g.k AND w.gram = g.gram),
reach AS (SELECT doc_id, p, max(k) AS k FROM hits GROUP BY doc_id, p),
covered AS (
  SELECT doc_id, sum(greatest(0, p + k - greatest(p, coalesce(until, 0)))) AS n
  FROM (SELECT doc_id, p, k, max(p + k) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until
        FROM reach)
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT s.id AS doc_id, s.n::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
  sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM sized s LEFT JOIN covered c ON c.doc_id = s.id LEFT JOIN items i ON i.doc_id = s.id WHERE s.side = 'd'
"""

REPEATED_PASSAGES = r"""
WITH parts AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM parts),
ahead AS (
  SELECT doc_id, p, word, string_agg(word, ' ') OVER w AS gram, count(*) OVER w AS n
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
counted AS (SELECT doc_id, p, word, n = 35 AND count(*) OVER (PARTITION BY n, gram) > 1 AS again FROM ahead),
marked AS (
  SELECT doc_id, p, word, max(CASE WHEN again THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM counted),
kept AS (
  SELECT doc_id, sum(gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY p) FILTER (WHERE gone = 0), '') AS rest
  FROM marked GROUP BY doc_id)
SELECT p.doc_id, len(p.words)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(k.rest, '')) AS kept_sha256
FROM parts p LEFT JOIN kept k ON k.doc_id = p.doc_id
"""

URL_FILTER = r"""
WITH rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
cut AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, coalesce(r.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
QUALIFY row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) = 1
"""

QUOTATIONS = r"""
WITH lines AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS body, string_split(coalesce(text, ''), chr(10)) AS parts FROM conversations),
each AS (
  SELECT conv_id, turn, unnest(parts) AS line, generate_subscripts(parts, 1) AS i, len(parts) AS n FROM lines),
level AS (
  SELECT conv_id, turn, i, length(regexp_replace(regexp_extract(line, '^((?:[ \t]*>)*)[ \t]?', 1), '[^>]', '', 'g')) AS level,
    regexp_replace(line, '^((?:[ \t]*>)*)[ \t]?', '') AS body FROM each),
deep AS (SELECT conv_id, turn, max(level) AS max_level FROM level GROUP BY conv_id, turn),
kept AS (
  SELECT l.conv_id, l.turn, l.i, l.level, l.body FROM (
    SELECT *, lead(level, 1, 0) OVER (PARTITION BY conv_id, turn ORDER BY i) AS next FROM level) l JOIN deep d ON d.conv_id = l.conv_id AND d.turn = l.turn
  WHERE NOT (d.max_level > 0 AND l.next > l.level AND regexp_matches(l.body, '^[ \t]*(?:On|Le|El|Am) .{1,200}(?:wrote|écrit|escribió|schrieb) ?:[ \t]*$'))),
runs AS (
  SELECT *, sum(step) OVER (PARTITION BY conv_id, turn ORDER BY i) AS run FROM (
    SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY conv_id, turn ORDER BY i) THEN 0 ELSE 1 END AS step FROM kept)),
evidence AS (
  SELECT DISTINCT conv_id, turn, level, said FROM (
    SELECT conv_id, turn, level, trim(regexp_replace(lower(body), '[^\p{L}\p{N}]+', ' ', 'g')) AS said FROM kept
    UNION ALL
    SELECT conv_id, turn, level, trim(regexp_replace(lower(string_agg(body, chr(10) ORDER BY i)), '[^\p{L}\p{N}]+', ' ', 'g'))
    FROM runs GROUP BY conv_id, turn, run, level)
  WHERE said <> ''),
first AS (SELECT conv_id, said, min(turn) AS said_at FROM evidence WHERE level = 0 GROUP BY conv_id, said),
votes AS (
  SELECT e.conv_id, e.turn, e.level, f.said_at, count(*) AS votes, sum(length(replace(e.said, ' ', ''))) AS weight
  FROM evidence e JOIN first f ON f.conv_id = e.conv_id AND f.said = e.said WHERE e.level > 0 AND f.said_at < e.turn GROUP BY ALL),
best AS (
  SELECT conv_id, turn, arg_max(said_at, {'l': -level, 'w': weight, 's': said_at}) AS said_at, sum(votes) AS n_linked FROM votes GROUP BY conv_id, turn),
quoted AS (SELECT conv_id, turn, count(*) AS n FROM evidence WHERE level > 0 GROUP BY conv_id, turn),
own AS (SELECT conv_id, turn, coalesce(string_agg(body, chr(10) ORDER BY i), '') AS own_text FROM kept WHERE level = 0 GROUP BY conv_id, turn),
place AS (
  SELECT conv_id, turn, row_number() OVER w - 1 AS position, lag(turn) OVER w AS before
  FROM (SELECT DISTINCT conv_id, turn FROM conversations) WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT l.conv_id, l.turn, l.role, p.position::BIGINT AS position, coalesce(b.said_at, p.before) AS reply_to,
  CASE WHEN d.max_level = 0 THEN l.body ELSE regexp_replace(regexp_replace(coalesce(o.own_text, ''), '^\s+', ''), '\s+$', '') END AS clean_text,
  d.max_level::BIGINT AS max_level, coalesce(q.n, 0)::BIGINT AS n_quoted, coalesce(b.n_linked, 0)::BIGINT AS n_linked
FROM lines l JOIN place p ON p.conv_id = l.conv_id AND p.turn = l.turn JOIN deep d ON d.conv_id = l.conv_id AND d.turn = l.turn
LEFT JOIN best b ON b.conv_id = l.conv_id AND b.turn = l.turn LEFT JOIN quoted q ON q.conv_id = l.conv_id AND q.turn = l.turn
LEFT JOIN own o ON o.conv_id = l.conv_id AND o.turn = l.turn
"""

DIVERGENCE = r"""
WITH texts AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS body, row_number() OVER () AS r FROM documents),
occurring AS (SELECT DISTINCT lang, source FROM texts),
words AS (
  SELECT lang, source, r, unnest(regexp_extract_all(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts),
counted AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM words GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM counted GROUP BY lang, term HAVING sum(docs) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
used AS (SELECT c.lang, c.source, c.term, c.n FROM counted c JOIN kept k ON c.lang = k.lang AND c.term = k.term),
totals AS (
  SELECT o.lang, o.source, coalesce(l.v, 0) AS v, coalesce(sum(u.n), 0) AS total
  FROM occurring o LEFT JOIN langs l ON o.lang = l.lang LEFT JOIN used u ON o.lang = u.lang AND o.source = u.source GROUP BY o.lang, o.source, l.v),
shares AS (
  SELECT t.lang, t.source, k.term, coalesce(u.n, 0) AS n,
    1 + (1000000000 * (coalesce(u.n, 0) + 5)::HUGEINT) // (t.total + 5 * t.v) AS p,
    1 + (1000000000 * (k.n + 5)::HUGEINT) // (l.total + 5 * l.v) AS q
  FROM totals t JOIN kept k ON t.lang = k.lang JOIN langs l ON l.lang = t.lang
  LEFT JOIN used u ON u.lang = t.lang AND u.source = t.source AND u.term = k.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM occurring a JOIN occurring b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
