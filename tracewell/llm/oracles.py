"""DuckDB SQL of the operators' queries that SQL can express."""

from __future__ import annotations

from tracewell.llm import contamination, jaccard_join, line_dedup, quality_rules, substring_dedup

SPACE = r"[\x20\x09-\x0D]"
WORDS = rf"list_filter(string_split_regex(coalesce(text, ''), '{SPACE}+'), lambda x: x <> '')"
N = substring_dedup.WINDOW

OP2 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + {N - 1}], ' ') AS name FROM (SELECT doc_id, w, unnest(range(1, len(w) - {N - 2})) AS i FROM d)),
firsts AS (SELECT doc_id, i, row_number() OVER (PARTITION BY name ORDER BY doc_id, i) AS n FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {N})) AS i FROM firsts WHERE n > 1),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS t, count(*) AS n FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i WHERE g.i IS NULL GROUP BY p.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

S = jaccard_join.SHINGLE
A, B = jaccard_join.THRESHOLD
OP4 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS} AS w FROM documents),
sets AS (SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - {S - 2}, 2)), lambda i: array_to_string(w[i:i + {S - 1}], ' ')))) AS s FROM d WHERE len(w) > 0),
copies AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY s) AS copy_id FROM sets),
members AS (SELECT doc_id, copy_id, len(s) AS size, unnest(s) AS token FROM copies),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(b.copy_id) AS other, any_value(a.copy_id) AS own, count(*) AS k, any_value(a.size) AS m, any_value(b.size) AS n
  FROM members a JOIN members b ON a.token = b.token AND a.doc_id <> b.doc_id AND {B} * least(a.size, b.size) >= {A} * greatest(a.size, b.size) GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b, own, other FROM shared WHERE {B} * k >= {A} * (m + n - k)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a, least(a, min(b)) AS root FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n, count(DISTINCT other) FILTER (other <> own) AS t FROM links GROUP BY a)
SELECT d.doc_id, coalesce(r.root, d.doc_id) AS class_id, coalesce(c.copy_id, d.doc_id) AS copy_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(n.t, 0)::BIGINT AS n_text_links
FROM d LEFT JOIN copies c ON c.doc_id = d.doc_id LEFT JOIN roots r ON r.a = d.doc_id LEFT JOIN counts n ON n.a = d.doc_id
"""

OP6 = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20
"""

OP7 = f"""
WITH p AS (SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
  list_filter(list_transform(string_split_regex(regexp_replace(coalesce(html, ''), '{line_dedup.HIDDEN}', '', 'g'), '{line_dedup.BREAKS}'),
    lambda x: trim(regexp_replace(x, '<[^>]*>', '', 'g'))), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM pages),
once AS (SELECT host, lines, row_number() OVER () AS k FROM (SELECT DISTINCT host, lines FROM p WHERE host IS NOT NULL)),
totals AS (SELECT host, count(*) AS pages FROM once GROUP BY host),
counts AS (SELECT host, line, count(DISTINCT k) AS n FROM (SELECT host, k, unnest(lines) AS line FROM once) GROUP BY host, line),
common AS (SELECT host, list(line) AS gone FROM counts JOIN totals USING (host)
  WHERE n > CASE WHEN pages < {line_dedup.MIN_PAGES} THEN least({line_dedup.RATIO * line_dedup.MIN_PAGES**2} / pages, pages - 1) ELSE {line_dedup.RATIO} * pages END AND n > 1 GROUP BY host),
kept AS (SELECT page_id, p.host, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(gone, []), x)) AS k FROM p LEFT JOIN common USING (host))
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(k))::BIGINT AS n_dropped, sha256(coalesce(array_to_string(k, chr(10)), '')) AS kept_sha256 FROM kept
"""

SHARES = quality_rules.SHARES
P = "CASE rule " + " ".join(f"WHEN '{r}' THEN {quality_rules.RISK * s}" for r, s in SHARES.items()) + " END"
ALPHA = "CASE rule " + " ".join(f"WHEN '{r}' THEN {quality_rules.DELTA * s}" for r, s in SHARES.items()) + " END"
OP9 = f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
runs AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d))),
repeats AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS i FROM runs WHERE n > 1) GROUP BY doc_id),
m AS (SELECT d.doc_id, lang, t, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[{quality_rules.SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(list_filter(d.w, lambda x: NOT regexp_matches(x, '\\p{{L}}'))) AS n_unlettered FROM d LEFT JOIN repeats r ON r.doc_id = d.doc_id),
f AS (SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
scored AS (SELECT doc_id, lang, t, base_failed, unnest(['symbols', 'unlettered', 'dup_lines', 'repeats']) AS rule,
  unnest([ceil(least(1, n_symbols / greatest(n_words, 1)) * 100), ceil(least(1, n_unlettered / greatest(n_words, 1)) * 100), ceil(least(1, n_dup_lines / greatest(len(lines), 1)) * 100), ceil(least(1, n_repeat_words / greatest(n_words, 1)) * 100)]) AS score FROM f),
clear AS (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = max(quality)),
held AS (SELECT lang, rule, any_value(score) AS score, min(q) AS q FROM scored JOIN clear USING (doc_id) WHERE NOT base_failed GROUP BY lang, t, rule HAVING min(q) = max(q)),
curve AS (SELECT lang, rule, cutoff, {P} AS p, count(*) FILTER (q = 1) AS n_good, count(*) FILTER (q = 1 AND score > cutoff) AS n_lost, count(*) FILTER (q = 0 AND score > cutoff) AS n_caught
  FROM (SELECT *, unnest(range(0, {quality_rules.STEPS})) AS cutoff FROM held) GROUP BY lang, rule, cutoff),
tested AS (SELECT *, CASE WHEN n_lost >= n_good * p THEN 1 ELSE list_sum(list_transform(range(0, n_lost + 1), lambda i: exp(lgamma(n_good + 1) - lgamma(i + 1) - CASE WHEN n_good > i THEN lgamma(n_good - i + 1) ELSE 0 END + i * ln(p) + (n_good - i) * ln(1 - p)))) END AS tail FROM curve),
best AS (SELECT lang, rule, arg_max(cutoff, (n_caught - n_lost) * 1000 + cutoff) AS cutoff FROM tested
  WHERE tail <= {ALPHA} / (SELECT count(*) FROM (SELECT DISTINCT lang FROM curve)) AND n_caught > n_lost GROUP BY lang, rule),
over AS (SELECT DISTINCT s.doc_id FROM scored s JOIN best b ON s.lang IS NOT DISTINCT FROM b.lang AND s.rule = b.rule WHERE s.score > b.cutoff)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND o.doc_id IS NULL AS kept FROM f LEFT JOIN over o ON o.doc_id = f.doc_id
"""

OP11 = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
near AS (SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
far AS (SELECT n.a, n.b AS p, n.score AS top, f.b, f.score, row_number() OVER (PARTITION BY n.a, n.b ORDER BY f.score DESC, f.b) AS rank
  FROM near n JOIN pairs f ON n.a = f.a AND NOT f.same AND 50 * n.score <= 100 * f.score AND 100 * f.score <= 95 * n.score)
SELECT a AS anchor_id, p AS positive_id, rank::INTEGER AS rank, b AS negative_id, top AS positive_score, score AS negative_score FROM far WHERE rank <= 3
"""

W = contamination.WINDOW
ALNUM = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP13 = f"""
WITH d AS (SELECT doc_id, {ALNUM} AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item, w, least(len(w), {W}) AS m FROM (SELECT item_id, {ALNUM} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item, m, array_to_string(w[s:s + m - 1], ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS s FROM i)),
dw AS (SELECT doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS s FROM d, (SELECT DISTINCT m FROM i) WHERE len(w) >= m)),
hits AS (SELECT doc_id, item, s, dw.m FROM dw JOIN iw ON dw.m = iw.m AND dw.t = iw.t),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(f.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id
"""

ORACLES = {"op2_substring_dedup": OP2, "op4_jaccard_join": OP4, "op6_block_search": OP6, "op7_line_dedup": OP7, "op9_quality_rules": OP9, "op11_hard_negatives": OP11, "op13_decontaminate": OP13}
