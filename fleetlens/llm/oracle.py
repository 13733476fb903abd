"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

# [^\x20\x09-\x0D]+ in DuckDB's own escapes.
WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '{WORD}') AS words
    FROM documents),
windows AS (
    SELECT r, i, array_to_string(words[i:i + 7], ' ') AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM d)),
twice AS (SELECT r, w FROM windows GROUP BY r, w HAVING count(*) > 1),
repeated AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM windows JOIN twice USING (r, w)) GROUP BY r),
lines AS (
    SELECT r, doc_id, source, line, len(regexp_extract_all(line, '{WORD}')) AS n,
           array_to_string(list_filter(string_split_regex(translate(lower(line), '123456789', '000000000'), '\s+'), lambda x: x <> ''), ' ') AS norm
    FROM (SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '{WORD}')),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
frequent AS (SELECT source, norm FROM lines GROUP BY source, norm HAVING count(DISTINCT doc_id) > 10),
lost AS (
    SELECT r, sum(n) AS n FROM lines l
    WHERE EXISTS (SELECT 1 FROM frequent f WHERE f.norm = l.norm AND f.source IS NOT DISTINCT FROM l.source) GROUP BY r),
m AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
           coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS n_removed_words
    FROM d LEFT JOIN dups USING (r) LEFT JOIN repeated USING (r) LEFT JOIN lost USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed, n_removed_words::BIGINT AS n_removed_words,
       NOT base_failed AND 100 * (n_words - n_removed_words) >= 30 * n_words AS kept
FROM b
"""

OP3 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""



def _filled(n: str, given: str, by: str) -> str:
    """Budgets of the children ``n`` (capacity, w) out of their parents' ``given``."""
    part = f"PARTITION BY {by}" if by else ""
    source = f"{n} JOIN {given} USING ({by})" if by else f"{n}, {given}"
    return f"""
    (SELECT * EXCLUDE (given, fill, nth, fixed), least(capacity, coalesce(fixed * w, capacity)) AS given FROM (
        SELECT *, min_by(fill, nth) FILTER (WHERE capacity / w > fill) OVER ({part}) AS fixed FROM (
            SELECT {n}.*, given,
                   (given - coalesce(sum(capacity) OVER earlier, 0)) / sum(w) OVER onward AS fill,
                   row_number() OVER ({part} ORDER BY capacity / w, {n}.name) AS nth
            FROM {source} WHERE capacity > 0
            WINDOW earlier AS ({part} ORDER BY capacity / w, {n}.name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   onward AS ({part} ORDER BY capacity / w, {n}.name ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))))"""


OP5 = rf"""
WITH m AS (
    SELECT doc_id, md5(text) AS content, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS tokens,
           'domain' || ((strpos('0123456789abcdef', md5(source)[1]) - 1) // 4) AS domain, lang, source
    FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM m GROUP BY ALL),
n3 AS (SELECT domain, lang, source AS name, tokens * 2.0::DOUBLE AS capacity, 1.0::DOUBLE AS w FROM leaf),
n2 AS (
    SELECT domain, lang AS name, sum(capacity) AS capacity, CASE lang WHEN 'en' THEN 5.0 WHEN 'fr' THEN 2.0 WHEN 'de' THEN 2.0 ELSE 1.0 END::DOUBLE AS w
    FROM n3 GROUP BY domain, lang),
n1 AS (
    SELECT domain AS name, sum(capacity) AS capacity, CASE domain WHEN 'domain0' THEN 4.0 WHEN 'domain1' THEN 3.0 WHEN 'domain2' THEN 2.0 ELSE 1.0 END::DOUBLE AS w
    FROM n2 GROUP BY domain),
g0 AS (SELECT 0.8::DOUBLE * sum(tokens) AS given FROM leaf),
g1 AS (SELECT name AS domain, given FROM {_filled("n1", "g0", "")}),
g2 AS (SELECT domain, name AS lang, given FROM {_filled("n2", "g1", "domain")}),
g3 AS (SELECT domain, lang, name AS source, given FROM {_filled("n3", "g2", "domain, lang")}),
b AS (
    SELECT domain, lang, source, floor(floor(given + 1e-6) / tokens)::BIGINT AS epochs, floor(given + 1e-6) - floor(floor(given + 1e-6) / tokens) * tokens AS rest
    FROM g3 JOIN leaf USING (domain, lang, source)),
p AS (
    SELECT doc_id, tokens, epochs, rest, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('17:' || epochs || ':' || doc_id), doc_id, content) AS so_far
    FROM m JOIN b USING (domain, lang, source) WHERE tokens > 0)
SELECT doc_id, tokens AS n_tokens, (epochs + (so_far <= rest)::INTEGER)::INTEGER AS copies FROM p WHERE epochs + (so_far <= rest)::INTEGER > 0
"""

OP7 = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * m >= 85 * (a.n + b.n - m)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
heads AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id FROM heads LEFT JOIN n USING (doc_id)
"""

# [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+ and [^\x00-\x40\x5B-\x60\x7B-\x7F]+
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LETTER_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{pattern}')"


OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms(TERM)} AS terms FROM documents),
g AS (SELECT count(*)::BIGINT AS all_docs, sum(len(terms))::BIGINT AS all_terms FROM d WHERE len(terms) > 0),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS t FROM d) GROUP BY r, t),
q AS (
    SELECT item_id, t, count(*)::BIGINT AS n
    FROM (SELECT item_id, unnest({_terms(TERM)}) AS t FROM (SELECT item_id, min(text) AS text FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id)) GROUP BY item_id, t),
w AS (
    SELECT t, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM tf, g WHERE t IN (SELECT t FROM q) GROUP BY t, all_docs),
m AS (SELECT r, doc_id, 75 + (25 * len(terms)::BIGINT * all_docs) // all_terms AS m FROM d, g WHERE doc_id IS NOT NULL),
s AS (
    SELECT item_id, r, doc_id, sum(n * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM q JOIN w USING (t) JOIN tf USING (t) JOIN m USING (r) GROUP BY item_id, r, doc_id),
top AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM top WHERE rank <= 20
"""

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_terms(LETTER_TERM)} AS terms FROM documents),
tf AS (SELECT r, lang, source, t, count(*)::BIGINT AS n FROM (SELECT r, lang, source, unnest(terms) AS t FROM d) GROUP BY ALL),
kept AS (SELECT lang, t, sum(n)::BIGINT AS n FROM tf GROUP BY lang, t HAVING count(*) >= 10),
size AS (SELECT lang, count(*)::BIGINT AS v, sum(n)::BIGINT AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
held AS (SELECT lang, source, t, sum(tf.n)::BIGINT AS n FROM tf JOIN kept USING (lang, t) GROUP BY lang, source, t),
total AS (SELECT lang, source, coalesce(sum(n), 0)::BIGINT AS total FROM grp LEFT JOIN held USING (lang, source) GROUP BY lang, source),
p AS (
    SELECT lang, source, t, coalesce(held.n, 0) AS n, 1 + (1000000000 * (coalesce(held.n, 0) + 2)) // (total.total + 2 * v) AS p,
           1 + (1000000000 * (kept.n + 2)) // (size.total + 2 * v) AS whole
    FROM grp JOIN kept USING (lang) JOIN size USING (lang) JOIN total USING (lang, source) LEFT JOIN held USING (lang, source, t)),
f AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::BIGINT AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL
    SELECT lang, source, 'term', t, (((p - whole) * (p - whole)) // (p + whole))::BIGINT FROM p WHERE n > 0 AND p > whole),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op3_exact_topk": OP3,
    "op5_source_mixing": OP5,
    "op7_ngram_jaccard": OP7,
    "op12_ranked_search": OP12,
    "op13_source_divergence": OP13,
}
