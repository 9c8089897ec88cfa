"""DuckDB SQL of the registered queries that SQL can express."""

WORD = r"'[^\x20\x09-\x0D]+'"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

URL_FILTER = r"""
WITH rules(rh, rp, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                                 ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parts AS (SELECT row_number() OVER () AS r, page_id,
                 translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
fits AS (SELECT r, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
         FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM parts LEFT JOIN fits USING (r)
"""

TOPK = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_CRC = ("list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), "
        "lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))")
PREFIX_TRIE = f"""
WITH crc AS (SELECT {_CRC} AS t),
own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) - 1 AS pos, k, w
        FROM (SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
                     len(regexp_extract_all(coalesce(text, ''), {WORD})) AS w FROM conversations WHERE conv_id IS NOT NULL)),
conv AS (SELECT c, c - c % 20 AS base,
                xor(list_reduce(list_concat([4294967295], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                                lambda a, b: xor(a // 256, t[1 + xor(a, b) % 256])), 4294967295) % 4 AS h
         FROM (SELECT DISTINCT c FROM own), crc),
turns AS (SELECT conv.c, 0 AS part, pos, k, w FROM conv JOIN own ON own.c = conv.base AND pos < h
          UNION ALL SELECT conv.c, 1, pos, k, w FROM conv JOIN own ON own.c = conv.c AND pos >= h),
lists AS (SELECT conv.c, coalesce(list(k ORDER BY part, pos) FILTER (k IS NOT NULL), []) AS ks, coalesce(list(w ORDER BY part, pos) FILTER (k IS NOT NULL), []) AS ws
          FROM conv LEFT JOIN turns USING (c) GROUP BY conv.c),
steps AS (SELECT c, ks, ws, unnest(range(0, len(ks) + 1)) AS d FROM lists),
named AS (SELECT c, d, md5(array_to_string(ks[1:d], ',')) AS node, CASE WHEN d > 0 THEN md5(array_to_string(ks[1:d - 1], ',')) END AS up,
                 CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w, d = len(ks) AS ends, list_transform(range(0, d + 1), lambda e: md5(array_to_string(ks[1:e], ','))) AS path FROM steps),
node AS (SELECT node, any_value(d) AS depth, any_value(up) AS up, min(c) AS conv_id, count(*) AS n, any_value(w) AS w, any_value(path) AS path,
                sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM named GROUP BY node),
kids AS (SELECT up AS node, count(*) AS n_children FROM node WHERE up IS NOT NULL GROUP BY up),
sums AS (SELECT a AS node, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n - 1) * w) AS saved_tokens
         FROM (SELECT unnest(path) AS a, n, w, n_children FROM node LEFT JOIN kids USING (node)) GROUP BY a)
SELECT x.conv_id, x.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n AS n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, x.ends_sha256
FROM node x LEFT JOIN node p ON p.node = x.up LEFT JOIN kids ON kids.node = x.node JOIN sums ON sums.node = x.node
"""

HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 3
"""


def _components(n: int, percent: int) -> str:
    """Components of word shingle sets by Jaccard similarity."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce({LOWER.format('text')}, ''), {WORD}) AS ws FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []
               WHEN len(ws) < {n} THEN [array_to_string(ws, ' ')]
               ELSE list_transform(range(1, len(ws) - {n - 2}), lambda i: array_to_string(ws[i:i + {n - 1}], ' ')) END) AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS k FROM g),
many AS (SELECT k FROM x GROUP BY k HAVING count(*) > 1),
y AS (SELECT x.* FROM x JOIN many USING (k)),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS nu, any_value(b.n) AS nv, count(*) AS c
           FROM y a JOIN y b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT u, v FROM common WHERE 100 * c >= {percent} * (nu + nv - c)),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
least AS (SELECT u, min(v) AS m FROM reach GROUP BY u)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM g LEFT JOIN least ON g.doc_id = least.u
"""


NGRAM_JOIN = _components(4, 85)
MINHASH = f"SELECT *, doc_id = component_id AS kept FROM ({_components(5, 85)})"

SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w),
k AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM p),
lead AS (SELECT k, min(doc_id) AS m FROM k GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM k JOIN lead USING (k) WHERE m < doc_id),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def _later(k: int) -> str:
    """Word characters inside the later copies of a text's repeated runs of ``k`` words."""
    return f"""
g{k} AS (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, k ORDER BY i) AS r, count(*) OVER (PARTITION BY doc_id, k) AS c
         FROM (SELECT doc_id, i, md5(array_to_string(ws[i:i + {k - 1}], ' ')) AS k
               FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {k - 2})) AS i FROM w))),
d{k} AS (SELECT doc_id, sum(length(word)) AS d{k} FROM word
         JOIN (SELECT DISTINCT doc_id, unnest(range(i, i + {k})) AS pos FROM g{k} WHERE r > 1) USING (doc_id, pos) GROUP BY doc_id),"""


_LIMITS = [(5, 15), (6, 14), (7, 13), (8, 12), (9, 11), (10, 10)]
QUALITY_RULES = f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {WORD}) AS ws FROM documents),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),{''.join(_later(k) for k, _ in _LIMITS)}
rep AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS pos FROM g5 WHERE c > 1) GROUP BY doc_id),
line AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS r
         FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM w)
         WHERE regexp_matches(line, {WORD})),
dup AS (SELECT doc_id, count(*) AS lines, count(*) FILTER (r > 1) AS n,
               coalesce(sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) FILTER (r > 1), 0) AS chars FROM line GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
             coalesce(rep.n, 0) AS n_repeat_words, coalesce(dup.lines, 0) AS lines, coalesce(dup.chars, 0) AS chars,
             {', '.join(f'coalesce(d{k}, 0) AS d{k}' for k, _ in _LIMITS)}
      FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) {' '.join(f'LEFT JOIN d{k} USING (doc_id)' for k, _ in _LIMITS)}),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR 100 * chars > 20 * word_chars OR 100 * n_dup_lines > 30 * lines OR 100 * n_symbols > 10 * n_words
            OR {' OR '.join(f'100 * d{k} > {p} * word_chars' for k, p in _LIMITS)}) AS kept
FROM b
"""
