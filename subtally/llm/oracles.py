"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from subtally.llm.jaccard_join import PERCENT, SHINGLE_WORDS
from subtally.llm.license_scan import PHRASES, SHARE, SHIFT, TEMPLATES
from subtally.llm.substring_dedup import MIN_WORDS

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_filters(rules: list[tuple[str, str, str]]) -> str:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return rf"""
WITH r(rule_host, rule_path, rule_verdict) AS (VALUES {values}),
p AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(coalesce(regexp_extract(url, '{_URL}', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '{_URL}', 2), '') AS path
  FROM pages
),
fits AS (
  SELECT n, max(struct_pack(long := length(rule_host || rule_path), v := rule_verdict,
                            rule := rule_host || rule_path)) AS best
  FROM p JOIN r ON (host = rule_host OR suffix(host, '.' || rule_host))
               AND prefix(path, rule_path)
  GROUP BY n
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, 'allow') AS verdict
FROM p LEFT JOIN fits USING (n)"""


def license_scan() -> str:
    texts = [(t, n, True) for t, n in PHRASES.items()] + [(t, n, False) for t, n in TEMPLATES.items()]
    values = ", ".join(f"({i}, '{t}', '{n}', {p})" for i, (t, n, p) in enumerate(texts))
    return rf"""
WITH RECURSIVE t AS (
  SELECT template, label, phrase, unnest(range(len(w) - 1)) AS t_at, w, len(w) - 1 AS pairs
  FROM (SELECT *, string_split(words, ' ') AS w
        FROM (VALUES {values}) AS v(template, words, label, phrase))
),
d AS (
  SELECT row_number() OVER () AS n, doc_id,
         list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
),
g AS (SELECT n, pos, w[pos + 1] AS one, w[pos + 2] AS two
      FROM (SELECT n, w, unnest(range(len(w) - 1)) AS pos FROM d)),
x AS (
  SELECT DISTINCT n, template, label, phrase, pairs, t_at, pos, pos - t_at AS diagonal
  FROM g JOIN t ON one = t.w[t_at + 1] AND two = t.w[t_at + 2]
),
v AS (SELECT n, template, label, phrase, pairs, diagonal, count(*) AS votes FROM x GROUP BY ALL),
near AS (
  SELECT v.n, v.template, v.diagonal, x.t_at, x.pos FROM v JOIN x
  ON x.n = v.n AND x.template = v.template AND NOT v.phrase
  AND x.diagonal BETWEEN v.diagonal - {SHIFT} AND v.diagonal + {SHIFT}
),
chain(n, template, diagonal, t_at, pos, links) AS (
  SELECT n, template, diagonal, t_at, pos, 1 FROM near
  UNION
  SELECT near.n, near.template, near.diagonal, near.t_at, near.pos, links + 1
  FROM chain JOIN near ON near.n = chain.n AND near.template = chain.template
   AND near.diagonal = chain.diagonal AND near.t_at > chain.t_at AND near.pos > chain.pos
),
m AS (
  SELECT v.*, coalesce(longest, votes) / pairs AS covered, phrase AND votes = pairs AS place
  FROM v LEFT JOIN (SELECT n, template, diagonal, max(links) AS longest FROM chain GROUP BY ALL)
  USING (n, template, diagonal)
),
s AS (
  SELECT n, count(*) FILTER (place) AS n_base, min(diagonal) FILTER (place) AS first_word,
         max(diagonal) FILTER (place) AS last_word,
         list_sort(list_distinct(list(label) FILTER (place))) AS base,
         list_sort(list_distinct(list(label)
           FILTER (place OR (NOT phrase AND covered >= {SHARE})))) AS every,
         max(CASE WHEN place THEN 1.0 WHEN phrase THEN votes / pairs ELSE covered END) AS score
  FROM m GROUP BY n
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(base, ','), '') AS base_labels,
       coalesce(array_to_string(every, ','), '') AS labels,
       CAST(coalesce(score, 0.0) AS DOUBLE) AS score
FROM d LEFT JOIN s USING (n)"""


def substring_dedup(size: int = MIN_WORDS) -> str:
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
p AS (SELECT n, doc_id, b, sha256(array_to_string(w[b:b + {size - 1}], ' ')) AS h
      FROM (SELECT n, doc_id, w, unnest(range(1, len(w) - {size - 2})) AS b FROM d)),
o AS (SELECT h, min(doc_id) AS low FROM p GROUP BY h),
g AS (SELECT DISTINCT n, unnest(range(b, b + {size})) AS gone
      FROM p JOIN o USING (h) WHERE low < doc_id),
r AS (SELECT n, list(gone) AS gone FROM g GROUP BY n),
k AS (
  SELECT doc_id, w, coalesce(gone, []) AS gone,
         CASE WHEN gone IS NULL THEN w
              ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END AS kept
  FROM d LEFT JOIN r USING (n)
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM k"""


def jaccard_join(size: int = SHINGLE_WORDS, percent: int = PERCENT) -> str:
    return rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[b:b + {size - 1}], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {size - 2}, 2))) AS b FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT o.a, o.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m
    FROM s x JOIN s y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY ALL) o
  JOIN n p ON p.doc_id = o.a JOIN n q ON q.doc_id = o.b
  WHERE 100 * m >= {percent} * (p.n + q.n - m)
),
c(doc_id, root) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT l.b, c.root FROM c JOIN l ON l.a = c.doc_id
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(root) AS component_id,
       (SELECT count(*) FROM l WHERE l.a = d.doc_id) AS n_links
FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id) GROUP BY ALL"""


METRIC_SEARCH = """
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 5"""


DECONTAMINATION = r"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
),
t AS (
  SELECT DISTINCT item, size, array_to_string(w[s:s + size - 1], ' ') AS phrase
  FROM (SELECT item, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s
        FROM b WHERE len(w) > 0)
),
o AS (
  SELECT n, s, d.size, array_to_string(w[s:s + size - 1], ' ') AS phrase
  FROM (SELECT n, w, size, unnest(range(1, len(w) - size + 2)) AS s
        FROM d JOIN (SELECT DISTINCT size FROM t) ON len(w) >= size) d
),
f AS (SELECT o.n, o.s, o.size, t.item FROM o JOIN t ON o.size = t.size AND o.phrase = t.phrase),
h AS (SELECT n, count(DISTINCT word) AS n_hit
      FROM (SELECT n, unnest(range(s, s + size)) AS word FROM f) GROUP BY n),
i AS (SELECT n, list_sort(list(DISTINCT item)) AS items FROM f WHERE item IS NOT NULL GROUP BY n)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (n) LEFT JOIN i USING (n)"""


HARD_NEGATIVES = """
WITH e AS (
  SELECT row_number() OVER () AS n, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.n AS anchor, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM e a JOIN e c ON a.vec_id % 100 = 0 AND a.n <> c.n
),
p AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same QUALIFY place <= 5
)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, place ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT same
 AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5"""


# CRC-32 by bit steps: a byte to combine (plus one), then eight shifts (zeros); 3988292384 is
# its reversed polynomial.
PREFIX_TRIE = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
         struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS said
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (SELECT conv_id, list(said ORDER BY pos) AS said FROM t GROUP BY conv_id),
m AS (
  SELECT conv_id, said, conv_id - conv_id % 20 AS base,
         CAST(xor(list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
             string_split(CAST(conv_id AS VARCHAR), ''),
             lambda c: [CAST(ascii(c) + 1 AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0]))),
           lambda c, s: CASE WHEN s > 0 THEN xor(c, s - 1)
                             WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END),
           4294967295) % 4 AS INTEGER) AS h
  FROM own
),
c AS (
  SELECT m.conv_id, list_concat(coalesce(b.said, [])[1:m.h], m.said[m.h + 1:]) AS said
  FROM m LEFT JOIN own b ON b.conv_id = m.base
),
p AS (SELECT conv_id, d AS depth, said[1:d] AS path, len(said) = d AS last
      FROM (SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS d FROM c)),
n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '') AS ends,
         CASE WHEN depth = 0 THEN 0 ELSE len(list_filter(regexp_split_to_array(
           path[depth].x, '[\x20\x09-\x0D]+'), lambda w: w <> '')) END AS words
  FROM p GROUP BY path, depth
),
k AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children
      FROM n WHERE depth > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path, depth)),
s AS (
  SELECT up.path, sum((f.n_convs - 1) * f.words) AS saved, count(*) FILTER (f.n_children = 0) AS leaves
  FROM (SELECT f.path, f.n_convs, f.words, f.n_children, unnest(range(0, f.depth + 1)) AS d FROM f) f
  JOIN f up ON up.depth = f.d AND up.path = f.path[1:f.d]
  GROUP BY up.path
)
SELECT f.conv_id, f.depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN s USING (path) LEFT JOIN f q ON f.depth > 0 AND q.depth = f.depth - 1 AND q.path = f.path[1:f.depth - 1]"""
