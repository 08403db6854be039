"""SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

from assayline.llm import centroids, lines, mixing, shingles, trie, vectors

SPACE = r"'[\x20\x09-\x0D]+'"

ORACLE: dict[str, str] = {}

ORACLE["op1_mix_sources"] = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens,
         md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
blocks AS (SELECT source, substr(h, 1, {mixing.BLOCK_DIGITS}) AS block, CAST(sum(n_tokens) AS BIGINT) AS tokens
           FROM docs GROUP BY ALL),
shares AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS tokens FROM blocks GROUP BY ALL HAVING sum(tokens) > 0),
total AS (SELECT CAST(sum(tokens) AS DOUBLE) AS t, CAST(max(tokens) AS DOUBLE) AS most,
                 CAST(min(tokens) AS DOUBLE) AS least FROM shares),
-- With the smallest budget that reads every source once, the smallest source is repeated
-- (most / least) ** (1 - exponent) times.
search(k, low, high) AS (
  SELECT 0, CAST(0 AS DOUBLE), CASE WHEN most / least <= {mixing.MAX_EPOCHS} THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END FROM total
  UNION ALL
  SELECT k + 1, CASE WHEN good THEN low ELSE (low + high) / 2 END, CASE WHEN good THEN (low + high) / 2 ELSE high END
  FROM (SELECT s.*, pow(most / least, 1 - (low + high) / 2) <= {mixing.MAX_EPOCHS} AS good FROM search s, total)
  WHERE k < {mixing.STEPS}),
found AS (SELECT high AS e FROM search WHERE k = {mixing.STEPS}),
norm AS (SELECT e, sum(pow(tokens / t, e)) AS norm FROM shares, total, found GROUP BY e),
plan AS (SELECT source, tokens AS size, pow(tokens / t, e) / norm AS weight,
                greatest(tokens, CAST(floor(pow(tokens / t, e) / norm * floor(most * norm / pow(most / t, e) + 1e-6) + 1e-6) AS BIGINT)) AS budget
         FROM shares, total, norm),
epochs AS (
  SELECT b.source, b.block, b.tokens, p.size, p.weight, p.budget // p.size AS whole, p.budget % p.size AS rest, u.epoch,
         coalesce(sum(b.tokens) OVER (PARTITION BY b.source, u.epoch ORDER BY md5('{mixing.SEED}:' || u.epoch || ':' || b.block), b.block
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM blocks b JOIN plan p ON b.source IS NOT DISTINCT FROM p.source,
       (SELECT unnest(generate_series(0, {int(mixing.MAX_EPOCHS) + 1})) AS epoch) u
  WHERE u.epoch <= p.budget // p.size),
placed AS (
  SELECT d.doc_id, d.source, d.n_tokens, e.epoch, e.block, e.start + e.epoch * e.size AS block_start, e.weight, e.epoch < e.whole AS sure, e.rest,
         e.start + coalesce(sum(d.n_tokens) OVER (PARTITION BY d.source, e.epoch, e.block ORDER BY d.h, d.doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN epochs e ON d.source IS NOT DISTINCT FROM e.source AND substr(d.h, 1, {mixing.BLOCK_DIGITS}) = e.block)
SELECT doc_id, source, n_tokens, CAST(epoch AS BIGINT) AS epoch, block, CAST(block_start AS BIGINT) AS block_start,
       round(weight, 9) AS weight
FROM placed WHERE sure OR before < rest
"""

ORACLE["op6_embedding_near_dedup"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
         AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
          ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= {vectors.COSINE}),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
number AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(l.b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(l.b, vec_id)) AS kept
FROM v LEFT JOIN least l ON l.a = vec_id LEFT JOIN number n ON n.a = vec_id
"""

ORACLE["op7_exact_dedup"] = f"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), {SPACE}, ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""

ORACLE["op9_ngram_jaccard"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + {shingles.WIDTH - 1}), ' ') AS x
      FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - {shingles.WIDTH - 1}, least(len(words), 1)))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
          WHERE 100 * c >= {shingles.PERCENT} * (p.n + q.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(l.b, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least l ON l.a = w.doc_id
"""

ORACLE["op10_line_dedup"] = rf"""
WITH p AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[^/?#]*//([^/?#@]*@)?([^/?#:]*)', 2)) AS site,
         string_split(regexp_replace(coalesce(html, ''), '({lines.BLOCK_END.removeprefix("(?i)")})', '\1' || chr(10), 'gi'), chr(10)) AS l
  FROM pages),
f AS (SELECT page_id, site, pos - 1 AS pos, l[pos] AS line, trim(regexp_replace(l[pos], {SPACE}, ' ', 'g'), ' ') AS t
      FROM (SELECT *, unnest(generate_series(1, len(l))) AS pos FROM p)),
gone AS (SELECT t FROM f WHERE t <> '' GROUP BY t HAVING count(DISTINCT site) > {lines.MAX_SITES}),
m AS (SELECT f.*, gone.t IS NOT NULL AS cut FROM f LEFT JOIN gone ON f.t = gone.t)
SELECT page_id, count(*) AS n_lines, CAST(sum(CASE WHEN cut THEN 1 ELSE 0 END) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT cut), '')) AS kept_sha256
FROM m GROUP BY page_id
"""


#: CRC-32 of the decimal text of conv_id, by its table of 256 values.
ORACLE["op11_prefix_trie"] = f"""
WITH RECURSIVE step(i, k, v) AS (
  SELECT i, 0, i FROM (SELECT unnest(generate_series(CAST(0 AS BIGINT), 255)) AS i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM step WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM step WHERE k = 8),
turns AS (SELECT conv_id, turn, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(x ORDER BY turn NULLS FIRST, sha256(len(x.role) || ':' || x.role || x.text)) AS l FROM turns GROUP BY conv_id),
h AS (SELECT conv_id, l, xor(list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda a, b: xor(a // 256, t[xor(a, b) % 256 + 1])), 4294967295) % {trie.SHARED} AS h FROM own, crc),
full_ AS (SELECT c.conv_id, list_concat(coalesce(list_slice(r.l, 1, c.h), []), list_slice(c.l, c.h + 1, len(c.l))) AS l
          FROM h c LEFT JOIN own r ON r.conv_id = c.conv_id - c.conv_id % {trie.FAMILY}),
member AS (SELECT conv_id, depth, list_slice(l, 1, depth) AS prefix, len(l) = depth AS ends
           FROM (SELECT *, unnest(generate_series(0, len(l))) AS depth FROM full_)),
node AS (SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
                coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS e
         FROM member GROUP BY depth, prefix),
kids AS (SELECT p.conv_id, p.depth, count(*) AS n FROM node p JOIN node k
         ON k.depth = p.depth + 1 AND list_slice(k.prefix, 1, p.depth) = p.prefix GROUP BY ALL),
whole AS (SELECT n.*, coalesce(k.n, 0) AS n_children,
                 (n_convs - 1) * CASE WHEN n.depth > 0 THEN len(prefix[n.depth].text) ELSE 0 END AS saved
          FROM node n LEFT JOIN kids k ON k.conv_id = n.conv_id AND k.depth = n.depth),
-- A node lies under every prefix of its smallest member that is no longer than its own.
under AS (SELECT t.conv_id, t.depth, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, CAST(sum(b.saved) AS BIGINT) AS saved_tokens
          FROM whole b JOIN member m ON m.conv_id = b.conv_id AND m.depth <= b.depth
          JOIN node t ON t.depth = m.depth AND t.prefix = m.prefix GROUP BY ALL)
SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, u.n_leaves, u.saved_tokens,
       sha256(w.e) AS ends_sha256
FROM whole w JOIN under u ON u.conv_id = w.conv_id AND u.depth = w.depth
LEFT JOIN node p ON p.depth = w.depth - 1 AND p.prefix = list_slice(w.prefix, 1, w.depth - 1)
"""


def _centroid_sql() -> str:
    """The rounds written out one after the other."""
    k, width, scale = centroids.CENTROIDS, centroids.WIDTH, centroids.SCALE
    parts = [f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
v AS MATERIALIZED (SELECT r, vec_id, list_transform(e, lambda x: CAST(floor({scale} * x) AS HUGEINT)) AS q FROM e
      WHERE len(e) = {width} AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, unnest(generate_series(1, {width})) AS j, unnest(q) AS v FROM v),
begun AS (SELECT row_number() OVER (ORDER BY sha256('{centroids.SALT}' || vec_id), q) - 1 AS c, q FROM v),
c0 AS MATERIALIZED (SELECT c, unnest(generate_series(1, {width})) AS j, unnest(q) AS v FROM begun WHERE c < {k})"""]
    for i in range(centroids.ROUNDS + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (SELECT r, c, d FROM (SELECT x.r, c.c, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{i} c ON x.j = c.j GROUP BY ALL)
       QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if i < centroids.ROUNDS:
            parts.append(f"""
m{i} AS MATERIALIZED (SELECT c, j, sum(v) AS s, count(*) AS n FROM a{i} JOIN x USING (r) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT c.c, c.j, CASE WHEN n IS NULL THEN v WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END AS v
       FROM c{i} c LEFT JOIN m{i} m ON m.c = c.c AND m.j = c.j)""")
    last = centroids.ROUNDS
    parts.append(f"""
sha AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY j)) AS s FROM c{last} GROUP BY c)""")
    return ",".join(parts) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, s AS centroid_sha256
FROM a{last} a JOIN v USING (r) JOIN sha ON sha.c = a.c
"""


ORACLE["op12_centroid_clustering"] = _centroid_sql()
