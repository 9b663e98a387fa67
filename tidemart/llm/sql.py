"""DuckDB SQL for the numbered queries that SQL can express."""

OP2 = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 2) AS lane
  FROM documents),
classed AS (
  SELECT *, CASE WHEN size > 0 THEN CAST(floor(log2(CAST(size AS DOUBLE)) * 8) AS INTEGER) ELSE -1 END AS size_class
  FROM sized),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM classed GROUP BY source),
ranked AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) / weight AS ratio, CAST(sum(source_size) OVER () AS BIGINT) AS all_sizes
  FROM per_source),
leveled AS (
  SELECT *, CAST(3 * sum(source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS filled,
         CAST(coalesce(sum(weight) OVER (ORDER BY ratio, source NULLS LAST
                                    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS BIGINT) AS open_weight
  FROM ranked),
marked AS (SELECT *, filled + ratio * open_weight < all_sizes AS capped FROM leveled),
shared AS (
  SELECT *, CAST(all_sizes - coalesce(sum(CASE WHEN capped THEN 3 * source_size END) OVER (), 0) AS DOUBLE)
            / CAST(sum(CASE WHEN NOT capped THEN weight END) OVER () AS BIGINT) AS rest
  FROM marked),
targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE)
              ELSE least(rest * weight, CAST(3 * source_size AS DOUBLE)) END AS target
  FROM shared),
laid AS (
  SELECT c.doc_id, c.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         CAST(row_number() OVER (PARTITION BY c.source ORDER BY c.size_class, c.lane, c.size, c.doc_id NULLS FIRST) AS DOUBLE) AS last,
         CAST(CAST('0x' || substr(md5('7|' || coalesce(c.source, '')), 1, 5) AS BIGINT) AS DOUBLE) / 1048576.0 AS shift
  FROM classed c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(least(floor(shift + rate * last) - floor(shift + rate * (last - 1)), ceil(rate)) AS BIGINT) * size AS taken
FROM laid
"""

OP9 = """
WITH valid AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM valid q JOIN valid c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP13 = """
WITH turns AS (
  SELECT conv_id, md5(coalesce(role, '')) || md5(coalesce(text, '')) AS label, length(coalesce(text, '')) AS n_chars,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS position
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, count(*) AS turns, conv_id - conv_id % 100 AS base,
         -- crc32 of the decimal key, bit by bit
         xor(list_reduce(list_concat([4294967295::BIGINT],
               [ascii(c)::BIGINT FOR c IN string_split(CAST(conv_id AS VARCHAR), '')]),
               lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
                                          lambda x, bit: xor(x >> 1, 3988292384::BIGINT * (x & 1)))),
             4294967295::BIGINT) % 6 AS head
  FROM turns GROUP BY conv_id),
info AS (
  SELECT c.conv_id, c.base, c.head, least(c.head, coalesce(b.turns, 0)) AS taken
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
rebuilt AS (
  SELECT conv_id, position - head + taken AS depth, label, n_chars
  FROM turns JOIN info USING (conv_id) WHERE position > head
  UNION ALL
  SELECT i.conv_id, t.position, t.label, t.n_chars
  FROM info i JOIN turns t ON t.conv_id = i.base AND t.position <= i.taken),
prefixes AS (
  SELECT conv_id, depth, n_chars,
         md5(string_agg(label, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, min(n_chars) AS n_chars FROM prefixes GROUP BY depth, key),
linked AS (
  SELECT n.*, p.key AS parent
  FROM nodes n LEFT JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
families AS (
  SELECT l.*, m.conv_id AS parent_conv_id, coalesce(c.n_children, 0) AS n_children
  FROM linked l LEFT JOIN nodes m ON m.depth = l.depth - 1 AND m.key = l.parent
  LEFT JOIN (SELECT depth - 1 AS depth, parent, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY 1, 2) c
    ON c.depth = l.depth AND c.parent = l.key),
subtrees AS (
  SELECT p.depth, p.key, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n_convs - 1) * f.n_chars) AS saved
  FROM families f JOIN prefixes p ON p.conv_id = f.conv_id AND p.depth <= f.depth GROUP BY p.depth, p.key),
ends AS (
  SELECT depth, key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, max(depth) AS depth, arg_max(key, depth) AS key FROM prefixes GROUP BY conv_id) GROUP BY depth, key)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, f.parent_conv_id, CAST(f.n_convs AS BIGINT) AS n_convs,
       CAST(f.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM families f JOIN subtrees s USING (depth, key) LEFT JOIN ends e USING (depth, key)
"""

STATEMENTS = {"op2_mix_sources": OP2, "op9_top_k": OP9, "op13_conversation_trie": OP13}


def oracle_sql() -> dict[str, str]:
    return dict(STATEMENTS)
