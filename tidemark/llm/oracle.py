"""SQL of the training-data queries that SQL can express."""

from __future__ import annotations


def _clusters(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Plain assignment and floor means, one round after the other."""
    parts = [f"""rows_ AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
v AS MATERIALIZED (
  SELECT rid, vec_id, unnest(range({dims})) AS d, floor(1024 * unnest(embedding)::DOUBLE)::HUGEINT AS x FROM rows_),
firsts AS MATERIALIZED (
  SELECT rid, row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR), embedding) - 1 AS k FROM rows_
  WHERE vec_id IS NOT NULL QUALIFY k < {k}),
c0 AS MATERIALIZED (SELECT k, d, x FROM v JOIN firsts USING (rid))"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, vec_id, k, s FROM (
    SELECT rid, any_value(vec_id) AS vec_id, k, sum((v.x - c.x) * (v.x - c.x)) AS s FROM v JOIN c{i} c USING (d) GROUP BY rid, k)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY s, k) = 1)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.k, c.d, coalesce((t - ((t % n) + n) % n) // n, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT k, d, sum(x)::HUGEINT AS t, count(*)::HUGEINT AS n FROM a{i} JOIN v USING (rid) GROUP BY k, d) USING (k, d))""")
    return "WITH " + ",\n".join(parts) + f""",
digest AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, k::INTEGER AS cluster, s::BIGINT AS distance, (sum(s) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
       (sum(s) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN digest USING (k)"""


_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT],
    list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""

_TRIE = f"""WITH own AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS MATERIALIZED (
  SELECT conv_id AS c, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (
  SELECT c, 0 AS part, n, role, text FROM convs JOIN own ON own.conv_id = base AND n <= h
  UNION ALL SELECT c, 1, n, role, text FROM convs JOIN own ON own.conv_id = c AND n > h),
deep AS MATERIALIZED (
  SELECT c, row_number() OVER w AS d, length(text) AS chars,
         sha256(string_agg(sha256(strlen(role) || ':' || role || text), '') OVER w) AS node
  FROM turns WINDOW w AS (PARTITION BY c ORDER BY part, n)),
lines AS MATERIALIZED (SELECT c, d, chars, node FROM deep UNION ALL SELECT c, 0, 0, '' FROM convs),
nodes AS MATERIALIZED (
  SELECT node, min(c) AS conv_id, any_value(d) AS depth, count(*) AS n_convs, any_value(chars) AS chars FROM lines GROUP BY node),
parents AS (SELECT DISTINCT a.node, b.node AS parent FROM lines a JOIN lines b ON a.c = b.c AND b.d = a.d - 1),
kids AS MATERIALIZED (
  SELECT nodes.*, p.conv_id AS parent_conv_id, coalesce(n, 0) AS n_children
  FROM nodes LEFT JOIN parents USING (node) LEFT JOIN nodes p ON p.node = parents.parent
  LEFT JOIN (SELECT parent, count(*) AS n FROM parents GROUP BY parent) k ON k.parent = nodes.node),
below AS (
  SELECT top, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
  FROM (SELECT DISTINCT a.node AS top, b.node FROM lines a JOIN lines b ON a.c = b.c AND b.d >= a.d) JOIN kids USING (node)
  GROUP BY top),
ends AS (
  SELECT node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256
  FROM (SELECT c, node FROM lines QUALIFY d = max(d) OVER (PARTITION BY c)) GROUP BY node)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM kids JOIN below ON top = node LEFT JOIN ends USING (node)"""

ORACLE: dict[str, str] = {"op11_centroids": _clusters(), "op13_prefix_trie": _TRIE}
