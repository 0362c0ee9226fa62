"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations


def clusters(k: int = 8, rounds: int = 10, seed: int = 3) -> str:
    """Lloyd's rounds on integer vectors, one pair of tables for each."""
    squares = "list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    parts = [
        """v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, v
  FROM v ORDER BY sha256('{seed}:' || vec_id) LIMIT {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, v, best.d AS d, best.c AS c FROM (
    SELECT vec_id, v.v AS v, min({{'d': {squares}, 'c': c.c}}) AS best FROM v CROSS JOIN c{i} c GROUP BY vec_id, v.v))""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS v FROM (
      SELECT c, place, sum(x) AS s, count(*) AS n FROM (
        SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i}) GROUP BY c, place)
    GROUP BY c) m ON m.c = o.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.c"""
