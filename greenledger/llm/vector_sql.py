"""DuckDB SQL of the vector queries: every distance, unrolled round by round."""

from __future__ import annotations

_SOUND = "len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_INTS = "list_transform(embedding, lambda x: floor(256 * x::DOUBLE))"


def _gap(a: str, b: str) -> str:
    """Squared distance of two lists of whole numbers, exact in doubles."""
    return f"list_inner_product({a}, {a}) - 2 * list_inner_product({a}, {b}) + list_inner_product({b}, {b})"


def centroids_sql(k: int = 40, rounds: int = 5) -> str:
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, {_INTS} AS v FROM embeddings
                  WHERE len(embedding) = 64 AND {_SOUND}),
             c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS c, v FROM
                  (SELECT sha256('2:' || vec_id) AS h, v FROM v ORDER BY h NULLS LAST, v LIMIT {k}))"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, min([{_gap('v.v', 'c.v')}, c]) AS m FROM v, c{i} AS c GROUP BY r)""")
        if i < rounds:
            steps.append(f"""m{i} AS MATERIALIZED (SELECT c, list(m ORDER BY i) AS v FROM
                  (SELECT c, i, floor(sum(x) / count(*)) AS m FROM
                   (SELECT m[2] AS c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i} JOIN v USING (r)) GROUP BY c, i) GROUP BY c),
             c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} AS c LEFT JOIN m{i} AS m ON m.c = c.c)""")
    return f"""
        WITH {', '.join(steps)}
        SELECT vec_id, m[2]::INT AS cluster, m[1]::BIGINT AS distance,
               (sum(m[1]) OVER (PARTITION BY m[2]))::BIGINT AS cluster_inertia, (sum(m[1]) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(list_transform(c.v, lambda x: x::BIGINT), ',')) AS centroid_sha256
        FROM a{rounds} AS a JOIN v USING (r) JOIN c{rounds} AS c ON c.c = a.m[2]"""


def codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    steps = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, {_INTS} AS v FROM embeddings WHERE {_SOUND}),
             width AS (SELECT len(v) AS n FROM kept ORDER BY vec_id NULLS LAST, v LIMIT 1),
             v AS MATERIALIZED (SELECT kept.* FROM kept, width WHERE len(v) = n),
             x AS MATERIALIZED (SELECT r, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x
                  FROM v, range({parts}) AS t(p)),
             f AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM v QUALIFY e < {entries}),
             c0 AS MATERIALIZED (SELECT p, e, x AS c FROM x JOIN f USING (r))"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, p, min([{_gap('x', 'c')}, e]) AS m FROM x JOIN c{i} USING (p) GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""m{i} AS MATERIALIZED (SELECT p, e, list(m ORDER BY i) AS c FROM
                  (SELECT p, e, i, floor(sum(y) / count(*)) AS m FROM
                   (SELECT p, m[2] AS e, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{i} JOIN x USING (r, p)) GROUP BY p, e, i) GROUP BY p, e),
             c{i + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(m.c, c.c) AS c FROM c{i} AS c LEFT JOIN m{i} AS m ON m.p = c.p AND m.e = c.e)""")
    return f"""
        WITH {', '.join(steps)},
             coded AS (SELECT r, string_agg(lpad(lower(to_hex(m[2]::INT)), 2, '0'), '' ORDER BY p) AS code, sum(m[1])::BIGINT AS error
                       FROM a{rounds} GROUP BY r),
             books AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda y: y::BIGINT), ','), ',' ORDER BY p, e)) AS h FROM c{rounds})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
        FROM coded JOIN v USING (r), books"""
