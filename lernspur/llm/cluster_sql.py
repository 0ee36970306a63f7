"""SQL for DuckDB of the centroid clustering query."""

from __future__ import annotations

from .centroids import CENTROIDS, DIMENSIONS, ROUNDS, SCALE, SEED


def _assign(turn: int) -> str:
    return f"""
        a{turn} AS MATERIALIZED (
          SELECT rid, min(struct_pack(d := d, c := c)) AS best
          FROM (SELECT rid, c, CAST(list_sum(list_transform(list_zip(x.v, m.v),
                       lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
                FROM x, m{turn} AS m)
          GROUP BY rid)"""


def _move(turn: int) -> str:
    return f"""
        m{turn + 1} AS MATERIALIZED (
          SELECT m.c, coalesce(t.v, m.v) AS v
          FROM m{turn} AS m LEFT JOIN (
            SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v
            FROM (SELECT best.c AS c, i, sum(x.v[i]) AS s, count(*) AS n
                  FROM a{turn} JOIN x USING (rid), range(1, {DIMENSIONS + 1}) AS r(i) GROUP BY 1, 2)
            GROUP BY c) AS t ON t.c = m.c)"""


SQL = f"""
        WITH x AS MATERIALIZED (
          SELECT row_number() OVER () AS rid, vec_id,
                 list_transform(embedding, lambda e: CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings
          WHERE len(embedding) = {DIMENSIONS}
            AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIMENSIONS}),
        m0 AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY sha256('{SEED}' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS c, v
          FROM x QUALIFY c < {CENTROIDS}),""" + ",".join(
    _assign(t) + ("," + _move(t) if t < ROUNDS else "") for t in range(ROUNDS + 1)) + f"""
        , f AS (SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance FROM a{ROUNDS} JOIN x USING (rid))
        SELECT vec_id, cluster, distance,
               CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(m.v, ',')) AS centroid_sha256
        FROM f JOIN m{ROUNDS} AS m ON m.c = f.cluster"""
