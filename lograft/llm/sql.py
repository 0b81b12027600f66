"""DuckDB SQL of the queries whose results SQL can express, generated from the same parameters."""

from __future__ import annotations


def centroid_sql(clusters: int = 40, rounds: int = 5, width: int = 64, scale: int = 256, seed: str = "2") -> str:
    """Every distance of every round as a sum over a join of components."""
    steps = ""
    for j in range(rounds + 1):
        steps += f""",
d{j} AS MATERIALIZED (SELECT e.rid, c.c, sum((e.x - c.x) * (e.x - c.x))::BIGINT AS d FROM e JOIN c{j} c ON e.i = c.i GROUP BY ALL),
a{j} AS MATERIALIZED (SELECT rid, c, d FROM d{j} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)"""
        if j < rounds:
            steps += f""",
s{j} AS (SELECT a.c, e.i, sum(e.x)::BIGINT AS s, count(*) AS n FROM a{j} a JOIN e ON e.rid = a.rid GROUP BY ALL),
c{j + 1} AS MATERIALIZED (SELECT c.c, c.i, coalesce((s - ((s % n) + n) % n) // n, c.x) AS x FROM c{j} c LEFT JOIN s{j} s ON s.c = c.c AND s.i = c.i)"""
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}),
e AS MATERIALIZED (SELECT rid, unnest(range({width})) AS i, unnest(v) AS x FROM v),
f AS (SELECT rid, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM v),
c0 AS MATERIALIZED (SELECT f.c, e.i, e.x FROM f JOIN e USING (rid) WHERE f.c < {clusters}){steps},
h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, a.c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} a JOIN v USING (rid) JOIN h ON h.c = a.c
"""


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit: after the first of a byte's eight steps, nothing is mixed in."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda ch: [ord(ch), 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(c, e) >> 1, (xor(c, e) & 1) * 3988292384)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform({bits}, lambda b: b::BIGINT)), lambda c, e: {step}), 4294967295)"


def repair_sql() -> str:
    """Damage, faults, and the cheapest edits row by row: per conversation and state the
    least (cost, audit) with its repaired text. States: 0 nothing, 1 system, 2 user, 3 assistant."""
    name = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    space = r"'[\x20\x09-\x0D]'"
    inserted = """SELECT {cols}, s, cost, audit, kept FROM {table}
       UNION ALL SELECT {cols}, t.t, cost + 5, audit || 'I', kept || t.role || ':' || chr(10) FROM {table} JOIN turned t USING (s)"""
    return fr"""
WITH RECURSIVE
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql(name)} % 20 AS rule FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN rule = 4 THEN 'user' ELSE role END AS role,
        CASE rule WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN rule = 3 THEN [0, 1] ELSE [0] END) AS copy FROM c WHERE rule <> 0),
o AS (SELECT *, dense_rank() OVER (ORDER BY conv_id) AS g, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
        regexp_replace(text, {space}, '', 'g') AS words FROM d),
w AS (SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) AS nth, lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) AS prev FROM o),
r AS MATERIALIZED (SELECT g, i, conv_id, turn, role, text, left(role, 1) AS ini, prev,
        CASE WHEN words = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(words, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM w),
stays(s, ini, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
turned(s, t, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
best(g, i, s, cost, audit, kept) AS (
  SELECT DISTINCT g, 0::BIGINT, 0, 0::BIGINT, '', '' FROM r
  UNION ALL
  SELECT g, i, s, least.cost, least.audit, least.kept FROM (
    SELECT g, i, s, min({{'cost': cost, 'audit': audit, 'kept': kept}}) AS least FROM (
      WITH b AS ({inserted.format(cols='g, i', table='best')}),
      e AS (SELECT b.g, r.i, b.s, b.cost, b.audit, b.kept, r.ini, r.role, r.text, r.fault, CASE WHEN r.fault = 'truncated' THEN 5 ELSE 0 END AS more
            FROM b JOIN r ON r.g = b.g AND r.i = b.i + 1)
      SELECT g, i, s, cost + 2 AS cost, audit || 'D' AS audit, kept FROM e
      UNION ALL SELECT g, i, k.t, cost + more, audit || 'K', kept || role || ':' || text || chr(10) FROM e JOIN stays k USING (s, ini)
        WHERE fault NOT IN ('blank', 'duplicate')
      UNION ALL SELECT g, i, t.t, cost + more + 1, audit || 'R', kept || t.role || ':' || text || chr(10) FROM e JOIN turned t USING (s)
        WHERE fault NOT IN ('blank', 'duplicate')
    ) GROUP BY g, i, s)),
n AS (SELECT g, any_value(conv_id) AS conv_id, max(i) AS i, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
        count_if(i > 1 AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY g),
f AS (SELECT g, min({{'cost': cost, 'audit': audit, 'kept': kept}}) AS least FROM (
        {inserted.format(cols='g', table='(SELECT best.* FROM best JOIN n ON n.g = best.g AND n.i = best.i)')}) WHERE s IN (0, 3) GROUP BY g),
a AS (SELECT n.*, least.cost AS cost, least.audit AS audit, least.kept[:-2] AS kept FROM n JOIN f USING (g))
SELECT u.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(kept, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) u LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM u.conv_id
"""
