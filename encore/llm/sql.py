"""DuckDB SQL of the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op7_url_rules"] = r"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), places AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT page_id, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM places JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT p.page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM places p LEFT JOIN (SELECT * FROM fits WHERE place = 1) f USING (page_id)
"""


def _repair() -> str:
    """Damage, faults, and the cheapest repair by a recursion over rows with one column per state of the role grammar."""

    def plus(value: str, cost: str, letter: str) -> str:
        """A cost of nine digits and the audit so far, one action on; `~` cannot be reached."""
        return f"CASE WHEN {value} = '~' THEN '~' ELSE lpad(CAST(CAST(left({value}, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || substr({value}, 10) || '{letter}' END"

    def stay(value: str, initial: str) -> str:
        return (
            f"CASE WHEN fault = 'x' THEN '~' WHEN initial = '{initial}' THEN {plus(value, 'more', 'K')} ELSE "
            + (plus(value, "more + 1", "R") if initial != "s" else "'~'") + " END"
        )

    close2 = f"least(s2, {plus('s0', '5', 'I')}, {plus('s1', '5', 'I')}, {plus('s3', '5', 'I')})"
    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
        lambda c: CAST(ord(c) AS BIGINT)),
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1))),
      CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS damage
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
    CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN damage = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM keyed WHERE damage <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
    rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS told
  FROM damaged
), faults AS (
  SELECT *, CASE WHEN told = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
      WHEN right(told, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS name
  FROM numbered
), tokens AS (
  SELECT conv_id, n, left(role, 1) AS initial, CASE WHEN name IN ('blank', 'duplicate') THEN 'x' ELSE '.' END AS fault,
    CASE WHEN name = 'truncated' THEN 5 ELSE 0 END AS more, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before, name, turn
  FROM faults
), steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, '000000000' AS s0, '~' AS s1, '~' AS s2, '~' AS s3 FROM (SELECT DISTINCT conv_id FROM tokens)
  UNION ALL
  SELECT conv_id, n, {plus('s0', '2', 'D')}, least({plus('s1', '2', 'D')}, {stay('s0', 's')}),
    least({plus('i2', '2', 'D')}, {stay('s0', 'u')}, {stay('s1', 'u')}, {stay('i3', 'u')}), least({plus('i3', '2', 'D')}, {stay('i2', 'a')})
  FROM (
    SELECT conv_id, n, s0, s1, i2, least(s3, {plus('i2', '5', 'I')}) AS i3, initial, fault, more
    FROM (
      SELECT t.conv_id, t.n, s0, s1, s3, {close2} AS i2, initial, fault, more
      FROM steps s JOIN tokens t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.n = s.n + 1
    )
  )
), last AS (
  SELECT s.conv_id, least(s0, s3, {plus(close2, '5', 'I')}) AS best
  FROM steps s JOIN (SELECT conv_id, max(n) AS n FROM tokens GROUP BY 1) m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.n = s.n
), letters AS (
  SELECT conv_id, unnest(string_split(substr(best, 10), '')) AS letter, generate_subscripts(string_split(substr(best, 10), ''), 1) AS place FROM last
), placed AS (
  SELECT *, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER w AS n, sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER w AS line
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY place)
), lines AS (
  SELECT p.conv_id, place, letter, line, f.role, f.text,
    max(CASE WHEN line = 1 AND letter = 'K' AND left(f.role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS lead
  FROM placed p LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.n AND letter <> 'I'
  WHERE letter <> 'D'
), repaired AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (line - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY place)) AS hash
  FROM lines GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (name = 'blank') AS blank, count(*) FILTER (name = 'duplicate') AS duplicate, count(*) FILTER (name = 'truncated') AS truncated,
    count(*) FILTER (n > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM tokens GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(CAST(left(best, 9) AS BIGINT), 0) AS cost, coalesce(substr(best, 10), '') AS audit,
  coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN last l ON l.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM a.conv_id
"""


ORACLE["op11_glr_repair"] = _repair()


def _clusters(rounds: int = 10) -> str:
    steps = ""
    for at in range(rounds + 1):
        steps += f"""
, a{at} AS MATERIALIZED (
  SELECT row, cluster, d FROM (
    SELECT row, cluster, d, row_number() OVER (PARTITION BY row ORDER BY d, cluster) AS place FROM (
      SELECT p.row, c.cluster, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS d FROM parts p JOIN c{at} c USING (i) GROUP BY ALL))
  WHERE place = 1)"""
        if at < rounds:
            steps += f"""
, c{at + 1} AS MATERIALIZED (
  SELECT c.cluster, c.i, coalesce(m.x, c.x) AS x FROM c{at} c LEFT JOIN (
    SELECT a.cluster, p.i, CAST((sum(p.x) - ((sum(p.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
    FROM a{at} a JOIN parts p USING (row) GROUP BY ALL) m USING (cluster, i))"""
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT row, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM vectors
), starts AS (
  SELECT x, row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, x) - 1 AS cluster FROM vectors
), c0 AS MATERIALIZED (
  SELECT cluster, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM starts WHERE cluster < 8
){steps}
, told AS (
  SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS hash FROM c{rounds} GROUP BY cluster
)
SELECT vec_id, CAST(cluster AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, hash AS centroid_sha256
FROM a{rounds} JOIN vectors USING (row) JOIN told USING (cluster)
"""


ORACLE["op12_hadamard_clusters"] = _clusters()

ORACLE["op13_voronoi_top_k"] = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(place AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
WHERE place <= 10
"""
