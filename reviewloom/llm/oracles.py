"""DuckDB SQL of operators whose result a plain program of tables can give."""

from __future__ import annotations

_FIELDS = "doc_id::VARCHAR, source, lang, {n}, text"


def _leaf(n_chars: str) -> str:
    fields = _FIELDS.format(n=n_chars).split(", ")
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


_CRC32 = """xor(4294967295::UBIGINT, list_reduce([4294967295::UBIGINT] || list_transform(range(1, len({s}) + 1), lambda i: ascii(substr({s}, i, 1))::UBIGINT),
  lambda c, b: list_reduce([xor(c, b)] || range(8)::UBIGINT[], lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))))"""

MERKLE = f"""
WITH RECURSIVE rows_ AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS lang, {_leaf("n_chars::VARCHAR")} AS leaf,
    CASE WHEN {_CRC32.format(s="doc_id::VARCHAR")} % 7 = 0 THEN {_leaf("(n_chars + 1)::VARCHAR")} ELSE {_leaf("n_chars::VARCHAR")} END AS now
  FROM documents),
p AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n FROM rows_),
t AS (
  SELECT lang, 0 AS level, pos, leaf AS node, n FROM p
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(node || coalesce(after, '')), (n + 1) // 2
  FROM (SELECT *, lead(node) OVER (PARTITION BY lang ORDER BY pos) AS after FROM t WHERE n > 1) WHERE pos % 2 = 0),
s AS (
  SELECT lang, level AS height, node AS subroot, row_number() OVER (ORDER BY lang) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS level, pos, subroot AS node, n FROM s
  UNION ALL
  SELECT level + 1, pos // 2, sha256(node || coalesce(after, '')), (n + 1) // 2
  FROM (SELECT *, lead(node) OVER (ORDER BY pos) AS after FROM u WHERE n > 1) WHERE pos % 2 = 0),
steps AS (
  SELECT p.rid, t.level AS step, (p.pos >> t.level) % 2 AS is_right, o.node AS sibling
  FROM p JOIN (SELECT DISTINCT lang, level FROM t WHERE n > 1) t USING (lang)
  LEFT JOIN t o ON o.lang = p.lang AND o.level = t.level AND o.pos = xor(p.pos >> t.level, 1)
  UNION ALL
  SELECT p.rid, s.height + u.level, (s.pos >> u.level) % 2, o.node
  FROM p JOIN s USING (lang) JOIN (SELECT DISTINCT level FROM u WHERE n > 1) u ON true
  LEFT JOIN u o ON o.level = u.level AND o.pos = xor(s.pos >> u.level, 1)),
f AS (
  SELECT rid, 0 AS step, now AS node FROM p
  UNION ALL
  SELECT f.rid, f.step + 1, sha256(CASE WHEN is_right = 1 THEN coalesce(sibling, '') || node ELSE node || coalesce(sibling, '') END)
  FROM f JOIN steps USING (rid, step)),
folded AS (SELECT rid, arg_max(node, step) AS folded_root FROM f GROUP BY rid),
proofs AS (SELECT rid, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256 FROM steps GROUP BY rid),
root AS (SELECT node AS root FROM u WHERE n = 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM p JOIN s USING (lang) JOIN folded USING (rid) LEFT JOIN proofs USING (rid) CROSS JOIN root"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Lloyd's rounds written out; every assignment looks at all entries."""
    sql = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, w) AS rid, * FROM (
    SELECT vec_id, label, [floor(x::DOUBLE * {scale})::BIGINT for x in embedding] AS w FROM embeddings
    WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)),
x AS MATERIALIZED (
  SELECT rid, vec_id, label, p, w[p * (len(w) // {parts}) + 1 : (p + 1) * (len(w) // {parts})] AS x FROM v, range({parts}) r(p)),
b0 AS MATERIALIZED (SELECT p, rid - 1 AS e, x AS c FROM x WHERE rid <= {entries})"""
    for i in range(rounds + 1):
        sql += f""",
a{i} AS MATERIALIZED (
  SELECT rid, vec_id, label, p, x, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT x.*, e, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x, c)])::BIGINT AS d FROM x JOIN b{i} USING (p))
  GROUP BY ALL)"""
        if i < rounds:
            sql += f""",
m{i} AS (
  SELECT p, e, list(m ORDER BY k) AS c FROM (
    SELECT p, e, k, (sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*) AS m
    FROM (SELECT p, e, unnest(x) AS y, generate_subscripts(x, 1) AS k FROM a{i}) GROUP BY p, e, k) GROUP BY p, e),
b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c)::BIGINT[] AS c FROM b{i} b LEFT JOIN m{i} m USING (p, e))"""
    return sql + f""",
r AS (
  SELECT rid, vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM a{rounds} GROUP BY ALL)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM r"""

SUFFIX_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (
  SELECT rid, doc_id, i, md5(b[i + 1 : i + 100]) AS s
  FROM (SELECT rid, doc_id, b, unnest(range(greatest(octet_length(b) - 99, 0))) AS i FROM d)),
f AS (SELECT rid, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w),
g AS (SELECT rid, i, coalesce(i - lag(i) OVER (PARTITION BY rid ORDER BY i) > 100, true) AS first FROM f WHERE k > 1),
r AS (SELECT rid, i, sum(first::INT) OVER (PARTITION BY rid ORDER BY i) AS run FROM g),
s AS (SELECT rid, run, min(i) AS a, max(i) + 100 AS z FROM r GROUP BY rid, run),
p AS (
  SELECT rid, a, z, coalesce(lag(z) OVER (PARTITION BY rid ORDER BY z), 0) AS after FROM (
    SELECT rid, a, z FROM s UNION ALL SELECT rid, octet_length(b), octet_length(b) + 1 FROM d))
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, sum(least(z, octet_length(b)) - a)::BIGINT AS n_removed,
  (count(*) - 1)::BIGINT AS n_spans, sha256(unhex(string_agg(hex(b[after + 1 : a]), '' ORDER BY a, z))) AS kept_sha256
FROM p JOIN d USING (rid) GROUP BY rid, doc_id, b"""
