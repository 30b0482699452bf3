"""SQL counterparts of the queries that SQL can express, over views named like the tables."""

from __future__ import annotations

from terrella.llm.mixing import WORD

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}') AS t FROM documents WHERE text IS NOT NULL),
  n AS (SELECT r, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
  s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
  tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL),
  w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM tf, s GROUP BY term, docs),
  m AS (SELECT r, doc_id, 10 + (90 * n * docs) // terms AS m FROM n, s),
  q AS (SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS term
    FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
  f AS (SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL),
  o AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST, r) AS rank FROM f WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM o WHERE rank <= 10"""


def _field(name: str) -> str:
    value = f"({name})::VARCHAR"
    return f"coalesce(strlen({value})::VARCHAR || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


#: crc32 of the decimal id, bit by bit; it only serves to pick rows.
_CRC = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, b:
  list_reduce([0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384), xor(c, b)),
  4294967295::BIGINT), 4294967295::BIGINT)"""

OP12 = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
      CASE WHEN {_CRC} % 7 = 0 AND n_chars IS NOT NULL THEN {_leaf("n_chars::HUGEINT + 1")} END AS tampered FROM documents),
  placed AS (SELECT *, coalesce('+' || lang, '') AS g,
      row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
  tree AS (
    SELECT g, 0 AS lvl, i, leaf AS node, count(*) OVER (PARTITION BY g) AS n FROM placed
    UNION ALL
    SELECT g, lvl + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (n + 1) // 2
    FROM tree WHERE n > 1 GROUP BY g, lvl, i // 2, n),
  subs AS (SELECT g, node AS subroot, lvl AS height, row_number() OVER (ORDER BY g) - 1 AS k FROM tree WHERE n = 1),
  top AS (
    SELECT 0 AS lvl, k AS i, subroot AS node, count(*) OVER () AS n FROM subs
    UNION ALL
    SELECT lvl + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY lvl, i // 2, n),
  steps AS (
    SELECT p.g, p.i, t.lvl AS step, t.node FROM placed p JOIN subs s USING (g)
      JOIN tree t ON t.g = p.g AND t.lvl < s.height AND t.i = xor(p.i >> t.lvl, 1)
    UNION ALL
    SELECT p.g, p.i, s.height + t.lvl, t.node FROM placed p JOIN subs s USING (g) JOIN top t ON t.n > 1 AND t.i = xor(s.k >> t.lvl, 1)),
  proofs AS (SELECT g, i, sha256(string_agg(node, '' ORDER BY step)) AS proof FROM steps GROUP BY ALL),
  heights AS (SELECT p.g, p.i, coalesce(tampered, leaf) AS start, s.height, s.k, (SELECT max(lvl) FROM top) AS higher
    FROM placed p JOIN subs s USING (g)),
  folds AS (
    SELECT g, i, 0 AS step, start AS acc FROM heights
    UNION ALL
    SELECT f.g, f.i, f.step + 1, sha256(CASE WHEN s.node IS NULL THEN f.acc
        WHEN (CASE WHEN f.step < h.height THEN f.i >> f.step ELSE h.k >> (f.step - h.height) END) & 1 = 1 THEN s.node || f.acc
        ELSE f.acc || s.node END)
    FROM folds f JOIN heights h USING (g, i) LEFT JOIN steps s ON s.g = f.g AND s.i = f.i AND s.step = f.step
    WHERE f.step < h.height + h.higher)
SELECT p.doc_id, p.leaf, s.subroot, t.node AS root, coalesce(r.proof, sha256('')) AS proof_sha256, f.acc AS folded_root,
  f.acc = t.node AS verified
FROM placed p JOIN subs s USING (g) JOIN heights h USING (g, i) JOIN folds f ON f.g = p.g AND f.i = p.i AND f.step = h.height + h.higher
  JOIN top t ON t.n = 1 LEFT JOIN proofs r ON r.g = p.g AND r.i = p.i"""

OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    md5(coalesce(text, '')) AS content FROM documents),
  k AS (SELECT source, sum(size)::BIGINT AS source_size,
      [5e0, 2e0, 1e0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
    FROM d GROUP BY source),
  c AS (SELECT *, coalesce(sum(3 * source_size) OVER e, 0)::BIGINT AS capped, sum(weight) OVER e AS used
    FROM k WINDOW e AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  l AS (SELECT ((SELECT sum(source_size) FROM k)::BIGINT - capped) / ((SELECT sum(weight) FROM k) - coalesce(used, 0e0)) AS level,
      3 * source_size / weight AS ratio FROM c),
  v AS (SELECT coalesce(arg_min(level, ratio) FILTER (WHERE level <= ratio), 0e0) AS level FROM l),
  g AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, weight * level) AS target FROM k, v),
  a AS (SELECT r, doc_id, size, d.source, source_size, target, floor(target + 5e-1)::BIGINT AS goal,
      CAST('0x' || substr(md5(concat_ws('-', '13', coalesce(doc_id::VARCHAR, ''), content)), 1, 15) AS BIGINT) AS draw, content
    FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
  b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id NULLS FIRST, content, r
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
      CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS whole FROM a),
  t AS (SELECT *, greatest(least(goal - whole * source_size - before, size), 0) AS part FROM b),
  x AS (SELECT r, source, before, pass, CASE WHEN pass < whole THEN size ELSE part END AS words,
      (pass * source_size + before)::DOUBLE AS done, goal, target, source_size FROM t, (SELECT unnest([0, 1, 2, 3]) AS pass) WHERE pass <= whole),
  u AS (SELECT x.*, weight, (done + words / 2e0) / goal * weight AS wanted,
      CASE weight WHEN 5e0 THEN 7.5e0 WHEN 2e0 THEN 2e0 ELSE 5e-1 END AS first,
      CASE weight WHEN 5e0 THEN -5e0 WHEN 2e0 THEN 0e0 ELSE 1e0 END AS slope
    FROM x JOIN k ON x.source IS NOT DISTINCT FROM k.source WHERE words > 0),
  y AS (SELECT *, least(2e0 * wanted / (first + sqrt(greatest(first * first + 2e0 * slope * wanted, 0e0))), 1e0) AS moment FROM u),
  z AS (SELECT r, coalesce(sum(words) OVER (ORDER BY moment, source NULLS FIRST, before, pass
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS spot FROM y),
  f AS (SELECT r, min(spot) AS first_position FROM z GROUP BY r)
SELECT doc_id, size, source_size, target, (whole * size + part)::BIGINT AS taken, first_position FROM t LEFT JOIN f USING (r)"""
