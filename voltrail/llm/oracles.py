"""DuckDB SQL of the operators whose rows SQL can say, beside that in ``queries``."""

from __future__ import annotations

_FIELD = "COALESCE(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c=c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: The trees level by level, each leaf's siblings looked up by position; CRC-32 by its table of 256 entries.
MERKLE = f"""WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
 lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
leaves AS (SELECT doc_id, source, {_leaf('text')} AS leaf,
 CASE WHEN list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])) & 1 = 1 THEN {_leaf("replace(text, chr(10), '')")} END AS changed,
 row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos, COUNT(*) OVER (PARTITION BY source) AS n FROM documents, crc),
tree AS (SELECT source, 0 AS level, pos, leaf AS node, n FROM leaves UNION ALL
 SELECT source, level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3 FROM tree WHERE n > 1 GROUP BY source, level, pos // 3, n),
tops AS (SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, COUNT(*) OVER () AS n FROM tree WHERE n = 1),
upper AS (SELECT 0 AS level, pos, subroot AS node, n FROM tops UNION ALL
 SELECT level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3 FROM upper WHERE n > 1 GROUP BY level, pos // 3, n),
sides AS (SELECT a.source, a.level, a.pos, COALESCE(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
  COALESCE(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
 FROM tree a JOIN tree b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY 1, 2, 3),
top_sides AS (SELECT a.level, a.pos, COALESCE(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
  COALESCE(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
 FROM upper a JOIN upper b ON a.level = b.level AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY 1, 2),
steps AS (SELECT d.doc_id, s.level, s.l, s.r FROM leaves d JOIN sides s ON s.source IS NOT DISTINCT FROM d.source AND s.pos = d.pos // CAST(3 ** s.level AS BIGINT)
 UNION ALL SELECT d.doc_id, 1000 + s.level, s.l, s.r FROM leaves d JOIN tops t ON t.source IS NOT DISTINCT FROM d.source
  JOIN top_sides s ON s.pos = t.pos // CAST(3 ** s.level AS BIGINT)),
paths AS (SELECT doc_id, string_agg(l || r, '' ORDER BY level) AS proof, list(l || '|' || r ORDER BY level) AS path FROM steps GROUP BY doc_id),
folded AS (SELECT d.doc_id, d.leaf, t.subroot, u.node AS root, sha256(COALESCE(p.proof, '')) AS proof_sha256,
 list_reduce(list_prepend(COALESCE(d.changed, d.leaf), COALESCE(p.path, [])), lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2))) AS folded_root
 FROM leaves d JOIN tops t ON t.source IS NOT DISTINCT FROM d.source CROSS JOIN (SELECT node FROM upper WHERE n = 1) u LEFT JOIN paths p ON p.doc_id = d.doc_id)
SELECT *, folded_root = root AS verified FROM folded"""

#: Rounds of sharing, then what each document has of its source's whole turns and of the last, started one.
MIXING = r"""WITH RECURSIVE sized AS (SELECT doc_id, source, CAST(len([x for x in string_split_regex(COALESCE(text, ''), '[\x20\x09-\x0D]+') if x <> '']) AS BIGINT) AS size FROM documents),
src AS (SELECT source, CAST(SUM(size) AS BIGINT) AS s, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM sized GROUP BY source),
rounds AS (SELECT 0 AS i, CAST(SUM(s) AS HUGEINT) AS rest, CAST(SUM(w) AS HUGEINT) AS open FROM src UNION ALL
 SELECT r.i + 1, CAST(SUM(s) - SUM(CASE WHEN w * r.rest > 3 * s * r.open THEN 3 * s ELSE 0 END) AS HUGEINT), CAST(SUM(CASE WHEN w * r.rest > 3 * s * r.open THEN 0 ELSE w END) AS HUGEINT)
 FROM rounds r, src GROUP BY r.i, r.rest, r.open
 HAVING SUM(CASE WHEN w * r.rest > 3 * s * r.open THEN 0 ELSE w END) <> r.open AND SUM(CASE WHEN w * r.rest > 3 * s * r.open THEN 0 ELSE w END) > 0),
goal AS (SELECT source, s, CASE WHEN w * rest > 3 * s * open THEN CAST(3 * s AS DOUBLE) ELSE CAST(w AS DOUBLE) * CAST(rest AS DOUBLE) / CAST(open AS DOUBLE) END AS target
 FROM src, (SELECT rest, open FROM rounds ORDER BY i DESC LIMIT 1)),
placed AS (SELECT doc_id, source, size, CAST(SUM(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)) NULLS FIRST, doc_id, size
 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS before FROM sized)
SELECT p.doc_id, p.size, g.s AS source_size, g.target, CASE WHEN g.s = 0 THEN 0 ELSE CAST(round(g.target) AS BIGINT) // g.s * p.size
 + greatest(0, least(p.size, CAST(round(g.target) AS BIGINT) % g.s - p.before)) END AS taken
FROM placed p JOIN goal g ON g.source IS NOT DISTINCT FROM p.source"""

#: Every anchor against every row.
HARD_NEGATIVES = """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) for x in embedding] AS v
 FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
 FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
 QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
negative AS (SELECT p.anchor_id, p.positive_id, p.positive_score, n.other_id AS negative_id, n.score AS negative_score,
 row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS rank
 FROM positive p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 10"""
