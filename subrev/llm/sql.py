"""Check SQL (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from subrev.llm import quality_rules

_WHITE = r"[^\x20\x09-\x0D]+"

_OP4 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{_WHITE}') AS ws, string_split(t, chr(10)) AS ls FROM d),
five AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS x
         FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
hit AS (SELECT r, i FROM five WHERE (r, x) IN (SELECT (r, x) FROM five GROUP BY r, x HAVING count(*) > 1)),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM hit, range(5) AS o(k) GROUP BY r),
stutter AS (SELECT r, count(*) AS n FROM (SELECT r, ws, unnest(range(2, len(ws) + 1)) AS i FROM w) WHERE ws[i] = ws[i - 1] GROUP BY r),
line AS (SELECT r, unnest(ls) AS x FROM w),
lines AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT x) AS dup FROM line WHERE regexp_matches(x, '{_WHITE}') GROUP BY r),
m AS (SELECT doc_id, ws, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(lines.dup, 0)::BIGINT AS n_dup_lines,
             coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(lines.n, 0)::BIGINT AS n_lines,
             length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS letters, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS uppers,
             coalesce(stutter.n, 0) AS stutters
      FROM w LEFT JOIN covered USING (r) LEFT JOIN lines USING (r) LEFT JOIN stutter USING (r)),
f AS (SELECT *, (n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
             + 8 * (10 * n_dup_lines > 4 * n_lines)::INT + 16 * (word_chars < 2 * n_words OR word_chars > 12 * n_words)::INT
             + 32 * (2 * uppers > letters AND letters > 0)::INT + 64 * (10 * stutters > 3 * len(ws))::INT AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 != 0 AS base_failed,
       failures & {quality_rules.policy_mask("v1")} = 0 AS kept, failures::BIGINT AS failures, 'v1' AS policy
FROM f
"""

_OP7 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS x
        FROM (SELECT item, ws, least(13, len(ws)) AS n, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
run AS (SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS x
       FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n)),
hit AS (SELECT r, i, n, item FROM run JOIN win USING (n, x)),
word AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(word.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items.s, '')) AS items_sha256,
       coalesce(word.n, 0) > 0 AND 20 * coalesce(word.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN word USING (r) LEFT JOIN items USING (r)
"""

_OP10 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '{_WHITE}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS x
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s AS a JOIN s AS b ON a.x = b.x AND a.doc_id != b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM o JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * k >= 90 * (na.n + nb.n - k)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       least(doc_id, (SELECT min(b) FROM reach WHERE a = doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id)
"""

_OP11 = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
           AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.r, a.vec_id AS anchor_id, a.label AS anchor_label, b.r AS other, b.vec_id, b.label,
             list_dot_product(a.e, b.e)::BIGINT AS score
      FROM v AS a JOIN v AS b ON a.r != b.r WHERE a.vec_id % 50 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, other) AS slot FROM s WHERE label = anchor_label QUALIFY slot <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.r, p.slot ORDER BY s.score DESC, s.vec_id, s.other)::INT AS rank
      FROM p JOIN s ON s.r = p.r AND s.label != p.anchor_label AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: crc32 of the decimal id, bit by bit, lowest first.
_CRC = """xor(4294967295, list_reduce([4294967295] || flatten([[(ascii(c) >> k) & 1 FOR k IN range(8)] FOR c IN string_split(doc_id::VARCHAR, '')]),
    lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)))"""

_OP13 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, lang, {_leaf('text')} AS leaf,
                            CASE WHEN doc_id IS NOT NULL AND {_CRC} % 3 = 0 THEN {_leaf(_LOWERED)} END AS other FROM documents),
leaf AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d),
node(lang, level, i, h, n) AS (SELECT lang, 0, i, leaf, n FROM leaf UNION ALL
    SELECT lang, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM node WHERE n > 1 GROUP BY lang, level, i // 8, n),
sub AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1),
top(level, i, h, n) AS (SELECT 0, i, h, n FROM sub UNION ALL
    SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY level, i // 8, n),
run AS (SELECT leaf.r, node.level AS k, node.i, node.h, leaf.i // (8 ** node.level)::BIGINT AS own FROM leaf JOIN node
            ON node.lang IS NOT DISTINCT FROM leaf.lang AND node.n > 1 AND node.i // 8 = leaf.i // (8 ** (node.level + 1))::BIGINT
        UNION ALL SELECT leaf.r, 1000 + top.level, top.i, top.h, sub.i // (8 ** top.level)::BIGINT FROM leaf JOIN sub ON sub.lang IS NOT DISTINCT FROM leaf.lang
            JOIN top ON top.n > 1 AND top.i // 8 = sub.i // (8 ** (top.level + 1))::BIGINT),
step AS (SELECT r, coalesce(string_agg(h, '' ORDER BY i) FILTER (i < own), '') AS before, coalesce(string_agg(h, '' ORDER BY i) FILTER (i > own), '') AS after,
                row_number() OVER (PARTITION BY r ORDER BY k) AS k FROM run GROUP BY r, k),
proof AS (SELECT r, sha256(string_agg(before || after, '' ORDER BY k)) AS p, count(*) AS steps FROM step GROUP BY r),
fold(r, k, h) AS (SELECT r, 0, coalesce(other, leaf) FROM leaf UNION ALL
    SELECT fold.r, fold.k + 1, sha256(before || h || after) FROM fold JOIN step ON step.r = fold.r AND step.k = fold.k + 1)
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, coalesce(p, sha256('')) AS proof_sha256, fold.h AS folded_root, fold.h = top.h AS verified
FROM leaf JOIN sub ON sub.lang IS NOT DISTINCT FROM leaf.lang JOIN top ON top.n = 1 LEFT JOIN proof USING (r)
JOIN fold ON fold.r = leaf.r AND fold.k = coalesce(steps, 0)
"""

ORACLE_SQL: dict[str, str] = {
    "op4_quality_rules": _OP4.strip(), "op7_decontaminate": _OP7, "op10_jaccard_join": _OP10, "op11_hard_negatives": _OP11, "op13_merkle_manifest": _OP13}
