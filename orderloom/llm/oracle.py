"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

LINE_DEDUP = r"""
WITH rows AS (
    SELECT doc_id, coalesce(doc_id, 9223372036854775807) AS doc, row_number() OVER () AS r,
           string_split(coalesce(text, ''), chr(10)) AS parts
    FROM documents
), lines AS (
    SELECT r, doc, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM rows
), keyed AS (
    SELECT r, doc, pos, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lines
), repeated AS (
    SELECT k, min(doc) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING min(doc) <> max(doc)
), marked AS (
    SELECT keyed.*, repeated.k IS NOT NULL AND doc <> owner AS gone FROM keyed LEFT JOIN repeated USING (k)
), per AS (
    SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
    FROM marked GROUP BY r
)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM per JOIN rows USING (r)
"""

#: documents_cte: a table expression with doc_id, text, source
MIXING_PLAN = r"""
sized AS (
    SELECT d.*, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS key,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5('mix-1|' || coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, '')))) AS draw
    FROM {documents} d
), per_source AS (
    SELECT key, source, sum(size)::BIGINT AS source_size FROM sized GROUP BY key, source
), weighted AS (
    SELECT key, source_size, ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
    FROM per_source
), fullest AS (
    -- sources by the level at which they are full; level: once the earlier ones are capped
    SELECT key, source_size, weight, source_size * 3 / weight AS full_at,
           (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER before, 0))::DOUBLE
             / sum(weight) OVER (ORDER BY source_size * 3 / weight, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted
    WINDOW before AS (ORDER BY source_size * 3 / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
    SELECT coalesce(max(level) FILTER (full_at >= level), 0) AS level FROM fullest
), targets AS (
    SELECT key, source_size, least(source_size * 3::DOUBLE, level * weight) AS target FROM weighted, water
), wholes AS (
    SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS whole FROM targets
), placed AS (
    SELECT s.*, source_size, target, whole, target - whole * source_size AS rest,
           sum(size) OVER (PARTITION BY key ORDER BY draw RANGE UNBOUNDED PRECEDING) AS upto
    FROM sized s JOIN wholes USING (key)
), mixed AS (
    SELECT *, whole + CASE WHEN upto * 2 - size <= rest * 2 THEN 1 ELSE 0 END AS reps FROM placed
)
"""

MIXING = "WITH " + MIXING_PLAN.format(documents="documents") + """
SELECT doc_id, size, source_size, target, (size * reps)::BIGINT AS taken FROM mixed
"""


#: smallest node reachable over the table expression links(a, b), both directions given
REACHED = """
reach(node, other) AS (
    SELECT a, b FROM links
    UNION
    SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other
), smallest AS (
    SELECT node, least(node, min(other)) AS component_id FROM reach GROUP BY node
)
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS v, row_number() OVER () AS r FROM embeddings
), usable AS (
    SELECT * FROM vectors WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
       AND list_dot_product(v, v) > 0
), pairs AS (
    SELECT x.r AS rx, x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.r <> y.r AND len(x.v) = len(y.v)
    WHERE list_dot_product(x.v, y.v) / (sqrt(list_dot_product(x.v, x.v)) * sqrt(list_dot_product(y.v, y.v))) >= 0.95
), links AS (SELECT DISTINCT a, b FROM pairs),
""" + REACHED + """
, counted AS (SELECT rx AS r, count(*) AS n FROM pairs GROUP BY rx)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM vectors LEFT JOIN counted USING (r) LEFT JOIN smallest ON node = vec_id
"""

NEAR_DEDUP = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, row_number() OVER () AS r,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split WHERE len(w) > 0)
), sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (
    SELECT x.r AS rx, y.r AS ry, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.r < y.r GROUP BY ALL
), close_pairs AS (
    SELECT rx, ry FROM shared JOIN sizes x ON x.r = rx JOIN sizes y ON y.r = ry
    WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)
), both_ways AS (SELECT rx, ry FROM close_pairs UNION SELECT ry, rx FROM close_pairs),
links AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM both_ways JOIN split x ON x.r = rx JOIN split y ON y.r = ry),
""" + REACHED + """
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       coalesce(component_id, doc_id) = doc_id AS kept
FROM split LEFT JOIN sizes USING (r) LEFT JOIN smallest ON node = doc_id
"""

DECONTAMINATE = r"""
WITH cut AS (
    SELECT doc_id, row_number() OVER () AS r,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
    FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)
), places AS (
    SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
    FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM cut, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
), found AS (SELECT r, k, i, item_id FROM places JOIN windows USING (k, s)),
hits AS (SELECT r, count(DISTINCT word) AS n FROM (SELECT r, unnest(range(i, i + k)) AS word FROM found) GROUP BY r),
owners AS (
    SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit, coalesce(owners.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM cut LEFT JOIN hits USING (r) LEFT JOIN owners USING (r)
"""

PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), cut AS (
    SELECT lang, w FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces) WHERE len(w) > 0
), sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM cut GROUP BY lang),
places AS (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM cut, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
), counted AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
    SELECT c.lang, c.k, c.phrase, c.f AS a, l.f AS l, r.f AS r, cut_at, (2000000::HUGEINT * c.f // (l.f + r.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut_at, string_split(phrase, ' ') AS w FROM counted WHERE k > 1) c
    JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut_at], ' ')
    JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut_at + 1:c.k], ' ')
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1
), inside AS (
    SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, max(f) AS f FROM (
        SELECT *, unnest(range(1, k - n + 2)) AS i FROM (SELECT lang, k, f, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS n FROM counted WHERE k > 2))
    GROUP BY ALL
), ranked AS (
    SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, encode(best.phrase)) AS rank
    FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.phrase = best.phrase
    WHERE coalesce(inside.f, 0) * 100 < a * 80
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""

PREFIX_TRIE = r"""
WITH turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
    FROM conversations
), convs AS (
    -- the reflected CRC-32, bit by bit over the bytes of the decimal id
    SELECT c, c - c % 100 AS base,
           xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
               lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                   lambda x, zero: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 6 AS h
    FROM (SELECT DISTINCT conv_id AS c FROM conversations)
), own AS (
    SELECT convs.c, 0 AS part, pos, role, text FROM convs JOIN turns ON turns.c = base AND pos < h
    UNION ALL
    SELECT convs.c, 1, pos, role, text FROM convs JOIN turns ON turns.c = convs.c AND pos >= h
), whole AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS depth,
           length(role) || ':' || role || length(text) || ':' || text || ';' AS turn, length(text) AS n
    FROM own
), prefixes AS (
    SELECT c, depth, n, string_agg(turn, '') OVER (PARTITION BY c ORDER BY depth) AS node FROM whole
    UNION ALL
    SELECT c, 0, 0, '' FROM convs
), lengths AS (SELECT c, max(depth) AS len FROM prefixes GROUP BY c),
nodes AS (
    SELECT depth, node, min(c) AS conv_id, any_value(n) AS n, count(*) AS n_convs, max(len) AS longest,
           coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len = depth), '') AS ended
    FROM prefixes JOIN lengths USING (c) GROUP BY depth, node
), ancestors AS (
    -- every node that the smallest member of a node passes on the way to it
    SELECT x.depth, x.conv_id, a.conv_id AS up, a.depth AS up_depth,
           CASE WHEN x.depth > 0 THEN (x.n_convs - 1) * x.n ELSE 0 END AS saved, x.longest = x.depth AS leaf
    FROM nodes x JOIN prefixes p ON p.c = x.conv_id AND p.depth <= x.depth JOIN nodes a ON a.depth = p.depth AND a.node = p.node
), subtrees AS (
    SELECT up AS conv_id, up_depth AS depth, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (leaf) AS n_leaves,
           count(*) FILTER (ancestors.depth = up_depth + 1) AS n_children
    FROM ancestors GROUP BY up, up_depth
)
SELECT nodes.conv_id, nodes.depth, up AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ended) AS ends_sha256
FROM nodes JOIN subtrees ON subtrees.conv_id = nodes.conv_id AND subtrees.depth = nodes.depth
LEFT JOIN ancestors ON ancestors.conv_id = nodes.conv_id AND ancestors.depth = nodes.depth AND up_depth = nodes.depth - 1
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_embedding_dedup": EMBEDDING_DEDUP, "op4_near_dedup": NEAR_DEDUP, "op5_line_dedup": LINE_DEDUP,
            "op6_mixing": MIXING, "op9_decontaminate": DECONTAMINATE, "op11_phrases": PHRASES, "op13_prefix_trie": PREFIX_TRIE}
