"""SQL checks of the manifest and of the filter audit."""

from __future__ import annotations

#: CRC-32 has no function in SQL: a table of 256 steps is made from its polynomial (a fixed value).
_CRC = """
    crc_steps AS (
        SELECT list(list_reduce([CAST(i AS BIGINT)] || [0, 0, 0, 0, 0, 0, 0, 0],
                    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
        FROM range(256) r(i)
    )
"""

_SIZED = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = " || ".join(_SIZED.format(c) for c in ("doc_id", "source", "lang", "n_chars"))

MANIFEST = f"""
    WITH RECURSIVE {_CRC}, docs AS (
        SELECT row_number() OVER () AS row, doc_id, coalesce('1' || source, '0') AS tree,
               sha256({_LEAF} || {_SIZED.format("text")}) AS leaf,
               CASE WHEN xor(list_reduce([4294967295] || [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')],
                             lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0
                    THEN sha256({_LEAF} || {_SIZED.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")})
               END AS other
        FROM documents, crc_steps
    ), leaves AS (
        SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs
    ), nodes AS (
        SELECT tree, 0 AS level, pos AS idx, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM leaves
        UNION ALL
        SELECT tree, level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), any_value((n + 15) // 16) FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 16
    ), subroots AS (
        SELECT tree, h AS subroot, level AS height, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM nodes WHERE n = 1
    ), upper_nodes AS (
        SELECT 0 AS level, pos AS idx, subroot AS h, count(*) OVER () AS n FROM subroots
        UNION ALL
        SELECT level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), any_value((n + 15) // 16) FROM upper_nodes WHERE n > 1 GROUP BY level, idx // 16
    ), sides AS (
        SELECT tree, level, idx,
               coalesce(string_agg(h, '' ORDER BY idx) OVER (PARTITION BY tree, level, idx // 16 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
               coalesce(string_agg(h, '' ORDER BY idx) OVER (PARTITION BY tree, level, idx // 16 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
        FROM (SELECT tree, level, idx, h FROM nodes WHERE n > 1 UNION ALL SELECT NULL, level, idx, h FROM upper_nodes WHERE n > 1)
    ), way AS (
        SELECT l.row, s.level AS k, s.before, s.after FROM leaves l JOIN sides s ON s.tree = l.tree AND s.idx = l.pos // CAST(pow(16, s.level) AS BIGINT)
        UNION ALL
        SELECT l.row, r.height + s.level, s.before, s.after
        FROM leaves l JOIN subroots r USING (tree) JOIN sides s ON s.tree IS NULL AND s.idx = r.pos // CAST(pow(16, s.level) AS BIGINT)
    ), folded AS (
        SELECT row, 0 AS k, coalesce(other, leaf) AS h FROM leaves
        UNION ALL
        SELECT f.row, f.k + 1, sha256(w.before || f.h || w.after) FROM folded f JOIN way w ON w.row = f.row AND w.k = f.k
    ), proofs AS (
        SELECT row, sha256(string_agg(before || after, '' ORDER BY k)) AS proof_sha256 FROM way GROUP BY row
    ), ends AS (
        SELECT row, arg_max(h, k) AS folded_root FROM folded GROUP BY row
    ), top AS (
        SELECT h AS root FROM upper_nodes WHERE n = 1
    )
    SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
    FROM leaves JOIN subroots USING (tree) JOIN ends USING (row) LEFT JOIN proofs USING (row), top
"""

FILTERS = r"""
    WITH docs AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS smallest
        FROM documents
    ), marks AS (
        SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
    ), cells AS (
        SELECT part, CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
               + CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 4 ELSE 0 END
               + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > smallest THEN 16 ELSE 0 END AS mask,
               count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
        FROM docs LEFT JOIN marks USING (doc_id) GROUP BY ALL
    ), letters AS (
        SELECT letter, 1 << k AS bit FROM (VALUES ('A', 0), ('B', 1), ('C', 2), ('D', 3), ('E', 4)) v(letter, k)
    ), orders AS (
        SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
        FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
    ), steps AS (
        SELECT filter_order, step, bits[step] AS bit, list_sum(list_slice(bits, 1, step - 1)) AS earlier FROM orders, range(1, 6) s(step)
    ), counted AS (
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, bit,
               sum(CASE WHEN mask & before = 0 AND mask & bit = 0 THEN n ELSE 0 END) AS kept,
               sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
               sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
               sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
               sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
               sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
        FROM cells, (SELECT *, CAST(coalesce(earlier, 0) AS INTEGER) AS before FROM steps) GROUP BY ALL
    )
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
           CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
    FROM counted
"""
