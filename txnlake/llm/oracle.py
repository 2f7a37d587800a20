"""SQL of another engine for the operators that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH item_words AS (
    SELECT item_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
    FROM benchmark
),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, i, i + 9) AS win
    FROM (
        SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM item_words WHERE len(w) > 0
    )
),
doc_words AS (
    SELECT doc_id, row_number() OVER () AS r,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
    FROM documents
),
starts AS (
    SELECT r, i, n, list_slice(w, i, i + n - 1) AS win
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
),
hits AS (
    SELECT r, i, s.n, item_id FROM starts s JOIN windows v ON s.win = v.win AND s.n = v.n
),
covered AS (
    SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits))
    GROUP BY r
),
named AS (
    SELECT r, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM hits GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

LINE_DEDUP = r"""
WITH parts AS (
    SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r,
        string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
),
lines AS (
    SELECT r, i - 1 AS line_no,
        list_filter(string_split_regex(lines[i], '[\x20\x09\x0B-\x0D]+'), lambda x: x <> '') AS w
    FROM (SELECT r, lines, unnest(range(1, len(lines) + 1)) AS i FROM parts)
),
worded AS (SELECT r, line_no, w FROM lines WHERE len(w) > 0),
firsts AS (
    SELECT w, min(struct_pack(r := r, l := line_no)) AS place FROM worded GROUP BY w
),
variants AS (
    SELECT place, n, p, w[1:p] || w[p + 2:] AS rest
    FROM (SELECT place, w, len(w) AS n, unnest(range(0, len(w))) AS p
          FROM firsts WHERE len(w) >= 8)
    UNION ALL
    SELECT place, n + 1, p, w
    FROM (SELECT place, w, len(w) AS n, unnest(range(0, len(w) + 1)) AS p
          FROM firsts WHERE len(w) >= 8)
),
gone AS (
    SELECT DISTINCT place FROM (
        SELECT place, min(place) OVER (PARTITION BY n, p, rest) AS least FROM variants
    ) WHERE least < place
),
kept AS (
    SELECT place.r AS r, count(*) AS n_kept,
        string_agg(place.l::VARCHAR, ',' ORDER BY place.l) AS kept
    FROM firsts WHERE place NOT IN (SELECT place FROM gone) GROUP BY 1
),
counted AS (SELECT r, count(*) AS n_lines FROM worded GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_kept, 0)::BIGINT AS n_kept,
    coalesce(kept, '') AS kept_lines
FROM parts LEFT JOIN counted USING (r) LEFT JOIN kept USING (r)
"""

EXACT_DEDUP = r"""
WITH rows AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
),
ranked AS (
    SELECT doc_id, norm,
        first_value(doc_id) OVER g AS keep_id,
        row_number() OVER g AS place,
        count(*) OVER (PARTITION BY norm) AS group_size
    FROM rows WINDOW g AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM ranked
"""


# crc32 of the digits of an id, bit by bit, as SQL has no function for it.
CRC32 = """xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT,
            list_transform(string_split(c::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)),
        lambda crc, b: list_reduce(
            list_prepend(xor(crc, b), range(8)),
            lambda v, k: xor(v >> 1, 3988292384::BIGINT * (v & 1))
        )
    ))"""

CONVERSATION_TRIE = f"""
WITH turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT c, c - c % 5 AS donor, {CRC32} % 9 AS h FROM (SELECT DISTINCT c FROM turns)
),
spliced AS (
    SELECT v.c, 0 AS part, i, role, text FROM convs v JOIN turns t ON t.c = v.donor AND i <= h
    UNION ALL
    SELECT v.c, 1, i, role, text FROM convs v JOIN turns t ON t.c = v.c AND i > h
),
rebuilt AS (
    SELECT c, text, sha256(sha256(role) || sha256(text)) AS own,
        row_number() OVER (PARTITION BY c ORDER BY part, i) AS d
    FROM spliced
),
prefixes AS (
    SELECT c, d, strlen(text) AS bytes,
        sha256(string_agg(own, '') OVER (PARTITION BY c ORDER BY d)) AS k
    FROM rebuilt
    UNION ALL
    SELECT c, 0, 0, '' FROM convs
),
ends AS (
    SELECT d, k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
    FROM (SELECT *, max(d) OVER (PARTITION BY c) AS last FROM prefixes) WHERE d = last
    GROUP BY d, k
),
nodes AS (
    SELECT d, k, min(c) AS c, count(*) AS n_convs, min(bytes) AS bytes FROM prefixes GROUP BY d, k
),
parents AS (
    SELECT n.d, n.k, p.k AS up FROM nodes n JOIN prefixes p ON p.c = n.c AND p.d = n.d - 1
),
children AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM parents GROUP BY ALL),
subtrees AS (
    SELECT p.d, p.k, count(*) FILTER (WHERE f.n_children IS NULL) AS n_leaves,
        sum((n.n_convs - 1) * n.bytes) AS saved
    FROM nodes n LEFT JOIN children f ON f.d = n.d AND f.k = n.k
        JOIN prefixes p ON p.c = n.c AND p.d <= n.d
    GROUP BY p.d, p.k
)
SELECT n.c AS conv_id, n.d AS depth, m.c AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
    coalesce(f.n_children, 0)::BIGINT AS n_children, t.n_leaves::BIGINT AS n_leaves,
    t.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n
JOIN subtrees t ON t.d = n.d AND t.k = n.k
LEFT JOIN parents p ON p.d = n.d AND p.k = n.k
LEFT JOIN nodes m ON m.d = n.d - 1 AND m.k = p.up
LEFT JOIN children f ON f.d = n.d AND f.k = n.k
LEFT JOIN ends e ON e.d = n.d AND e.k = n.k
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": DECONTAMINATION,
        "op5_line_dedup": LINE_DEDUP,
        "op8_exact_dedup": EXACT_DEDUP,
        "op13_conversation_trie": CONVERSATION_TRIE,
    }
