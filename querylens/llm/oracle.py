"""The same results in SQL for DuckDB, for the operators that SQL can express."""

from __future__ import annotations

# Words, windows and hits; a short item is one window of its own length.
DECONTAMINATE = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item, least(len(ws), 10) AS n, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS w
    FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
), lengths AS (
    SELECT DISTINCT n FROM item_windows
), doc_windows AS (
    SELECT r, i, n, array_to_string(ws[i : i + n - 1], ' ') AS w
    FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lengths WHERE len(ws) >= n)
), hits AS (
    SELECT r, i, n, item FROM doc_windows JOIN item_windows USING (n, w)
), words_hit AS (
    SELECT r, count(DISTINCT j) AS n_hit
    FROM (SELECT r, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT r, i, n FROM hits))
    GROUP BY r
), items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL)
    GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit USING (r) LEFT JOIN items USING (r)
"""

# Sizes, targets by filling the sources up to their limits, and the place of each document in its source's order.
MIX = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS key
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, 1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS weight FROM s
), o AS (
    SELECT *, sum(source_size) OVER () AS total,
        sum(weight) OVER later AS left_weight,
        sum(source_size) OVER () - 3 * (sum(source_size) OVER later_too - source_size) AS left_total
    FROM w
    WINDOW later AS (ORDER BY source_size / weight, encode(source) NULLS LAST
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
        later_too AS (ORDER BY source_size / weight, encode(source) NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), f AS (
    SELECT *, 3 * source_size * left_weight <= left_total * weight AS limited FROM o
), t AS (
    SELECT source, source_size,
        CASE WHEN limited THEN CAST(3 * source_size AS DOUBLE)
             ELSE CAST(total - sum(CASE WHEN limited THEN 3 * source_size ELSE 0 END) OVER () AS DOUBLE) * weight
                  / sum(CASE WHEN limited THEN 0 ELSE weight END) OVER () END AS target
    FROM f
), e AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t
), p AS (
    SELECT d.*, source_size, target, epochs, target - epochs * source_size AS part,
        sum(size) OVER (PARTITION BY d.source ORDER BY key, size RANGE UNBOUNDED PRECEDING)
            - sum(size) OVER (PARTITION BY d.source, key, size) AS start,
        sum(size) OVER (PARTITION BY d.source, key, size) AS tied
    FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
    CAST(size * (epochs + CASE WHEN 2 * start + tied < 2 * part THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
"""

# The prompt is what both conversations render alike, turn by turn, up to the first turn that differs.
PREFERENCE = r"""
WITH last_reply AS (
    SELECT conv_id, max(turn) AS turn FROM conversations WHERE role = 'assistant' GROUP BY conv_id
), t AS (
    SELECT c.conv_id, row_number() OVER (PARTITION BY c.conv_id ORDER BY c.turn NULLS FIRST, role, text) AS place,
        coalesce(role, '') AS role, coalesce(text, '') AS good,
        CASE WHEN role = 'assistant' AND l.turn IS NOT NULL THEN left(coalesce(text, ''), length(text) // 2)
             ELSE coalesce(text, '') END AS bad
    FROM conversations c LEFT JOIN last_reply l ON c.conv_id = l.conv_id AND c.turn = l.turn
    WHERE c.conv_id IS NOT NULL
), r AS (
    SELECT *, '<|' || role || '|>' || chr(10) || good || '<|end|>' || chr(10) AS a,
        '<|' || role || '|>' || chr(10) || bad || '<|end|>' || chr(10) AS b
    FROM t
), f AS (
    SELECT conv_id, coalesce(min(CASE WHEN a <> b THEN place END) - 1, count(*)) AS n_common FROM r GROUP BY conv_id
), p AS (
    SELECT r.*, n_common,
        coalesce(sum(CASE WHEN place > n_common THEN length(a) ELSE 0 END) OVER w, 0) AS a_at,
        coalesce(sum(CASE WHEN place > n_common THEN length(b) ELSE 0 END) OVER w, 0) AS b_at
    FROM r JOIN f USING (conv_id)
    WINDOW w AS (PARTITION BY r.conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT conv_id AS pair_id, any_value(n_common) AS n_common,
    coalesce(string_agg(a, '' ORDER BY place) FILTER (place <= n_common), '') AS prompt,
    coalesce(string_agg(a, '' ORDER BY place) FILTER (place > n_common), '') AS chosen,
    coalesce(string_agg(b, '' ORDER BY place) FILTER (place > n_common), '') AS rejected,
    coalesce(string_agg((a_at + 14)::BIGINT || '-' || (a_at + length(a) - 1)::BIGINT, ',' ORDER BY place)
             FILTER (place > n_common AND role = 'assistant'), '') AS chosen_mask,
    coalesce(string_agg((b_at + 14)::BIGINT || '-' || (b_at + length(b) - 1)::BIGINT, ',' ORDER BY place)
             FILTER (place > n_common AND role = 'assistant'), '') AS rejected_mask
FROM p GROUP BY conv_id
"""

# Tokens as a list, cut by slices; what is rebuilt is the text itself.
FILL_IN_MIDDLE = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
    FROM documents
), h AS (
    SELECT *, len(tokens) AS n, CAST('0x' || digest[1:8] AS BIGINT) AS h1, CAST('0x' || digest[9:16] AS BIGINT) AS h2,
        CAST('0x' || digest[17:24] AS BIGINT) AS h3, CAST('0x' || digest[25:32] AS BIGINT) AS h4
    FROM d
), c AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
             THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM h
), p AS (
    SELECT *, array_to_string(tokens[1:a], '') AS prefix, array_to_string(tokens[a + 1:b], '') AS middle,
        array_to_string(tokens[b + 1:], '') AS suffix
    FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
                     WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                     ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM p
"""

ORACLE_SQL = {
    "op4_decontaminate": DECONTAMINATE,
    "op6_preference": PREFERENCE,
    "op9_mix_sources": MIX,
    "op11_fill_in_middle": FILL_IN_MIDDLE,
}
