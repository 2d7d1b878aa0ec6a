"""SQL counterparts of the queries in this folder."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS h, sha256(coalesce(html, '')) AS payload_digest,
        strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages
), f AS (
    SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

OP4 = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS ws FROM documents),
w AS (
    SELECT doc_id, i, md5(array_to_string(list_slice(ws, i, i + 19), ' ')) AS g
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d)
), later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM w)
    WHERE k > 1
), gone AS (
    SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later)
    GROUP BY doc_id
), word AS (
    SELECT doc_id, p, w FROM (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS w FROM d)
), kept AS (
    SELECT word.doc_id, string_agg(w, ' ' ORDER BY p) AS t FROM word
    LEFT JOIN (SELECT doc_id, unnest(ps) AS p, true AS cut FROM gone) USING (doc_id, p)
    WHERE cut IS NULL GROUP BY word.doc_id
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

#: All pairs, then the least id reachable.
OP5 = """
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS l FROM e WHERE len(v) > 0),
p AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM n x JOIN n y
    ON x.vec_id <> y.vec_id AND list_inner_product(x.v, y.v) >= 0.95 * (x.l * y.l) AND x.l > 0 AND y.l > 0
), reach(v, r) AS (
    SELECT vec_id, vec_id FROM e UNION SELECT reach.v, p.b FROM reach JOIN p ON reach.r = p.a
), c AS (SELECT v AS vec_id, min(r) AS component_id FROM reach GROUP BY v),
d AS (SELECT a AS vec_id, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept,
    1.0::DOUBLE AS audited_recall
FROM c LEFT JOIN d USING (vec_id)
"""

OP6 = rf"""
WITH w AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {WORDS} AS ws FROM documents
), win AS (
    SELECT rid, i, list_slice(ws, i, i + 7) AS g
    FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)
), rep AS (
    SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1
), cov AS (
    SELECT rid, count(DISTINCT p) AS r FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY rid
), ln AS (
    SELECT rid, count(*) AS n, count(*) - count(DISTINCT l) AS d
    FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM w)
    WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid
), m AS (
    SELECT doc_id, len(ws)::BIGINT AS n_words,
        len(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        coalesce(ln.d, 0)::BIGINT AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words,
        coalesce(ln.n, 0)::BIGINT AS n_lines, len(regexp_extract_all(t, '!'))::BIGINT AS n_exclaimed
    FROM w LEFT JOIN cov USING (rid) LEFT JOIN ln USING (rid)
), b AS (
    SELECT *, (n_words < 20) AS b0, (100 * n_repeat_words > 30 * n_words) AS b1,
        (10 * n_symbols > n_words) AS b2, (n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines) AS b3,
        (100 * n_exclaimed > 20 * n_words) AS b4,
        (word_chars < 2 * n_words OR word_chars > 25 * n_words) AS b5
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_exclaimed,
    (b0::INT + 2 * b1::INT + 4 * b2::INT + 8 * b3::INT + 16 * b4::INT + 32 * b5::INT)::BIGINT AS failed,
    (b0 OR b1) AS base_failed, NOT (b0 OR b1 OR b2 OR b3 OR b4 OR b5) AS kept
FROM b
"""

#: Exact set join, then the least id reachable.
OP9 = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
    SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws ELSE list_slice(ws, i, i + 1) END AS s
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws), least(len(ws), 1) + 1))) AS i FROM d WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*)::BIGINT AS n FROM g GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id
    GROUP BY ALL
), e AS (
    SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * c >= 80 * (x.n + y.n - c)
), both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(v, r) AS (
    SELECT doc_id, doc_id FROM d UNION SELECT reach.v, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a
), m AS (SELECT v AS doc_id, min(r) AS component_id FROM reach GROUP BY v)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM m LEFT JOIN n USING (doc_id)
"""

#: Reshares by rounds, unlike the ordered trial of the operator.
OP10 = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, text, source, len({WORDS})::BIGINT AS size FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
    FROM d GROUP BY source
), t AS (SELECT sum(source_size)::BIGINT AS total FROM s),
limited AS (
    SELECT 0 AS k, []::VARCHAR[] AS names, 0::BIGINT AS held, (SELECT sum(w) FROM s)::BIGINT AS open_w, true AS more
    UNION ALL
    SELECT k + 1, list_concat(names, added),
        (SELECT coalesce(sum(3 * source_size), 0) FROM s WHERE list_contains(list_concat(names, added), coalesce('n' || source, '')))::BIGINT,
        (SELECT coalesce(sum(w), 0) FROM s WHERE NOT list_contains(list_concat(names, added), coalesce('n' || source, '')))::BIGINT,
        len(added) > 0
    FROM (
        SELECT k, names, coalesce((
            SELECT list(coalesce('n' || source, '')) FROM s, t
            WHERE NOT list_contains(names, coalesce('n' || source, ''))
                AND (total - held) / open_w * w > 3 * source_size), []::VARCHAR[]) AS added
        FROM limited WHERE more
    )
), share AS (SELECT names, (total - held) / open_w AS unit FROM limited, t ORDER BY k DESC LIMIT 1),
rates AS (
    SELECT source, source_size,
        CASE WHEN list_contains(names, coalesce('n' || source, '')) THEN (3 * source_size)::DOUBLE
             ELSE least((3 * source_size)::DOUBLE, unit * w) END AS target
    FROM s, share
), r AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM rates
)
SELECT doc_id, size, source_size, target,
    (size * (floor(rate) + CASE WHEN ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 't' || coalesce(text, ''))), 1, 13))::BIGINT
        / 4503599627370496.0 < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""

OP11 = r"""
WITH t AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(turn_key)) AS pos,
        turn_key, words
    FROM (
        SELECT conv_id, turn, concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')) AS turn_key,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
        FROM conversations WHERE conv_id IS NOT NULL
    )
), c AS (
    SELECT c, list_reduce(
        list_concat([4294967295], list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
        lambda acc, byte: list_reduce(
            list_concat([xor(acc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda r, unused: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END
        )
    ) AS crc FROM (SELECT DISTINCT c FROM t)
), h AS (
    SELECT c, xor(crc, 4294967295) % 4 AS h FROM c
), parts AS (
    SELECT h.c, 0 AS own, t.pos, turn_key, words FROM h JOIN t ON t.c = h.c - h.c % 20 AND t.pos <= h.h
    UNION ALL
    SELECT h.c, 1, t.pos, turn_key, words FROM h JOIN t ON t.c = h.c AND t.pos > h.h
), rebuilt AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d, turn_key, words FROM parts
), member AS (
    SELECT c, d, words, md5(string_agg(md5(turn_key), '') OVER (PARTITION BY c ORDER BY d)) AS node FROM rebuilt
    UNION ALL SELECT c, 0, 0, '' FROM h
), sized AS (
    SELECT *, max(d) OVER (PARTITION BY c) AS size FROM member
), nodes AS (
    SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words, max(size) = d AS leaf,
        sha256(coalesce(string_agg(CASE WHEN size = d THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
    FROM sized GROUP BY node, d
), edges AS (
    SELECT DISTINCT a.node AS child, b.node AS parent FROM sized a JOIN sized b ON a.c = b.c AND a.d = b.d + 1
), below AS (
    SELECT DISTINCT a.node AS top, b.node AS node FROM sized a JOIN sized b ON a.c = b.c AND b.d >= a.d
), fans AS (
    SELECT parent, count(*) AS n_children FROM edges GROUP BY parent
), sums AS (
    SELECT top, count(*) FILTER (leaf) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
    FROM below JOIN nodes USING (node) GROUP BY top
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs,
    coalesce(f.n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums ON top = n.node LEFT JOIN fans f ON f.parent = n.node LEFT JOIN edges e ON e.child = n.node LEFT JOIN nodes p ON p.node = e.parent
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_warc_chunks": OP1,
        "op4_recompression": OP4,
        "op5_nn_descent": OP5,
        "op6_rule_ledger": OP6,
        "op9_multi_index_minhash": OP9,
        "op10_repetition_mix": OP10,
        "op11_prefix_table": OP11,
    }
