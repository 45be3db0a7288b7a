"""DuckDB SQL of the queries that SQL can express, written from the definitions."""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"

# Sources stop at their cap in the order of the level at which they are full; the rest share by weight.
MIXING = rf"""
WITH sized AS (
    SELECT doc_id, source, md5(text) AS digest, coalesce(len(regexp_extract_all(text, {_WORDS})), 0)::BIGINT AS size
    FROM documents
),
sources AS (
    SELECT source, source_size, rank, [3, 1, 2][(rank % 3) + 1]::BIGINT AS weight
    FROM (
        SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
        FROM sized GROUP BY source
    )
),
fill AS (
    SELECT a.rank, a.source, a.source_size, a.weight,
        (SELECT 3 * sum(source_size) FROM sources)
            - coalesce(sum(4 * b.source_size) FILTER (WHERE NOT later), 0) AS rest,
        sum(b.weight) FILTER (WHERE later) AS open_weight
    FROM sources a, (SELECT * FROM sources) b,
        LATERAL (SELECT (b.source_size / b.weight, b.rank) >= (a.source_size / a.weight, a.rank) AS later)
    GROUP BY ALL
),
level AS (
    SELECT rest, open_weight FROM fill WHERE 4 * source_size * open_weight > rest * weight
    ORDER BY source_size / weight, rank LIMIT 1
),
target AS (
    SELECT source, source_size, rank,
        CASE WHEN level.rest IS NULL OR 4 * source_size * level.open_weight <= level.rest * weight
            THEN 2.0::DOUBLE * source_size
            ELSE (weight * level.rest)::DOUBLE / (level.open_weight * 2)::DOUBLE END AS target
    FROM sources LEFT JOIN level ON true
),
laid AS (
    SELECT doc_id, size, source,
        coalesce(sum(size) OVER (
            PARTITION BY source ORDER BY ('0x' || substr(h, 1, 4))::INT % 256, h, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
        ), 0)::BIGINT AS first_at
    FROM (SELECT *, md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(digest, '')) AS h FROM sized)
),
passes AS (
    SELECT l.doc_id, l.size, t.source_size, t.target, t.rank,
        l.first_at AS at_1, l.first_at + t.source_size AS at_2
    FROM laid l JOIN target t ON l.source IS NOT DISTINCT FROM t.source
),
shares AS (
    SELECT *, CASE WHEN at_1 < target THEN at_1::DOUBLE / target END AS s_1,
        CASE WHEN at_2 < target THEN at_2::DOUBLE / target END AS s_2
    FROM passes
)
SELECT doc_id, size, source_size, target,
    (greatest(least(floor(target)::BIGINT - at_1, size), 0)
        + greatest(least(floor(target)::BIGINT - at_2, size), 0))::BIGINT AS taken,
    {{first}} AS position,
    {{second}} AS position_2
FROM shares
"""


def _due(s: str) -> str:
    def rising(s: str, w0: str) -> str:
        return f"2.0 * {s} / ({w0} + sqrt(greatest({w0} * {w0} + 3.0 * {s}, 0.0)))"

    return (
        f"CASE rank % 3 WHEN 0 THEN 2.0 * {s} / (1.5::DOUBLE + sqrt(greatest(2.25::DOUBLE + -2.0::DOUBLE * {s}, 0.0))) "
        f"WHEN 1 THEN {s} / 1.0::DOUBLE "
        f"ELSE CASE WHEN {s} < 0.3125 THEN {rising(s, '0.25::DOUBLE')} "
        f"ELSE 0.5::DOUBLE + {rising(f'({s} - 0.3125::DOUBLE)', '1.0::DOUBLE')} END END"
    )


MIXING = MIXING.replace("{first}", _due("s_1")).replace("{second}", _due("s_2"))

# Every pair of documents by an index of their shingles.
_LINKED = rf"""
words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
    FROM words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT x, y, shared = p.n AND shared = q.n AS equal FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * shared >= 75 * (p.n + q.n - shared)
)
"""

# The closure of the links.
NGRAM_JOIN = rf"""
WITH RECURSIVE {_LINKED},
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
    SELECT x AS node, x AS least FROM edges
    UNION
    SELECT e.y, r.least FROM reach r JOIN edges e ON e.x = r.node AND e.y > r.least
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r.least, d.doc_id)) AS component_id
FROM documents d
LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT node, min(least) AS least FROM reach GROUP BY node) r ON r.node = d.doc_id
"""

NGRAM_LINKS = rf"""
WITH {_LINKED},
ends AS (SELECT x AS doc_id, equal FROM links UNION ALL SELECT y, equal FROM links),
counted AS (
    SELECT doc_id, count(*) FILTER (WHERE equal) AS n_equal, count(*) FILTER (WHERE NOT equal) AS n_links FROM ends GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(n_equal, 0)::BIGINT AS n_equal, coalesce(n_links, 0)::BIGINT AS n_links
FROM documents d
LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN counted c ON c.doc_id = d.doc_id
"""

# Exact search (factor 1): every candidate's product, added up from the first component on.
VP_TREE = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        list_reduce(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]), lambda a, b: a + b) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_ITEM_WORDS = rf"regexp_extract_all(translate(text, {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# All windows of all documents against all windows of all items.
DECONTAMINATION = rf"""
WITH items AS (SELECT DISTINCT item_id, {_ITEM_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s + 1:s + least(len(w), 10)], ' ') AS words
    FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS s FROM items WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT k FROM windows),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_ITEM_WORDS}, []) AS w FROM documents),
cut AS (
    SELECT r, k, s, array_to_string(w[s + 1:s + k], ' ') AS words
    FROM (SELECT r, w, k, unnest(range(len(w) - k + 1)) AS s FROM docs, lengths WHERE len(w) >= k)
),
found AS (SELECT c.r, c.k, c.s, i.item_id FROM cut c JOIN windows i USING (k, words)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT r, k, s FROM found)) GROUP BY r),
named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, coalesce(item_id::VARCHAR, '') AS item FROM found) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

# crc32 by its table of 256 remainders; near words by what is left when one place is taken out.
SPELLING = rf"""
WITH RECURSIVE remainders AS MATERIALIZED (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) AS x(i)
    )
),
runs AS MATERIALIZED (
    SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS named, count(*) AS times
    FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, {_AZ}), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= 6 GROUP BY ALL
),
hashed AS (
    SELECT run, times, xor(list_reduce(
        [4294967295::BIGINT] || list_transform(range(1, strlen(named) + 1), lambda k: ('0x' || substr(hex(named), 2 * k - 1, 2))::BIGINT),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM runs, remainders
),
words AS MATERIALIZED (
    SELECT word, sum(times)::BIGINT AS n FROM (
        SELECT times, CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
        FROM hashed
    ) WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
),
holes AS MATERIALIZED (
    SELECT word, n, i, left(word, i) AS head, substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
),
pairs AS (
    SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b ON a.i = b.i AND a.head = b.head AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON b.word = a.head || a.rest
    UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON b.word = a.head || a.rest
),
near AS (SELECT word, count(*) AS n_near, max(m) AS best_n FROM pairs GROUP BY word),
best AS (
    SELECT word, n_near, best_n, min(other COLLATE C) AS best FROM near JOIN pairs USING (word) WHERE m = best_n GROUP BY ALL
),
formed AS MATERIALIZED (
    SELECT w.word, n, coalesce(n_near, 0)::BIGINT AS n_near,
        CASE WHEN best_n >= 5 * n THEN best END AS form, CASE WHEN best_n >= 5 * n THEN best_n END::BIGINT AS form_n
    FROM words w LEFT JOIN best USING (word)
),
walk AS (
    SELECT word, form AS at FROM formed WHERE form IS NOT NULL
    UNION ALL SELECT walk.word, f.form FROM walk JOIN formed f ON f.word = walk.at WHERE f.form IS NOT NULL
),
ends AS (SELECT walk.word, walk.at FROM walk JOIN formed f ON f.word = walk.at WHERE f.form IS NULL)
SELECT formed.word, form, coalesce(ends.at, formed.word) AS root, n, n_near, form_n FROM formed LEFT JOIN ends ON ends.word = formed.word
"""

ORACLE = {
    "op5_mixing": MIXING,
    "op7_vp_tree": VP_TREE,
    "op9_ngram_join": NGRAM_JOIN,
    "op9_ngram_links": NGRAM_LINKS,
    "op11_winnowing": DECONTAMINATION,
    "op12_edit_transducer": SPELLING,
}
