"""DuckDB SQL of the queries that SQL can express, written from the contracts rather than from the Spark plans."""

from __future__ import annotations

from vitrine.llm import licence_rules

_HOST = "coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
_PATH = "coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '')"

OP8 = f"""
WITH judged AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
listed AS (
    SELECT DISTINCT host, path FROM judged
    WHERE regexp_matches(host, '(^|[.])(spam-farm|casino-win|cheap-pills)[.]')
),
ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    END AS rule
    FROM judged
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN (host, path) IN (SELECT (host, path) FROM listed) THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""


def _op9() -> str:
    known = licence_rules.SENTENCES
    forms = ", ".join(f"({n}, '{licence_rules.normalised(text)}')" for n, text in known.items())
    # Each rule takes what it finds; the sequence after rule k is in column r<k>.
    steps, last = [], "sentence_ids"
    for k, (_, sequence) in enumerate(licence_rules.RULES):
        wanted = "".join(f"<{n}>" for n in sequence)
        steps.append(
            f"s{k} AS (SELECT *, replace({last}, '{wanted}', '|') AS r{k}, "
            f"(length({last}) - length(replace({last}, '{wanted}', '|'))) // {len(wanted) - 1} AS n{k} "
            f"FROM {'ids' if k == 0 else f's{k - 1}'})"
        )
        last = f"r{k}"
    names = ", ".join(f"CASE WHEN n{k} > 0 THEN '{name}' END" for k, (name, _) in enumerate(licence_rules.RULES))
    total = " + ".join(f"n{k}" for k in range(len(licence_rules.RULES)))
    return f"""
    WITH known(id, form) AS (VALUES {forms}),
    numbered AS (SELECT row_number() OVER () AS n, doc_id, text FROM documents),
    cut AS (
        SELECT n, regexp_split_to_array(
            regexp_replace(lower(coalesce(text, '')), '[.!?]+([ \\t\\r\\n\\f\\v]|$)', chr(10), 'g'), chr(10)) AS parts
        FROM numbered
    ),
    formed AS (
        SELECT n, place, trim(regexp_replace(part, '[^a-z0-9]+', ' ', 'g')) AS form
        FROM (SELECT n, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM cut)
    ),
    counted AS (
        SELECT n, count(*) AS n_sentences,
            coalesce(string_agg('<' || id || '>', '' ORDER BY place), '') AS sentence_ids
        FROM formed LEFT JOIN known USING (form) WHERE form <> '' GROUP BY n
    ),
    ids AS (
        SELECT doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(sentence_ids, '') AS sentence_ids
        FROM numbered LEFT JOIN counted USING (n)
    ),
    {", ".join(steps)}
    SELECT doc_id, n_sentences, sentence_ids,
        array_to_string(list_sort(list_distinct(list_filter([{names}], lambda x: x IS NOT NULL))), ',') AS licences,
        CAST({total} AS BIGINT) AS n_matches
    FROM {f"s{len(licence_rules.RULES) - 1}"}
    """


OP2 = """
WITH usable AS (
    SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.row AS query_row, q.vec_id AS query_id, c.vec_id, c.row,
        CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.row <> c.row AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id NULLS FIRST, row) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


_GOOD = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP11 = """
WITH own AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
),
-- crc32 bit by bit
bits AS (
    SELECT conv_id, CAST(conv_id AS VARCHAR) AS digits, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, byte: list_reduce([xor(crc, byte), 1, 2, 3, 4, 5, 6, 7, 8],
            lambda x, step: xor(x >> 1, (x & 1) * 3988292384))) AS crc
    FROM (SELECT DISTINCT conv_id FROM own)
),
heads AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(crc, 4294967295) % 4 AS h FROM bits),
taken AS (
    SELECT heads.conv_id, own.place, role, text FROM heads JOIN own ON own.conv_id = heads.base AND own.place <= h
    UNION ALL
    SELECT heads.conv_id, 1000000 + own.place, role, text FROM heads JOIN own ON own.conv_id = heads.conv_id AND own.place > h
),
rebuilt AS (
    SELECT conv_id, row_number() OVER w AS depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
        string_agg(sha256(len(role) || ':' || role || text), '' ORDER BY place) OVER w AS path
    FROM taken WINDOW w AS (PARTITION BY conv_id ORDER BY place)
),
steps AS (
    SELECT conv_id, 0 AS depth, 0 AS words, '' AS path, NULL AS above FROM heads
    UNION ALL SELECT conv_id, depth, words, path, left(path, len(path) - 64) FROM rebuilt
),
ends AS (SELECT conv_id, arg_max(path, depth) AS path FROM steps GROUP BY conv_id),
nodes AS (
    SELECT path, any_value(above) AS above, any_value(depth) AS depth, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n
    FROM steps GROUP BY path
),
kids AS (SELECT above AS path, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above),
known AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (path)),
sums AS (
    SELECT a.path, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n - 1) * b.words) AS saved
    FROM known a JOIN known b ON b.depth >= a.depth AND left(b.path, 64 * a.depth) = a.path GROUP BY a.path
),
digests AS (SELECT path, string_agg(conv_id, ',' ORDER BY conv_id) AS ids FROM ends GROUP BY path)
SELECT known.conv_id, CAST(known.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, known.n AS n_convs, known.n_children,
    n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM known JOIN sums USING (path) LEFT JOIN nodes up ON up.path = known.above LEFT JOIN digests ON digests.path = known.path
"""

OP12 = f"""
WITH RECURSIVE rows AS (SELECT *, row_number() OVER () AS row FROM embeddings),
good AS (
    SELECT row, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM rows
    WHERE {_GOOD} AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.row AS a, b.row AS b FROM good a JOIN good b ON a.row <> b.row AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.9
),
reach(a, b) AS (SELECT row, row FROM rows UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
classes AS (SELECT a, min(vec_id) AS component_id FROM reach JOIN rows ON rows.row = reach.b GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows JOIN classes ON classes.a = rows.row LEFT JOIN counts ON counts.a = rows.row
"""

OP13 = f"""
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS row,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE label IS NOT NULL AND {_GOOD}
),
scored AS (
    SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row, b.vec_id, a.label = b.label AS same,
        CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.row <> b.row AND len(a.v) = len(b.v)
    WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS FIRST, row) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY n.score DESC, n.vec_id NULLS FIRST, n.row) AS INTEGER) AS rank
FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_pivot_search": OP2,
        "op8_url_filter": OP8,
        "op9_licences": _op9(),
        "op11_prefix_trie": OP11,
        "op12_near_vectors": OP12,
        "op13_hard_negatives": OP13,
    }
