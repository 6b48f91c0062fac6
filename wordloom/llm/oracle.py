"""SQL for the queries that SQL can express, in DuckDB's dialect, over whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# White space of the word pattern, and what parts words of the benchmark search.
SPACE = r"[\x09-\x0D\x20]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str, parting: str = SPACE, lower: bool = True) -> str:
    text = f"coalesce({text}, '')"
    if lower:
        text = f"translate({text}, '{UPPER}', '{LOWER}')"
    return f"list_filter(string_split_regex({text}, '{parting}'), lambda w: w <> '')"


REPEATED_WORDS = f"""
WITH docs AS (SELECT doc_id, {words('text', lower=False)} AS ws FROM documents),
places AS (
    SELECT doc_id, p, ws[p] AS w,
        CASE WHEN p + 49 <= len(ws) THEN md5(array_to_string(ws[p:p + 49], ' ')) END AS h
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM docs)),
firsts AS (SELECT h, min(doc_id) AS first FROM places WHERE h IS NOT NULL GROUP BY h),
covered AS (
    SELECT doc_id, p, w, coalesce(
        max(CASE WHEN first < doc_id THEN p END) OVER (PARTITION BY doc_id ORDER BY p) > p - 50,
        false) AS gone
    FROM places LEFT JOIN firsts USING (h)),
kept AS (
    SELECT doc_id, count(*) FILTER (gone) AS n,
        string_agg(w, ' ' ORDER BY p) FILTER (NOT gone) AS kept
    FROM covered GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

REPEATED_BYTES = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
places AS (
    SELECT doc_id, p, substr(x, 2 * p + 1, 2) AS b,
        CASE WHEN 2 * p + 200 <= length(x) THEN md5(substr(x, 2 * p + 1, 200)) END AS h
    FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2)) AS p FROM docs)),
firsts AS (
    SELECT h, min({'d': doc_id, 'p': p}) AS first FROM places WHERE h IS NOT NULL GROUP BY h),
covered AS (
    SELECT doc_id, p, b, coalesce(
        max(CASE WHEN first < {'d': doc_id, 'p': p} THEN p END)
            OVER (PARTITION BY doc_id ORDER BY p) > p - 100, false) AS gone
    FROM places LEFT JOIN firsts USING (h)),
runs AS (
    SELECT doc_id, p, b, gone,
        gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens
    FROM covered),
kept AS (
    SELECT doc_id, count(*) FILTER (gone) AS n, count(*) FILTER (opens) AS spans,
        string_agg(b, '' ORDER BY p) FILTER (NOT gone) AS kept
    FROM runs GROUP BY doc_id)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed,
    coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {words('text')} AS ws FROM documents),
sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1),
            lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE []::VARCHAR[] END) AS s
    FROM docs),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM members a JOIN members b USING (s) WHERE a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
    SELECT doc_id, doc_id AS other FROM sets
    UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
"""

CONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {words('text', NOT_WORD)} AS ws FROM documents),
items AS (SELECT item_id::VARCHAR AS item_id, {words('text', NOT_WORD)} AS ws FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[p:p + 9], ' ') AS t
    FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS p
          FROM items WHERE len(ws) > 0)),
lengths AS (SELECT DISTINCT k FROM windows),
found AS (
    SELECT doc_id, p, k, item_id
    FROM (SELECT doc_id, k, p, array_to_string(ws[p:p + k - 1], ' ') AS t
          FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM docs, lengths))
    JOIN windows USING (k, t)),
hits AS (
    SELECT doc_id, count(DISTINCT q) AS n_hit
    FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM found) GROUP BY doc_id),
ids AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

EMBEDDING_LINKS = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, CASE WHEN len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        THEN list_transform(embedding, lambda x: x::DOUBLE) END AS v
    FROM embeddings),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (
    SELECT vec_id AS a, vec_id AS b FROM vectors
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id
"""

# crc(bytes) by the table of the polynomial, which is made from its rule.
PREFIX_TRIE = """
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
        xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS crc
    FROM (SELECT unnest(range(256)) AS i)),
turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
            md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p,
        md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w
    FROM conversations),
own AS (
    SELECT conv_id, list(id ORDER BY p) AS ids, list(w ORDER BY p) AS ws FROM turns GROUP BY conv_id),
hashed AS (
    SELECT conv_id, ids, ws, xor(list_reduce(
        list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''),
            lambda c: ascii(c)::BIGINT)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 4 AS h
    FROM own, crc_table),
convs AS (
    SELECT a.conv_id, list_concat(coalesce(b.ids, [])[1:a.h], a.ids[a.h + 1:]) AS ids,
        list_concat(coalesce(b.ws, [])[1:a.h], a.ws[a.h + 1:]) AS ws
    FROM hashed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
members AS (
    SELECT conv_id, d AS depth, array_to_string(ids[1:d], '') AS path,
        array_to_string(ids[1:d - 1], '') AS above, coalesce(ws[d], 0) AS w, d = len(ids) AS ending
    FROM (SELECT *, unnest(range(len(ids) + 1)) AS d FROM convs)),
nodes AS (
    SELECT path, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
        any_value(w) AS w,
        coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ending), '') AS ends
    FROM members GROUP BY path, depth),
children AS (
    SELECT p.path, count(c.path) AS n_children
    FROM nodes p LEFT JOIN nodes c ON c.above = p.path AND c.depth = p.depth + 1 GROUP BY p.path),
below AS (
    SELECT a.path, count(*) FILTER (n_children = 0) AS n_leaves,
        sum(CASE WHEN b.depth > 0 THEN (b.n_convs - 1) * b.w ELSE 0 END) AS saved
    FROM nodes a JOIN nodes b ON starts_with(b.path, a.path) JOIN children c ON c.path = b.path
    GROUP BY a.path)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
    n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
    sha256(n.ends) AS ends_sha256
FROM nodes n JOIN children USING (path) JOIN below USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.above
"""

ORACLE: dict[str, str] = {
    "op2_substring_dedup": REPEATED_WORDS,
    "op5_near_duplicates": NEAR_DUPLICATES,
    "op6_suffix_array_dedup": REPEATED_BYTES,
    "op9_decontamination": CONTAMINATION,
    "op11_embedding_links": EMBEDDING_LINKS,
    "op12_prefix_trie": PREFIX_TRIE,
}
