"""SQL for the queries of this subpackage that SQL can express."""

SQL: dict[str, str] = {}

SQL["op2_line_dedup"] = """
WITH lines AS (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
    FROM documents
),
pages AS (SELECT source, count(*) AS pages FROM documents WHERE text IS NOT NULL GROUP BY source),
often AS (
    SELECT l.source, trim(l.line) AS line
    FROM lines l
    WHERE trim(l.line) <> ''
    GROUP BY l.source, trim(l.line)
    HAVING count(DISTINCT l.doc_id) >= 3
       AND count(DISTINCT l.doc_id) > 0.1 * (SELECT any_value(p.pages) FROM pages p WHERE p.source = l.source)
),
judged AS (
    SELECT l.*, EXISTS (SELECT 1 FROM often o WHERE o.source = l.source AND o.line = trim(l.line)) AS gone
    FROM lines l
),
cleaned AS (
    SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text, count(*) FILTER (gone) AS n
    FROM judged
    GROUP BY doc_id
)
SELECT d.doc_id, d.source, c.text, CAST(coalesce(c.n, 0) AS INTEGER) AS n_dropped
FROM documents d LEFT JOIN cleaned c USING (doc_id)
"""

SQL["op3_warc_from_arc"] = """
WITH records AS (
    SELECT page_id, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
firsts AS (
    SELECT payload_digest, min(page_id) AS first FROM records WHERE strlen(payload) >= 100 GROUP BY payload_digest
)
SELECT r.page_id, CAST(strlen(r.payload) AS BIGINT) AS payload_bytes, r.payload_digest,
       CASE WHEN f.first <> r.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> r.page_id THEN f.first END AS refers_to
FROM records r LEFT JOIN firsts f USING (payload_digest)
"""

SQL["op4_vector_near_duplicates"] = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
),
reached AS (
    SELECT vec_id AS node, vec_id AS origin FROM embeddings
    UNION
    SELECT l.b, r.origin FROM reached r JOIN links l ON l.a = r.node
),
smallest AS (SELECT node, min(origin) AS component_id FROM reached GROUP BY node),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, s.component_id, s.component_id = e.vec_id AS kept
FROM embeddings e JOIN smallest s ON s.node = e.vec_id LEFT JOIN degrees d ON d.a = e.vec_id
"""

SQL["op10_minhash_forest"] = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS shingles
    FROM worded
),
single AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
),
reached AS (
    SELECT doc_id AS node, doc_id AS origin FROM documents
    UNION
    SELECT l.b, r.origin FROM reached r JOIN links l ON l.a = r.node
),
smallest AS (SELECT node, min(origin) AS component_id FROM reached GROUP BY node)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, m.component_id, m.component_id = s.doc_id AS kept
FROM sets s JOIN smallest m ON m.node = s.doc_id
"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's bytes, four bits at a time."""
    steps = list(range(16))
    for _ in range(4):
        steps = [c >> 1 ^ 0xEDB88320 if c & 1 else c >> 1 for c in steps]
    each = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda h: ('0x' || h)::BIGINT)"
    half = lambda x: f"xor(({x}) >> 4, {steps}[(({x}) & 15) + 1])"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {each}), lambda a, b: {half(half('xor(a, b)'))}), 4294967295)"


SQL["op13_conversation_trie"] = f"""
WITH original AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (
               PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
           ) AS pos
    FROM conversations
    WHERE conv_id IS NOT NULL
),
shared AS (
    SELECT c, c - c % 100 AS base, ({_crc32("CAST(c AS VARCHAR)")}) % 6 AS h FROM (SELECT DISTINCT c FROM original)
),
heads AS (
    SELECT s.c, o.pos, o.role, o.text FROM shared s JOIN original o ON o.c = s.base AND o.pos <= s.h
),
given AS (SELECT c, count(*) AS k FROM heads GROUP BY c),
turns AS (
    SELECT * FROM heads
    UNION ALL
    SELECT s.c, o.pos - s.h + coalesce(g.k, 0), o.role, o.text
    FROM shared s JOIN original o ON o.c = s.c AND o.pos > s.h LEFT JOIN given g ON g.c = s.c
),
paths AS (
    SELECT c, pos AS depth, length(text) AS chars,
           md5(string_agg(md5(strlen(role) || ':' || role || text), ',') OVER (PARTITION BY c ORDER BY pos)) AS node
    FROM turns
    UNION ALL
    SELECT c, 0, 0, 'root' FROM shared
),
nodes AS (SELECT node, depth, min(c) AS conv, count(*) AS n_convs, any_value(chars) AS chars FROM paths GROUP BY node, depth),
parents AS (
    SELECT n.node, p.conv AS parent_conv
    FROM nodes n JOIN paths up ON up.c = n.conv AND up.depth = n.depth - 1 JOIN nodes p ON p.node = up.node AND p.depth = up.depth
),
kids AS (
    SELECT up.node, count(*) AS n_children
    FROM nodes n JOIN paths up ON up.c = n.conv AND up.depth = n.depth - 1
    GROUP BY up.node
),
subtrees AS (
    SELECT up.node, count(*) FILTER (k.node IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved
    FROM nodes n JOIN paths up ON up.c = n.conv AND up.depth <= n.depth LEFT JOIN kids k ON k.node = n.node
    GROUP BY up.node
),
ends AS (
    SELECT node, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends_sha256
    FROM (SELECT c, arg_max(node, depth) AS node FROM paths GROUP BY c)
    GROUP BY node
)
SELECT n.conv AS conv_id, CAST(n.depth AS BIGINT) AS depth, p.parent_conv AS parent_conv_id, n.n_convs,
       coalesce(k.n_children, 0) AS n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
       coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n
LEFT JOIN parents p ON p.node = n.node
LEFT JOIN kids k ON k.node = n.node
LEFT JOIN subtrees s ON s.node = n.node
LEFT JOIN ends e ON e.node = n.node
"""

SQL["op12_rendezvous_shards"] = f"""
WITH sized AS (
    SELECT d.doc_id, CAST(coalesce(strlen(d.text), 0) + 8 AS BIGINT) AS size, {_crc32("coalesce(d.text, '')")} AS text_crc32,
           coalesce(CAST(d.doc_id AS VARCHAR), 'content:' || md5(coalesce(d.text, ''))) AS named
    FROM documents d
),
scored AS (
    SELECT named, s.shard, -ln((CAST('0x' || substr(md5(named || ':' || s.shard), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) AS score
    FROM (SELECT DISTINCT named FROM sized), range(25) s(shard)
),
placed AS (
    SELECT named, arg_min(shard, score) FILTER (shard < 24) AS shard, arg_min(shard, score) AS grown_shard FROM scored GROUP BY named
)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM sized JOIN placed USING (named)
"""
