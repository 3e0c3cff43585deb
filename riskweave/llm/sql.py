"""SQL for the queries that SQL can express, in the dialect of DuckDB."""

WORDS = r"'[^\x20\x09-\x0D]+'"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {WORDS})) AS size,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || '/' || coalesce(md5(text), '-')), 1, 15))::BIGINT AS h
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighted AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
    CAST(2 * source_size AS DOUBLE) AS cap
  FROM sources
), running AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
    sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left,
    1.5::DOUBLE * sum(source_size) OVER () AS wanted
  FROM weighted
), levels AS (
  SELECT *, cap / weight * weight_left + cap_before <= wanted AS stopped FROM running
), targets AS (
  SELECT source, source_size, CASE WHEN stopped THEN cap ELSE weight * ((wanted - sum(CASE WHEN stopped THEN cap ELSE 0 END) OVER ())
    / sum(CASE WHEN stopped THEN 0 ELSE weight END) OVER ()) END AS target
  FROM levels
), shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets
), hashed AS (
  SELECT source, h, sum(size) AS words FROM docs GROUP BY source, h
), run AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM hashed
)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, s.source_size, CAST(s.target AS DOUBLE) AS target,
  CAST(d.size * (s.whole + CASE WHEN s.target - s.whole * s.source_size > 0
    AND 2 * (s.target - s.whole * s.source_size - r.before) >= r.words THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM docs d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source
JOIN run r ON r.source IS NOT DISTINCT FROM d.source AND r.h = d.h
"""

OP5 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
    list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
      ((('0x' || substr(hex, CAST(1 + 10 * (k // 8) AS BIGINT), 10))::BIGINT >> CAST(35 - 5 * (k % 8) AS BIGINT)) & 31) AS BIGINT), 1)),
      'string_agg', '') AS payload_digest
  FROM p
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM f
"""

OP4 = f"""
WITH items AS (
  SELECT item_id, w, least(5, len(w)) AS width
  FROM (SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, {WORDS}) AS w FROM benchmark) WHERE len(w) > 0
), item_shingles AS (
  SELECT DISTINCT item_id, width, array_to_string(w[i : i + width - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS i FROM items)
), counted AS (
  SELECT *, count(*) OVER (PARTITION BY item_id) AS n FROM item_shingles
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, {WORDS}) AS w FROM documents
), doc_shingles AS (
  SELECT DISTINCT r, doc_id, width, array_to_string(w[i : i + width - 1], ' ') AS s
  FROM (SELECT r, doc_id, width, w, unnest(range(1, len(w) - width + 2)) AS i
    FROM docs, (SELECT DISTINCT width FROM items) WHERE len(w) >= width)
)
SELECT doc_id, item_id, n AS item_shingles, count(*) AS shared_shingles, count(*) / CAST(n AS DOUBLE) AS containment
FROM doc_shingles JOIN counted USING (width, s) GROUP BY r, doc_id, item_id, n HAVING count(*) >= 0.75 * n
"""

OP12 = f"""
WITH turns AS (
  SELECT conv_id, len(regexp_extract_all(text, {WORDS})) AS words, md5(strlen(role) || ':' || role || text) AS name,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), own AS (
  SELECT conv_id, count(*) AS n, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END), 4294967295) % 4 AS h
  FROM turns GROUP BY conv_id
), convs AS (
  SELECT o.conv_id, o.h, least(o.h, coalesce(b.n, 0)) AS opening, o.conv_id - o.conv_id % 20 AS opener
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
), rebuilt AS (
  SELECT conv_id, i - h + opening AS depth, name, words FROM turns JOIN convs USING (conv_id) WHERE i > h
  UNION ALL
  SELECT c.conv_id, t.i, t.name, t.words FROM convs c JOIN turns t ON t.conv_id = c.opener AND t.i <= c.opening
), lists AS (
  SELECT conv_id, coalesce(list(name ORDER BY depth) FILTER (WHERE depth IS NOT NULL), []) AS names,
    coalesce(list(words ORDER BY depth) FILTER (WHERE depth IS NOT NULL), []) AS sizes
  FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id
), members AS (
  SELECT conv_id, d AS depth, len(names) = d AS ends, md5(array_to_string(names[1:d], '')) AS node,
    CASE WHEN d > 0 THEN md5(array_to_string(names[1:d - 1], '')) END AS parent, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS words
  FROM (SELECT *, unnest(range(0, len(names) + 1)) AS d FROM lists)
), nodes AS (
  SELECT node, depth, parent, words, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY node, depth, parent, words
), families AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children
  FROM nodes n LEFT JOIN (SELECT parent, count(*) AS n_children FROM nodes GROUP BY parent) c ON c.parent = n.node
), below AS (
  SELECT a.node, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved_tokens
  FROM (SELECT DISTINCT a.node, b.node AS other FROM members a JOIN members b ON a.conv_id = b.conv_id AND a.depth <= b.depth) a
  JOIN families f ON f.node = a.other GROUP BY a.node
)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, CAST(f.n_children AS BIGINT) AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM families f JOIN below USING (node) LEFT JOIN nodes p ON p.node = f.parent
"""

ORACLE_SQL = {"op2_source_mix": OP2, "op4_benchmark_containment": OP4, "op5_warc_revisits": OP5, "op12_conversation_trie": OP12}
