"""SQL counterparts of the queries of this folder, for DuckDB."""

from __future__ import annotations

OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM s
)
SELECT query_id, CAST(rn AS INTEGER) AS rank, vec_id, score FROM r WHERE rn <= 5
"""

_DRAWS = ", ".join(
    f"('0x' || substr(sha256(coalesce(doc_id::VARCHAR, 'null') || ':{j // 8}'), {8 * (j % 8) + 1}, 8))::BIGINT / 4294967296.0::DOUBLE"
    for j in range(16)
)

OP3 = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, [{_DRAWS}] AS draws
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), weighted AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS n, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM per
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER b, 0))
      / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS lvl
  FROM weighted
  WINDOW b AS (ORDER BY source_size::DOUBLE / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_min(lvl, (source_size::DOUBLE / w, n)) AS lvl FROM levels WHERE 2.0::DOUBLE * source_size >= lvl * w
), t AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce((SELECT lvl FROM level) * w, 2.0::DOUBLE * source_size)) AS target
  FROM weighted
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t
), tries AS (
  SELECT r.source, j, abs(sum(CASE WHEN d.draws[j] < r.rate - floor(r.rate) THEN d.size ELSE 0 END)
      - (any_value(r.rate) - floor(any_value(r.rate))) * any_value(r.source_size)) AS off
  FROM rates r JOIN d ON r.source IS NOT DISTINCT FROM d.source, range(1, 17) AS g(j) GROUP BY r.source, j
), chosen AS (
  SELECT source, arg_min(j, (off, j)) AS j FROM tries GROUP BY source
)
SELECT d.doc_id, d.size, r.source_size, r.target,
  CAST(d.size * (floor(r.rate) + CASE WHEN d.draws[c.j] < r.rate - floor(r.rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source
"""

OP4 = """
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), u AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM p
), s AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM u
), rules(h, p, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT s.page_id, s.host, s.path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM (SELECT DISTINCT * FROM s) s LEFT JOIN rules ON (s.host = h OR s.host LIKE '%.' || h) AND starts_with(s.path, p)
  GROUP BY ALL
)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM s JOIN fits f ON s.page_id IS NOT DISTINCT FROM f.page_id AND s.host = f.host AND s.path = f.path
"""

_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[0-9a-z\\x{80}-\\x{10FFFF}]+')"
)

OP6 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS w FROM documents
), b AS (
  SELECT item_id, {_WORDS} AS w, least(10, len({_WORDS})) AS k FROM benchmark WHERE len({_WORDS}) > 0
), bw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i + 1:i + k], ' ') AS g FROM b, unnest(range(0, len(w) - k + 1)) AS u(i)
), lengths AS (
  SELECT DISTINCT k FROM b
), dw AS (
  SELECT rid, i, k, array_to_string(w[i + 1:i + k], ' ') AS g
  FROM (SELECT rid, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM d, lengths)
), hit AS (
  SELECT rid, i, dw.k AS k, item_id FROM dw JOIN bw USING (k, g)
), pos AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hit) GROUP BY rid
), its AS (
  SELECT rid, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM hit GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""

OP8 = r"""
WITH RECURSIVE lines AS (
  SELECT rid, conv_id, turn, role, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM (SELECT row_number() OVER () AS rid, * FROM conversations)
), leveled AS (
  SELECT *, length(regexp_replace(regexp_extract(line, '^\s*>[> ]*'), '[^>]', '', 'g')) AS lvl, regexp_replace(line, '^\s*>[> ]*', '') AS words
  FROM lines
), flows AS (
  SELECT rid, any_value(conv_id) AS conv_id, any_value(turn) AS turn, lvl, 
    CASE lvl WHEN 0 THEN string_agg(words, chr(10) ORDER BY i) ELSE string_agg(words, ' ' ORDER BY i) END AS flow
  FROM leveled
  WHERE lvl > 0 OR NOT regexp_matches(words, '^\s*(On|Am|Le|El)\b.*(wrote|schrieb|écrit|escribió)[^:]*:\s*$')
  GROUP BY rid, lvl
), messages AS (
  SELECT c.rid, c.conv_id, c.turn, coalesce(c.role, 'unknown') AS role, coalesce(regexp_replace(f.flow, '^\s+|\s+$', '', 'g'), '') AS text
  FROM (SELECT row_number() OVER () AS rid, * FROM conversations) c LEFT JOIN flows f ON f.rid = c.rid AND f.lvl = 0
), pieces AS (
  SELECT conv_id, turn, lvl, trim(whole) AS whole,
    list_filter([trim(x) for x in string_split(regexp_replace(whole, '([.!?]) ', '\1' || chr(10), 'g'), chr(10))], lambda x: length(x) >= 8) AS long
  FROM (SELECT *, lower(regexp_replace(CASE lvl WHEN 0 THEN regexp_replace(flow, '^\s+|\s+$', '', 'g') ELSE flow END, '\s+', ' ', 'g')) AS whole FROM flows)
), units AS (
  SELECT DISTINCT conv_id, turn, lvl, unnest(CASE WHEN len(long) > 0 THEN long WHEN whole <> '' THEN [chr(10) || whole] ELSE [] END) AS u
  FROM pieces
), said AS (
  SELECT conv_id, u, min(turn) AS origin FROM units WHERE lvl = 0 GROUP BY ALL
), votes AS (
  SELECT q.conv_id, q.turn, q.lvl, s.origin, count(*) AS n
  FROM units q JOIN said s ON q.conv_id = s.conv_id AND q.u = s.u AND s.origin < q.turn AND q.lvl > 0 GROUP BY ALL
), parents AS (
  SELECT conv_id, turn, arg_max(origin, (-lvl, n, origin)) AS parent FROM votes GROUP BY ALL
), chain AS (
  SELECT conv_id, turn, turn AS root FROM (SELECT DISTINCT conv_id, turn FROM messages)
  UNION ALL
  SELECT c.conv_id, c.turn, p.parent FROM chain c JOIN parents p ON c.conv_id = p.conv_id AND c.root = p.turn
), rooted AS (
  SELECT conv_id, turn, min(root) AS root FROM chain GROUP BY ALL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY root, turn) - 1 AS place FROM rooted
)
SELECT m.conv_id, m.turn, m.role, p.parent, r.root, r.place, m.text, '<|' || m.role || '|>' || chr(10) || m.text || chr(10) AS formatted
FROM messages m JOIN placed r USING (conv_id, turn) LEFT JOIN parents p USING (conv_id, turn)
"""

# The same over messages of which two in three quote the one before.
QUOTED = OP8.replace(
    "WITH RECURSIVE",
    """WITH RECURSIVE answers AS (
  SELECT c.conv_id, c.turn, role, CASE WHEN before IS NULL OR c.turn % 3 = 0 THEN text
    ELSE '> ' || replace(before, chr(10), chr(10) || '> ') || chr(10) || coalesce(text, '') END AS text
  FROM conversations c LEFT JOIN (SELECT conv_id, turn + 1 AS turn, min(text) AS before FROM conversations GROUP BY ALL) b USING (conv_id, turn)
),""",
    1,
).replace("row_number() OVER () AS rid, * FROM conversations", "row_number() OVER (ORDER BY conv_id, turn, role, text) AS rid, * FROM answers")

OP9 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(0, len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' ')) END) AS g FROM d
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 75 * (any_value(na.n) + any_value(nb.n) - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(y) FROM reach WHERE x = d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id)
"""

# The pages of the provided tables have one template; on these, plain text rules say the same as the field.
OP10 = r"""
WITH a AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'),
    '</?(p|h1)>', chr(1), 'g'), '<[^>]*>', ' ', 'g') AS t FROM pages
), b AS (
  SELECT page_id, url, list_transform(string_split(t, chr(1)),
    lambda x: trim(regexp_replace(regexp_replace(regexp_replace(x, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS blocks FROM a
), c AS (
  SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)) AS text FROM b
)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM c
"""


def _ball_rounds(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """One pair of CTEs for each round: the nearest entry of every part, then the floored means."""
    nearest = """a{k} AS MATERIALIZED (
  SELECT row_id, p, arg_min(e, (d, e)) AS e, min(d)::BIGINT AS d FROM (
    SELECT x.row_id, x.p, b.e, x.xx - 2 * list_inner_product(x.x, b.c) + list_inner_product(b.c, b.c) AS d FROM parts x JOIN b{k} b USING (p)
  ) GROUP BY row_id, p
)"""
    moved = """m{k} AS (
  SELECT p, e, i, floor(sum(x[i]::BIGINT)::DOUBLE / count(*)) AS c FROM a{k} JOIN parts USING (row_id, p), range(1, 1 + (SELECT any_value(len(x)) FROM parts)) g(i)
  GROUP BY p, e, i
), b{n} AS MATERIALIZED (
  SELECT p, e, coalesce(l.c, b.c) AS c FROM b{k} b LEFT JOIN (SELECT p, e, list(c ORDER BY i) AS c FROM m{k} GROUP BY p, e) l USING (p, e)
)"""
    chain = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS (
  SELECT row_id, vec_id, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) AS x FROM kept, range({parts}) g(p)
), parts AS MATERIALIZED (
  SELECT *, list_inner_product(x, x) AS xx FROM cut
), b0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id, row_id) - 1 AS e, x AS c FROM parts
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id, row_id) <= {entries}
)"""]
    for k in range(rounds):
        chain += [nearest.format(k=k), moved.format(k=k, n=k + 1)]
    return ", ".join([*chain, nearest.format(k=rounds)])


OP12 = f"""
WITH {_ball_rounds()}, books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b4
), coded AS (
  SELECT row_id, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a4 GROUP BY row_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (row_id), books
"""

SQL: dict[str, str] = {
    "op1_topk": OP1,
    "op3_mixing": OP3,
    "op4_url_filter": OP4,
    "op6_decontamination": OP6,
    "op8_chat_formatting": OP8,
    "quoted_conversations": QUOTED,
    "op9_ngram_jaccard_join": OP9,
    "op10_html_extraction": OP10,
    "op12_vector_code_compression": OP12,
}
