"""SQL for DuckDB that gives the rows of a registered query, plainly: all pairs are formed."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


#: ``node, component`` of ``link(x, y)``, which holds both directions.
REACH = """
    reach AS (
        SELECT x AS node, y AS other FROM link
        UNION SELECT r.node, l.y FROM reach r JOIN link l ON l.x = r.other),
    component AS (SELECT node, least(node, min(other)) AS component FROM reach GROUP BY node)"""

WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

CONTAMINATION = rf"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all({_lowered('text')}, {WORDS}) AS words FROM documents),
item AS (
    SELECT item_id, regexp_extract_all({_lowered('text')}, {WORDS}) AS words FROM benchmark),
sized AS (SELECT item_id, words, least(10, len(words)) AS size FROM item WHERE len(words) > 0),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS gram
    FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM sized)),
places AS (
    SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS gram
    FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM doc, (SELECT DISTINCT size FROM windows))),
found AS (SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, gram)),
hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)"""

SHINGLES = rf"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all({_lowered('text')}, '[^\x20\x09-\x0D]+') AS words
    FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 1))) AS i
        FROM doc WHERE len(words) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingle a JOIN shingle b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
    SELECT x, y FROM common c JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
    WHERE 100 * c.n >= 90 * (a.n + b.n - c.n)),
{REACH}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id
FROM doc d LEFT JOIN size s ON s.doc_id = d.doc_id LEFT JOIN component ON node = d.doc_id"""

VECTORS = f"""
WITH RECURSIVE vector AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM vector a JOIN vector b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
{REACH},
links AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
    coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN links ON x = vec_id LEFT JOIN component ON node = vec_id"""

FILTERS = r"""
WITH RECURSIVE base AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
label AS (
    SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failed AS (
    SELECT part, good, toxic,
        CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text)
            THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
    FROM base LEFT JOIN label USING (doc_id)),
cell AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM failed GROUP BY part, fails),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT '' AS o UNION ALL SELECT o || f FROM orders, letter WHERE NOT contains(o, f)),
steps AS (
    SELECT o AS filter_order, unnest(range(1, 6)) AS step FROM orders WHERE length(o) = 5),
fate AS (
    SELECT filter_order, step, filter_order[step] AS f, part, fails, n, good, toxic,
        contains(fails, filter_order[step]) AS hit,
        len(list_filter(string_split(left(filter_order, step - 1), ''),
            lambda x: x <> '' AND contains(fails, x))) > 0 AS before
    FROM steps, cell),
counted AS (
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, any_value(f) AS f,
        coalesce(sum(n) FILTER (NOT hit AND NOT before), 0) AS kept,
        coalesce(sum(n) FILTER (hit AND NOT before), 0) AS removed,
        coalesce(sum(n) FILTER (hit AND before), 0) AS redundant,
        coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails,
        coalesce(sum(good) FILTER (hit AND NOT before), 0) AS good_lost,
        coalesce(sum(toxic) FILTER (hit AND NOT before), 0) AS toxic_lost
    FROM fate GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted"""

#: CRC-32 bit by bit, roles and faults, then all cheapest ways by state, row by row.
CONVERSATIONS = r"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations),
way AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
            string_split(k, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
            WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384::BIGINT) ELSE crc // 2 END),
        4294967295::BIGINT) % 20 AS v
    FROM keyed),
rows_ AS (
    SELECT conv_id, turn, CASE WHEN v = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN v = 1 THEN '' WHEN v = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN v = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM way WHERE v <> 0),
ordered AS (
    SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS rest,
        row_number() OVER w AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
    FROM rows_ WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
faulty AS (
    SELECT conv_id, turn, i, role, text, left(role, 1) AS r,
        CASE WHEN rest = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
            WHEN right(rest, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM ordered),
stats AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) AS n
    FROM faulty GROUP BY conv_id),
neighbours AS (
    SELECT conv_id, count(*) AS illegal FROM (
        SELECT conv_id, i, lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS two FROM faulty)
    WHERE i > 1 AND two NOT IN ('su', 'ua', 'au') GROUP BY conv_id),
-- How an output may go on: from the role it ends with, by a letter, to a role.
kept AS (SELECT * FROM (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')) k(p, q)),
given AS (SELECT * FROM (VALUES ('', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')) g(p, q)),
put AS (
    SELECT p, p AS q, '' AS letters, 0 AS cost, [] AS lines FROM (SELECT DISTINCT p FROM given)
    UNION ALL SELECT p, q, 'I', 5, [CASE q WHEN 'u' THEN 'user:' ELSE 'assistant:' END] FROM given
    UNION ALL SELECT a.p, b.q, 'II', 10, [CASE a.q WHEN 'u' THEN 'user:' ELSE 'assistant:' END,
        CASE b.q WHEN 'u' THEN 'user:' ELSE 'assistant:' END]
    FROM given a JOIN given b ON a.q = b.p),
ways AS (
    SELECT conv_id, i, put.p, put.letters || e.letter AS letters, put.cost + e.cost AS cost, e.q,
        put.lines || e.lines AS lines
    FROM faulty f, put, LATERAL (
        SELECT 'D' AS letter, 2 AS cost, put.q AS q, [] AS lines
        UNION ALL SELECT 'K', CASE fault WHEN '' THEN 0 ELSE 5 END, k.q, [f.role || ':' || f.text]
        FROM kept k WHERE k.p = put.q AND k.q = f.r AND fault IN ('', 'truncated')
        UNION ALL SELECT 'R', CASE fault WHEN '' THEN 1 ELSE 6 END, g.q,
            [CASE g.q WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text]
        FROM given g WHERE g.p = put.q AND fault IN ('', 'truncated')) e),
walk AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, '' AS q, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines
    FROM stats
    UNION ALL
    SELECT conv_id, i, q, cost, audit, lines FROM (
        SELECT w.conv_id, x.i, x.q, w.cost + x.cost AS cost, w.audit || x.letters AS audit,
            w.lines || x.lines AS lines,
            row_number() OVER (PARTITION BY w.conv_id, x.q
                ORDER BY w.cost + x.cost, w.audit || x.letters) AS best
        FROM walk w JOIN ways x ON w.conv_id IS NOT DISTINCT FROM x.conv_id AND x.i = w.i + 1
            AND x.p = w.q)
    WHERE best = 1),
ends AS (
    SELECT w.conv_id, w.cost + put.cost AS cost, w.audit || put.letters AS audit,
        w.lines || put.lines AS lines,
        row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + put.cost, w.audit || put.letters) AS best
    FROM walk w JOIN stats s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.i
    JOIN put ON put.p = w.q AND put.q IN ('', 'a'))
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN neighbours n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND e.best = 1"""
