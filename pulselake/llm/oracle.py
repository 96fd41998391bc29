"""Reference SQL (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op3_exact_top_k"] = """
WITH rows AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, r.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM rows q JOIN rows r ON q.vec_id % 100 = 0 AND r.vec_id <> q.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

ORACLES["op4_exact_dedup"] = r"""
WITH rows AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM rows
"""

ORACLES["op1_sharding"] = """
WITH sized AS (
    SELECT doc_id, coalesce(text, '') AS body, md5(coalesce(text, '')) AS digest,
           strlen(coalesce(text, '')) + 1 AS size
    FROM documents
), placed AS (
    SELECT *, sum(size) OVER (ORDER BY digest, doc_id ROWS UNBOUNDED PRECEDING) - size AS byte,
           row_number() OVER (ORDER BY digest, doc_id) - 1 AS place,
           sum(size) OVER () AS total
    FROM sized
), first_cut AS (
    SELECT *, least(15, ((2 * byte + size) * 16) // (2 * total)) AS shard FROM placed
), texts AS (
    SELECT digest, min(byte) AS byte, sum(size) AS size, any_value(total) AS total
    FROM first_cut GROUP BY digest HAVING min(shard) < max(shard)
), moved AS (
    SELECT digest, least(15, ((2 * byte + size) * 16) // (2 * total)) AS home
    FROM texts WHERE size <= 0.05 * total / 16
), final_cut AS (
    SELECT doc_id, size, body, place, coalesce(home, shard) AS shard
    FROM first_cut LEFT JOIN moved USING (digest)
), crc_table AS (
    SELECT list(v ORDER BY n) AS entries FROM (
        SELECT n, list_reduce(list_prepend(n, range(8)),
            lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM (SELECT unnest(range(256)) AS n))
), bytes AS (
    SELECT doc_id, list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS data
    FROM final_cut
), checksums AS (
    SELECT doc_id, CAST(xor(list_reduce(list_prepend(4294967295, data),
        lambda c, b: xor(c >> 8, entries[xor(c & 255, b) + 1])), 4294967295) AS BIGINT) AS text_crc32
    FROM bytes, crc_table
)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(place - min(place) OVER (PARTITION BY shard) AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM final_cut JOIN checksums USING (doc_id)
"""

ORACLES["op5_source_mix"] = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS spot
    FROM documents
), placed AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY spot, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
    FROM sized
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM sized GROUP BY source
), weighted AS (
    SELECT *, [5, 2, 1][(place - 1) % 3 + 1] AS weight, 3 * source_size AS cap FROM sources
), ordered AS (
    -- Sources reach their cap in the order of cap / weight.
    SELECT *, sum(source_size) OVER () AS total,
           coalesce(sum(cap) OVER w, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS open_weight
    FROM weighted
    WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT CAST(total - capped AS BIGINT) AS words_left, CAST(open_weight AS BIGINT) AS among FROM ordered
    WHERE (total - capped) * weight < cap * open_weight
    ORDER BY CAST(cap AS DOUBLE) / weight, place LIMIT 1
), goals AS (
    SELECT source, source_size, CASE
        WHEN among IS NULL OR CAST(words_left AS HUGEINT) * weight >= CAST(cap AS HUGEINT) * among THEN CAST(cap AS DOUBLE)
        ELSE CAST(words_left AS DOUBLE) * CAST(weight AS DOUBLE) / CAST(among AS DOUBLE) END AS target
    FROM weighted LEFT JOIN level ON true
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0 ELSE
           (floor(target)::BIGINT // source_size) * size
           + greatest(0, least(start + size, floor(target)::BIGINT % source_size) - start) END AS BIGINT) AS taken
FROM placed JOIN goals ON placed.source IS NOT DISTINCT FROM goals.source
"""

ORACLES["op8_line_dedup"] = """
WITH cut AS (
    SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL
), lines AS (
    SELECT doc_id, unnest(range(len(parts))) AS line_no,
           trim(unnest(parts), ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line
    FROM cut
), firsts AS (
    SELECT line, length(line) AS n, min({'d': doc_id, 'l': line_no}) AS place FROM lines WHERE line <> '' GROUP BY line
), halves AS (
    SELECT *, left(line, n // 2) AS head, right(line, n - n // 2) AS tail FROM firsts WHERE n >= 20
), longer AS (
    -- The same line as the longer of a pair: halves of a line that is one shorter.
    SELECT line, place, n - 1 AS n, left(line, (n - 1) // 2) AS head, right(line, n - 1 - (n - 1) // 2) AS tail
    FROM firsts WHERE n >= 21
), pairs AS (
    SELECT a.line AS one, b.line AS two, a.place AS p, b.place AS q
    FROM halves a JOIN halves b ON a.n = b.n AND a.head = b.head AND a.line <> b.line
    UNION SELECT a.line, b.line, a.place, b.place
    FROM halves a JOIN halves b ON a.n = b.n AND a.tail = b.tail AND a.line <> b.line
    UNION SELECT a.line, b.line, a.place, b.place FROM halves a JOIN longer b ON a.n = b.n AND a.head = b.head
    UNION SELECT a.line, b.line, a.place, b.place FROM halves a JOIN longer b ON a.n = b.n AND a.tail = b.tail
), near AS (
    SELECT one, two, p, q FROM pairs WHERE levenshtein(one, two) = 1
), homes AS (
    SELECT line, min(place) AS home FROM (
        SELECT line, place FROM firsts
        UNION ALL SELECT one, q FROM near
        UNION ALL SELECT two, p FROM near)
    GROUP BY line
)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no,
       home IS NULL OR home = {'d': doc_id, 'l': line_no} AS kept,
       coalesce(home.d, doc_id) AS first_doc_id, CAST(coalesce(home.l, line_no) AS INTEGER) AS first_line_no
FROM lines LEFT JOIN homes USING (line)
"""

ORACLES["op11_chat_format"] = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), placed AS (
    SELECT *, row_number() OVER same - 1 AS place, coalesce(lag(role) OVER same, '') AS prev,
           row_number() OVER same = count(*) OVER (PARTITION BY conv_id) AS is_last
    FROM said WINDOW same AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), judged AS (
    SELECT *, CASE WHEN place = 0 THEN role IN ('system', 'user')
                   WHEN role = 'user' THEN prev IN ('system', 'assistant')
                   WHEN role = 'assistant' THEN prev = 'user' ELSE false END AS allowed,
           length(role) + length(role) - length(replace(replace(role, chr(92), ''), chr(10), ''))
           + len(regexp_extract_all(role, '<\|')) AS role_chars,
           length(text) + len(regexp_extract_all(text, '<\\*\|')) AS text_chars
    FROM placed
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + role_chars + 1 + text_chars + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars,
       bool_and(allowed) AS valid,
       bool_and(allowed) AND bool_or(is_last AND role = 'assistant') AS complete,
       CAST(min(place) FILTER (NOT allowed) AS INTEGER) AS bad_turn
FROM judged GROUP BY conv_id
"""

ORACLES["op12_prefix_trie"] = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), told AS (
    SELECT conv_id, turn, role, sha256(length(role) || ':' || role || text) AS digest,
           len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
    FROM said
), own AS (
    SELECT conv_id, list({'digest': digest, 'words': words} ORDER BY turn NULLS FIRST, role, digest) AS turns
    FROM told GROUP BY conv_id
), crc_table AS (
    SELECT list(v ORDER BY n) AS entries FROM (
        SELECT n, list_reduce(list_prepend(n, range(8)),
            lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM (SELECT unnest(range(256)) AS n))
), drawn AS (
    SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295,
        list_transform(regexp_extract_all(hex(encode(CAST(conv_id AS VARCHAR))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
        lambda c, b: xor(c >> 8, entries[xor(c & 255, b) + 1])), 4294967295) % 4 AS h
    FROM own, crc_table
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(f.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
    FROM drawn c LEFT JOIN own f ON f.conv_id = c.conv_id - c.conv_id % 20
), prefixes AS (
    SELECT conv_id, d AS depth, len(turns) AS size, CASE WHEN d = 0 THEN 0 ELSE turns[d].words END AS words,
           array_to_string(list_transform(turns[1:d], lambda t: t.digest), '') AS path
    FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
           string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth) AS ends
    FROM prefixes GROUP BY depth, path
), kids AS (
    SELECT depth - 1 AS depth, left(path, 64 * (depth - 1)) AS path, count(*) AS n_children
    FROM nodes WHERE depth > 0 GROUP BY ALL
), counted AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, path)
), tops AS (
    SELECT d AS depth, left(path, 64 * d) AS path, n_children, n_convs, words
    FROM (SELECT *, unnest(range(depth + 1)) AS d FROM counted)
), trees AS (
    SELECT depth, path, count(*) FILTER (n_children = 0) AS n_leaves,
           CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
    FROM tops GROUP BY ALL
)
SELECT CAST(c.conv_id AS BIGINT) AS conv_id, c.depth, CAST(p.conv_id AS BIGINT) AS parent_conv_id, c.n_convs,
       c.n_children, n_leaves, saved_tokens, sha256(coalesce(c.ends, '')) AS ends_sha256
FROM counted c JOIN trees USING (depth, path)
LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.path = left(c.path, 64 * (c.depth - 1))
"""

ORACLES["op13_fill_middle"] = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text,
           list_transform(range(4), lambda i: CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8 * i + 1, 8) AS BIGINT)) AS h
    FROM documents
), lined AS (
    SELECT *, string_split(text, chr(10)) AS parts,
           CAST(length(text) - length(replace(text, chr(10), '')) + CASE WHEN text = '' OR suffix(text, chr(10)) THEN 0 ELSE 1 END AS BIGINT) AS n
    FROM drawn
), cuts AS (
    SELECT *, text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 AS plain,
           least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b
    FROM lined
), placed AS (
    -- The end of the k-th line; only the last one may lack its line end.
    SELECT *, least(length(text), length(array_to_string(parts[1:a], chr(10))) + CASE WHEN a > 0 THEN 1 ELSE 0 END) AS p,
           least(length(text), length(array_to_string(parts[1:b], chr(10))) + CASE WHEN b > 0 THEN 1 ELSE 0 END) AS q
    FROM cuts
), formed AS (
    SELECT *, CASE WHEN plain THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
           substr(text, 1, p) AS prefix, substr(text, p + 1, q - p) AS middle, substr(text, q + 1) AS rest
    FROM placed
)
SELECT doc_id, n, form, CASE WHEN NOT plain THEN p END AS prefix_chars, CASE WHEN NOT plain THEN q - p END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || rest || '<M>' || middle
              ELSE '<S>' || rest || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM formed
"""
