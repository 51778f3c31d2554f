"""DuckDB twins of the registered queries."""

from __future__ import annotations


def sql() -> dict[str, str]:
    return {
        # The shortest stretches with ten words from every line on and back; all but the first of equal ones are copies.
        "op6_line_dedup": r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
w AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM l),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM w),
s AS (SELECT a.doc_id, a.pos AS start, min(b.pos) AS stop FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.pos >= a.pos
        AND b.upto - (a.upto - a.words) >= 10 GROUP BY ALL
      UNION SELECT b.doc_id, max(a.pos), b.pos FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.pos >= a.pos
        AND b.upto - (a.upto - a.words) >= 10 GROUP BY b.doc_id, b.pos),
n AS (SELECT s.doc_id, s.start, s.stop, string_agg(line, chr(10) ORDER BY pos) AS body
      FROM s JOIN l ON l.doc_id = s.doc_id AND l.pos BETWEEN s.start AND s.stop GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, start) AS r FROM n),
gone AS (SELECT DISTINCT l.doc_id, l.pos FROM r JOIN l ON l.doc_id = r.doc_id AND l.pos BETWEEN r.start AND r.stop WHERE r.r > 1)
SELECT l.doc_id, count(*) AS n_lines, count(gone.pos) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (gone.pos IS NULL), '') AS text
FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos GROUP BY l.doc_id
""",
        "op8_chat_formatting": """
WITH t AS (SELECT conv_id, turn, count(*) AS n,
                  string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), ''
                             ORDER BY role NULLS FIRST, text NULLS FIRST) AS piece,
                  string_agg(turn || '|' || coalesce(role, '~') || '|' || coalesce(text, '~'), chr(0) ORDER BY role, text) AS mark
           FROM conversations GROUP BY conv_id, turn),
p AS (SELECT conv_id, sum(n) OVER (PARTITION BY conv_id) AS total, sum(n) OVER w AS n,
             string_agg(mark, chr(1)) OVER w AS prefix FROM t
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST ROWS UNBOUNDED PRECEDING)),
longest AS (SELECT prefix, max(total) AS longest, min(conv_id) FILTER (total = n) AS first FROM p GROUP BY prefix),
r AS (SELECT conv_id, string_agg(piece, '' ORDER BY turn NULLS FIRST) AS rendered FROM t GROUP BY conv_id)
SELECT p.conv_id, CAST(p.n AS BIGINT) AS n_turns, r.rendered
FROM p JOIN longest USING (prefix) JOIN r ON r.conv_id = p.conv_id
WHERE p.n = p.total AND longest = p.total AND first = p.conv_id
""",
        "op10_top_k": """
WITH fine AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
              FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                  CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
           FROM fine q JOIN fine c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
        # Checksums byte by byte over a table of 256 remainders; near words share what is left without one letter.
        "op11_spelling_variants": r"""
WITH RECURSIVE remainders AS (SELECT list(list_reduce(list_concat([n], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY n) AS t FROM range(256) r(n)),
found AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
runs AS (SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= 7 GROUP BY doc_id, run),
digits AS (SELECT *, hex(encode(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', run))) AS x FROM runs),
marked AS (SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT],
    list_transform(range(length(x) // 2), lambda i: CAST(concat('0x', substr(x, CAST(2 * i + 1 AS BIGINT), 2)) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM digits CROSS JOIN remainders),
left_out AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n AS k FROM marked),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM left_out WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
rests AS (SELECT word, word AS rest, 0 AS pos FROM words
  UNION ALL SELECT word, substr(word, 1, CAST(pos - 1 AS BIGINT)) || substr(word, CAST(pos + 1 AS BIGINT)), pos FROM (SELECT word, unnest(range(1, length(word) + 1)) AS pos FROM words)),
near AS (SELECT DISTINCT a.word, b.word AS other FROM rests a JOIN rests b ON a.rest = b.rest AND a.word <> b.word AND (a.pos = b.pos OR a.pos = 0 OR b.pos = 0)),
best AS (SELECT near.word, count(*) AS n_near, max(w.n) AS most, arg_min(other, {'n': -w.n, 'w': other}) AS first FROM near JOIN words w ON w.word = other GROUP BY near.word),
forms AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN first END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM forms UNION ALL SELECT chain.word, f.form FROM chain JOIN forms f ON f.word = chain.root WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
""",
        # Row by row the cheapest edits into each of four states (nothing, s, u, a), least by cost and then by audit.
        "op13_conversation_repair": r"""
WITH RECURSIVE checked AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS name FROM conversations),
marked AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(name) + 1), lambda i: ascii(substr(name, i, 1))::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS what FROM checked),
damaged AS (SELECT conv_id, turn, CASE what WHEN 4 THEN 'user' ELSE role END AS role,
    CASE what WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE what WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM marked),
ordered AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, substr(role, 1, 1) AS ini FROM damaged),
faulty AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
    WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    concat(lag(ini) OVER (PARTITION BY conv_id ORDER BY i), ini) AS pair, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) IS NOT NULL AS follows FROM ordered),
facts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (follows AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id),
dp AS (SELECT conv_id, 0::BIGINT AS i, [{'c': 0::BIGINT, 'a': '', 'l': []::VARCHAR[]}, {'c': 1000000000, 'a': '', 'l': []},
      {'c': 3, 'a': 'I', 'l': ['user:']}, {'c': 6, 'a': 'II', 'l': ['user:', 'assistant:']}] AS s FROM facts
  UNION ALL
  SELECT conv_id, i, [t0, t1, t2, list_sort([t3, {'c': t2.c + 3, 'a': t2.a || 'I', 'l': list_append(t2.l, 'assistant:')}])[1]] FROM (
    SELECT conv_id, i, t0, t1, t3, list_sort([t2, {'c': t0.c + 3, 'a': t0.a || 'I', 'l': list_append(t0.l, 'user:')},
      {'c': t1.c + 3, 'a': t1.a || 'I', 'l': list_append(t1.l, 'user:')}, {'c': t3.c + 3, 'a': t3.a || 'I', 'l': list_append(t3.l, 'user:')}])[1] AS t2 FROM (
      SELECT conv_id, i, d[1] AS t0, list_sort(list_concat([d[2]], CASE WHEN ok AND ini = 's' THEN [k[1]] ELSE [] END))[1] AS t1,
        list_sort(list_concat([d[3]], CASE WHEN ok THEN [r[1], r[2], r[4]] ELSE [] END, CASE WHEN ok AND ini = 'u' THEN [k[1], k[2], k[4]] ELSE [] END))[1] AS t2,
        list_sort(list_concat([d[4]], CASE WHEN ok THEN [r[3]] ELSE [] END, CASE WHEN ok AND ini = 'a' THEN [k[3]] ELSE [] END))[1] AS t3 FROM (
        SELECT f.conv_id, f.i, f.ini, f.fault NOT IN ('b', 'd') AS ok,
          list_transform(dp.s, lambda x: {'c': x.c + 4, 'a': x.a || 'D', 'l': x.l}) AS d,
          list_transform(dp.s, lambda x: {'c': x.c + CASE f.fault WHEN 't' THEN 3 ELSE 0 END, 'a': x.a || 'K', 'l': list_append(x.l, f.role || ':' || f.text)}) AS k,
          list_transform(dp.s, lambda x, j: {'c': x.c + 3 + CASE f.fault WHEN 't' THEN 3 ELSE 0 END, 'a': x.a || 'R',
            'l': list_append(x.l, CASE j WHEN 3 THEN 'assistant:' ELSE 'user:' END || f.text)}) AS r
        FROM dp JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1)))),
ended AS (SELECT f.*, list_sort([dp.s[1], dp.s[4]])[1] AS b FROM dp JOIN facts f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.n = dp.i),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit, sha256(coalesce(array_to_string(b.l, chr(10)), '')) AS repaired_sha256
FROM every e LEFT JOIN ended ON e.conv_id IS NOT DISTINCT FROM ended.conv_id
""",
    }
