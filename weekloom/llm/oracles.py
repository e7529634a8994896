"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

OP3 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '### |</turn>'))
    + length(replace(replace(replace(replace(replace(replace(role,
        '~', '~0'), ':', '~1'), chr(10), '~2'), '#', '~3'), '<', '~4'), '\', '~5'))
    + length('### ') + length(':') + 1 + 1 + length('</turn>') + 1 AS block
  FROM rows
), loss AS (
  SELECT conv_id, coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS t
  FROM rows GROUP BY conv_id
)
SELECT s.conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  length(any_value(loss.t))::BIGINT AS loss_chars, sha256(any_value(loss.t)) AS loss_sha256,
  sum(block)::BIGINT AS formatted_chars
FROM sized s JOIN loss ON s.conv_id IS NOT DISTINCT FROM loss.conv_id GROUP BY s.conv_id
"""

OP10 = r"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), parts AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM base
), win AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM parts WHERE len(words) >= 3)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM win) WHERE n >= 2
), rep AS (
  SELECT r, sum(least(3, i - prev))::BIGINT AS n_repeat_words
  FROM (SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -2) AS prev FROM twice) GROUP BY r
), stats AS (
  SELECT parts.r, doc_id, lang, source, len(words)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM parts LEFT JOIN rep USING (r)
), ppm AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    CASE WHEN word_chars > 0 THEN n_symbols * 1000000 // word_chars ELSE 0 END AS symbol_ppm,
    CASE WHEN n_lines > 0 THEN n_dup_lines * 1000000 // n_lines ELSE 0 END AS dup_line_ppm,
    CASE WHEN n_words > 0 THEN n_repeat_words * 1000000 // n_words ELSE 0 END AS repeat_ppm,
    CASE WHEN n_words > 0 THEN word_chars * 1000000 // n_words ELSE 0 END AS word_len_ppm
  FROM stats
), long AS (
  SELECT lang, source, 'symbol_ppm' AS ratio, symbol_ppm AS v FROM ppm WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'dup_line_ppm', dup_line_ppm FROM ppm WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'repeat_ppm', repeat_ppm FROM ppm WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'word_len_ppm', word_len_ppm FROM ppm WHERE NOT base_failed
), sketch AS (
  SELECT lang, source, ratio,
    v - v % (1::BIGINT << greatest(length(bin(v)) - 7, 0)::BIGINT) AS bucket, count(*) AS n
  FROM long GROUP BY ALL
), levels AS (
  SELECT 0 AS level, * FROM sketch
  UNION ALL SELECT 1, lang, NULL, ratio, bucket, sum(n) FROM sketch GROUP BY lang, ratio, bucket
  UNION ALL SELECT 2, NULL, NULL, ratio, bucket, sum(n) FROM sketch GROUP BY ratio, bucket
), run AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, ratio ORDER BY bucket) AS upto,
    sum(n) OVER (PARTITION BY level, lang, source, ratio) AS total FROM levels
), quart AS (
  SELECT level, lang, source, ratio, max(total) AS total,
    min(bucket) FILTER (100 * upto >= 25 * total) AS q1, min(bucket) FILTER (100 * upto >= 75 * total) AS q3
  FROM run GROUP BY ALL
), edge AS (
  SELECT level, lang, source, ratio, total,
    q3 + 3 * greatest(q3 - q1, CASE ratio WHEN 'symbol_ppm' THEN 10000 WHEN 'word_len_ppm' THEN 500000 ELSE 100000 END) AS hi,
    q1 - 3 * greatest(q3 - q1, CASE ratio WHEN 'symbol_ppm' THEN 10000 WHEN 'word_len_ppm' THEN 500000 ELSE 100000 END) AS lo
  FROM quart
), chosen AS (
  SELECT o.lang, o.source, o.ratio,
    (o.total * o.hi + 50.0::DOUBLE * ((l.total * l.hi + 50.0::DOUBLE * a.hi) / (l.total + 50.0::DOUBLE)))
      / (o.total + 50.0::DOUBLE) AS hi,
    (o.total * o.lo + 50.0::DOUBLE * ((l.total * l.lo + 50.0::DOUBLE * a.lo) / (l.total + 50.0::DOUBLE)))
      / (o.total + 50.0::DOUBLE) AS lo
  FROM (SELECT * REPLACE (total::DOUBLE AS total, hi::DOUBLE AS hi, lo::DOUBLE AS lo) FROM edge) o
    JOIN (SELECT * REPLACE (total::DOUBLE AS total, hi::DOUBLE AS hi, lo::DOUBLE AS lo) FROM edge) l
      ON l.level = 1 AND l.ratio = o.ratio AND l.lang IS NOT DISTINCT FROM o.lang
    JOIN edge a ON a.level = 2 AND a.ratio = o.ratio
  WHERE o.level = 0
), bad AS (
  SELECT DISTINCT r FROM ppm p JOIN chosen c
    ON c.lang IS NOT DISTINCT FROM p.lang AND c.source IS NOT DISTINCT FROM p.source
  WHERE CASE c.ratio WHEN 'symbol_ppm' THEN symbol_ppm > hi WHEN 'dup_line_ppm' THEN dup_line_ppm > hi
    WHEN 'repeat_ppm' THEN repeat_ppm > hi ELSE word_len_ppm > hi OR word_len_ppm < lo END
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND bad.r IS NULL AS kept
FROM ppm LEFT JOIN bad USING (r)
"""

OP2 = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS x
  FROM documents
), windows AS (
  SELECT r, i, md5(x[2 * i + 1:2 * i + 400]) AS h
  FROM (SELECT r, x, unnest(range(0, octet_length(b) - 199)) AS i FROM texts WHERE octet_length(b) >= 200)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS c FROM windows) WHERE c > 1
), marked AS (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS fresh FROM twice
), spans AS (
  SELECT r, min(i) AS a, max(i) + 200 AS z
  FROM (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS s FROM marked) GROUP BY r, s
), between_spans AS (
  SELECT r, a, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS f, z FROM spans
), kept AS (
  SELECT t.r, string_agg(x[2 * f + 1:2 * a], '' ORDER BY a) || any_value(x)[2 * max(z) + 1:] AS k,
    count(*) AS n, sum(z - a) AS gone
  FROM between_spans s JOIN texts t USING (r) GROUP BY t.r
)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed,
  coalesce(n, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, x))) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""


def similar_sql(width: int, percent: int, last: str) -> str:
    """Components of documents whose word shingle sets reach a Jaccard similarity, by all shared shingles."""
    words = " || ' ' || ".join(f"w[i + {k}]" for k in range(width))
    return rf"""
WITH RECURSIVE tokens AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents
), sets AS (
  SELECT r, doc_id, CASE WHEN len(w) >= {width}
    THEN list_distinct(list_transform(range(1, len(w) - {width} + 2), lambda i: {words}))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM tokens
), shingles AS (
  SELECT r, doc_id, len(s) AS n, unnest(s) AS h FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.h = b.h AND a.r < b.r
  GROUP BY a.r, b.r, a.doc_id, b.doc_id
  HAVING 100 * count(*) >= {percent} * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, l.b FROM reach JOIN (SELECT a, b FROM links UNION SELECT b, a FROM links) l ON l.a = reach.b
), least AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, c AS component_id{last} FROM sets JOIN least ON a = doc_id
"""


OP7 = similar_sql(5, 75, ", doc_id = c AS kept")
OP11 = similar_sql(3, 90, "")

OP12 = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM texts
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), counts AS (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
      lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
    FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS size))
  GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.a) // (l.f + r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
    JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:c.size], ' ')
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(a) AS most
  FROM candidates, (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3]) AS k)
  WHERE k < size AND i + k - 1 <= size GROUP BY ALL
), ranked AS (
  SELECT v.*, row_number() OVER (PARTITION BY v.lang ORDER BY score DESC, a DESC, v.phrase) AS rank
  FROM lowest v LEFT JOIN inside USING (lang, phrase) WHERE most IS NULL OR 100 * most < 80 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

OP13 = r"""
WITH RECURSIVE steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS tab
), found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents
), runs AS (
  SELECT run, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS b, count(*) AS n
  FROM found WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(len(b) // 2), lambda i: ('0x' || b[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS h
  FROM runs, steps
), vocab AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), dropped AS (
  SELECT word, i, word[1:i - 1] || word[i + 1:] AS d FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocab)
), longer AS (
  SELECT d.word, v.word AS other FROM dropped d JOIN vocab v ON d.d = v.word
), near AS (
  SELECT word, other FROM longer UNION SELECT other, word FROM longer
  UNION SELECT a.word, b.word FROM dropped a JOIN dropped b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
), best AS (
  SELECT near.word, o.word AS other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near
  FROM near JOIN vocab o ON o.word = near.other
  QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, o.word) = 1
), forms AS (
  SELECT v.word, CASE WHEN other_n >= 10 * n THEN other END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM vocab v LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL SELECT chain.word, f.form, step + 1 FROM chain JOIN forms f ON f.word = chain.root WHERE f.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n
FROM forms JOIN (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word) USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_repeated_bytes": OP2, "op3_chat_format": OP3, "op7_near_duplicates": OP7, "op10_quality_rules": OP10,
        "op11_jaccard_join": OP11, "op12_collocations": OP12,
        "op13_spelling_variants": OP13,
    }
