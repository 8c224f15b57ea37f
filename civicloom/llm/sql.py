"""DuckDB SQL for the operators that SQL can express."""

OP11 = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS words
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM texts)
),
firsts AS (SELECT words, min(doc_id) AS least FROM windows GROUP BY words),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
    FROM windows JOIN firsts USING (words) WHERE doc_id > least
),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM texts),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words
    FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

OP12 = """
WITH vectors AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
        list_dot_product(a.q, b.q)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
    WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
    other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

#: CRC-32 byte by byte, its table made by the polynomial's rule.
OP13 = r"""
WITH RECURSIVE bits(n, k, c) AS (
    SELECT n::UBIGINT, 0, n::UBIGINT FROM range(256) t(n)
    UNION ALL
    SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM bits WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY n) AS steps FROM bits WHERE k = 8),
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
        translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
),
counted AS (SELECT id, run, count(*) AS times FROM runs WHERE length(run) >= 7 GROUP BY id, run),
bytes AS (
    SELECT id, run, times, hex(encode(id || ':' || run)) AS digits FROM counted
),
summed AS (
    SELECT run, times, xor(4294967295::UBIGINT, list_reduce(
        list_concat([4294967295::UBIGINT], list_transform(range(1, length(digits), 2), lambda i: ('0x' || digits[i:i + 1])::UBIGINT)),
        lambda c, b: xor(c >> 8, steps[((xor(c, b) & 255) + 1)::BIGINT]))) AS h
    FROM bytes, crc_table
),
words AS (
    SELECT word, sum(times)::BIGINT AS n
    FROM (
        SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, times
        FROM summed
    )
    WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
less AS (SELECT word, n, i, left(word, i - 1) AS a, substr(word, i + 1) AS b FROM places),
near AS (
    SELECT x.word, y.word AS other, y.n AS m FROM less x JOIN less y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
    UNION
    SELECT x.word, y.word, y.n FROM less x JOIN words y ON x.a || x.b = y.word
    UNION
    SELECT y.word, x.word, x.n FROM less x JOIN words y ON x.a || x.b = y.word
),
best AS (SELECT word, count(*) AS n_near, min({'less': -m, 'other': other}) AS top FROM near GROUP BY word),
formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN -top.less >= 10 * w.n THEN top.other END AS form, CASE WHEN -top.less >= 10 * w.n THEN -top.less END AS form_n
    FROM words w LEFT JOIN best USING (word)
),
roots AS (
    SELECT word, word AS root, form AS next FROM formed
    UNION ALL
    SELECT r.word, r.next, f.form FROM roots r JOIN formed f ON r.next = f.word
)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n
FROM formed JOIN (SELECT word, root FROM roots WHERE next IS NULL) USING (word)
"""

SQL: dict[str, str] = {
    "op11_prefix_trees": OP11,
    "op12_hilbert_negatives": OP12,
    "op13_spelling_variants": OP13,
}
