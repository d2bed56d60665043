"""SQL that gives the rows of the registered text queries, where SQL can."""

from __future__ import annotations

OP1 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, s, array_to_string(words[s:s + 19], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM w)),
repeated AS (
  SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM repeated),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w)
  ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP3 = """
WITH t AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS h FROM t),
r AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(h, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4)::INT)) & 31), 1)), 'string_agg', '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id != first THEN first END AS refers_to
FROM r
"""

OP5 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(words[s:s + 3], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS s FROM w WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.k = b.k AND a.doc_id != b.doc_id
  GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 85 * (x.n + y.n - common)),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

OP8 = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""

OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id != c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""

# CRC-32 by its table of 256 steps, of the bytes in column ``bytes``.
CRC_STEPS = """crc AS (
  SELECT list(v ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) t(i)))"""
CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes),
            lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)])))"""


def _bytes(text: str) -> str:
    return f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), 1 + 2 * i::INT, 2))::BIGINT)"


OP11 = rf"""
WITH RECURSIVE {CRC_STEPS},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
counted AS (
  SELECT run, n, {_bytes("(doc_id || ':' || run)")} AS bytes
  FROM (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL)),
hashed AS (SELECT run, n, {CRC} AS h FROM counted, crc),
words AS MATERIALIZED (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
places AS (SELECT word, unnest(range(length(word))) AS i FROM words),
holes AS MATERIALIZED (
  SELECT word, substr(word, 1, i) || '*' || substr(word, i + 2) AS masked, substr(word, 1, i) || substr(word, i + 2) AS less
  FROM places),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM holes a JOIN holes b ON a.masked = b.masked AND a.word != b.word
  UNION SELECT h.word, w.word FROM holes h JOIN words w ON h.less = w.word
  UNION SELECT w.word, h.word FROM holes h JOIN words w ON h.less = w.word),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS form, max(n) AS form_n
  FROM (SELECT near.word, other, n FROM near JOIN words ON words.word = other) GROUP BY word),
formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form,
         CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
followed(word, step) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT f.word, formed.form FROM followed f JOIN formed ON formed.word = f.step WHERE formed.form IS NOT NULL)
SELECT formed.word, form, step AS root, n, n_near, form_n
FROM formed JOIN followed ON followed.word = formed.word
WHERE step IN (SELECT word FROM formed WHERE form IS NULL)
"""

OP13 = rf"""
WITH {CRC_STEPS},
given AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         {_bytes("doc_id::VARCHAR")} AS bytes
  FROM documents),
hashed AS (SELECT doc_id, words, len(words) AS n, {CRC} AS h FROM given, crc),
placed AS (
  SELECT doc_id, words, n, h, (h // 10) % greatest(n, 1) AS a,
         1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p
  FROM hashed),
docs AS MATERIALIZED (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
         THEN list_transform(range(n), lambda i: words[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END])
         ELSE words END AS words
  FROM placed),
-- A run shares 16 words or more with what stands a period on.
grams AS MATERIALIZED (
  SELECT doc_id, n, i, array_to_string(words[i + 1:i + 16], ' ') AS gram
  FROM (SELECT *, unnest(range(n - 15)) AS i FROM docs)),
lags AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.gram = b.gram AND a.i < b.i
  WHERE 3 * (b.i - a.i) <= a.n),
stretches AS (
  SELECT doc_id, q, min(i) AS s, max(i) - min(i) + 16 + q AS l
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM lags)
  GROUP BY doc_id, q, island),
runs AS MATERIALIZED (
  SELECT doc_id, s, l, min(q) AS q FROM stretches WHERE l >= greatest(24, 3 * q) GROUP BY doc_id, s, l),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(n)) AS i FROM docs) ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
         arg_min({{'s': s, 'l': l, 'q': q}}, (-l::DOUBLE / q, s, q)) AS best
  FROM runs GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period,
       best.l * 1000 // best.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(text, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1,
    "op3_warc": OP3,
    "op5_ngram_join": OP5,
    "op8_exact_dedup": OP8,
    "op10_topk": OP10,
    "op11_spelling": OP11,
    "op13_periodic_runs": OP13,
}
