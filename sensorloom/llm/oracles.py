"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from sensorloom.llm.warc_audit import SEGMENT_BYTES

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# All alignments of a document and an item on which enough words are equal, not only those with a common seed.
_OP5 = r"""
WITH docs AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws
              FROM (SELECT doc_id, regexp_replace(text, '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', ' \1 ', 'g') AS text FROM documents)),
 items AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws
           FROM (SELECT item_id, regexp_replace(text, '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', ' \1 ', 'g') AS text FROM benchmark)),
 d AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM docs),
 t AS (SELECT item_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS k FROM items),
 m AS (SELECT doc_id, item_id, n, i - k AS place, list_sort(list(k)) AS ks
       FROM d JOIN t USING (w) GROUP BY ALL HAVING 100 * count(*) >= CASE WHEN n < 8 THEN 100 ELSE 80 END * least(13, n)),
 b AS (SELECT *, list_max(list_transform(ks, lambda s: len(list_filter(ks, lambda k: k >= s AND k < s + 13)))) AS best FROM m)
SELECT doc_id, item_id, CAST(n AS INTEGER) AS item_words, CAST(len(ks) AS INTEGER) AS matched,
       CAST(best AS INTEGER) AS window_matched, CAST(place AS INTEGER) AS place
FROM b WHERE 100 * best >= CASE WHEN n < 8 THEN 100 ELSE 80 END * least(13, n)
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY best DESC, len(ks) DESC, place) = 1
"""

_OP7 = rf"""
WITH RECURSIVE w AS (
 SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '[^\x20\x09-\x0D]+') AS ws
 FROM documents),
 s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3
         THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
         WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
 e AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
 reach AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
 c AS (SELECT a, min(b) AS low FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(c.low, doc_id)) AS component_id,
       coalesce(c.low, doc_id) >= doc_id AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = doc_id
"""

_OP10 = f"""
WITH r AS (
 SELECT page_id, substr(md5(coalesce(url, '')), 1, 2) AS digits, strlen(concat(
   'WARC/1.1', '..', 'WARC-Type: resource', '..', 'WARC-Record-ID: <urn:uuid:', repeat('.', 36), '>', '..',
   'WARC-Target-URI: ', url, '..', 'Content-Type: text/html', '..',
   'Content-Length: ', strlen(coalesce(html, '')), '....', html, '....')) AS length FROM pages),
 f AS (SELECT CAST(sum(length) AS BIGINT) // {SEGMENT_BYTES} + 1 AS files FROM r),
 p AS (SELECT r.*, CAST(CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 8) AS BIGINT) % files AS INTEGER) AS segment FROM r, f),
 o AS (SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY segment ORDER BY page_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM p)
SELECT page_id, segment, "offset", length, CASE digits WHEN '01' THEN 'missing' ELSE 'changed' END AS kind
FROM o WHERE digits IN ('00', '01', '02')
"""

# Every document is scored, with no masks or bounds.
_OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
 i AS (SELECT row_number() OVER () AS k, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}',
        '{_LETTERS.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ts FROM benchmark),
 q AS (SELECT k, item_id, unnest(ts) AS t FROM i),
 s AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM d WHERE len(ws) > 0),
 o AS (SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n, unnest(ws) AS t FROM d),
 f AS (SELECT r, doc_id, n, t, count(*) AS tf FROM o SEMI JOIN q USING (t) GROUP BY ALL),
 w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY t, n_docs),
 p AS (SELECT k, item_id, r, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
       FROM q JOIN f USING (t) JOIN w USING (t), s GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id, r) AS INTEGER) AS rank, doc_id, score
FROM p WHERE score > 0 QUALIFY rank <= 10
"""

# crc32 bit by bit; neighbours from the words with one place cut out.
_OP13 = rf"""
WITH RECURSIVE steps AS (SELECT CAST(i AS UINTEGER) AS b, CAST(i AS UINTEGER) AS v, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT b, CASE WHEN v % 2 = 1 THEN xor(v >> 1, CAST(3988292384 AS UINTEGER)) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8),
 crc AS MATERIALIZED (SELECT list(v ORDER BY b) AS t FROM steps WHERE k = 8),
 runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'),
            '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
 r AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
 bytes AS (SELECT doc_id, run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM r),
 h AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
          lambda a, b: xor(a >> 8, CAST(t[xor(a & 255, b) + 1] AS BIGINT)))) AS h FROM bytes, crc),
 words AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n FROM h),
 v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
 cut AS (SELECT word, n, i, left(word, CAST(i AS INTEGER)) || substr(word, CAST(i AS INTEGER) + 2) AS rest FROM v, LATERAL unnest(range(0, length(word))) u(i)),
 near AS (SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
   UNION SELECT c.word, v.word FROM cut c JOIN v ON c.rest = v.word
   UNION SELECT v.word, c.word FROM cut c JOIN v ON c.rest = v.word),
 best AS (SELECT near.word AS word, near.near AS near, m.n AS near_n, count(*) OVER (PARTITION BY near.word) AS n_near FROM near JOIN v m ON m.word = near.near
   QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY m.n DESC, near.near) = 1),
 f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form,
         CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n FROM v LEFT JOIN best USING (word)),
 up AS (SELECT word, word AS top, 0 AS k FROM f UNION ALL SELECT up.word, f.form, k + 1 FROM up JOIN f ON f.word = up.top WHERE f.form IS NOT NULL),
 roots AS (SELECT word, arg_max(top, k) AS root FROM up GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN roots USING (word)
"""

ORACLES = {
    "op5_decontaminate": _OP5, "op7_near_dedup": _OP7, "op10_warc_audit": _OP10, "op11_ranked_search": _OP11,
    "op13_spelling_variants": _OP13,
}
