"""DuckDB SQL for the queries that SQL can express; written from the contracts, not from the plans."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op1_warc_revisits"] = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS n, sha1(body) AS hexed FROM p
), b AS (
  SELECT page_id, n, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hexed, 1 + 5 * (i // 4), 5) AS BIGINT)
      >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS digest
  FROM d
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY digest) AS top FROM b
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM m
"""

SQL["op2_quality_rules"] = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    text IS NULL AS none FROM documents
), w AS (
  SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM t
), grams AS (
  SELECT r, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), again AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1)
  GROUP BY r
), raw AS (
  SELECT r, host, text, unnest(string_split(text, chr(10))) AS raw FROM t WHERE NOT none
), lines AS (
  SELECT r, host, text, raw, translate(trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line
  FROM raw WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT r, count(*) - count(DISTINCT raw) AS n FROM lines GROUP BY r
), own AS (
  SELECT DISTINCT r, host, text, line FROM lines
), frequent AS (
  SELECT host, line FROM own GROUP BY host, line HAVING count(DISTINCT text) > 20
), lost AS (
  SELECT r, sum(length(line)) AS chars, coalesce(sum(length(line)) FILTER (f.line IS NOT NULL), 0) AS lost
  FROM own LEFT JOIN (SELECT host, line FROM frequent) f USING (host, line) GROUP BY r
), s AS (
  SELECT t.r, doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words
  FROM t JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN again USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce(lost / chars, 0) <= 0.5 AS kept
FROM s LEFT JOIN lost USING (r)
"""

SQL["op6_decontamination"] = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), g AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i : i + least(len(w), 10) - 1] AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), lens AS (
  SELECT DISTINCT n FROM g
), d AS (
  SELECT r, n, i, w[i : i + n - 1] AS gram
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM t, lens WHERE len(w) >= n)
), hit AS (
  SELECT r, i, d.n, item_id FROM d JOIN g ON d.n = g.n AND d.gram = g.gram
), words AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r
), items AS (
  SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(words.n, 0) > 0 AS contaminated
FROM t LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

SQL["op11_line_dedup"] = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), x AS (
  SELECT r, doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM t
), k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM (SELECT DISTINCT key, doc_id FROM k WHERE length(key) >= 20)
  GROUP BY key HAVING count(*) >= 3
), told AS (
  SELECT k.*, keeper IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS dropped FROM k LEFT JOIN shared USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT dropped), '')) AS kept_sha256
FROM told GROUP BY r
"""

#: CRC-32 of a list of bytes, by its table of 256 entries in the one row of ``crc``.
CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
)"""
CRC = """xor(list_reduce(list_concat([4294967295], {bytes}), lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), 4294967295)"""

SQL["op12_spelling_variants"] = (
    rf"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents WHERE text IS NOT NULL
), hashed AS (
  SELECT run, n, {CRC.format(bytes="list_transform(range(octet_length(encode(id || ':' || run))), lambda i: CAST('0x' || substr(hex(encode(id || ':' || run)), 2 * i + 1, 2) AS BIGINT))")} AS h
  FROM (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY id, run), crc
), words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
    ELSE run END AS word, n FROM hashed
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)
), pairs AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT cut.word, v.word FROM cut JOIN v ON cut.rest = v.word
  UNION SELECT v.word, cut.word FROM cut JOIN v ON cut.rest = v.word
), best AS (
  SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, near) AS k
  FROM (SELECT pairs.word, near, v.n AS m FROM pairs JOIN v ON near = v.word)
), told AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * v.n THEN near END AS form,
    CASE WHEN m >= 10 * v.n THEN m END AS form_n
  FROM v LEFT JOIN (SELECT * FROM best WHERE k = 1) b USING (word)
), chain AS (
  SELECT word, word AS last, 0 AS k FROM told
  UNION ALL SELECT chain.word, told.form, k + 1 FROM chain JOIN told ON chain.last = told.word WHERE told.form IS NOT NULL
), ends AS (
  SELECT word, arg_max(last, k) AS root FROM chain GROUP BY word
)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM told JOIN ends USING (word)
"""
)

_FIELDS = "doc_id", "source", "lang", "n_chars"
_LEAF = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in _FIELDS)
_SIBLINGS = """coalesce(string_agg(d, '') OVER (PARTITION BY {0}lvl, idx // 3 ORDER BY idx
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(d, '') OVER (PARTITION BY {0}lvl, idx // 3 ORDER BY idx
    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r"""

SQL["op13_merkle_manifest"] = (
    rf"""
WITH RECURSIVE {CRC_TABLE}, t AS (
  SELECT *, {CRC.format(bytes="list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))")} % 2 = 0 AS touched
  FROM documents, crc
), h AS (
  SELECT doc_id, source IS NOT NULL AS has, coalesce(source, '') AS src, sha256({_LEAF} || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256({_LEAF} || coalesce(strlen(cut) || ':' || cut, '-')) AS tampered
  FROM (SELECT *, CASE WHEN touched THEN replace(text, chr(10), '') ELSE text END AS cut FROM t)
), leaf AS (
  SELECT *, row_number() OVER () AS doc, row_number() OVER (PARTITION BY has, src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS lo,
    count(*) OVER (PARTITION BY has, src) AS n FROM h
), nodes AS (
  SELECT has, src, 0 AS lvl, lo AS idx, n, leaf AS d FROM leaf
  UNION ALL SELECT has, src, lvl + 1, idx // 3, (max(n) + 2) // 3, sha256(string_agg(d, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY has, src, lvl, idx // 3
), sides AS (
  SELECT has, src, lvl, idx, {_SIBLINGS.format("has, src, ")} FROM nodes WHERE n > 1
), walk AS (
  SELECT doc, has, src, 0 AS lvl, lo AS idx, tampered AS d, '' AS proof FROM leaf
  UNION ALL SELECT doc, w.has, w.src, w.lvl + 1, w.idx // 3, sha256(l || w.d || r), proof || l || r
  FROM walk w JOIN sides s ON w.has = s.has AND w.src = s.src AND w.lvl = s.lvl AND w.idx = s.idx
), up AS (
  SELECT doc, arg_max(d, lvl) AS d, arg_max(proof, lvl) AS proof FROM walk GROUP BY doc
), subs AS (
  SELECT has, src, d, row_number() OVER (ORDER BY has, src) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1
), above AS (
  SELECT 0 AS lvl, idx, n, d FROM subs
  UNION ALL SELECT lvl + 1, idx // 3, (max(n) + 2) // 3, sha256(string_agg(d, '' ORDER BY idx)) FROM above WHERE n > 1 GROUP BY lvl, idx // 3
), sides_above AS (
  SELECT lvl, idx, {_SIBLINGS.format("")} FROM above WHERE n > 1
), walk_above AS (
  SELECT doc, 0 AS lvl, s.idx, up.d, proof FROM up JOIN leaf USING (doc) JOIN subs s ON leaf.has = s.has AND leaf.src = s.src
  UNION ALL SELECT doc, w.lvl + 1, w.idx // 3, sha256(l || w.d || r), proof || l || r
  FROM walk_above w JOIN sides_above s ON w.lvl = s.lvl AND w.idx = s.idx
), ends AS (
  SELECT doc, arg_max(d, lvl) AS d, arg_max(proof, lvl) AS proof FROM walk_above GROUP BY doc
)
SELECT doc_id, leaf, subs.d AS subroot, top.d AS root, sha256(proof) AS proof_sha256, ends.d AS folded_root, ends.d = top.d AS verified
FROM leaf JOIN ends USING (doc) JOIN subs ON leaf.has = subs.has AND leaf.src = subs.src, (SELECT d FROM above WHERE n = 1) top
"""
)
