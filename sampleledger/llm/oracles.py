"""SQL that says what a query of this subpackage returns, where SQL can."""

from __future__ import annotations

from sampleledger.llm import licenses

#: The CRC-32 of a list of byte values: the table follows from the polynomial, in eight halvings.
_CRC = """
bits AS (SELECT i::BIGINT AS i, i::BIGINT AS c FROM range(256) AS r(i)),
""" + "\n".join(
    f"bits{k} AS (SELECT i, CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END AS c FROM bits{k - 1 if k > 1 else ''}),"
    for k in range(1, 9)
) + """
crc AS (SELECT list(c ORDER BY i) AS t FROM bits8)"""

_BYTES = "list_transform(regexp_extract_all(hex(encode({0})), '..'), lambda h: ('0x' || h)::BIGINT)"

SHARDS = f"""
WITH {_CRC},
docs AS (
  SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size,
    ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h,
    xor(4294967295::BIGINT, list_reduce({_BYTES.format("coalesce(text, '')")}, lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::BIGINT)) AS text_crc32
  FROM documents, crc),
ranked AS (
  SELECT *, CASE WHEN source IS NULL THEN '~' ELSE '=' || source END AS key,
    row_number() OVER (PARTITION BY source ORDER BY h, doc_id, size, text_crc32) AS r, count(*) OVER (PARTITION BY source) AS n FROM docs),
placed AS (
  SELECT *, row_number() OVER (ORDER BY (2 * r - 1)::DOUBLE / (2 * n)::DOUBLE, key, r) - 1 AS place, count(*) OVER () AS total FROM ranked),
cut AS (SELECT *, (place * 8 // total)::INTEGER AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, shard, (place - (shard::BIGINT * total + 7) // 8)::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM cut"""

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_WORDS = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
_SHINGLES = "list_distinct(list_transform(range(1, greatest(len({0}) - 3, 2)), lambda i: array_to_string({0}[i:i + 4], ' ')))"
_SIZES = "SELECT unnest([{}]) AS size".format(", ".join(str(s) for s in sorted({licenses.size_of(len(licenses.plain_words(t))) for t in licenses.TEMPLATES.values()})))

NOTICES = f"""
WITH notices AS (SELECT * FROM (VALUES {", ".join(f"({_quoted(n)}, {licenses.size_of(len(licenses.plain_words(t)))}, {_quoted(t)})" for n, t in licenses.TEMPLATES.items())}) AS t(license, size, notice)),
templates AS (SELECT license, size, {_SHINGLES.format("ws")} AS want FROM (SELECT license, size, {_WORDS.format("notice")} AS ws FROM notices) n),
docs AS (SELECT doc_id, ws FROM (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents) d WHERE len(ws) > 0),
starts AS (SELECT doc_id, ws, size, unnest(range(0, greatest(ceil((len(ws) - size * 3 // 2) / (size // 2))::BIGINT, 0) + 1)) * (size // 2) AS pos FROM docs, ({_SIZES}) s),
windows AS (SELECT doc_id, size, pos, list_slice(ws, pos + 1, pos + size * 3 // 2) AS part FROM starts),
marked AS (SELECT doc_id, size, pos, {_SHINGLES.format("part")} AS have FROM windows),
met AS (SELECT doc_id, license, pos, len(list_intersect(want, have)) / len(want) AS containment FROM marked JOIN templates USING (size))
SELECT doc_id, license, max(containment)::DOUBLE AS containment, count(*) AS n_windows, min(pos)::BIGINT AS first_word
FROM met WHERE containment >= 0.8 GROUP BY doc_id, license"""

_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"

LINKS = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings WHERE {_USABLE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id"""

TOP = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings WHERE {_USABLE}),
scores AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) r WHERE rank <= 5"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_P = "(1 + (1000000000::HUGEINT * ({0} + 5)) // ({1} + 5 * {2}))::BIGINT"

DIVERGENCE = rf"""
WITH docs AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (SELECT i, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT i) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(n) AS size FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
sizes AS (SELECT lang, source, sum(n) AS size FROM counts GROUP BY lang, source),
groups AS (SELECT DISTINCT lang, source FROM docs),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {_P.format("coalesce(c.n, 0)", "coalesce(s.size, 0)", "l.v")} AS p, {_P.format("k.n", "l.size", "l.v")} AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term) LEFT JOIN sizes s USING (lang, source)),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM dense WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) u)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50"""


VARIANTS = rf"""
WITH RECURSIVE {_CRC},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS (
  SELECT run, k, xor(4294967295::BIGINT, list_reduce({_BYTES.format("coalesce(doc_id::VARCHAR, '') || ':' || run")}, lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::BIGINT)) AS h
  FROM counted, crc),
slipped AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
deleted AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS short FROM places),
masked AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
links AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM masked a JOIN masked b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT d.word, w.word, w.n FROM deleted d JOIN words w ON w.word = d.short
  UNION ALL SELECT w.word, d.word, d.n FROM deleted d JOIN words w ON w.word = d.short),
ordered AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM links),
formed AS (
  SELECT w.word, w.n, coalesce(o.n_near, 0)::BIGINT AS n_near, CASE WHEN o.near_n >= 5 * w.n THEN o.near END AS form, CASE WHEN o.near_n >= 5 * w.n THEN o.near_n END AS form_n
  FROM words w LEFT JOIN ordered o ON o.word = w.word AND o.place = 1),
walk AS (SELECT word, word AS root FROM formed UNION ALL SELECT k.word, f.form FROM walk k JOIN formed f ON f.word = k.root WHERE f.form IS NOT NULL),
ends AS (SELECT k.word, k.root FROM walk k JOIN formed f ON f.word = k.root WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e ON e.word = f.word"""


_BASE32 = "array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr({0}, (k // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (k % 8))) & 31) + 1, 1)), '')"

ARCHIVED = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, {_BASE32.format("sha1(payload)")} AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM payloads"""
