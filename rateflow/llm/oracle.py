"""DuckDB SQL for the queries that SQL can express: the exact ones.

Each computes the result straight from the contract, without anchors,
buckets, projections or archives.
"""

from __future__ import annotations

# The alphabet of base32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def suffix_dedup_sql(window: int = 50) -> str:
    """Bytes are handled as pairs of hexadecimal digits; ``w`` has every window, ``gone`` the removed bytes."""
    return f"""
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (
  SELECT doc_id, s, substr(h, 2 * s + 1, {2 * window}) AS x
  FROM (SELECT doc_id, h, unnest(range(greatest(n - {window} + 1, 0))) AS s FROM d)
),
marked AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY x) < doc_id AS hit FROM w),
covered AS (SELECT DISTINCT doc_id, s + o AS p FROM marked, range({window}) AS r(o) WHERE hit),
spans AS (
  SELECT doc_id, min(p) AS a, count(*) AS k
  FROM (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS g FROM covered) GROUP BY doc_id, g
),
lists AS (SELECT doc_id, list(a ORDER BY a) AS a, list(k ORDER BY a) AS k, sum(k) AS total, count(*) AS m FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(total, 0) AS BIGINT) AS n_removed, CAST(coalesce(m, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN m IS NULL THEN h ELSE
         list_aggregate(list_transform(range(m + 1), lambda i: substr(h,
           2 * CASE WHEN i = 0 THEN 0 ELSE a[i] + k[i] END + 1,
           2 * (CASE WHEN i = m THEN n ELSE a[i + 1] END - CASE WHEN i = 0 THEN 0 ELSE a[i] + k[i] END))), 'string_agg', '')
       END)) AS kept_sha256
FROM d LEFT JOIN lists USING (doc_id)"""


def fm_dedup_sql(window: int = 35) -> str:
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
w AS (
  SELECT doc_id, s, list_slice(words, s + 1, s + {window}) AS x
  FROM (SELECT doc_id, words, unnest(range(greatest(len(words) - {window} + 1, 0))) AS s FROM d)
),
marked AS (SELECT doc_id, s, count(*) OVER (PARTITION BY x) > 1 AS hit FROM w),
covered AS (SELECT DISTINCT doc_id, s + o AS p FROM marked, range({window}) AS r(o) WHERE hit),
gone AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM covered GROUP BY doc_id),
each_word AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS p FROM d),
kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.p) AS t
  FROM each_word e LEFT JOIN covered c ON c.doc_id = e.doc_id AND c.p = e.p WHERE c.p IS NULL GROUP BY e.doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def warc_sql() -> str:
    """Base32 reads the digest's bits five at a time; a hexadecimal digit holds four of them."""
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT html, max(page_id) AS keeper FROM p GROUP BY html),
b AS (
  SELECT p.*, keeper, list_aggregate(list_transform(range(40), lambda i:
    substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (instr('0123456789abcdef', substr(h, i + 1, 1)) - 1) + 1, 4)), 'string_agg', '') AS bits
  FROM p JOIN g USING (html)
)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('{BASE32}',
         1 + CAST(substr(bits, 5 * i + 1, 1) AS INT) * 16 + CAST(substr(bits, 5 * i + 2, 1) AS INT) * 8 + CAST(substr(bits, 5 * i + 3, 1) AS INT) * 4
           + CAST(substr(bits, 5 * i + 4, 1) AS INT) * 2 + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM b"""


def links_sql(threshold: float = 0.98) -> str:
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= {threshold}
),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
least AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT vec_id, CAST(coalesce((SELECT count(*) FROM links WHERE links.x = least.vec_id), 0) AS BIGINT) AS n_links,
       component_id, vec_id = component_id AS kept
FROM least"""


def fill_in_middle_sql() -> str:
    """Lines as a list; prefix, middle and suffix are slices of it."""
    return """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT *, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS lines, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d
),
c AS (SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a, greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b FROM u),
p AS (
  SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle, array_to_string(lines[b + 1:n], '') AS suffix,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""


def spelling_variants_sql() -> str:
    """crc32 goes over the bytes, each followed by eight shifts (-1 in the list of steps).

    Two words are near if dropping the letter at one same place leaves the same
    text, or dropping a letter of the longer leaves the shorter.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS head,
         unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[a-z\\x{{C0}}-\\x{{FF}}]{{5,}}')) AS run
  FROM documents
),
each_run AS (SELECT head, run, count(*) AS k FROM runs GROUP BY ALL),
steps AS (
  SELECT run, k, [CAST(4294967295 AS BIGINT)] || flatten(list_transform(range(octet_length(encode(head || run))), lambda i:
           [CAST('0x' || substr(hex(encode(head || run)), 2 * i + 1, 2) AS BIGINT)] || [-1, -1, -1, -1, -1, -1, -1, -1])) AS s
  FROM each_run
),
crc AS (
  SELECT run, k, xor(list_reduce(s, lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) AS h
  FROM steps
),
noisy AS (
  SELECT k, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM crc
),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM noisy WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cut AS (SELECT word, length(word) AS len, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM v)),
pairs AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT cut.word, v.word FROM cut JOIN v ON cut.rest = v.word
  UNION SELECT v.word, cut.word FROM cut JOIN v ON cut.rest = v.word
),
ranked AS (
  SELECT p.word, p.near, b.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY b.n DESC, encode(p.near)) AS place
  FROM pairs p JOIN v b ON b.word = p.near
),
forms AS (
  SELECT v.word, v.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= 2 * v.n THEN r.near END AS form, CASE WHEN r.near_n >= 2 * v.n THEN r.near_n END AS form_n
  FROM v LEFT JOIN ranked r ON r.word = v.word AND r.place = 1
),
walk AS (
  SELECT word, word AS here, 0 AS depth FROM forms
  UNION ALL SELECT walk.word, forms.form, depth + 1 FROM walk JOIN forms ON forms.word = walk.here WHERE forms.form IS NOT NULL
),
ends AS (SELECT word, max_by(here, depth) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM forms JOIN ends USING (word)"""


def pii_sanitize_sql() -> str:
    """Spans from the plain patterns; ``shares`` has what each term discloses of each entity."""
    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    patterns = [
        ("email", email), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ]
    kinds = " UNION ALL ".join(
        f"SELECT r, doc_id, digest, {i} AS kind_no, '{kind}' AS kind, regexp_extract_all(t, '{p}') AS found, string_split_regex(t, '{p}') AS gaps FROM d"
        for i, (kind, p) in enumerate(patterns)
    )
    letters = r"\p{L}{3,}"

    def words(text: str) -> str:
        return f"regexp_extract_all(lower(regexp_replace({text}, '{email}', ' ', 'g')), '{letters}')"

    before = r"CASE WHEN length(before) > 120 THEN regexp_replace(right(before, 120), '^\p{L}+', '') ELSE before END"
    after = r"CASE WHEN length(after) > 120 THEN regexp_replace(left(after, 120), '\p{L}+$', '') ELSE after END"
    n = ", ".join(f"CAST(count(*) FILTER (kind = '{kind}') AS BIGINT) AS n_{kind}" for kind, _ in patterns)
    counts = ", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind, _ in patterns)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS digest FROM documents),
lists AS ({kinds}),
each_match AS (SELECT *, unnest(range(1, len(found) + 1)) AS k FROM lists WHERE len(found) > 0),
matched AS (
  SELECT r, doc_id, digest, kind_no, kind, found[k] AS value, gaps[k] AS before, gaps[k + 1] AS after,
         sum(length(gaps[k]) + length(found[k])) OVER (PARTITION BY r, kind_no ORDER BY k) AS stop, regexp_replace(found[k], '[^0-9]', '', 'g') AS digits
  FROM each_match
),
base AS (
  SELECT r, doc_id, digest, kind_no, kind, before, after, stop - length(value) AS start, stop,
         kind || ':' || CASE kind WHEN 'email' THEN lower(value) WHEN 'ip' THEN value ELSE digits END AS entity
  FROM matched
  WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(value, '.'), lambda x: length(ltrim(x, '0')) > 3 OR lpad(right(x, 3), 3, '0') > '255')) = 0
    WHEN 'card' THEN length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
      CAST(substr(reverse(digits), i, 1) AS INT) * (2 - i % 2) - CASE WHEN CAST(substr(reverse(digits), i, 1) AS INT) * (2 - i % 2) > 9 THEN 9 ELSE 0 END)) % 10 = 0
    ELSE length(digits) BETWEEN 8 AND 15 END
),
near AS (
  SELECT r, doc_id, digest, entity,
         {words(before)} AS b, {words(after)} AS a
  FROM base
),
mentions AS (
  SELECT DISTINCT r, doc_id, digest, entity, term
  FROM (SELECT r, doc_id, digest, entity, unnest(b[greatest(len(b) - 8, 0) + 1:] || a[1:8]) AS term FROM near)
),
entities AS (SELECT entity, count(*) AS n_c FROM (SELECT DISTINCT r, digest, entity FROM base) GROUP BY entity HAVING count(DISTINCT digest) > 1),
pairs AS (SELECT entity, term, count(*) AS n_ct FROM mentions GROUP BY entity, term HAVING count(DISTINCT digest) > 1),
terms AS (
  SELECT term, count(*) AS n_t FROM (SELECT DISTINCT r, unnest({words("t")}) AS term FROM d)
  WHERE term IN (SELECT term FROM pairs) GROUP BY term
),
total AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM d),
shares AS (
  SELECT entity, term, ln(n * n_ct / (n_c * n_t)) / ln(n / n_c) AS disclosure
  FROM pairs JOIN entities USING (entity) JOIN terms USING (term) CROSS JOIN total WHERE n_c < n
),
risky AS (SELECT DISTINCT r, term FROM mentions JOIN shares USING (entity, term) WHERE disclosure >= 0.6),
hidden AS (
  SELECT r, coalesce(string_agg(gaps[k] || coalesce(repeat('.', length(found[k])), ''), '' ORDER BY k), '') AS t
  FROM (SELECT r, gaps, found, unnest(range(1, len(gaps) + 1)) AS k FROM lists WHERE kind = 'email' AND r IN (SELECT r FROM risky)) GROUP BY r
),
word_lists AS (SELECT r, regexp_extract_all(t, '{letters}') AS found, string_split_regex(t, '{letters}') AS gaps FROM hidden),
word_matches AS (
  SELECT r, found[k] AS value, sum(length(gaps[k]) + length(found[k])) OVER (PARTITION BY r ORDER BY k) AS stop
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS k FROM word_lists)
),
added AS (SELECT r, 4 AS kind_no, 'term' AS kind, stop - length(value) AS start, stop FROM word_matches w JOIN risky USING (r) WHERE lower(value) = term),
spans AS (
  SELECT r, kind_no, kind, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span, start FROM base
  UNION ALL SELECT r, kind_no, kind, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), start FROM added
),
per_row AS (
  SELECT r, {n}, CAST(count(*) FILTER (kind = 'term') AS BIGINT) AS n_term,
         string_agg(span, ',' ORDER BY kind_no, start) FILTER (kind <> 'term') AS base_spans, string_agg(span, ',' ORDER BY kind_no, start) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, {counts}, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_term, 0) AS n_term
FROM d LEFT JOIN per_row USING (r)"""


ORACLE_SQL = {
    "op2_suffix_dedup": suffix_dedup_sql(),
    "op3_warc": warc_sql(),
    "op5_collision_dedup": links_sql(),
    "op10_fm_dedup": fm_dedup_sql(),
    "op11_fill_in_middle": fill_in_middle_sql(),
    "op12_spelling_variants": spelling_variants_sql(),
    "op13_pii_sanitize": pii_sanitize_sql(),
}
