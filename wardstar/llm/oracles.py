"""DuckDB statements for the queries that SQL can express."""

# Word list of a text: maximal runs of [^\x20\x09-\x0D].
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP9_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
win AS (
  SELECT r, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s
  FROM d, LATERAL (SELECT unnest(generate_series(1, len(w) - 7)) AS i)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest(generate_series(i, i + 7)) AS p FROM twice) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup FROM (
    SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
stut AS (
  SELECT r, count(*) AS n FROM (
    SELECT r, w, unnest(generate_series(2, len(w))) AS i FROM d) WHERE w[i] = w[i - 1] GROUP BY r),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(stut.n, 0)::BIGINT AS n_stutter
  FROM d LEFT JOIN rep USING (r) LEFT JOIN lines USING (r) LEFT JOIN stut USING (r)),
f AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_stutter > 30 * n_words THEN 64 ELSE 0 END)::BIGINT AS failed_bits FROM m)
SELECT *, (failed_bits & 3) <> 0 AS base_failed, failed_bits = 0 AS kept FROM f
"""

# A-Z to a-z only, then words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
_ITEM_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
               r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP6_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, p, p + 9), ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS p
        FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
spots AS (
  SELECT r, p, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS s
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p
        FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, p, n, item_id FROM spots JOIN win USING (n, s)),
hit AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (
    SELECT r, unnest(generate_series(p, p + n - 1)) AS q FROM hits) GROUP BY r),
named AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
    sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
  FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

OP8_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(conv_id::VARCHAR, chr(0) || 'none') AS key, role, text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS position
  FROM conversations),
reply AS (
  SELECT *, md5(CASE WHEN text IS NULL THEN 'n' ELSE 't' || text END) AS digest FROM t
  WHERE role = 'assistant' QUALIFY row_number() OVER (PARTITION BY key ORDER BY position DESC) = 1),
placed AS (
  SELECT *, row_number() OVER (ORDER BY digest, md5(key), key) AS n, count(*) OVER () AS total FROM reply),
most AS (SELECT max(c) AS m FROM (SELECT count(*) AS c FROM reply GROUP BY digest)),
s AS (
  SELECT key, conv_id AS pair_id, 'chosen' AS side, conv_id, position, role, text FROM t
  UNION ALL
  SELECT t.key, t.conv_id, 'rejected', t.conv_id, t.position, t.role, t.text
  FROM t LEFT JOIN reply r USING (key) WHERE r.position IS NULL OR t.position < r.position
  UNION ALL
  SELECT a.key, a.conv_id, 'rejected', b.conv_id, a.position, b.role, b.text
  FROM placed a, most JOIN placed b ON b.n = (a.n - 1 + m) % a.total + 1),
cut AS (
  SELECT key, min(position) AS cut FROM (
    SELECT key, position FROM s GROUP BY ALL
    HAVING count(*) < 2 OR count(DISTINCT (coalesce(role, chr(1)), coalesce(text, chr(1)))) > 1)
  GROUP BY key),
p AS (SELECT s.*, cut, coalesce(position < cut, true) AS shared FROM s LEFT JOIN cut USING (key))
SELECT key AS sample_id, pair_id, conv_id, CASE WHEN shared THEN 'prompt' ELSE side END AS part,
  position - CASE WHEN shared THEN 1 ELSE cut END AS segment, position, role,
  '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) AS rendered,
  NOT shared AND coalesce(role = 'assistant', false) AS train
FROM p WHERE NOT shared OR side = 'chosen'
"""

# CRC-32 of a short text, bit by bit: a value below 256 is a byte to take in, -1 a shift.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split({0}, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"""


def _field(x: str) -> str:
    return f"coalesce(strlen({x}) || ':' || {x}, '-')"


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(map(_field, fields)) + ")"


OP11_SQL = f"""
WITH RECURSIVE
leaf AS (
  SELECT row_number() OVER () AS r, doc_id, lang, {_leaf("text")} AS leaf,
    CASE WHEN {_CRC32.format("doc_id::VARCHAR")} % 3 = 0
      THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
      ELSE {_leaf("text")} END AS claim FROM documents),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n FROM leaf),
tree AS (
  SELECT g, 0 AS lvl, pos AS i, n, leaf AS d FROM placed
  UNION ALL
  SELECT g, lvl + 1, i // 8, any_value((n + 7) // 8), sha256(string_agg(d, '' ORDER BY i))
  FROM tree WHERE n > 1 GROUP BY g, lvl, i // 8),
sub AS (SELECT g, lvl AS h, d AS subroot, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS lvl, g - 1 AS i, n, subroot AS d FROM sub
  UNION ALL
  SELECT lvl + 1, i // 8, any_value((n + 7) // 8), sha256(string_agg(d, '' ORDER BY i))
  FROM top WHERE n > 1 GROUP BY lvl, i // 8),
climb AS (
  SELECT r, g, lvl, pos // (8 ** lvl)::BIGINT AS i, lvl AS step
  FROM placed JOIN sub USING (g), LATERAL (SELECT unnest(generate_series(0, h - 1)) AS lvl)
  UNION ALL
  SELECT r, NULL, lvl, (g - 1) // (8 ** lvl)::BIGINT, 1000 + lvl
  FROM placed, LATERAL (SELECT unnest(generate_series(0, (SELECT max(lvl) FROM top) - 1)) AS lvl)),
sides AS (
  SELECT c.r, c.step, coalesce(string_agg(t.d, '' ORDER BY t.i) FILTER (t.i < c.i), '') AS a,
    coalesce(string_agg(t.d, '' ORDER BY t.i) FILTER (t.i > c.i), '') AS b
  FROM climb c JOIN (
    SELECT g, lvl, i, d FROM tree UNION ALL SELECT NULL, lvl, i, d FROM top) t
  ON c.g IS NOT DISTINCT FROM t.g AND c.lvl = t.lvl AND c.i // 8 = t.i // 8
  GROUP BY c.r, c.step),
paths AS (
  SELECT r, list({{'a': a, 'b': b}} ORDER BY step) AS path, string_agg(a || b, '' ORDER BY step) AS s
  FROM sides GROUP BY r),
folded AS (
  SELECT r, coalesce(path, []) AS path, coalesce(s, '') AS s, 1 AS k, claim AS d
  FROM placed LEFT JOIN paths USING (r)
  UNION ALL
  SELECT r, path, s, k + 1, sha256(path[k].a || d || path[k].b) FROM folded WHERE k <= len(path))
SELECT doc_id, leaf, subroot, (SELECT d FROM top WHERE n = 1) AS root, sha256(s) AS proof_sha256,
  d AS folded_root, d = (SELECT d FROM top WHERE n = 1) AS verified
FROM folded JOIN placed USING (r) JOIN sub USING (g) WHERE k > len(path)
"""

OP13_SQL = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, c.vec_id, c.r, a.label = c.label AS same,
    list_inner_product(a.v, c.v)::BIGINT AS score
  FROM e a JOIN e c ON a.r <> c.r AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT a, anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, r) AS i FROM s WHERE same),
n AS (
  SELECT p.anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY a, i ORDER BY score DESC, vec_id NULLS LAST, r) AS rank
  FROM p JOIN s USING (a)
  WHERE i <= 5 AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10
"""
