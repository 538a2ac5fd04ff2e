"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from candlewarden.llm import mixing, quality_rules

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_RISK, _LEVEL = quality_rules.SHARE, f"{quality_rules.ERROR} / (strata * {len(quality_rules.RULES) * quality_rules.TOP})"

QUALITY_RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
windows AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
repeated AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1)
  GROUP BY rid),
f AS (
  SELECT d.doc_id, d.lang, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    len(regexp_extract_all(t, '\p{{Lu}}'))::BIGINT AS n_capitals,
    coalesce(n_lines, 0)::BIGINT AS n_lines,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN lines USING (rid) LEFT JOIN repeated USING (rid)),
s AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    least(20 * n_symbols // greatest(n_words, 1), {quality_rules.TOP}) AS symbols,
    least(40 * n_capitals // greatest(word_chars, 1), {quality_rules.TOP}) AS capitals,
    least(40 * n_dup_lines // greatest(n_lines, 1), {quality_rules.TOP}) AS dup_lines,
    least(40 * n_repeat_words // greatest(n_words, 1), {quality_rules.TOP}) AS repeats
  FROM f),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING max(quality) = 1),
cells AS (
  SELECT coalesce(lang, '(null)') AS stratum, rule, score, count(*) AS c
  FROM (SELECT lang, unnest(['symbols', 'capitals', 'dup_lines', 'repeats']) AS rule,
               unnest([symbols, capitals, dup_lines, repeats]) AS score
        FROM s WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good))
  GROUP BY ALL),
tests AS (
  SELECT stratum, rule, sum(c)::BIGINT AS n, (SELECT count(DISTINCT stratum) FROM cells) AS strata FROM cells GROUP BY ALL),
terms AS (
  SELECT stratum, rule, n, strata, j,
    n * ln(1 - {_RISK}) + sum(CASE WHEN j = 0 THEN 0 ELSE ln((n - j + 1) / j * {_RISK / (1 - _RISK)!r}) END)
      OVER (PARTITION BY stratum, rule ORDER BY j) AS term
  FROM (SELECT *, unnest(range(0, ceil(n * {_RISK})::BIGINT + 1)) AS j FROM tests)),
allowed AS (
  SELECT stratum, rule, coalesce(max(j) FILTER (WHERE total <= {_LEVEL}), -1) AS x
  FROM (SELECT *, sum(exp(term)) OVER (PARTITION BY stratum, rule ORDER BY j) AS total FROM terms) GROUP BY ALL),
cuts AS (
  SELECT a.stratum, a.rule, min(cut) AS cutoff
  FROM (SELECT *, unnest(range(1, {quality_rules.TOP + 1})) AS cut FROM allowed) AS a
  WHERE (SELECT coalesce(sum(c), 0) FROM cells WHERE cells.stratum = a.stratum AND cells.rule = a.rule AND score >= cut) <= x
  GROUP BY ALL),
wide AS (
  SELECT stratum, max(cutoff) FILTER (WHERE rule = 'symbols') AS a, max(cutoff) FILTER (WHERE rule = 'capitals') AS b,
    max(cutoff) FILTER (WHERE rule = 'dup_lines') AS c, max(cutoff) FILTER (WHERE rule = 'repeats') AS e
  FROM cuts GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (coalesce(symbols >= a, false) OR coalesce(capitals >= b, false)
    OR coalesce(dup_lines >= c, false) OR coalesce(repeats >= e, false)) AS kept
FROM s LEFT JOIN wide ON coalesce(lang, '(null)') = stratum
"""

MIXING = f"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
u AS (
  SELECT *, (('0x' || substr(md5(concat_ws('|', '{mixing.SALT}', coalesce(doc_id::VARCHAR, ''), size::VARCHAR)), 1, 13))::BIGINT
    + 0.5::DOUBLE) / {float(1 << 52)!r}::DOUBLE AS u FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, {mixing.MOST} * sum(size)::BIGINT AS most,
    {list(mixing.WEIGHTS)}[((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1)::BIGINT]::BIGINT AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, row_number() OVER w AS place, sum(source_size) OVER () AS total, coalesce(sum(most) OVER b, 0) AS cut,
    sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS weights
  FROM s WINDOW w AS (ORDER BY most::DOUBLE / weight::DOUBLE, source NULLS LAST),
    b AS (ORDER BY most::DOUBLE / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - cut)::DOUBLE / weights::DOUBLE AS level FROM o),
t AS (
  SELECT source, source_size, least(most::DOUBLE, weight * coalesce(
    (SELECT level FROM l WHERE weight * level <= most ORDER BY place LIMIT 1), 0::DOUBLE)) AS target FROM l),
c AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)::DOUBLE), 0)::BIGINT AS copies FROM t),
p AS (
  SELECT *, target - (copies * source_size)::DOUBLE AS extra FROM c),
k AS (
  SELECT source, length(bin(size)) AS bits, sum(size)::BIGINT AS words FROM u WHERE size > 0 GROUP BY ALL),
f AS (
  SELECT k.source, bits, (extra - coalesce(sum(words) OVER (PARTITION BY k.source ORDER BY bits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(bits * words) OVER (PARTITION BY k.source ORDER BY bits DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS factor
  FROM k JOIN p ON k.source IS NOT DISTINCT FROM p.source),
x AS (
  SELECT source, arg_max(factor, bits) AS factor FROM f WHERE factor * bits <= 1 GROUP BY source),
odds AS (
  SELECT u.doc_id, u.source, size, u, extra, least(1, factor * length(bin(size)))::DOUBLE AS pi
  FROM u JOIN p ON u.source IS NOT DISTINCT FROM p.source JOIN x ON u.source IS NOT DISTINCT FROM x.source
  WHERE size > 0 AND extra > 0 AND factor > 0),
ties AS (
  SELECT source, u, CASE WHEN pi >= 1 THEN 0 ELSE (u / (1 - u)) / (pi / (1 - pi)) END::DOUBLE AS rank, sum(size)::BIGINT AS words, any_value(extra) AS extra
  FROM odds GROUP BY source, u, rank),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY rank, u) AS i,
    coalesce(sum(words) OVER (PARTITION BY source ORDER BY rank, u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far FROM ties),
ends AS (
  SELECT source, max(i) AS last FROM numbered WHERE 2 * so_far + words <= 2 * extra GROUP BY source),
added AS (
  SELECT n.source, u FROM numbered AS n JOIN ends AS e ON n.source IS NOT DISTINCT FROM e.source WHERE i <= last)
SELECT u.doc_id, size, source_size, target, size * (copies + (a.u IS NOT NULL AND size > 0)::BIGINT) AS taken
FROM u JOIN p ON u.source IS NOT DISTINCT FROM p.source
LEFT JOIN (SELECT DISTINCT source, u FROM added) AS a ON a.source IS NOT DISTINCT FROM u.source AND a.u = u.u
"""

WARC_INDEX = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS holder FROM p)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(h, (5 * (i // 4) + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = holder THEN NULL ELSE holder END AS refers_to
FROM r
"""

PIVOT_SEARCH = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id, c.r, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v AS q JOIN v AS c ON c.r <> q.r WHERE q.vec_id % 100 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id, r)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 10
"""

PREFIX_TRIE = """
WITH c AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, count(*) AS n FROM c GROUP BY conv_id),
h AS (
  SELECT conv_id, n, conv_id - conv_id % 5 AS base,
    xor(list_reduce(list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT),
      lambda crc, x: list_reduce([xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, 3988292384 * (r & 1))), 4294967295), 4294967295) % 9 AS h
  FROM n),
k AS (SELECT h.*, least(h, coalesce(b.n, 0)) AS kept FROM h LEFT JOIN n AS b ON b.conv_id = h.base),
r AS (
  SELECT k.conv_id, pos AS depth, role, text FROM k JOIN c ON c.conv_id = k.base AND pos <= kept
  UNION ALL SELECT k.conv_id, pos - h + kept, role, text FROM k JOIN c USING (conv_id) WHERE pos > h),
p AS (
  SELECT conv_id, depth, text, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM r
  UNION ALL SELECT conv_id, 0, '', '' FROM k),
len AS (SELECT conv_id, max(depth) AS last FROM p GROUP BY conv_id),
nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * octet_length(encode(any_value(text))) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = last), '')) AS ends_sha256
  FROM p JOIN len USING (conv_id) GROUP BY key, depth),
up AS (
  SELECT u.key, u.depth, q.key AS parent FROM nodes AS u JOIN p AS q ON q.conv_id = u.conv_id AND q.depth = u.depth - 1),
kids AS (SELECT parent AS key, count(*) AS n_children FROM up GROUP BY parent),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (key)),
below AS (
  SELECT q.key, sum(u.saved) AS saved_tokens, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves
  FROM full_nodes AS u JOIN p AS q ON q.conv_id = u.conv_id AND q.depth <= u.depth GROUP BY q.key)
SELECT x.conv_id::BIGINT AS conv_id, x.depth::BIGINT AS depth, y.conv_id::BIGINT AS parent_conv_id, x.n_convs::BIGINT AS n_convs,
  x.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, x.ends_sha256
FROM full_nodes AS x JOIN below USING (key) LEFT JOIN up ON up.key = x.key LEFT JOIN nodes AS y ON y.key = up.parent
"""

ORACLES: dict[str, str] = {
    "op5_quality_rules": QUALITY_RULES,
    "op6_mixing": MIXING,
    "op9_warc_index": WARC_INDEX,
    "op12_pivot_search": PIVOT_SEARCH,
    "op13_prefix_trie": PREFIX_TRIE,
}
