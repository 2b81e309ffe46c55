"""DuckDB SQL for the operators that it can express, on the same tables."""

from __future__ import annotations

from quillgraph.llm import quality_rules, suffix_dedup, vector_codes

#: Bytes of a text that are cut into strings together, so that a long text isn't read from its begin for each.
_CHUNK = 1000
_L = suffix_dedup.LENGTH

SUFFIX_DEDUP = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, {suffix_dedup.NO_ID}) AS owner, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT *, length(h) // 2 AS n FROM d),
chunks AS (SELECT rid, owner, {_CHUNK} * c AS base, substr(h, {2 * _CHUNK} * c + 1, {2 * (_CHUNK + _L - 1)}) AS part FROM n, unnest(range(0, n // {_CHUNK} + 1)) AS u(c)),
strings AS (SELECT rid, owner, base + i AS i, substr(part, 2 * i + 1, {2 * _L}) AS s FROM chunks, unnest(range(0, least({_CHUNK}, length(part) // 2 - {_L - 1}))) AS u(i)),
least_owner AS (SELECT s, min(owner) AS least FROM strings GROUP BY s HAVING min(owner) < max(owner)),
hits AS (SELECT rid, i, i - lag(i) OVER (PARTITION BY rid ORDER BY i) AS gap FROM strings JOIN least_owner USING (s) WHERE least < owner),
runs AS (SELECT rid, i, count(*) FILTER (gap IS NULL OR gap > {_L}) OVER (PARTITION BY rid ORDER BY i) AS run FROM hits),
spans AS (SELECT rid, min(i) AS a, max(i) + {_L} AS z FROM runs GROUP BY rid, run),
ends AS (SELECT rid, a, z, coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM spans),
found AS (SELECT rid, count(*) AS n_spans, sum(z - a)::BIGINT AS n_removed, max(z) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM ends JOIN n USING (rid) GROUP BY rid)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM n LEFT JOIN found USING (rid)
"""

_WORD = "[^\\x20\\x09-\\x0D]"
_NO_WORD = "[\\x20\\x09-\\x0D]"
_GRID = " UNION ALL ".join(f"SELECT lang, '{rule}' AS rule, {step} AS step, {cutoff} AS cutoff, ({value}) > {cutoff} AS rejected FROM good" for rule, (value, cuts) in quality_rules.RULES.items() for step, cutoff in enumerate(cuts))
_RISK = quality_rules.ALPHA / len(quality_rules.RULES)
_REJECTS = " OR ".join(f"coalesce(({value}) > (SELECT cutoff FROM chosen WHERE rule = '{rule}' AND chosen.lang IS NOT DISTINCT FROM f.lang), false)" for rule, (value, _) in quality_rules.RULES.items())

QUALITY_RULES = f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
c AS (SELECT *, regexp_extract_all(t, '{_WORD}+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l FROM t),
trios AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM c, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, s) AS k FROM trios) WHERE k > 1),
places AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, unnest([0, 1, 2]) AS u(k) GROUP BY rid),
f AS (SELECT doc_id, lang, len(w) AS n_words, length(regexp_replace(t, '{_NO_WORD}', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(w) < 50 OR 100 * coalesce(n, 0) > 50 * len(w) AS base_failed FROM c LEFT JOIN places USING (rid)),
good AS (SELECT f.* FROM f JOIN labels ON f.doc_id = labels.doc_id AND quality = 1 WHERE NOT base_failed),
counts AS (SELECT lang, rule, step, cutoff, count(*) AS n, count(*) FILTER (rejected) AS k FROM ({_GRID}) GROUP BY ALL),
strata AS (SELECT count(DISTINCT coalesce(lang, chr(1))) AS strata FROM counts),
tails AS (SELECT *, CASE WHEN k <= n * {_RISK} THEN (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RISK}) + (n - i) * ln(1 - {_RISK}))) FROM unnest(range(0, k + 1)) AS u(i)) END AS tail FROM counts),
passed AS (SELECT *, coalesce(tail <= {quality_rules.DELTA / len(quality_rules.RULES)} / strata, false) AS ok FROM tails, strata),
chosen AS (SELECT lang, rule, min(cutoff) AS cutoff FROM (SELECT *, bool_and(ok) OVER (PARTITION BY lang, rule ORDER BY step) AS held FROM passed) WHERE held GROUP BY lang, rule)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({_REJECTS}) AS kept FROM f
"""


def _vector_codes(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Lloyd rounds without any bounds, a pair of tables for each."""
    assign = "SELECT rid, p, arg_min(e, {{'d': d, 'e': e}}) AS e, min(d) AS d FROM (SELECT rid, p, e, list_sum(list_transform(list_zip(s, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM x JOIN c{0} USING (p)) GROUP BY rid, p"
    mean = "SELECT p, e, i, CASE WHEN n > 0 THEN (t - ((t % n) + n) % n) // n END AS m FROM (SELECT p, e, i, sum(v)::HUGEINT AS t, count(*)::HUGEINT AS n FROM (SELECT p, e, unnest(s) AS v, unnest(range(len(s))) AS i FROM x JOIN a{0} USING (rid, p)) GROUP BY ALL)"
    update = f"SELECT c.p, c.e, coalesce(u.c, c.c) AS c FROM c{{0}} c LEFT JOIN (SELECT p, e, list(m::BIGINT ORDER BY i) AS c FROM ({mean}) GROUP BY p, e) u USING (p, e)"
    tables = [
        f"v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label, list_transform(embedding, lambda y: floor(y::DOUBLE * {scale})::BIGINT) AS v FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0)",
        f"x AS MATERIALIZED (SELECT rid, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS s FROM v, unnest(range({parts})) AS u(p))",
        f"c0 AS MATERIALIZED (SELECT p, rid - 1 AS e, s AS c FROM x WHERE rid <= {entries})",
    ]
    for r in range(rounds + 1):
        tables.append(f"a{r} AS MATERIALIZED ({assign.format(r)})")
        if r < rounds:
            tables.append(f"c{r + 1} AS MATERIALIZED ({update.format(r)})")
    return f"""
WITH {", ".join(tables)},
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM c{rounds}),
rows AS (SELECT rid, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM rows JOIN v USING (rid), book
"""


VECTOR_CODES = _vector_codes(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS, vector_codes.SCALE)

PREFIX_TRIE = """
WITH bytes AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) AS r(i)),
own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n, role, text FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT conv_id AS c, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT), lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]), 4294967295), 4294967295) % 9 AS h FROM (SELECT DISTINCT conv_id FROM own), bytes),
turns AS (SELECT c, n, 0 AS later, role, text FROM convs JOIN own ON conv_id = c - c % 5 AND n <= h UNION ALL SELECT c, n, 1, role, text FROM convs JOIN own ON conv_id = c AND n > h),
paths AS (SELECT c, row_number() OVER w AS d, md5(string_agg(md5(strlen(role) || ':' || role || text), '') OVER w) AS node, strlen(text) AS bytes FROM turns WINDOW w AS (PARTITION BY c ORDER BY later, n)),
all_paths AS (SELECT c, d, node, coalesce(lag(node) OVER (PARTITION BY c ORDER BY d), '') AS parent, bytes FROM paths UNION ALL SELECT c, 0, '', NULL, 0 FROM convs),
last AS (SELECT c, max(d) AS d FROM all_paths GROUP BY c),
nodes AS (SELECT node, any_value(parent) AS parent, d AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS own FROM all_paths GROUP BY node, d),
children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
pairs AS (SELECT DISTINCT a.node, b.node AS below FROM all_paths a JOIN all_paths b ON a.c = b.c AND a.d <= b.d),
sums AS (SELECT pairs.node, count(*) FILTER (children.n IS NULL) AS n_leaves, sum(own)::BIGINT AS saved FROM pairs JOIN nodes ON nodes.node = below LEFT JOIN children ON children.node = below GROUP BY pairs.node),
ends AS (SELECT node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS h FROM all_paths JOIN last USING (c, d) GROUP BY node)
SELECT nodes.conv_id, nodes.depth, p.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children, n_leaves, saved AS saved_tokens, coalesce(h, sha256('')) AS ends_sha256
FROM nodes LEFT JOIN nodes p ON p.node = nodes.parent LEFT JOIN children ON children.node = nodes.node JOIN sums ON sums.node = nodes.node LEFT JOIN ends ON ends.node = nodes.node
"""
