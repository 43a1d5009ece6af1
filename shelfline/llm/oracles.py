"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from shelfline.llm import secrets

_SPACE = r"[\x20\x09-\x0D]"
_WORDS = rf"list_filter(string_split_regex(t, '{_SPACE}+'), lambda x: x <> '')"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
      FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)),
k AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM g),
p AS (SELECT r, count(DISTINCT i + o) AS n FROM k, (VALUES (0), (1), (2)) v(o) WHERE n > 1 GROUP BY r),
c AS (SELECT w.r, doc_id, source, len(ws)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
             (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(p.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN p ON p.r = w.r),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS failed FROM f GROUP BY source),
m AS (SELECT sum(failed) / sum(n) AS mean, count(*) - 1 AS others,
             sum(failed * failed / n) - sum(failed) ** 2 / sum(n) AS spread, sum(n) - (count(*) - 1) - sum(n::DOUBLE * n) / sum(n) AS room FROM h),
s AS (SELECT *, CASE WHEN mean * (1 - mean) > 0 AND room > 0 THEN (spread / (mean * (1 - mean)) - others) / room ELSE 0 END AS share FROM m),
b AS (SELECT least(greatest(1 / greatest(share, 1e-9) - 1, 1), 1000) AS strength FROM s),
q AS (SELECT strength, sum(failed / (n + strength)) / sum(n / (n + strength)) AS mean FROM h, b GROUP BY strength),
y AS (SELECT greatest(mean * strength, 1e-6) AS alpha, greatest((1 - mean) * strength, 1e-6) AS beta FROM q),
u AS (SELECT source, alpha / (alpha + beta) AS mean, n + alpha + beta AS size, (failed + alpha) / (n + alpha + beta) AS rate FROM h, y),
v AS (SELECT source, NOT (rate > 0.5 OR rate - 2 * sqrt(rate * (1 - rate) / (size + 1)) > 1.5 * mean) AS good FROM u)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND good AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""

_FIVE = "('0x' || substr(sha1(coalesce(html, '')), {0}, 5))::BIGINT"
_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
_BASE32 = " || ".join(
    f"substr({_LETTERS}, ((({_FIVE.format(5 * k + 1)}) >> {shift}) & 31)::INT + 1, 1)" for k in range(8) for shift in (15, 10, 5, 0)
)

WARC = f"""
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
"""

MIXING = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text, coalesce(text, '') AS t FROM documents),
v AS (SELECT *, {_WORDS} AS ws FROM d),
q AS (SELECT *, length(translate(text, '#*$%&|<>0123456789', ''))::DOUBLE / greatest(length(text), 1)
                * sqrt(len(list_distinct(ws))::DOUBLE / greatest(len(ws), 1)) AS weight FROM v),
k AS (SELECT r, doc_id, source, len(ws)::BIGINT AS size,
             -ln((('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || t), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
             / coalesce(greatest(weight, 0.05), 0.05) AS key
      FROM q),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS most FROM k GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s),
x AS (SELECT *, ([3, 1, 2])[mod(place, 3)::INT + 1] AS weight FROM w),
y AS (SELECT *, most / weight AS ratio, (sum(source_size) OVER ())::BIGINT * 150 / 100 AS wanted,
             coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS spent,
             (sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS heavy FROM x),
z AS (SELECT *, (wanted - spent) / heavy AS level FROM y),
l AS (SELECT arg_min(level, (ratio, place)) AS level FROM z WHERE level * weight <= most),
g AS (SELECT source, source_size, CASE WHEN l.level IS NULL OR l.level * weight >= most THEN most::DOUBLE ELSE l.level * weight END AS target
      FROM z LEFT JOIN l ON true),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM g),
o AS (SELECT k.*, source_size, target, epochs, target - epochs * source_size AS budget,
             (sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size, r ROWS UNBOUNDED PRECEDING))::BIGINT - size AS before
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, ((epochs + (before + size / 2 <= budget)::INT) * size)::BIGINT AS taken FROM o
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _parts(at: int) -> str:
    """The spans of a kind: lengths of matches and of the pieces between them, summed up."""
    kind, pattern, group, least, category = secrets.KINDS[at]
    p = _quoted(pattern)
    ok = f"length(g) >= {least}"
    if kind == "key":
        ok = "regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]')"
    return f"""
    SELECT r, {at} AS kind, '{kind}' AS name, '{category}' AS category, stop - length(m) AS start, stop FROM (
      SELECT r, m, g, (sum(length(q) + length(m)) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING))::BIGINT AS stop FROM (
        SELECT r, i, ms[i] AS m, gs[i] AS g, ps[i] AS q FROM (
          SELECT r, ms, gs, ps, unnest(generate_series(1, len(ms))) AS i FROM (
            SELECT r, regexp_extract_all(t, {p}, 0) AS ms, regexp_extract_all(t, {p}, {group}) AS gs, string_split_regex(t, {p}) AS ps
            FROM d WHERE regexp_matches(t, {p})))))
    WHERE {ok}"""


SECRETS = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
p AS MATERIALIZED ({" UNION ALL ".join(map(_parts, range(len(secrets.KINDS))))}),
strong AS (SELECT * FROM p WHERE kind < {secrets.STRONG}),
weak AS (SELECT * FROM p WHERE kind >= {secrets.STRONG} AND NOT EXISTS (
    SELECT 1 FROM strong s WHERE s.r = p.r AND p.start < s.stop AND p.stop > s.start AND p.start >= s.start)),
linked AS (SELECT * FROM weak a WHERE EXISTS (
    SELECT 1 FROM p b WHERE b.r = a.r AND b.start < a.stop + 200 AND b.stop > a.start - 200
    AND a.category <> b.category AND 'secret' IN (a.category, b.category))),
kept AS (SELECT * FROM strong UNION ALL SELECT * FROM linked),
o AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
             string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < {secrets.STRONG}) AS base,
             string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans FROM kept GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN o ON d.r = o.r
"""

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
_LETTER = "(VALUES ('A'), ('B'), ('C'), ('D'), ('E')) {0}({0})"
_PLACES = "abcde"
_UNEQUAL = " AND ".join(f"{x} <> {y}" for i, x in enumerate(_PLACES) for y in _PLACES[:i])

AUDIT = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS} AS ws, coalesce(doc_id > (min(doc_id) OVER (PARTITION BY t)), false) AS seen FROM d),
l AS (SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
             + 4 * (100 * (length(t) - length(translate(t, {_UPPER}, ''))) > 3 * length(t))::INT
             + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * seen::INT AS mask
      FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
s AS MATERIALIZED (
      SELECT part, subset, coalesce(sum(n) FILTER (mask & subset = 0), 0)::BIGINT AS n,
             coalesce(sum(good) FILTER (mask & subset = 0), 0)::BIGINT AS good, coalesce(sum(toxic) FILTER (mask & subset = 0), 0)::BIGINT AS toxic
      FROM c, (SELECT unnest(range(32)) AS subset) GROUP BY part, subset),
p AS (SELECT a || b || c || d || e AS filter_order FROM {", ".join(_LETTER.format(x) for x in _PLACES)} WHERE {_UNEQUAL}),
o AS (SELECT part, filter_order, step::INT AS step, 1 << (ascii(filter_order[step]) - 65) AS bit,
             list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))) AS early
      FROM p, (SELECT unnest(range(1, 6)) AS step), (SELECT DISTINCT part FROM c)),
r AS (SELECT o.part, filter_order, step, bit, x.n AS kept, y.n - x.n AS removed, z.n - f.n - (y.n - x.n) AS redundant, u.n - v.n AS unique_fails,
             y.good - x.good AS good_lost, y.toxic - x.toxic AS toxic_lost
      FROM (SELECT *, coalesce(early, 0)::BIGINT AS before FROM o) o
      JOIN s x ON x.part = o.part AND x.subset = before | bit JOIN s y ON y.part = o.part AND y.subset = before
      JOIN s z ON z.part = o.part AND z.subset = 0 JOIN s f ON f.part = o.part AND f.subset = bit
      JOIN s u ON u.part = o.part AND u.subset = 31 - bit JOIN s v ON v.part = o.part AND v.subset = 31)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""


def _assigned(turn: int) -> str:
    """Nearest entries: distances are whole numbers, and an entry's number settles ties."""
    return f"""a{turn} AS MATERIALIZED (
  SELECT r, part, any_value(x) AS x, (best % 256)::INT AS entry, best // 256 AS error FROM (
    SELECT r, part, x, min((xx + cc - 2 * list_inner_product(x, c))::BIGINT * 256 + entry) AS best
    FROM p JOIN b{turn} USING (part) GROUP BY r, part, x) GROUP BY r, part, best)"""


def _moved(turn: int) -> str:
    return f"""b{turn + 1} AS MATERIALIZED (
  SELECT part, entry, c, list_inner_product(c, c) AS cc FROM (
    SELECT b.part, b.entry, coalesce(n.c, b.c) AS c FROM b{turn} b LEFT JOIN (
      SELECT part, entry, list(m ORDER BY i) AS c FROM (
        SELECT part, entry, i, floor(sum(x) / count(*)) AS m FROM (SELECT part, entry, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM a{turn})
        GROUP BY part, entry, i) GROUP BY part, entry) n ON n.part = b.part AND n.entry = b.entry))"""


_ROUNDS = ",\n".join(f"{_assigned(k)},\n{_moved(k)}" for k in range(4))
CODES = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
p AS MATERIALIZED (SELECT r, part, x, list_inner_product(x, x) AS xx FROM (
  SELECT r, part, v[(part * len(v) // 4) + 1 : (part + 1) * len(v) // 4] AS x FROM v, (SELECT unnest(range(4)) AS part))),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c, xx AS cc FROM p WHERE r <= 256),
{_ROUNDS},
{_assigned(4)},
h AS (SELECT sha256(string_agg(x::BIGINT, ',' ORDER BY part, entry, i)) AS h FROM (SELECT part, entry, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM b4)),
o AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(error)::BIGINT AS error FROM a4 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM o JOIN v USING (r), h
"""

LINES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
e AS MATERIALIZED (SELECT r, doc_id, i, line, trim(translate(line, {_UPPER}, {_LOWER}), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
      FROM (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d)),
s AS (SELECT key AS shared FROM e WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(shared) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (shared IS NULL), '')) AS kept_sha256
FROM e LEFT JOIN s ON shared = key GROUP BY r, doc_id
"""

ORACLES = {
    "op3_quality_rules": QUALITY,
    "op4_warc": WARC,
    "op7_mixing": MIXING,
    "op8_secrets": SECRETS,
    "op11_filter_audit": AUDIT,
    "op12_vector_codes": CODES,
    "op13_line_dedup": LINES,
}
