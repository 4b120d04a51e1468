"""Oracle SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP3 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS o
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3)::DOUBLE AS w
  FROM d GROUP BY source),
c AS (
  SELECT *, (3 * source_size)::DOUBLE AS cap, row_number() OVER (ORDER BY (3 * source_size)::DOUBLE / w, source ASC NULLS LAST) AS pos FROM s),
x AS (
  SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS x FROM c),
v AS (SELECT *, (SELECT arg_min(y.x, y.pos) FROM x AS y WHERE y.w * y.x <= y.cap) AS level FROM x),
t AS (
  SELECT source, source_size, CASE WHEN w * level > cap THEN cap ELSE w * level END AS target FROM v),
g AS (SELECT *, least(floor(target + 0.5)::BIGINT, 3 * source_size) AS goal FROM t),
p AS (
  SELECT doc_id, source, size,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY o, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a
  FROM d)
SELECT p.doc_id, p.size, g.source_size, g.target,
       (greatest(0, least(p.a + p.size, g.goal) - p.a)
        + greatest(0, least(g.source_size + p.a + p.size, g.goal) - (g.source_size + p.a))
        + greatest(0, least(2 * g.source_size + p.a + p.size, g.goal) - (2 * g.source_size + p.a)))::BIGINT AS taken
FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source
"""


_UNITS = r"list_distinct(list_filter(list_transform([{0}] || regexp_split_to_array({0}, '\n\s*\n') || string_split({0}, chr(10)), lambda p: trim(regexp_replace(lower(p), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))), lambda u: len(string_split(u, ' ')) >= 3))"
OP1 = rf"""
WITH RECURSIVE o AS (SELECT conv_id, turn, min(text) AS x FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
m AS (
  SELECT row_number() OVER () AS id, c.conv_id, c.turn, c.role, coalesce(c.text, '') AS own, a.x AS q1, CASE WHEN a.x IS NOT NULL THEN b.x END AS q2
  FROM conversations c LEFT JOIN o AS a ON a.conv_id = c.conv_id AND a.turn = c.turn - 1 LEFT JOIN o AS b ON b.conv_id = c.conv_id AND b.turn = c.turn - 2),
said AS (SELECT DISTINCT conv_id, turn, unnest({_UNITS.format('own')}) AS u FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
near AS (SELECT conv_id, u, min(turn) AS turn FROM said GROUP BY ALL),
wide AS (SELECT u, min(row(conv_id, turn)) AS m FROM near GROUP BY u),
asked AS (
  SELECT DISTINCT conv_id, turn, 1 AS v, unnest({_UNITS.format("coalesce(q1, '')")}) AS u FROM m
  UNION SELECT DISTINCT conv_id, turn, 2, unnest({_UNITS.format("coalesce(q2, '')")}) FROM m),
inside AS (SELECT a.*, CASE WHEN n.turn < a.turn THEN n.turn END AS t FROM asked a LEFT JOIN near n ON n.conv_id = a.conv_id AND n.u = a.u),
votes AS (
  SELECT conv_id, turn, v, 1 AS near, length(u) AS n, conv_id AS c, t FROM inside WHERE t IS NOT NULL
  UNION ALL SELECT i.conv_id, i.turn, v, 0, length(i.u), w.m[1], w.m[2] FROM inside i JOIN wide w ON w.u = i.u WHERE t IS NULL AND w.m < row(i.conv_id, i.turn) AND w.m[1] <> i.conv_id),
summed AS (SELECT conv_id, turn, v, near, c, t, sum(n) AS n FROM votes GROUP BY ALL),
levels AS (SELECT conv_id, turn, v, max(row(near, n, c, t)) AS b FROM summed GROUP BY ALL),
parents AS (SELECT conv_id, turn, string_agg(v || ':' || b[3] || ':' || b[4], ',' ORDER BY v) AS quoted, arg_min(b[3], v) AS pc, arg_min(b[4], v) AS pt FROM levels GROUP BY ALL),
up AS (
  SELECT conv_id, turn, pc AS rc, pt AS rt, 1 AS depth FROM parents
  UNION ALL SELECT u.conv_id, u.turn, p.pc, p.pt, u.depth + 1 FROM up u JOIN parents p ON p.conv_id = u.rc AND p.turn = u.rt),
roots AS (SELECT conv_id, turn, arg_max(rc, depth) AS rc, arg_max(rt, depth) AS rt, max(depth) AS depth FROM up GROUP BY ALL)
SELECT m.conv_id, m.turn, m.role,
  regexp_replace(regexp_replace(array_to_string(list_transform(string_split(own, chr(10)), lambda l: regexp_replace(regexp_replace(l, '^ ', ''), '\s+$', '')), chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS content,
  ((q1 IS NOT NULL)::INTEGER + (q2 IS NOT NULL)::INTEGER) AS n_quotes, coalesce(p.quoted, '') AS quoted, p.pc AS reply_conv, p.pt AS reply_turn,
  coalesce(r.rc, m.conv_id) AS root_conv, coalesce(r.rt, m.turn) AS root_turn, coalesce(r.depth, 0)::BIGINT AS depth,
  CASE WHEN m.conv_id IS NULL OR m.turn IS NULL THEN 1 ELSE rank() OVER (PARTITION BY coalesce(r.rc, m.conv_id), coalesce(r.rt, m.turn), m.conv_id IS NULL OR m.turn IS NULL ORDER BY m.conv_id, m.turn) END AS place
FROM m LEFT JOIN parents p ON p.conv_id = m.conv_id AND p.turn = m.turn LEFT JOIN roots r ON r.conv_id = m.conv_id AND r.turn = m.turn
"""


OP5 = r"""
WITH c AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_hours((page_id % 17520)::INTEGER) AS fetched,
         regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path
  FROM pages),
h AS (SELECT host, min(page_id) AS h FROM c WHERE host <> '' GROUP BY host),
e AS (
  SELECT 'host' AS kind, host AS value, 'block' AS action, TIMESTAMP '2024-01-01' + to_days((h * 37 % 365)::INTEGER) AS since FROM h WHERE h % 2 = 0
  UNION ALL SELECT 'host', host, 'remove', TIMESTAMP '2024-01-01' + to_days((h * 37 % 365 + 90)::INTEGER) FROM h WHERE h % 6 = 0
  UNION ALL SELECT 'host', host, 'block', TIMESTAMP '2024-01-01' + to_days((h * 37 % 365 + 200)::INTEGER) FROM h WHERE h % 12 = 0
  UNION ALL SELECT 'prefix', host || '/fr', 'allow', TIMESTAMP '2024-05-30' FROM h WHERE h % 5 = 0
  UNION ALL SELECT 'domain', 'cheap-pills.example.com', 'block', TIMESTAMP '2023-06-01'
  UNION ALL SELECT 'domain', 'example.net', 'block', TIMESTAMP '2025-06-01'),
m AS (
  SELECT c.page_id, c.url, c.fetched, e.kind, e.value, e.action, e.since,
         row_number() OVER (PARTITION BY c.page_id, e.kind, e.value ORDER BY e.since DESC) AS latest
  FROM c JOIN e ON e.since <= c.fetched AND CASE e.kind
    WHEN 'host' THEN c.host = e.value
    WHEN 'domain' THEN c.host = e.value OR ends_with(c.host, '.' || e.value)
    ELSE c.host || regexp_replace(c.path, '/+', '/', 'g') = e.value OR starts_with(c.host || regexp_replace(c.path, '/+', '/', 'g'), e.value || '/') END),
a AS (
  SELECT *, count(*) OVER (PARTITION BY page_id) AS n_active,
         row_number() OVER (PARTITION BY page_id ORDER BY CASE kind WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END DESC, length(value) DESC, action DESC, value DESC) AS best
  FROM m WHERE latest = 1 AND action <> 'remove')
SELECT c.page_id, c.url, c.fetched, coalesce(a.action = 'block', false) AS blocked, a.kind AS rule_kind, a.value AS rule_value, a.since AS rule_since, coalesce(a.n_active, 0)::BIGINT AS n_active
FROM c LEFT JOIN a ON a.page_id = c.page_id AND a.best = 1
"""


OP10 = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(h, (5 * (i // 4) + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) % 32 + 1, 1)), '') AS digest,
    min(page_id) OVER (PARTITION BY h) AS first
  FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to, true AS intact
FROM d
"""


OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
p AS MATERIALIZED (SELECT lang, regexp_extract_all(unnest(ps), '[^\x20\x09]+') AS w FROM d),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, m, phrase, count(*) AS a FROM (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (SELECT unnest(range(1, 5)) AS m) WHERE len(w) >= m))
  GROUP BY lang, m, phrase HAVING count(*) >= 30),
c AS (SELECT lang, phrase, m, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
s AS (SELECT k.lang, k.phrase, k.m, k.a, k.k, l.a AS l, r.a AS r, (2000000::HUGEINT * k.a // (l.a + r.a))::BIGINT AS score
  FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[1:k.k], ' ') JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[k.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, array_to_string(w[i:i + z - 1], ' ') AS phrase, max(a) AS over FROM (SELECT lang, a, w, m, z, unnest(range(1, m - z + 2)) AS i FROM c, (SELECT unnest(range(2, 4)) AS z) WHERE z < m) GROUP BY 1, 2),
left_over AS (SELECT b.* FROM b LEFT JOIN inner_parts i USING (lang, phrase) WHERE i.over IS NULL OR 100::HUGEINT * i.over < 80::HUGEINT * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM left_over JOIN n USING (lang) QUALIFY rank <= 2000
"""


def _op9(floors: tuple[float, ...] = (0.15, 0.6, 0.75, 1.0), steps: int = 3) -> str:
    """The estimate unrolled: a common table per histogram, bound and set of moments."""
    dims = range(4)
    pairs = [(i, j) for i in dims for j in range(i + 1)]
    columns = ", ".join(f"q{i}" for i in dims)

    def distance(a: str) -> str:
        """Tables of the forward substitution over rows joined to the estimate ``a``."""
        y = [f"(q{i} / 10000.0 - m{i}" + "".join(f" - l{i}{j} * y{j}" for j in range(i)) + f") / l{i}{i} AS y{i}" for i in dims]
        out = f"SELECT r.*, {', '.join(f'e.m{i}' for i in dims)}, {', '.join(f'e.l{i}{j}' for i, j in pairs)} FROM grouped r LEFT JOIN {a} e USING (g)"
        for x in y:
            out = f"SELECT *, {x} FROM ({out})"
        return f"SELECT *, 0.0 + y0 * y0 + y1 * y1 + y2 * y2 + y3 * y3 AS d FROM ({out})"

    sql = [
        r"""t AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, chr(2)) AS lang, coalesce(lang, chr(2)) || chr(1) || coalesce(source, chr(2)) AS own, coalesce(text, '') AS x FROM documents)""",
        r"""w AS MATERIALIZED (SELECT *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM t)""",
        """gr AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS gram FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5))""",
        """rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM gr) WHERE c > 1) GROUP BY rid)""",
        r"""st AS MATERIALIZED (SELECT w.rid, doc_id, lang, own, len(ws)::BIGINT AS n_words, length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars, (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  len(ls) AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN rep USING (rid))""",
        """q AS (SELECT *, floor(ln(1 + word_chars / greatest(n_words, 1)::DOUBLE) * 10000 + 0.5)::BIGINT AS q0, floor(ln(1 + 100 * n_symbols / greatest(n_words, 1)::DOUBLE) * 10000 + 0.5)::BIGINT AS q1,
  floor(ln(1 + 100 * n_dup_lines / greatest(n_lines, 1)::DOUBLE) * 10000 + 0.5)::BIGINT AS q2, floor(ln(1 + 100 * n_repeat_words / greatest(n_words, 1)::DOUBLE) * 10000 + 0.5)::BIGINT AS q3,
  CASE WHEN count(*) OVER (PARTITION BY own) < 40 THEN lang || chr(1) || chr(3) ELSE own END AS g0 FROM st)""",
        """grouped AS MATERIALIZED (SELECT *, CASE WHEN count(*) OVER (PARTITION BY g0) >= 40 THEN g0 END AS g FROM q)""",
    ]
    middle = ", ".join(f"list_sort(list(floor(q{i} / 10) * 10))[ceil(count(*) / 2)::BIGINT] / 10000.0 AS m{i}" for i in dims)
    roots = ", ".join(f"{floors[i] if i == j else 0.0}::DOUBLE AS l{i}{j}" for i, j in pairs)
    sql.append(f"e0 AS MATERIALIZED (SELECT g, {middle}, {roots} FROM grouped WHERE g IS NOT NULL GROUP BY g)")
    for k in range(steps):
        sql.append(f"n{k} AS MATERIALIZED (SELECT g, {columns}, floor(ln(1 + d) * 64) AS bin FROM ({distance(f'e{k}')}) WHERE g IS NOT NULL)")
        sql.append(f"b{k} AS (SELECT g, list_sort(list(bin))[ceil(count(*) * 0.75)::BIGINT] AS most FROM n{k} GROUP BY g)")
        means = ", ".join(f"sum(q{i})::DOUBLE / count(*) / 10000 AS m{i}" for i in dims)
        squares = ", ".join(f"sum(q{i} * q{j})::DOUBLE / count(*) / 10000 / 10000 AS e{i}{j}" for i, j in pairs)
        inner = f"SELECT g, {means}, {squares} FROM n{k} JOIN b{k} USING (g) WHERE bin <= most GROUP BY g"
        inner = f"SELECT g, {', '.join(f'm{i}' for i in dims)}, {', '.join(f'1.486::DOUBLE * (e{i}{j} - m{i} * m{j}) + {floors[i] ** 2 if i == j else 0.0!r}::DOUBLE AS v{i}{j}' for i, j in pairs)} FROM ({inner})"
        for i, j in pairs:
            less = f"v{i}{j}" + "".join(f" - l{i}{n} * l{j}{n}" for n in range(j))
            inner = f"SELECT *, {f'sqrt({less})' if i == j else f'({less}) / l{j}{j}'} AS l{i}{j} FROM ({inner})"
        sql.append(f"e{k + 1} AS MATERIALIZED ({inner})")
    failed = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"
    last = f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed, NOT {failed} AND NOT coalesce(d > 28.47, false) AS kept FROM ({distance(f'e{steps}')})"
    return "WITH " + ",\n".join(sql) + "\n" + last


def oracle_sql() -> dict[str, str]:
    return {"op1_quotation_linking": OP1, "op3_mixing_to_target_weights": OP3, "op5_temporal_url_lists": OP5, "op9_quality_rules": _op9(), "op10_warc_index_first": OP10, "op11_phrase_collocations": OP11}
