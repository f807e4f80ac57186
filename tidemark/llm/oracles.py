"""The same results as DuckDB SQL, where SQL can express the method."""
from __future__ import annotations

from . import filter_audit, line_dedup, mixing, pii, quality_rules, source_audit

ORACLES: dict[str, str] = {}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_rolled = " + ".join(
    ["h"] + [f"coalesce(lag(h, {k}) OVER w, 0) * {pow(line_dedup.BASE, k, line_dedup.PRIME)}" for k in range(1, line_dedup.WINDOW)]
)


def line_dedup_sql(table: str = "documents") -> str:
    return rf"""
WITH docs AS (SELECT doc_id, text FROM {table}),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
          FROM docs WHERE text <> ''),
full_lines AS (SELECT *, lead(i) OVER f AS j, lead(words) OVER f AS next_words
               FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM lines) WHERE words > 0 WINDOW f AS (PARTITION BY doc_id ORDER BY i)),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM lines),
cuts AS (SELECT *, (({_rolled}) % {line_dedup.PRIME}) % {line_dedup.DIVISOR} = 0 AS cut FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM cuts),
units AS (
  SELECT doc_id, min(i) AS first, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS unit FROM numbered GROUP BY doc_id, c HAVING count(*) >= {line_dedup.MIN_LINES}
  UNION
  SELECT doc_id, i, 1, line FROM full_lines WHERE words >= {line_dedup.LONG_WORDS}
  UNION
  SELECT p.doc_id, p.i, count(*), string_agg(l.line, chr(10) ORDER BY l.i)
  FROM full_lines p JOIN lines l ON l.doc_id = p.doc_id AND l.i BETWEEN p.i AND p.j
  WHERE least(p.words, p.next_words) < {line_dedup.LONG_WORDS} AND p.j IS NOT NULL GROUP BY p.doc_id, p.i),
later AS (SELECT * FROM (SELECT *, row_number() OVER u AS r, first_value(doc_id) OVER u AS owner, first_value(first) OVER u AS owner_first
                         FROM units WINDOW u AS (PARTITION BY unit ORDER BY doc_id, first)) WHERE r > 1),
dropped AS (SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = owner THEN greatest(first, owner_first + n) ELSE first END, first + n)) AS i FROM later),
kept AS (SELECT l.doc_id, count(*) AS n_lines, count(d.i) AS n_dropped, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (d.i IS NULL), '') AS text
         FROM lines l LEFT JOIN dropped d ON l.doc_id = d.doc_id AND l.i = d.i GROUP BY l.doc_id)
SELECT docs.doc_id, CASE WHEN docs.text IS NULL OR docs.text = '' THEN docs.text ELSE kept.text END AS text,
  CASE WHEN docs.text IS NULL THEN 0 WHEN docs.text = '' THEN 1 ELSE n_lines END AS n_lines, coalesce(n_dropped, 0) AS n_dropped
FROM docs LEFT JOIN kept ON docs.doc_id = kept.doc_id"""


ORACLES["op3_line_dedup"] = line_dedup_sql()


def mixing_sql(table: str = "documents") -> str:
    """The same water level and thresholds, by sorting where the operator only counts."""
    return rf"""
WITH d AS (SELECT *, len({WORDS})::BIGINT AS size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || chr(1) || coalesce(text, '')), 1, {mixing.BITS // 4}))::BIGINT AS place FROM {table}),
s AS (SELECT source, sum(size)::HUGEINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, source_size * 3 AS cap FROM s),
o AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(w) OVER (q ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest, row_number() OVER q AS r
      FROM w WINDOW q AS (ORDER BY cap * 6 // w, source NULLS LAST)),
f AS (SELECT *, cap * w_rest <= rest * w AS capped FROM o),
l AS (SELECT rest AS level, w_rest AS w_level FROM f WHERE NOT capped ORDER BY r LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE (level * w)::DOUBLE / w_level::DOUBLE END AS target FROM f LEFT JOIN l ON true),
u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS times FROM t),
b AS (SELECT *, target - times * source_size AS budget FROM u),
p AS (SELECT source, place, sum(size) AS n FROM d GROUP BY source, place),
c AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY place) - n AS before FROM p)
SELECT d.doc_id, d.size, b.source_size::BIGINT AS source_size, b.target,
  CASE WHEN d.size = 0 THEN 0 ELSE b.times + (2 * c.before + c.n <= 2 * b.budget)::BIGINT END AS copies,
  CASE WHEN d.size = 0 THEN 0 ELSE d.size * (b.times + (2 * c.before + c.n <= 2 * b.budget)::BIGINT) END AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.place = c.place"""


ORACLES["op5_source_mixing"] = mixing_sql()


def quality_sql(table: str = "documents") -> str:
    ladders = ", ".join(f"('{r}', {j}, {c})" for r, steps in quality_rules.LADDERS.items() for j, c in enumerate(steps))
    p = quality_rules.TOTAL_LIMIT / len(quality_rules.LADDERS)
    rules = ", ".join(f"('{r}', {r})" for r in quality_rules.LADDERS)
    return rf"""
WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS text, {WORDS} AS words,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM {table}),
win AS (SELECT doc_id, i, [words[i], words[i + 1], words[i + 2]] AS three FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
often AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, three) AS n FROM win) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM often) GROUP BY doc_id),
base AS (SELECT w.doc_id, lang, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
  FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS symbol_rate, CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_rate,
    CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_rate, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS long_word_mean FROM base),
r AS (SELECT doc_id, lang, unnest([{", ".join(f"struct_pack(rule := '{x}', value := {x})" for x in quality_rules.LADDERS)}], recursive := true) FROM v),
lab AS (SELECT doc_id, min(quality) AS label FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = max(quality)),
good AS (SELECT v.*, label FROM v JOIN lab ON v.doc_id = lab.doc_id WHERE NOT base_failed),
steps(rule, j, cutoff) AS (VALUES {ladders}),
n AS (SELECT lang, sum(label) AS good, sum(1 - label) AS bad, (SELECT count(*) FROM (SELECT DISTINCT lang FROM good)) AS strata FROM good GROUP BY lang),
hits AS (SELECT good.lang, s.rule, s.j, s.cutoff, sum(CASE WHEN value > cutoff THEN label ELSE 0 END) AS g, sum(CASE WHEN value > cutoff THEN 1 - label ELSE 0 END) AS b
  FROM good JOIN r ON good.doc_id = r.doc_id JOIN steps s ON r.rule = s.rule GROUP BY ALL),
chance AS (SELECT h.*, n.good, n.bad, n.strata, CASE WHEN g > n.good * {p} THEN 1.0 ELSE
    (SELECT sum(exp(lgamma(n.good + 1) - lgamma(k + 1) - lgamma(n.good - k + 1) + k * ln({p}) + (n.good - k) * ln(1 - {p}))) FROM range(0, (h.g + 1)::BIGINT) t(k)) END AS p
  FROM hits h JOIN n ON h.lang IS NOT DISTINCT FROM n.lang),
best AS (SELECT lang, rule, max_by(cutoff, j) AS cutoff FROM chance
  WHERE p <= {quality_rules.RISK} / (strata * {len(quality_rules.LADDERS)}) AND b > 0 AND b * good > {quality_rules.LIFT} * g * bad GROUP BY lang, rule),
rejected AS (SELECT DISTINCT r.doc_id FROM r JOIN best ON r.rule = best.rule AND r.lang IS NOT DISTINCT FROM best.lang WHERE r.value > best.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept FROM v"""


ORACLES["op6_quality_rules"] = quality_sql()


def filter_audit_sql(table: str = "documents") -> str:
    """Counts every step of every order by itself, and sums the shares over the orders."""
    letters = ", ".join(f"('{x}', {1 << i})" for i, x in enumerate(filter_audit.FILTERS))
    names = [f"l{i}" for i in range(len(filter_audit.FILTERS))]
    distinct = " AND ".join(f"{a}.x <> {b}.x" for i, a in enumerate(names) for b in names[:i])
    order = " || ".join(f"{n}.x" for n in names)
    steps = " UNION ALL ".join(
        f"SELECT filter_order, {i + 1} AS step, {n} AS bit, {' + '.join(names[:i]) or '0'} AS before FROM orders" for i, n in enumerate(names)
    )
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part, {WORDS} AS words FROM {table}),
f AS (SELECT doc_id, part, (len(words) < {filter_audit.MIN_WORDS})::INT + 2 * (100 * len(list_distinct(words)) < {filter_audit.MIN_DISTINCT_PCT} * len(words))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {filter_audit.MAX_CAPITALS_PCT} * length(text))::INT + 8 * regexp_matches(text, '{filter_audit.SYMBOLS}')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask FROM d),
lab AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
t AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
      FROM f LEFT JOIN lab ON f.doc_id = lab.doc_id GROUP BY part, mask),
letters(x, b) AS (VALUES {letters}),
orders AS (SELECT {order} AS filter_order, {", ".join(f"{n}.b AS {n}" for n in names)} FROM {", ".join(f"letters {n}" for n in names)} WHERE {distinct}),
steps AS ({steps}),
r AS (SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (mask & (before + bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS removed, coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails, coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS toxic_lost
  FROM t CROSS JOIN steps GROUP BY ALL)
SELECT * EXCLUDE (bit), sum(removed) OVER (PARTITION BY part, bit) AS shapley FROM r"""


ORACLES["op11_filter_audit"] = filter_audit_sql()


def source_audit_sql(table: str = "documents") -> str:
    """Dense: every term of a language for every source, every pair over all terms."""
    share = f"1 + {source_audit.SCALE} * (c + {source_audit.SMOOTH})::HUGEINT // (n + {source_audit.SMOOTH} * v)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM {table}),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS c FROM w GROUP BY ALL HAVING count(DISTINCT id) >= {source_audit.MIN_DOCS}),
l AS (SELECT lang, sum(c) AS n, count(*) AS v FROM k GROUP BY lang),
q AS (SELECT k.lang, term, {share} AS q FROM k JOIN l ON k.lang = l.lang),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT w.lang, source, term, count(*) AS c FROM w SEMI JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
s AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN o ON g.lang = o.lang AND g.source = o.source GROUP BY ALL),
p AS (SELECT s.lang, s.source, q.term, q.q, coalesce(o.c, 0) AS c, s.n, l.v FROM s JOIN l ON s.lang = l.lang JOIN q ON q.lang = s.lang
      LEFT JOIN o ON o.lang = s.lang AND o.source = s.source AND o.term = q.term),
x AS (SELECT lang, source, term, q, c, {share} AS p FROM p),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM x a JOIN x b ON a.lang = b.lang AND a.term = b.term WHERE a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
terms AS (SELECT lang, source, term AS item, p - q AS value FROM x WHERE c > 0 AND p > q),
both_parts AS (SELECT *, 'pair' AS part FROM every UNION ALL SELECT *, 'term' FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts
QUALIFY part = 'pair' OR rank <= {source_audit.TOP}"""


ORACLES["op13_source_audit"] = source_audit_sql()


def private_terms_sql(table: str = "documents") -> str:
    """Places by windows over the pieces of every text, and the same counts."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = " UNION ALL ".join(
        f"SELECT id, {i} AS kind, regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS gaps FROM d" for i, p in enumerate(plain.values())
    )
    w, letters, some = pii.WINDOW, pii.LETTERS, pii.LETTERS + "{3,}"
    names = "[" + ", ".join(f"'{k}'" for k in pii.KINDS) + "]"
    classed = f"CASE WHEN length(term) > {pii.CLASS_LETTERS + 1} THEN left(term, {pii.CLASS_LETTERS}) || '*' END"
    listed = f"string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM {table}),
k AS ({found}),
e AS (SELECT id, kind, i, m[i] AS value, gaps[i] AS before, gaps[i + 1] AS after FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM k)),
p AS (SELECT *, sum(length(before) + length(value)) OVER (PARTITION BY id, kind ORDER BY i) AS stop, regexp_replace(value, '[^0-9]', '', 'g') AS digits FROM e),
base AS (SELECT id, kind, (stop - length(value))::INT AS start, stop::INT AS stop, value, before, after, kind || ':' || CASE WHEN kind >= 2 THEN digits ELSE value END AS entity FROM p
  WHERE CASE kind WHEN 1 THEN len(list_filter(string_split(value, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(ltrim(x, '0') AS INT), 0) > 255)) = 0
    WHEN 2 THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1),
      lambda j: CASE WHEN j % 2 = 1 THEN reverse(digits)[j]::INT WHEN reverse(digits)[j]::INT > 4 THEN 2 * reverse(digits)[j]::INT - 9 ELSE 2 * reverse(digits)[j]::INT END)) % 10 = 0
    WHEN 3 THEN length(digits) BETWEEN 9 AND 15 ELSE true END),
beside AS (SELECT DISTINCT id, entity, unnest(regexp_extract_all(
    CASE WHEN length(before) > {w} THEN regexp_replace(right(before, {w}), '^{letters}+', '') ELSE before END || ' ' ||
    CASE WHEN length(after) > {w} THEN regexp_replace(left(after, {w}), '{letters}+$', '') ELSE after END, '{some}')) AS term FROM base),
pairs AS (SELECT entity, term, count(DISTINCT id) AS n_ct FROM (SELECT * FROM beside UNION ALL SELECT id, entity, {classed} FROM beside) WHERE term IS NOT NULL GROUP BY ALL HAVING n_ct >= {pii.SUPPORT}),
entities AS (SELECT entity, count(DISTINCT id) AS n_c FROM base GROUP BY entity),
t AS (SELECT id, i, ms[i] AS term, gaps[i] AS gap FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM
  (SELECT id, regexp_extract_all(text, '{some}') AS ms, string_split_regex(text, '{some}') AS gaps FROM d))),
counts AS (SELECT term, count(DISTINCT id) AS n_t FROM (SELECT id, term FROM t UNION ALL SELECT id, {classed} FROM t) GROUP BY term),
flagged AS (SELECT DISTINCT pairs.term FROM pairs JOIN entities ON pairs.entity = entities.entity JOIN counts ON pairs.term = counts.term
  WHERE 2 * n_ct >= n_t AND n_ct * (SELECT count(*) FROM d) >= {1 << pii.BITS} * n_c * n_t AND n_ct::HUGEINT * n_ct * (SELECT count(*) FROM d) >= n_c::HUGEINT * n_t * n_t),
kinds AS (SELECT term, CASE WHEN {classed} IS NULL OR {classed} IN (SELECT term FROM flagged) THEN 5 ELSE 4 END AS kind FROM flagged WHERE NOT ends_with(term, '*')),
places AS (SELECT id, term, (sum(length(gap) + length(term)) OVER (PARTITION BY id ORDER BY i))::INT AS stop FROM t),
more AS (SELECT id, kind, stop - length(places.term) AS start, stop FROM places JOIN kinds ON places.term = kinds.term),
apart AS (SELECT * FROM more WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.id = more.id AND more.start < b.stop AND b.start < more.stop)),
spans AS (SELECT id, kind, start, stop FROM base UNION ALL SELECT id, kind, start, stop FROM apart),
b AS (SELECT id, {listed} AS base, {", ".join(f"count(*) FILTER (kind = {i}) AS n_{k}" for i, k in enumerate(plain))} FROM base GROUP BY id),
a AS (SELECT id, {listed} AS spans FROM spans GROUP BY id)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in plain)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN b ON d.id = b.id LEFT JOIN a ON d.id = a.id"""


ORACLES["op12_private_terms"] = private_terms_sql()
