"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from metricspark.llm import filter_audit, license_scan, phrases, quality
from metricspark.llm.license_texts import NOTICES

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUP = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 75 * (nx.c + ny.c - i)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT DISTINCT x AS v, x AS m FROM e UNION SELECT e.y, r.m FROM r JOIN e ON r.v = e.x),
c AS (SELECT v, min(m) AS m FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.c, 0) AS n_shingles, coalesce(c.m, d.doc_id) AS component_id, coalesce(c.m, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.v = d.doc_id
"""


def quality_sql(version: int = 2) -> str:
    """Measurements, failure bits and the verdict of a policy."""
    bits = " + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in quality.RULES)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
x AS (SELECT doc_id, CAST(unnest(range(1, len(w) - 1)) AS BIGINT) AS i, w FROM d WHERE len(w) >= 3),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM x),
h AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE c >= 2) GROUP BY 1),
y AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
z AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM y WHERE regexp_matches(line, '{_WORD}') GROUP BY 1),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
        coalesce(h.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines FROM d LEFT JOIN h USING (doc_id) LEFT JOIN z USING (doc_id)),
b AS (SELECT *, CAST({bits} AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & {quality.BASE}) <> 0 AS base_failed,
  (fail_bits & {quality.POLICIES[version]}) = 0 AS kept, fail_bits FROM b
"""


def ablations_sql(version: int = 2) -> str:
    """Counts of documents by what each enforced rule does to them."""
    mask = quality.POLICIES[version]
    rules = ", ".join(f"('{r.name}', {1 << r.bit})" for r in quality.RULES if mask >> r.bit & 1)
    return f"""
WITH q AS ({quality_sql(version)}), r(rule, bit) AS (VALUES {rules})
SELECT rule, count(*) FILTER (WHERE (fail_bits & bit) <> 0) AS n_failed, count(*) FILTER (WHERE (fail_bits & {mask}) = bit) AS n_only,
  count(*) FILTER (WHERE (fail_bits & ({mask} - bit)) = 0) AS n_kept_without FROM q, r GROUP BY rule
"""


def license_sql() -> str:
    """Phrase places, and template containment of every block by brute force."""
    places = " UNION ALL ".join(
        f"SELECT doc_id, i, '{label}' AS label FROM x WHERE " + " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(phrase.split()))
        for phrase, label in license_scan.PHRASES.items()
    )
    templates = ", ".join(
        f"('{t.label}', [{', '.join(repr(w) for w in t.words)}], {t.stride}, {t.window})" for t in license_scan.templates_of(NOTICES)
    )
    word, percent = license_scan.WORD, license_scan.PERCENT
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{word}') AS w FROM documents),
x AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
p AS ({places}),
b AS (SELECT doc_id, count(*) AS n, min(i) - 1 AS lo, max(i) - 1 AS hi FROM p GROUP BY 1),
t(label, tokens, stride, span) AS (VALUES {templates}),
k AS (SELECT doc_id, label, tokens, w[q + 1:q + span] AS block FROM (SELECT doc_id, w, label, tokens, span, unnest(range(0, greatest(len(w), 1), stride)) AS q FROM d, t)),
f AS (SELECT doc_id, label, len(list_intersect(tokens, block)) AS c, len(tokens) AS size FROM k WHERE list_has_any(tokens, block)),
a AS (SELECT doc_id, label, max(c / size) AS best FROM f WHERE 100 * c >= {percent} * size GROUP BY 1, 2),
l AS (SELECT doc_id, label FROM p UNION SELECT doc_id, label FROM a),
s AS (SELECT doc_id, max(best) AS best FROM a GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(b.n, 0) AS n_base, b.lo AS first_word, b.hi AS last_word,
  coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM p WHERE p.doc_id = d.doc_id), '') AS base_labels,
  coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM l WHERE l.doc_id = d.doc_id), '') AS labels,
  greatest(coalesce(s.best, 0.0), CASE WHEN b.n > 0 THEN 1.0 ELSE 0.0 END) AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN s USING (doc_id)
"""


def phrases_sql() -> str:
    """All phrases counted one by one, cut and compared by the stated rules."""
    grams = " UNION ALL ".join(
        f"SELECT lang, {n} AS size, array_to_string(w[i:i + {n - 1}], ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {n} + 2)) AS i FROM p WHERE len(w) >= {n})"
        for n in range(1, phrases.LONGEST + 1)
    )
    return f"""
WITH s AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM s),
g AS ({grams}),
f AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM g GROUP BY 1, 2, 3 HAVING count(*) >= {phrases.LEAST}),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY 1),
k AS (SELECT lang, phrase, w, size, f AS a, unnest(range(1, size)) AS k FROM f WHERE size > 1),
c AS (SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * k.a // (x.f + y.f) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1:k.k], ' ') JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k.k + 1:], ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS first FROM c),
d AS (SELECT * FROM b WHERE first = 1 AND NOT EXISTS (SELECT 1 FROM f WHERE f.lang = b.lang AND f.size > len(string_split(b.phrase, ' '))
  AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ') AND CAST(100 AS HUGEINT) * f.f >= CAST({phrases.COVERED} AS HUGEINT) * b.a)),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM d)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN t ON t.lang = o.lang WHERE rank <= {phrases.BEST}
"""


def audit_sql() -> str:
    """Every document walked through every order of the filters."""
    steps = ", ".join(f"('{order}', {step}, '{f}', {before})" for order, step, f, before in filter_audit.steps_of(filter_audit.FILTERS))
    fails = " + ".join(f"CASE WHEN {f.lower()} THEN {1 << k} ELSE 0 END" for k, f in enumerate(filter_audit.FILTERS))
    symbols = filter_audit.SYMBOLS.decode()
    return f"""
WITH x AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
y AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM x),
z AS (SELECT doc_id, part, len(w) < {filter_audit.LEAST_WORDS} AS a, 100 * len(list_distinct(w)) < {filter_audit.LEAST_DISTINCT} * len(w) AS b,
  100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {filter_audit.MOST_CAPITALS} * length(t) AS c, regexp_matches(t, '[{symbols}]') AS d, doc_id > least AS e FROM y),
q AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, {fails} AS bits, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM z LEFT JOIN q USING (doc_id)),
s(filter_order, step, filter, before) AS (VALUES {steps}),
u AS (SELECT *, 1 << (ascii(filter) - 65) AS bit FROM s),
v AS (SELECT part, filter_order, step, filter, count(*) FILTER (WHERE bits & (before | bit) = 0) AS kept,
    count(*) FILTER (WHERE bits & bit <> 0 AND bits & before = 0) AS removed, count(*) FILTER (WHERE bits & bit <> 0 AND bits & before <> 0) AS redundant,
    count(*) FILTER (WHERE bits = bit) AS unique_fails, count(*) FILTER (WHERE bits & bit <> 0 AND bits & before = 0 AND good = 1) AS good_lost,
    count(*) FILTER (WHERE bits & bit <> 0 AND bits & before = 0 AND toxic = 1) AS toxic_lost FROM m, u GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM v
"""
