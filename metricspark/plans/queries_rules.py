"""Queries of the rule tables: one estate of formulas per source, projected from the parts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.operators import rules
from metricspark.plans.registry import query, table

# Formulas of each estate; ~ stands for a quote, ^ for a dollar sign, « and » for braces, {t} for the part's type, {n} for its size.
FORMULAS = {
    "tableau": (
        "SUM([{t}])",
        "",
        "«FIXED [{t}] : SUM([{n}])»",
        "window_sum (SUM([{t}])) + ZN([{n}])",
        "ZN(SUM([{t}]))",
        "DATETRUNC(~month~, [{t}])",
        "IIF([{n}] > 3, COUNTD([{t}]), 0)",
        "MAKEPOINT([{t}], [{n}])",
        "SCRIPT_REAL(~x~, [{t}])",
        "ROUNDSTR([{t}])",
        "STR([{n}]) + LOOKUP(SUM([{t}]), -1)",
        "total\n([{t}])",
    ),
    "cognos": (
        "[{t}].[{n}]",
        "to_char([{t}])",
        "#prompt(~{t}~)#",
        "promptmany (~{t}~)",
        "[{t}]->[all].[{n}]",
        "CurrentMember([{t}])",
        "my_function([{t}], {n})",
        "_add_days([{t}], {n}) + PeriodsToDate([{t}])",
        "[{t}] + [{n}]",
        "",
        "unknown(tail([{t}]))",
    ),
    "powerbi": (
        "SUM('{t}'[{n}])".replace("'", "~"),
        "CALCULATE(SUM(~{t}~[{n}]), ALL(~{t}~))",
        "DIVIDE(SUM(~{t}~[{n}]), 2)",
        "TOTALYTD(SUM(~{t}~[{n}]), ~Date~[Date])",
        "NPV({n}, ~{t}~)",
        "PERCENTILE.INC(~{t}~[{n}], 0.5)",
        "PERCENTILEX.INC(~{t}~, [{n}], 0.5)",
        "ROUNDUP([{n}], 0) + irr(~{t}~)",
        "ISNUMBER([{n}])",
        "SUBSTITUTE(~{t}~, 1, 2)",
        "GROUPBY(~{t}~)",
        "LASTDATE(~{t}~[{n}])",
        "ALLOCATION + ROUND([{n}], 1)",
        "",
    ),
    "denodo": (
        "SELECT {n} FROM a",
        "SELECT ADDDAY({n}) FROM a",
        "SELECT (SELECT (SELECT (SELECT {n}))) FROM a",
        "SELECT (SELECT {n}), (SELECT ~((SELECT~) FROM f((SELECT 1), (SELECT 2))",
        "SELECT CASE WHEN 1 THEN CASE WHEN 2 THEN CASE WHEN 3 THEN {n} END END END",
        "SELECT CASE WHEN 1 THEN 1 END, CASE WHEN 2 THEN ~CASE CASE~ END, CASE WHEN 3 THEN {n} END",
        "SELECT CAST(x AS LOCALDATE)",
        "SELECT CAST(x AS VARCHAR)",
        "SELECT * FROM JSON_TABLE (x)",
        "SELECT * FROM a, LATERAL b",
        "SELECT * FROM a CONNECT   BY x",
        "SELECT custom_function({n})",
        "SCHEDULE REFRESH SELECT {n}",
    ),
    "businessobjects": (
        "SUM({t}.{n})",
        "@Aggregate_Aware(a, b)",
        "@Select({t}) + @Select({n})",
        "@Prompt(~{t}~)",
        "DECODE({t}, 1, f(2, 3), 3, 4, 5, 6)",
        "DECODE({t}, 1, f(2, 3, 4, 5, 6), 3)",
        "(SELECT {n} FROM (SELECT 1))",
        "listagg ({t})",
        "SYS_CONTEXT(~{t}~)",
        "CASE WHEN 1 THEN CASE WHEN 2 THEN CASE WHEN 3 THEN {n} END END END",
        "CASE WHEN 1 THEN 1 END CASE WHEN 2 THEN 2 END CASE WHEN 3 THEN {n} END",
        "TRUNC({t}, ~MM~)",
        "TO_CHAR({t}, ~YYYY-MM~)",
        "{t} = {n} ( + )",
        "SUBSTR({t}, 1, 2) + NVL2({n}, 1, 2)",
        "DaysBetween({t}, {n})",
    ),
}
_LOOKER_TYPES = ("sum", "running_total", "location", "tier", "percentile", "number", "string", "median", "zipper", "YESNO", "distance", "date_time")


def _choice(texts: Sequence[str], at: str) -> str:
    cases = []
    for k, text in enumerate(texts):
        parts = re.split("({[tn]})", text)
        sql = [{"{t}": "p_type", "{n}": "CAST(p_size AS VARCHAR(20))"}.get(p, f"'{p}'".replace("«", "{").replace("»", "}")) for p in parts]
        cases.append(f"WHEN {k} THEN concat({', '.join(sql)})")
    return f"replace(replace(CASE {at} {' '.join(cases)} END, '~', chr(39)), '^', chr(36))"


def _estate(source: str) -> str:
    texts = FORMULAS[source]
    extra = ", CASE p_size % 4 WHEN 0 THEN 'INTERFACE' WHEN 1 THEN 'MATERIALIZED' ELSE 'DERIVED' END AS view_type, p_partkey % 7 AS n_joins" if source == "denodo" else ""
    return f"SELECT CAST(p_partkey AS BIGINT) AS ord, {_choice(texts, f'(p_partkey * 7 + p_size) % {len(texts)}')} AS expr{extra} FROM part"


_LOOKER = (
    f"SELECT CAST(p_partkey AS BIGINT) AS ord, {_choice(('^«TABLE».{t}', '^«other.{n}»', '«% if x %»{t}', '«« {n} »»', '^«view.name»'), 'p_size % 5')} AS expr, "
    f"{_choice(_LOOKER_TYPES, f'(p_partkey * 7 + p_size) % {len(_LOOKER_TYPES)}')} AS field_type, p_partkey % 11 = 0 AS is_native_derived, p_partkey % 13 = 0 AS is_group, p_partkey % 3 = 0 AS has_filters FROM part"
)
ESTATES = {**{s: _estate(s) for s in FORMULAS}, "looker": _LOOKER}

# What DuckDB's regular expressions cannot say, by tokens.
_TOKENS = "(SELECT e.ord, t.i, t.token FROM e, LATERAL (SELECT unnest({tokens}) AS token, unnest(range(len({tokens}))) AS i) t)"
_PAREN = r"regexp_extract_all(regexp_replace(expr, '''[^'']*''', ' ', 'g'), '(?i)\(\s*SELECT\b|[()]')"
_CASES = r"regexp_extract_all(regexp_replace(expr, '''[^'']*''|\"[^\"]*\"', ' ', 'g'), '(?i)\b(?:CASE|END)\b')"
_DECODE = r"regexp_extract_all(regexp_extract(expr, '(?is)\bDECODE\s*(\(.*)', 1), '[(),]')"
SPECIAL = {
    ("denodo", "interface"): "SELECT ord FROM e WHERE view_type = 'INTERFACE'",
    ("denodo", "refreshed materialization"): r"SELECT ord FROM e WHERE view_type = 'MATERIALIZED' AND regexp_matches(expr, '(?i)\b(SCHEDULE|REFRESH)\b')",
    ("denodo", "many joins"): "SELECT ord FROM e WHERE n_joins >= 5",
    # a parenthesis closes at the next place where the level falls below its own; selects that are open at one place are nested
    ("denodo", "deep subquery"): f"SELECT DISTINCT ord FROM (WITH k AS {_TOKENS.format(tokens=_PAREN)}, l AS (SELECT *, sum(CASE WHEN token = ')' THEN -1 ELSE 1 END) OVER (PARTITION BY ord ORDER BY i) AS level FROM k), "
    "o AS (SELECT a.ord, a.i, (SELECT coalesce(min(b.i), 1000000) FROM l b WHERE b.ord = a.ord AND b.i > a.i AND b.level < a.level) AS j FROM l a WHERE length(token) > 1) "
    "SELECT x.ord, x.i FROM o x JOIN o y ON x.ord = y.ord AND y.i <= x.i AND y.j > x.i GROUP BY 1, 2 HAVING count(*) >= 3)",
    ("denodo", "deep case"): f"SELECT DISTINCT ord FROM (SELECT ord, sum(CASE WHEN upper(token) = 'CASE' THEN 1 ELSE -1 END) OVER (PARTITION BY ord ORDER BY i) AS n FROM {_TOKENS.format(tokens=_CASES)}) WHERE n >= 3",
    ("businessobjects", "long decode"): f"SELECT ord FROM (WITH k AS {_TOKENS.format(tokens=_DECODE)}, l AS (SELECT *, sum(CASE token WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER (PARTITION BY ord ORDER BY i) AS level FROM k), "
    "z AS (SELECT ord, min(i) FILTER (level = 0) AS stop FROM l GROUP BY 1) SELECT ord FROM l JOIN z USING (ord) WHERE token = ',' AND level = 1 AND i < coalesce(stop, 1000000) GROUP BY 1 HAVING count(*) >= 6)",
    ("businessobjects", "deep case"): r"SELECT ord FROM e WHERE contains(upper(array_to_string(regexp_extract_all(expr, '(?i)\b(?:CASE|END)\b'), ' ')), 'CASE CASE CASE')",
    ("looker", "native derived table"): "SELECT ord FROM e WHERE is_native_derived",
    ("looker", "dimension group"): "SELECT ord FROM e WHERE is_group",
    ("looker", "number across views"): r"SELECT ord FROM e WHERE lower(field_type) = 'number' AND regexp_matches(expr, '[$][{]\w+[.]\w+[}]')",
    ("looker", "filtered measure"): "SELECT ord FROM e WHERE has_filters",
}


def decision_sql(source: str) -> str:
    """Every rule tried on every formula; the first that holds decides."""
    t = rules.TABLES[source]
    listed, patterns, special = [], [], []
    for k, r in enumerate(t.rules):
        listed.append(f"({k}, '{r.name}', '{r.tier}')")
        if (source, r.name) in SPECIAL:
            special.append(f"SELECT ord, {k} AS k FROM ({SPECIAL[source, r.name]})")
        elif r.condition:  # a set of field types
            special.append(f"SELECT ord, {k} AS k FROM e WHERE {r.condition}")
        else:
            names = "|".join(n.replace(".", "[.]") for n in (r.calls or r.words).split())
            text = r.pattern or rf"\b({names})" + (r"\s*\(" if r.calls else r"\b")
            patterns.append("({}, '{}')".format(k, text.replace("'", "''")))
    tried = [f"SELECT e.ord, m.k FROM e, LATERAL (SELECT k FROM p WHERE regexp_matches(e.expr, pattern, 'is')) m"] if patterns else []
    return (
        f"WITH e AS ({ESTATES[source]}), r(k, rule, tier) AS (VALUES {', '.join(listed)}), p(k, pattern) AS (VALUES {', '.join(patterns)}), "
        f"h AS (SELECT ord, min(k) AS k FROM ({' UNION ALL '.join(tried + special)}) GROUP BY 1) SELECT e.ord, r.rule, coalesce(r.tier, '{t.default}') AS tier FROM e LEFT JOIN h USING (ord) LEFT JOIN r USING (k)"
    )


def estate(spark, sf: str, source: str) -> DataFrame:
    """The formulas of a source as Spark rows."""
    return spark.sql(ESTATES[source].replace("VARCHAR(20)", "STRING").replace("{", "{{").replace("}", "}}").replace("FROM part", "FROM {t}"), t=table(spark, sf, "part"))


def _register(source: str) -> None:
    @query(f"rules_{source}", decision_sql(source))
    def _(spark, sf):
        return rules.decide(estate(spark, sf, source), rules.TABLES[source]).select("ord", "rule", "tier")


for _source in rules.TABLES:
    _register(_source)


@query(
    "rules_tally",
    " UNION ALL ".join(f"SELECT '{s}' AS source, tier, coalesce(rule, '(none)') AS rule, count(*) AS n FROM ({decision_sql(s)}) GROUP BY ALL" for s in rules.TABLES),
)
def _(spark, sf):
    """Definitions per source, tier and deciding rule."""
    out = None
    for source, t in rules.TABLES.items():
        one = rules.decide(estate(spark, sf, source), t).groupBy("tier", F.coalesce("rule", F.lit("(none)")).alias("rule")).agg(F.count("*").alias("n")).withColumn("source", F.lit(source))
        out = one if out is None else out.unionByName(one)
    return out
