"""First-match rule tables: which tier of work a definition needs, and the rule that says so.

A table is data: rules in order of priority, each a set of function names, of
words, a pattern or a condition over columns.  The names of all rules are found in
one pass over the text and looked up for their rule, patterns join one alternation
that most texts fail at once, and the rule of smallest priority decides, wherever
in the text it matches.  All of it is one column expression without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIMPLE, TRANSLATE, MANUAL = "simple", "needs_translation", "manual_required"


@dataclass(frozen=True)
class Rule:
    """``calls`` are names before a parenthesis, ``words`` names anywhere, ``pattern`` a regular expression (all without regard to
    case), ``condition`` SQL over the rows' columns, in which ``{text}`` stands for the text."""

    name: str
    tier: str
    calls: str = ""
    words: str = ""
    pattern: str = ""
    condition: str = ""

    def __post_init__(self) -> None:
        if sum(map(bool, (self.calls, self.words, self.pattern, self.condition))) != 1:
            raise ValueError(f"{self.name}: a rule has names, a pattern or a condition")


@dataclass(frozen=True)
class RuleTable:
    """Rules in order of priority; what none of them matches is ``default``."""

    source: str
    rules: Sequence[Rule]
    default: str = SIMPLE

    def __post_init__(self) -> None:
        names = [r.name for r in self.rules]
        if len(set(names)) < len(names):
            raise ValueError(f"{self.source}: two rules share a name")

    def names(self, kind: str) -> dict[str, int]:
        """Upper-case names of all rules of a kind with the first rule that has each."""
        out: dict[str, int] = {}
        for k, r in enumerate(self.rules):
            for name in getattr(r, kind).upper().split():
                out.setdefault(name, k)
        return out


def _alternation(names: Sequence[str], behind: str) -> str:
    return rf"\b({'|'.join(map(re.escape, sorted(names, key=len, reverse=True)))}){behind}"


def _named(text: Column, names: dict[str, int], behind: str) -> Column:
    """The smallest priority among the names that occur."""
    found = F.regexp_extract_all(text, F.lit("(?i)" + _alternation(list(names), behind)), F.lit(1))
    priority = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.array_min(F.transform(found, lambda name: F.element_at(priority, F.upper(name))))


def first_rule(table: RuleTable, text: Column, text_sql: str) -> Column:
    """Priority of the deciding rule, null where none matches."""
    parts, patterns = [], []
    for kind, behind in (("calls", r"\s*\("), ("words", r"\b")):
        if names := table.names(kind):
            parts.append(_named(text, names, behind))
            patterns.append(_alternation(list(names), behind))
    for k, r in enumerate(table.rules):
        if r.pattern:
            parts.append(F.when(text.rlike("(?is)" + r.pattern), k))
            patterns.append(r.pattern)
    by_text = F.when(text.rlike("(?is)" + "|".join(f"(?:{p})" for p in patterns)), F.least(*parts, F.lit(None), F.lit(None))) if patterns else F.lit(None).cast("int")
    conditions = [F.when(F.expr(r.condition.format(text=text_sql)), k) for k, r in enumerate(table.rules) if r.condition]
    return F.least(by_text, *conditions, F.lit(None).cast("int"))


def decide(df: DataFrame, table: RuleTable, text_col: str = "expr") -> DataFrame:
    """Rows with ``rule`` and ``tier``; a null or blank text without a matching condition has no rule and the default tier."""
    sql = f"coalesce(`{text_col}`, '')"
    at = first_rule(table, F.expr(sql), sql)
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("rule_at"))
    out = df.withColumn("rule_at", at).withColumns({"rule": pick([r.name for r in table.rules]), "tier": F.coalesce(pick([r.tier for r in table.rules]), F.lit(table.default))})
    return out.drop("rule_at")


_PLAIN = """regexp_replace({text}, "'[^']*'", ' ')"""
# The stack holds S for a parenthesis that opens a SELECT and P for any other.
SUBQUERY_DEPTH = (
    "aggregate(regexp_extract_all(" + _PLAIN + r""", '(?i)(\\(\\s*SELECT\\b|[()])', 1), named_struct('open', '', 'most', 0), """
    "(s, t) -> named_struct('open', if(t = ')', left(s.open, greatest(length(s.open) - 1, 0)), concat(s.open, if(t = '(', 'P', 'S'))), "
    "'most', greatest(s.most, length(replace(s.open, 'P', '')) + if(t in ('(', ')'), 0, 1))), s -> s.most)"
)
CASE_DEPTH = (
    r"""aggregate(regexp_extract_all(regexp_replace({text}, "'[^']*'|\"[^\"]*\"", ' '), '(?i)\\b(CASE|END)\\b', 1), named_struct('open', 0, 'most', 0), """
    "(s, t) -> named_struct('open', if(upper(t) = 'CASE', s.open + 1, greatest(s.open - 1, 0)), 'most', greatest(s.most, s.open + if(upper(t) = 'CASE', 1, 0))), s -> s.most)"
)
# Arguments of the first DECODE: commas at its own level until its parenthesis closes.
DECODE_ARGUMENTS = (
    r"""aggregate(regexp_extract_all(regexp_extract({text}, '(?is)\\bDECODE\\s*\\((.*)', 1), '([(),])', 1), named_struct('depth', 1, 'n', if({text} rlike '(?i)\\bDECODE\\s*\\(', 1, 0)), """
    "(s, t) -> named_struct('depth', if(s.depth = 0, 0, s.depth + if(t = '(', 1, if(t = ')', -1, 0))), 'n', s.n + if(t = ',' and s.depth = 1, 1, 0)), s -> s.n)"
)

# Names, patterns and limits of the rules of each source, in order.
TABLEAU = RuleTable(
    "tableau",
    [
        Rule("level of detail", MANUAL, pattern=r"\{(?:FIXED|INCLUDE|EXCLUDE)\b"),
        Rule(
            "table calculation",
            MANUAL,
            calls="LOOKUP RUNNING_SUM RUNNING_AVG RUNNING_MIN RUNNING_MAX RUNNING_COUNT WINDOW_SUM WINDOW_AVG WINDOW_MIN WINDOW_MAX WINDOW_COUNT WINDOW_MEDIAN "
            "WINDOW_PERCENTILE WINDOW_STDEV WINDOW_STDEVP WINDOW_VAR WINDOW_VARP WINDOW_CORR WINDOW_COVAR WINDOW_COVARP INDEX FIRST LAST SIZE RANK RANK_DENSE RANK_MODIFIED "
            "RANK_PERCENTILE RANK_UNIQUE TOTAL PREVIOUS_VALUE MODEL_EXTENSION_BOOL MODEL_EXTENSION_INT MODEL_EXTENSION_REAL MODEL_EXTENSION_STR MODEL_PERCENTILE MODEL_QUANTILE "
            "MODEL_OUTLIER_DETECTOR MODEL_TRIM_MEAN",
        ),
        Rule(
            "spatial function",
            MANUAL,
            calls="HEXBINX HEXBINY MAKEPOINT MAKELINE BUFFER AREA DISTANCE INTERSECTS ISCOLLECTION ISEMPTY ISEQUAL ISVALID ASTEXT COLLECTIONEXTRACT HEXTOBINARY BINARYTOHEX DEGREES RADIANS",
        ),
        Rule("analytics extension", MANUAL, calls="SCRIPT_REAL SCRIPT_STR SCRIPT_INT SCRIPT_BOOL"),
        Rule(
            "function to map",
            TRANSLATE,
            calls="ZN ATTR IIF COUNTD STR FLOAT INT LEN MID FIND FINDNTH SPLIT SPACE ISDATE PROPER DATE DATETIME DATEPARSE MAKEDATE MAKEDATETIME MAKETIME DATENAME WEEK ISOWEEK ISOYEAR "
            "ISOWEEKDAY ISOQUARTER LOG DIV REGEXP_MATCH REGEXP_EXTRACT REGEXP_EXTRACT_NTH REGEXP_REPLACE STDEV STDEVP VAR VARP COVAR COVARP CORR PERCENTILE COLLECT RAWSQL_BOOL RAWSQL_DATE "
            "RAWSQL_DATETIME RAWSQL_INT RAWSQL_REAL RAWSQL_STR RAWSQLAGG_BOOL RAWSQLAGG_DATE RAWSQLAGG_DATETIME RAWSQLAGG_INT RAWSQLAGG_REAL RAWSQLAGG_STR",
        ),
    ],
)
COGNOS = RuleTable(
    "cognos",
    [
        Rule("macro", MANUAL, pattern="#[^#]+#"),
        Rule("prompt", MANUAL, calls="prompt promptmany"),
        Rule("member reference", MANUAL, pattern=r"->\s*\["),
        Rule(
            "dimensional function",
            MANUAL,
            calls="aggregate currentmember completetuple tuple member memberset children descendants ancestor ancestors parent firstchild lastchild firstsibling lastsibling nextmember "
            "prevmember lag lead closingperiod openingperiod parallelperiod periodstodate ytd qtd mtd wtd hierarchize except intersect union filter order topcount bottomcount head tail "
            "item level levels linkmember rolevalue",
        ),
        Rule(
            "function to map",
            TRANSLATE,
            calls="to_char to_date to_number cast substring substr trim ltrim rtrim upper lower length char_length position concat coalesce nullif case decode abs ceil ceiling floor round "
            "trunc mod power sqrt exp ln log sign extract _add_days _add_months _add_years _days_between _months_between _years_between _day_of_week _day_of_year _week_of_year "
            "_first_of_month _last_of_month _make_timestamp current_date current_timestamp sysdate sum avg count min max stddev variance rank row_number dense_rank percentile",
        ),
        Rule("unknown function", TRANSLATE, pattern=r"\b[A-Za-z_][A-Za-z0-9_]*\s*\("),
    ],
)
LOOKER = RuleTable(
    "looker",
    [
        Rule("template", MANUAL, pattern=r"\{[%{]"),
        Rule("native derived table", MANUAL, condition="is_native_derived"),
        Rule(
            "measure type",
            MANUAL,
            condition="lower(field_type) in ('percent_of_total', 'percent_of_previous', 'running_total', 'sum_distinct', 'average_distinct', 'median_distinct', 'percentile_distinct', 'period_over_period', 'distance')",
        ),
        Rule("dimension type", MANUAL, condition="lower(field_type) in ('location', 'distance', 'custom_calendar', 'date_raw')"),
        Rule("dimension group", TRANSLATE, condition="is_group"),
        Rule("dimension type to map", TRANSLATE, condition="lower(field_type) in ('tier', 'bin', 'case', 'duration', 'yesno', 'date', 'time', 'percentile', 'list')"),
        Rule("measure type to map", TRANSLATE, condition="lower(field_type) in ('percentile', 'list')"),
        Rule("number across views", TRANSLATE, condition=r"lower(field_type) = 'number' and {text} rlike '[$][{{]\\w+[.]\\w+[}}]'"),
        Rule("filtered measure", TRANSLATE, condition="has_filters"),
        Rule("plain type", SIMPLE, condition="lower(field_type) in ('string', 'number', 'zipcode', 'date_time', 'time', 'count', 'count_distinct', 'sum', 'average', 'min', 'max', 'median')"),
    ],
    default=TRANSLATE,
)
POWERBI = RuleTable(
    "powerbi",
    [
        Rule(
            "filter context or table function",
            MANUAL,
            words="CALCULATE CALCULATETABLE ALL ALLEXCEPT ALLSELECTED RANKX EARLIER EARLIEST ISINSCOPE USERELATIONSHIP CROSSFILTER TREATAS SUMMARIZECOLUMNS ADDCOLUMNS SELECTCOLUMNS GENERATE "
            "GENERATESERIES PATH PATHITEM PATHITEMREVERSE PATHLENGTH HASONEVALUE HASONEFILTER ISFILTERED ISCROSSFILTERED SELECTEDVALUE PARALLELPERIOD OPENINGBALANCEMONTH OPENINGBALANCEQUARTER "
            "OPENINGBALANCEYEAR CLOSINGBALANCEMONTH CLOSINGBALANCEQUARTER CLOSINGBALANCEYEAR CALENDAR CALENDARAUTO PERCENTILEX.INC PERCENTILEX.EXC MEDIANX",
        ),
        Rule("financial function", MANUAL, words="NPV XNPV IRR XIRR PMT PV FV"),
        Rule("grouping or natural join", MANUAL, words="GROUPBY NATURALINNERJOIN NATURALLEFTOUTERJOIN"),
        Rule("iterator or logic", TRANSLATE, words="SUMX AVERAGEX COUNTX MINX MAXX RELATED RELATEDTABLE DIVIDE IF SWITCH IFERROR FORMAT"),
        Rule(
            "time intelligence",
            TRANSLATE,
            words="DATESYTD DATESMTD DATESQTD DATEADD DATESBETWEEN DATESINPERIOD SAMEPERIODLASTYEAR TOTALYTD TOTALMTD TOTALQTD PREVIOUSDAY PREVIOUSMONTH PREVIOUSQUARTER PREVIOUSYEAR NEXTDAY "
            "NEXTMONTH NEXTQUARTER NEXTYEAR",
        ),
        Rule("value or lookup", TRANSLATE, words="DISTINCTCOUNT COALESCE CONCATENATEX FIRSTDATE LASTDATE ISBLANK LOOKUPVALUE"),
        Rule("text transform", TRANSLATE, words="MID SUBSTITUTE REPLACE SEARCH FIND VALUE FIXED COMBINEVALUES"),
        Rule("arithmetic to map", TRANSLATE, words="ROUNDUP ROUNDDOWN INT CEILING FLOOR LOG LOG10 RAND RANDBETWEEN EVEN ODD QUOTIENT CURRENCY MROUND"),
        Rule("type or user", TRANSLATE, words="ISERROR ISNUMBER ISTEXT ISLOGICAL ISNONTEXT USERNAME USERPRINCIPALNAME"),
        Rule("statistics", TRANSLATE, words="PERCENTILE.INC PERCENTILE.EXC NORM.DIST"),
    ],
)
DENODO = RuleTable(
    "denodo",
    [
        Rule("interface", SIMPLE, condition="view_type = 'INTERFACE'"),
        Rule("refreshed materialization", MANUAL, condition="view_type = 'MATERIALIZED' and {text} rlike '(?i)\\\\bSCHEDULE\\\\b|\\\\bREFRESH\\\\b'"),
        Rule("many joins", MANUAL, condition="n_joins >= 5"),
        Rule("deep subquery", MANUAL, condition=f"{SUBQUERY_DEPTH} >= 3"),
        Rule("custom function", MANUAL, pattern=r"\bcustom_function\b|\.java\b|\bjava:"),
        Rule("hierarchical query", MANUAL, pattern=r"\bCONNECT\s+BY\b"),
        Rule("table function", MANUAL, calls="XMLTABLE JSON_TABLE"),
        Rule("lateral join", MANUAL, pattern=r"\b(?:LATERAL|CROSS\s+APPLY|OUTER\s+APPLY)\b"),
        Rule(
            "function to map",
            TRANSLATE,
            calls="ADDDAY ADDMINUTE ADDSECOND ADDHOUR ADDMONTH ADDWEEK ADDYEAR DATEPARTDATE GETDAY GETDAYOFWEEK GETDAYOFYEAR GETDAYSBETWEEN GETMONTH GETYEAR GETHOUR GETMINUTE GETSECOND "
            "GETQUARTER GETWEEK DIFFMONTH DIFFDAY DIFFSECOND DIFFMINUTE DIFFHOUR DIFFINBUSINESSDAYS FIRSTDAYOFMONTH LASTDAYOFMONTH FORMATDATE TRUNC REGEXP_REPLACE ILIKE NVL2 MODULENULL "
            "CONTEXT GETSESSION GETUSERNAME HASHCODE SPLITQUERY ISCONTAINED ISNOTCONTAINED CONTAINSAND CONTAINSOR PREVIOUSVALUEOF",
        ),
        Rule("deep case", TRANSLATE, condition=f"{CASE_DEPTH} >= 3"),
        Rule("cast to map", TRANSLATE, pattern=r"\bCAST\s*\(.*?AS\s+(?:LOCALDATE|LOCALDATETIME|LOCALTIME|INTERVAL|ARRAY|STRUCT|ROW|BLOB|CLOB|NCLOB|LONGNVARCHAR|BFILE|XMLTYPE)\b"),
    ],
)
BUSINESS_OBJECTS = RuleTable(
    "businessobjects",
    [
        Rule("aggregate aware", MANUAL, pattern=r"@Aggregate_Aware\s*\("),
        Rule("derived table", MANUAL, pattern=r"@Derived_Table\s*\("),
        Rule("script", MANUAL, pattern=r"@Script\s*\("),
        Rule("nested select", MANUAL, pattern=r"@Select\s*\(.*?@Select"),
        Rule("long decode", MANUAL, condition=f"{DECODE_ARGUMENTS} >= 7"),
        Rule("subquery in a subquery", MANUAL, pattern=r"\bSELECT\b.*?\bSELECT\b"),
        Rule("hierarchical query", MANUAL, pattern=r"\bCONNECT\s+BY\b|\bPRIOR\b"),
        Rule("special aggregate", MANUAL, calls="LISTAGG XMLAGG WM_CONCAT COLLECT CORR_K CORR_S"),
        Rule("pivot", MANUAL, calls="PIVOT UNPIVOT"),
        Rule("platform builtin", MANUAL, pattern=r"\b(?:ROWNUM|ROWID|SYSDATE\b|SYSTIMESTAMP\b|DBMS_\w+|UTL_\w+|USERENV\s*\(|SYS_CONTEXT\s*\()"),
        Rule("at function", TRANSLATE, pattern=r"@(?:Select|Where|Variable|Prompt|Aggregate_Aware|Derived_Table|Script)\s*\("),
        Rule("null test", TRANSLATE, calls="NVL2"),
        Rule("deep case", TRANSLATE, pattern=r"\bCASE\b(?:(?!\bEND\b).)*\bCASE\b(?:(?!\bEND\b).)*\bCASE\b"),
        Rule("date function", TRANSLATE, calls="RelativeDate ToDate DatesBetween DaysBetween LastDayOfMonth MonthsBetween YearsBetween WeekNumberOfYear DayOfWeek"),
        Rule("truncation by format", TRANSLATE, pattern=r"\bTRUNC\s*\([^,)]+,\s*'[^']+'\s*\)"),
        Rule("date format", TRANSLATE, pattern=r"\b(?:TO_CHAR|TO_DATE)\s*\([^,)]+,\s*'[^']*(?:DD|MM|YYYY|HH24|MI|SS)[^']*'\s*\)"),
        Rule("outer join mark", TRANSLATE, pattern=r"\(\s*\+\s*\)"),
        Rule("substring", TRANSLATE, calls="SUBSTR"),
    ],
)
TABLES = {t.source: t for t in (TABLEAU, COGNOS, LOOKER, POWERBI, DENODO, BUSINESS_OBJECTS)}
