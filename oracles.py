"""SQL counterparts of all queries, in the dialect of the checking engine.

They are written from the definition of each result, as subqueries and joins over
single rows, and share no plan with the Spark side.
"""

from __future__ import annotations

from ledgerweave.component import CC, GL, Component
from ledgerweave.operators.merge import STRATEGIES

# Nation n lies in region n % 5, at any scale.
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

RAW = {
    "GL": """
SELECT r.r_name AS DATALIB, CAST(n.n_nationkey AS VARCHAR) AS COMPANY,
       CAST(1000 + p.p_partkey % 500 AS VARCHAR) AS ACCOUNT,
       CONCAT(CASE WHEN n.n_nationkey % 2 = 0 THEN upper(p.p_name) ELSE p.p_name END,
              '  ', p.p_brand) AS DESCRIPTION,
       p.p_type AS TYPE,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL
            ELSE CONCAT(p.p_name, ' ', p.p_type) END AS DESCRIPTION_LANG,
       CASE WHEN SUM(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) > 1
            THEN 'J' ELSE 'N' END AS DOORTREK_JN,
       CASE WHEN p.p_size = 50 THEN 'J' WHEN p.p_size = 49 THEN NULL ELSE 'N' END AS VERDREK_JN,
       MAX(l.l_shipdate) AS LASTUSED_DATE,
       CAST(p.p_partkey AS BIGINT) * 32 + n.n_nationkey AS _ord
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name, n.n_nationkey, p.p_partkey, p.p_name, p.p_brand, p.p_type, p.p_size""",
    "CC": """
SELECT r.r_name AS DATALIB, CAST(n.n_nationkey AS VARCHAR) AS COMPANY,
       CASE WHEN c.c_custkey % 40 = 0 THEN NULL
            ELSE CAST(100 + c.c_custkey % 400 AS VARCHAR) END AS COSTCENTER,
       CONCAT(CASE WHEN n.n_nationkey % 2 = 0 THEN lower(c.c_mktsegment)
                   ELSE c.c_mktsegment END, ' - ',
              CAST(CAST(floor(c.c_acctbal / 100) AS BIGINT) AS VARCHAR)) AS DESCRIPTION,
       MAX(o.o_orderpriority) AS DESCRIPTION_LANG, MAX(o.o_orderdate) AS LASTUSED_DATE,
       CAST(c.c_custkey AS BIGINT) * 32 + n.n_nationkey AS _ord
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN orders o ON o.o_custkey = c.c_custkey
GROUP BY r.r_name, n.n_nationkey, c.c_custkey, c.c_mktsegment, c.c_acctbal""",
}

COLUMNS = {
    "GL": (
        "DATALIB, COMPANY, ACCOUNT, DESCRIPTION, TYPE, DESCRIPTION_LANG, "
        "DOORTREK_JN, VERDREK_JN, LASTUSED_DATE, _ord"
    ),
    "CC": "DATALIB, COMPANY, COSTCENTER, DESCRIPTION, DESCRIPTION_LANG, LASTUSED_DATE, _ord",
}
CUTOFF = "(TIMESTAMP '2001-11-05 00:00:00' - INTERVAL 1000 DAY)"
BLANK = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"


def canon(text: str) -> str:
    return (
        f"trim(regexp_replace(strip_accents(lower(replace({text}, 'ß', 'ss'))), "
        "'[^0-9a-z]+', ' ', 'g'))"
    )


def squeezed(text: str) -> str:
    return f"trim(regexp_replace({text}, '{BLANK}+', ' ', 'g'))"


def numeric(text: str) -> str:
    t = f"regexp_replace({text}, '^{BLANK}+|{BLANK}+$', '', 'g')"
    pattern = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return f"CASE WHEN regexp_full_match({t}, '{pattern}') THEN TRY_CAST({t} AS DOUBLE) END"


def formatted(text: str) -> str:
    spelled = rf"regexp_replace({text}, '([0-9])_([0-9])', '\1\2', 'g')"
    d = f"({numeric(spelled)})"
    return (
        f"CASE WHEN {d} = floor({d}) AND abs({d}) < 9223372036854775808 "
        f"THEN CAST(CAST({d} AS BIGINT) AS VARCHAR) ELSE {text} END"
    )


def ledger(comp: Component) -> str:
    """CTEs ``loaded`` and ``kept`` of a component."""
    texts = ["DESCRIPTION", "DATALIB", "COMPANY", "DESCRIPTION_LANG"]
    texts += ["TYPE"] if comp is GL else []
    clean = ", ".join(f"{squeezed(name)} AS {name}" for name in texts)
    return f"""raw AS ({RAW[comp.code]}),
loaded AS (
  SELECT * REPLACE ({clean}), {canon('DESCRIPTION')} AS DESC_KEY,
         DATALIB || '-' || COMPANY AS ENV, {comp.number} AS NUM
  FROM raw),
kept AS (SELECT * EXCLUDE (NUM), NUM FROM loaded WHERE {keep(comp)})"""


def keep(comp: Component) -> str:
    test = f"lower(coalesce(DESCRIPTION, '')) NOT IN ('', 'leeg') AND LASTUSED_DATE >= {CUTOFF}"
    for flag in comp.flags:
        test += f" AND upper(coalesce({flag}, 'N')) <> 'J'"
    return f"coalesce({test}, false)"


def loaded(comp: Component) -> str:
    columns = f"{COLUMNS[comp.code]}, DESC_KEY, ENV"
    day = "date_trunc('day', LASTUSED_DATE)"
    return (
        f"WITH {ledger(comp)} SELECT * REPLACE (CAST({day} AS TIMESTAMP) AS LASTUSED_DATE) "
        f"FROM (SELECT {columns} FROM loaded)"
    )


def kept(comp: Component) -> str:
    return f"WITH {ledger(comp)} SELECT {COLUMNS[comp.code]}, DESC_KEY, ENV FROM kept"


def rejected(comp: Component) -> str:
    return (
        f"WITH {ledger(comp)} SELECT {COLUMNS[comp.code]}, DESC_KEY, ENV "
        "FROM loaded WHERE _ord NOT IN (SELECT _ord FROM kept)"
    )


def kept_whitelist(comp: Component) -> str:
    flag = " AND VERDREK_JN IS DISTINCT FROM 'J'" if comp is GL else ""
    return (
        f"WITH {ledger(comp)} SELECT {COLUMNS[comp.code]}, DESC_KEY, ENV FROM loaded "
        "WHERE DATALIB IN ('EUROPE', 'ASIA') AND COMPANY IN ('3', '8', '12', '13') "
        f"AND lower(DESCRIPTION) NOT IN ('', 'leeg'){flag}"
    )


def _counts(comp: Component) -> str:
    flags = "".join(
        f", count(*) FILTER (upper({flag}) = 'J') AS Removed_{flag.removesuffix('_JN')}"
        for flag in comp.flags
    )
    return (
        f"SELECT count(*) FILTER (NOT {keep(comp)}) AS Removed, "
        f"count(*) FILTER ({keep(comp)}) AS Kept{flags} FROM loaded"
    )


def filter_counts(comp: Component) -> str:
    return f"WITH {ledger(comp)} {_counts(comp)}"


def filter_summary(comp: Component) -> str:
    names = ["Removed", "Kept", *(f"Removed_{f.removesuffix('_JN')}" for f in comp.flags)]
    rows = " UNION ALL ".join(f"SELECT '{n}' AS Filter, {n} AS Count FROM counts" for n in names)
    return f"WITH {ledger(comp)}, counts AS ({_counts(comp)}) {rows}"


def schema_violations(comp: Component) -> str:
    rules = [(c, "not null", f"{c} IS NULL") for c in ("DATALIB", "COMPANY", "DESCRIPTION")]
    rules += [
        (c, "not blank", f"length(regexp_replace({c}, '{BLANK}', '', 'g')) = 0")
        for c in ("DATALIB", "DESCRIPTION")
    ]
    rules += [(f, "J or N", f"upper({f}) NOT IN ('J', 'N')") for f in comp.flags]
    flags = "".join(
        f", CASE _ord % 5 WHEN 0 THEN ' J' WHEN 1 THEN 'j' WHEN 2 THEN 'yes' ELSE {f} END AS {f}"
        for f in comp.flags
    )
    cases = " UNION ALL ".join(
        f"SELECT _ord, '{c}' AS \"COLUMN\", '{check}' AS \"CHECK\", {c} AS \"VALUE\" "
        f"FROM damaged WHERE {broken}"
        for c, check, broken in rules
    )
    return f"""WITH raw AS ({RAW[comp.code]}),
damaged AS (SELECT _ord,
  CASE _ord % 13 WHEN 1 THEN '  ' WHEN 0 THEN NULL ELSE DATALIB END AS DATALIB,
  CASE _ord % 11 WHEN 0 THEN NULL ELSE COMPANY END AS COMPANY,
  CASE _ord % 7 WHEN 1 THEN '' WHEN 2 THEN chr(160) || chr(9) WHEN 0 THEN NULL
       ELSE DESCRIPTION END AS DESCRIPTION{flags}
  FROM raw)
{cases}"""


def _first(name: str, order: str = "_ord") -> str:
    return f"arg_min({name}, {order}) FILTER ({name} IS NOT NULL)"


def _cells(comp: Component) -> str:
    picks = "".join(f", {_first(name)} AS {name}" for name in comp.attributes)
    return f"SELECT DESC_KEY, ENV, count(*) AS Rows{picks} FROM kept GROUP BY DESC_KEY, ENV"


PCT = "CAST(round_even({n} / greatest({total}, 1) * 100, 1) AS DOUBLE)"


def presence_long(comp: Component) -> str:
    return f"WITH {ledger(comp)} {_cells(comp)}"


def presence_totals(comp: Component) -> str:
    pct = PCT.format(n="count(DISTINCT ENV)", total="(SELECT count(DISTINCT ENV) FROM kept)")
    return f"""WITH {ledger(comp)}
SELECT DESC_KEY, {_first('DESCRIPTION')} AS DESCRIPTION, count(DISTINCT ENV) AS Count_Present,
       {pct} AS Pct_Present
FROM kept GROUP BY DESC_KEY"""


def _marks(names: list[str]) -> str:
    return ", ".join(
        f"CAST(count(*) FILTER (ENV = '{e}') > 0 AS INTEGER) AS \"{e}\"" for e in names
    )


def presence_binary(comp: Component, names: list[str]) -> str:
    return f"WITH {ledger(comp)} SELECT DESC_KEY, {_marks(names)} FROM kept GROUP BY DESC_KEY"


def presence_enriched(comp: Component, names: list[str]) -> str:
    def picks(column: str, prefix: str) -> list[str]:
        return [
            f"arg_min({column}, _ord) FILTER (ENV = '{e}' AND {column} IS NOT NULL) "
            f'AS "{prefix}{e}"'
            for e in names
        ]

    columns = picks(comp.number, comp.number_prefix)
    if comp is GL:
        columns += picks("TYPE", "Type_")
    pct = PCT.format(n="count(DISTINCT ENV)", total="(SELECT count(DISTINCT ENV) FROM kept)")
    wide = f"""SELECT DESC_KEY, {_first('DESCRIPTION')} AS DESCRIPTION, {_marks(names)},
  {', '.join(columns)}, count(DISTINCT ENV) AS Count_Present, {pct} AS Pct_Present
FROM kept GROUP BY DESC_KEY"""
    if comp is GL:
        return f"WITH {ledger(comp)} {wide}"
    return f"""WITH {ledger(comp)}, wide AS ({wide})
SELECT wide.*, v.DESCRIPTION_LANG
FROM wide JOIN (SELECT DISTINCT DESC_KEY, DESCRIPTION_LANG FROM kept) v USING (DESC_KEY)"""


def _mismatches(comp: Component, value: str, detail: str, separator: str) -> str:
    return f"""WITH {ledger(comp)},
valued AS (SELECT DESC_KEY, ENV, DESCRIPTION, _ord, {value} AS v FROM kept),
seen AS (
  SELECT DESC_KEY, {detail} AS detail, min(_ord) AS pos
  FROM valued WHERE v IS NOT NULL GROUP BY ALL),
several AS (
  SELECT DESC_KEY, {_first('DESCRIPTION')} AS DESCRIPTION
  FROM valued WHERE v IS NOT NULL GROUP BY DESC_KEY HAVING count(DISTINCT v) > 1)
SELECT any_value(DESCRIPTION) AS DESCRIPTION,
       string_agg(detail, '{separator}' ORDER BY pos, detail) AS Details
FROM seen JOIN several USING (DESC_KEY) GROUP BY DESC_KEY"""


def _details(comp: Component, value: str) -> str:
    return f"""WITH {ledger(comp)},
valued AS (SELECT DESC_KEY, ENV, _ord, {value} AS VALUE FROM kept),
several AS (SELECT DESC_KEY FROM valued GROUP BY DESC_KEY HAVING count(DISTINCT VALUE) > 1)
SELECT DESC_KEY, VALUE, ENV, min(_ord) AS POSITION
FROM valued JOIN several USING (DESC_KEY) WHERE VALUE IS NOT NULL GROUP BY ALL"""


def number_details(comp: Component) -> str:
    return _details(comp, formatted(comp.number))


def type_details(comp: Component) -> str:
    return _details(comp, "CASE WHEN TYPE NOT IN ('nan', 'None', '', '<NA>') THEN trim(TYPE) END")


def number_mismatches(comp: Component) -> str:
    return _mismatches(comp, formatted(comp.number), "v || ' (' || ENV || ')'", ", ")


def type_mismatches(comp: Component) -> str:
    value = "CASE WHEN TYPE NOT IN ('nan', 'None', '', '<NA>') THEN trim(TYPE) END"
    return _mismatches(comp, value, "v || ': ' || ENV", " | ")


def _actions(comp: Component, gaps: str) -> str:
    num = comp.number
    category = ", f.TYPE" if comp is GL else ""
    lang = " || ' and ' || coalesce(DESCRIPTION_LANG, '<NA>')" if comp is GL else ""
    firsts = ", ".join(
        f"arg_min({name}, (ENV, _ord)) FILTER ({name} IS NOT NULL) AS {name}"
        for name in comp.attributes
    )
    out_category = ", TYPE" if comp is GL else ""
    return f"""fallback AS (SELECT DESC_KEY, {firsts} FROM kept GROUP BY DESC_KEY),
gaps AS ({gaps}),
highest AS (
  SELECT ENV, max({numeric('NUM')}) AS top FROM kept GROUP BY ENV),
holder AS (
  SELECT ENV, NUM, DESC_KEY AS HOLDER, min(_ord) AS pos, {_first('DESCRIPTION')} AS HELD_AS
  FROM kept WHERE NUM IS NOT NULL GROUP BY ENV, NUM, DESC_KEY),
judged AS (
  SELECT g.DESC_KEY, g.ENV, f.DESCRIPTION, f.DESCRIPTION_LANG, f.{num} AS NUM{category},
         (SELECT count(*) FROM holder h WHERE h.ENV = g.ENV AND h.NUM = f.{num}) > 0 AS used,
         (SELECT arg_min(HELD_AS, pos) FROM holder h
          WHERE h.ENV = g.ENV AND h.NUM = f.{num} AND h.HOLDER <> g.DESC_KEY) AS rival
  FROM gaps g LEFT JOIN fallback f USING (DESC_KEY)),
worded AS (
  SELECT *, CASE WHEN used THEN 'Review' ELSE 'Create' END AS ActionType,
         coalesce(NUM, '<NA>') AS number, coalesce(DESCRIPTION, '<NA>') AS described
  FROM judged)
SELECT ActionType,
       CASE WHEN rival IS NOT NULL THEN 'Nummer bestaat al in target voor andere omschrijving'
            WHEN used THEN 'Nummer bestaat al in target voor dezelfde omschrijving'
            ELSE 'Target mist nummer' END AS Reason,
       ENV, split_part(ENV, '-', 1) AS DATALIB,
       substr(ENV, strpos(ENV, '-') + 1) AS COMPANY,
       DESCRIPTION, DESCRIPTION_LANG, {formatted('NUM')} AS {num}{out_category},
       coalesce(rival, '') AS Conflicting_Description,
       CASE WHEN rival IS NOT NULL THEN CAST(CAST(top + 1 AS BIGINT) AS VARCHAR) END
         AS Suggested_Number,
       CASE WHEN used AND rival IS NULL
            THEN 'Verify {comp.verify_what} in ' || ENV || ' — {comp.noun} ' || number
                 || ' already exists for ''' || described || ''''
            ELSE ActionType || ' in ' || ENV || ' {comp.noun} with ' || number || ' and '
                 || described{lang} END AS Action
FROM worded LEFT JOIN highest USING (ENV)"""


MISSING = """SELECT k.DESC_KEY, e.ENV
  FROM (SELECT DISTINCT DESC_KEY FROM kept) k CROSS JOIN (SELECT DISTINCT ENV FROM kept) e
  WHERE NOT EXISTS (SELECT 1 FROM kept x WHERE x.DESC_KEY = k.DESC_KEY AND x.ENV = e.ENV)"""
PRESENT = "SELECT DISTINCT DESC_KEY, ENV FROM kept"


def gap_actions(comp: Component) -> str:
    return f"WITH {ledger(comp)}, {_actions(comp, MISSING)}"


def actions_of(comp: Component, kind: str) -> str:
    return f"SELECT * FROM ({gap_actions(comp)}) WHERE ActionType = '{kind}'"


def alignment_actions(comp: Component) -> str:
    return f"WITH {ledger(comp)}, {_actions(comp, PRESENT)}"


def _unified(comp: Component, strategy: str) -> str:
    """CTEs up to ``unified`` for the standard merge."""
    category = f", {_first('TYPE')} AS cat" if comp is GL else ""
    out_category = ", cat AS TYPE_CANONICAL" if comp is GL else ""
    pick = {
        "keep_preferred": "coalesce(preferred, majority)",
        "pick_majority": "majority",
        "first": "earliest",
        "new_range": "CAST(NULL AS VARCHAR)",
    }[strategy]
    why = f"'{strategy}'"
    if strategy == "keep_preferred":
        why = (
            "CASE WHEN preferred IS NOT NULL THEN 'keep_preferred(EUROPE-3)' "
            "ELSE 'pick_majority' END"
        )
    return f"""sources AS (SELECT * FROM kept WHERE ENV IN ('EUROPE-3', 'EUROPE-8', 'EUROPE-13')),
tally AS (
  SELECT DESC_KEY, NUM, count(*) AS n, min(_ord) AS pos FROM sources
  WHERE NUM IS NOT NULL GROUP BY DESC_KEY, NUM),
major AS (SELECT DESC_KEY, arg_min(NUM, (-n, pos)) AS majority FROM tally GROUP BY DESC_KEY),
grouped AS (
  SELECT DESC_KEY, {_first('DESCRIPTION')} AS described, {_first('NUM')} AS earliest,
         arg_min_null(NUM, _ord) FILTER (ENV = 'EUROPE-3') AS preferred,
         {_first('DESCRIPTION_LANG')} AS lang{category}
  FROM sources GROUP BY DESC_KEY),
unified AS (
  SELECT DESC_KEY, coalesce(nullif(described, ''), DESC_KEY) AS DESCRIPTION,
         {pick} AS {comp.number}_CANONICAL{out_category}, lang AS DESCRIPTION_LANG_CANONICAL,
         CASE WHEN earliest IS NULL THEN 'no_number' ELSE {why} END AS Why_Canonical
  FROM grouped LEFT JOIN major USING (DESC_KEY))"""


def merge_unified(comp: Component, strategy: str) -> str:
    return f"WITH {ledger(comp)}, {_unified(comp, strategy)} SELECT * FROM unified"


def merge_conflicts(comp: Component) -> str:
    types = (
        "coalesce(string_agg(DISTINCT TYPE, ', ' ORDER BY TYPE), '') AS Types, "
        "count(DISTINCT TYPE) AS n_types"
        if comp is GL
        else "0 AS n_types"
    )
    out_types = "Types, " if comp is GL else ""
    return f"""WITH {ledger(comp)}, {_unified(comp, 'pick_majority')},
listed AS (
  SELECT DESC_KEY, coalesce(string_agg(DISTINCT NUM, ', ' ORDER BY NUM), '') AS Numbers,
         count(DISTINCT NUM) AS n_numbers, {types}
  FROM sources GROUP BY DESC_KEY)
SELECT DESC_KEY, DESCRIPTION, Numbers, {out_types}Why_Canonical
FROM listed JOIN unified USING (DESC_KEY) WHERE n_numbers > 1 OR n_types > 1"""


def conflict_values(comp: Component) -> str:
    types = "UNION SELECT DESC_KEY, 'type', TYPE FROM sources WHERE TYPE IS NOT NULL" if comp is GL else ""
    return f"""WITH {ledger(comp)}, {_unified(comp, 'pick_majority')},
listed AS (
  SELECT DESC_KEY, 'number' AS KIND, NUM AS VALUE FROM sources WHERE NUM IS NOT NULL {types}),
several AS (
  SELECT DISTINCT DESC_KEY FROM listed GROUP BY DESC_KEY, KIND HAVING count(DISTINCT VALUE) > 1)
SELECT DISTINCT DESC_KEY, KIND, VALUE FROM listed JOIN several USING (DESC_KEY)"""


def merge_actions(comp: Component) -> str:
    category = ", TYPE_CANONICAL AS TYPE" if comp is GL else ""
    return f"""WITH {ledger(comp)}, {_unified(comp, 'pick_majority')},
target AS (SELECT * FROM kept WHERE ENV = 'EUROPE-18'),
own AS (SELECT DISTINCT DESC_KEY, NUM AS own FROM target),
used AS (SELECT NUM, DESC_KEY AS holder, min(_ord) AS pos, arg_min(DESCRIPTION, _ord) AS held_as
         FROM target WHERE NUM IS NOT NULL GROUP BY ALL),
joined AS (
  SELECT u.*, u.{comp.number}_CANONICAL AS canon, o.own,
         (SELECT count(*) FROM used h
          WHERE h.NUM = u.{comp.number}_CANONICAL AND h.holder <> u.DESC_KEY) > 0 AS collision,
         (SELECT arg_min(held_as, pos) FROM used h
          WHERE h.NUM = u.{comp.number}_CANONICAL AND h.holder <> u.DESC_KEY) AS held_as
  FROM unified u LEFT JOIN own o ON o.DESC_KEY = u.DESC_KEY)
SELECT CASE WHEN collision THEN 'Review' WHEN canon IS NULL OR own IS NULL THEN 'Create'
            ELSE 'Review' END AS ActionType,
       CASE WHEN collision
            THEN 'Canonical nummer bestaat in target voor andere omschrijving: '
                 || coalesce(held_as, '')
            WHEN own = canon THEN 'Target heeft al hetzelfde canonical nummer'
            WHEN canon IS NULL THEN 'Canonical is leeg; kies nieuw nummer'
            WHEN own IS NULL THEN 'Target mist nummer'
            ELSE 'Afstemmen/cross-check met canonical' END AS Reason,
       'EUROPE-18' AS ENV, 'EUROPE' AS DATALIB, '18' AS COMPANY, DESCRIPTION,
       DESCRIPTION_LANG_CANONICAL AS DESCRIPTION_LANG, canon AS {comp.number}{category}
FROM joined"""


def merge_mappings(comp: Component) -> str:
    num = comp.number
    return f"""WITH {ledger(comp)}, {_unified(comp, 'pick_majority')},
entries AS (
  SELECT DISTINCT ON (ENV, DESCRIPTION, NUM) ENV, DATALIB, COMPANY, DESC_KEY, DESCRIPTION, NUM
  FROM sources ORDER BY ENV, DESCRIPTION, NUM, _ord)
SELECT ENV AS Source_ENV, DATALIB, COMPANY, e.DESCRIPTION, NUM AS {num}_SOURCE, {num}_CANONICAL,
       coalesce(NUM = {num}_CANONICAL, false) AS Same_Number,
       CASE WHEN {num}_CANONICAL IS NULL THEN 'Create (new range/choose number)'
            WHEN NUM = {num}_CANONICAL THEN 'Keep (same number)'
            ELSE 'Map to canonical' END AS Suggested_Action,
       'EUROPE-18' AS Target_ENV, Why_Canonical
FROM entries e LEFT JOIN unified u ON u.DESC_KEY = e.DESC_KEY"""


def run_summary(comp: Component) -> str:
    types = f"({type_mismatches(comp)})" if comp is GL else "(SELECT 1 WHERE false)"
    counts = f"({filter_counts(comp)})"
    figures = {
        "Rows Loaded": f"SELECT Kept + Removed FROM {counts}",
        "Rows Kept": f"SELECT Kept FROM {counts}",
        "Rows Removed": f"SELECT Removed FROM {counts}",
    }
    for flag in comp.flags:
        name = f"Removed_{flag.removesuffix('_JN')}"
        figures[name.replace("_", " ")] = f"SELECT {name} FROM {counts}"
    cells = f"({presence_long(comp)})"
    actions = f"({gap_actions(comp)})"
    figures |= {
        "Environments": f"SELECT count(DISTINCT ENV) FROM {cells}",
        "Unique Descriptions": f"SELECT count(DISTINCT DESC_KEY) FROM {cells}",
        "Create Actions": f"SELECT count(*) FROM {actions} WHERE ActionType = 'Create'",
        "Review Actions": f"SELECT count(*) FROM {actions} WHERE ActionType = 'Review'",
        "Number Mismatches": f"SELECT count(*) FROM ({number_mismatches(comp)})",
        "Type Mismatches": f"SELECT count(*) FROM {types}",
    }
    rows = [f"SELECT 'Component' AS Metric, '{comp.code}' AS Value"]
    rows += [
        f"SELECT '{name}' AS Metric, format('{{:,}}', CAST(({sql}) AS BIGINT)) AS Value"
        for name, sql in figures.items()
    ]
    return " UNION ALL ".join(rows)


def schema_refusal(comp: Component) -> str:
    return f"""WITH v AS ({schema_violations(comp)})
SELECT (SELECT count(*) FROM v) AS "TOTAL", * FROM v ORDER BY _ord, "COLUMN", "CHECK" LIMIT 10"""


def _listing(table: str, values: dict[str, str]) -> list[str]:
    return [
        f"SELECT '{table}' AS \"TABLE\", '{name}' AS \"NAME\", CAST(({sql}) AS VARCHAR) AS \"VALUE\""
        for name, sql in values.items()
    ]


def _rows_of(tables: dict[str, str]) -> list[str]:
    return _listing("Rows", {name: f"SELECT count(*) FROM ({sql})" for name, sql in tables.items()})


def run_tables(comp: Component, names: list[str]) -> dict[str, str]:
    """The result tables of a run; of some only their number of rows is right."""
    code = comp.code
    keys = f"SELECT DISTINCT DESC_KEY FROM ({presence_long(comp)})"
    return {
        f"{code}_RunSummary": f"SELECT 1 FROM ({run_summary(comp)}) UNION ALL SELECT 1",
        f"{code}_Cleaned": kept(comp),
        f"{code}_Filtered": rejected(comp),
        f"{code}_Summary": filter_summary(comp),
        f"{code}_PresenceBin": keys,
        f"{code}_Presence": presence_enriched(comp, names),
        f"{code}_Create": actions_of(comp, "Create"),
        f"{code}_Review": actions_of(comp, "Review"),
        f"{code}_NumMismatch": number_mismatches(comp),
        f"{code}_TypeMismatch": type_mismatches(comp) if comp is GL else "SELECT 1 WHERE false",
        f"{code}_Config": "SELECT 1",
    }


def manifest(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "TABLE", 'parquet' AS FORMAT, count(*) AS "ROWS" FROM ({sql})"""
        for name, sql in tables.items()
    )


def run_report(comp: Component, names: list[str]) -> str:
    code = comp.code
    config = {
        "datalibs": "''",
        "companies": "''",
        "lastused_days": "'1000'",
        "excluded_flags": "'DOORTREK_JN,VERDREK_JN'",
        "as_of": "'2001-11-05 00:00:00'",
        "component": f"'{code}'",
        "run_timestamp": "'20011105_060000'",
    }
    summary = f"{run_summary(comp)} UNION ALL SELECT 'Run Timestamp', '20011105_060000'"
    parts = _rows_of(run_tables(comp, names))
    parts += _listing(f"{code}_Config", config)
    parts.append(f"SELECT '{code}_RunSummary', Metric, Value FROM ({summary})")
    parts.append(f"SELECT '{code}_Summary', Filter, CAST(Count AS VARCHAR) FROM ({filter_summary(comp)})")
    return " UNION ALL ".join(parts)


def merge_tables() -> dict[str, str]:
    """The result tables of a merge; of some only their number of rows is right."""
    tables = {"Config": "SELECT 1", "Sources": "SELECT unnest([1, 2, 3])"}
    for comp in (GL, CC):
        tables |= {
            f"Unified_{comp.code}": merge_unified(comp, "pick_majority"),
            f"Conflicts_{comp.code}": merge_conflicts(comp),
            f"Actions_{comp.code}": merge_actions(comp),
            f"Mappings_{comp.code}": merge_mappings(comp),
        }
    return tables


def merge_report() -> str:
    config = {
        "Target_ENV": "'EUROPE-18'",
        "Scope": "'GL,CC'",
        "Numbering_Strategy": "'pick_majority'",
        "Preferred_ENV": "'EUROPE-3'",
        "Created_At": "'20011105_060000'",
    }
    return " UNION ALL ".join([*_rows_of(merge_tables()), *_listing("Config", config)])


KEY = "CAST(o_orderkey AS VARCHAR)"
NUMBER_SPELLINGS = f"""SELECT o_orderkey, CASE o_orderkey % 12
  WHEN 0 THEN {KEY} WHEN 1 THEN '0' || {KEY} WHEN 2 THEN {KEY} || '.0'
  WHEN 3 THEN '  ' || {KEY} || ' ' WHEN 4 THEN {KEY} || 'e2' WHEN 5 THEN {KEY} || '_000'
  WHEN 6 THEN {KEY} || 'D' WHEN 7 THEN 'ABC' || {KEY} || '.0' WHEN 8 THEN 'inf'
  WHEN 10 THEN {KEY} || '.25' WHEN 11 THEN '-' || {KEY} || '.' END AS raw FROM orders"""
DATE_SPELLINGS = """SELECT o_orderkey, CASE o_orderkey % 11
  WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN strftime(o_orderdate, '%y%m%d')
  WHEN 2 THEN CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS VARCHAR)
  WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
  WHEN 5 THEN 'NaT' WHEN 7 THEN '  ' WHEN 8 THEN '99991231'
  WHEN 9 THEN strftime(o_orderdate, '%Y%m%d') || '.0' WHEN 10 THEN 'unknown' END AS raw
FROM orders"""


def scalars() -> dict[str, str]:
    return {
        "canonical_key": f"SELECT doc_id, {canon('text')} AS desc_key FROM documents",
        "squeezed_text": f"SELECT doc_id, {squeezed('text')} AS text FROM documents",
        "number_format": f"""WITH spelled AS ({NUMBER_SPELLINGS})
SELECT o_orderkey, {formatted('raw')} AS formatted, {numeric('raw')} AS numeric,
       coalesce(raw = {formatted('raw')}, false) AS unchanged FROM spelled""",
        "parse_last_used": f"""WITH spelled AS (
  SELECT o_orderkey, regexp_replace(trim(raw), '^([0-9]+)[.]0$', '\\1') AS t
  FROM ({DATE_SPELLINGS})),
parsed AS (
  SELECT o_orderkey, CASE
    WHEN regexp_full_match(t, '[0-9]{{6}}') THEN try_strptime(t, '%y%m%d')
    WHEN regexp_full_match(t, '[0-9]{{8}}') THEN try_strptime(t, '%Y%m%d')
    WHEN regexp_full_match(t, '[0-9]+') THEN
      CASE WHEN TRY_CAST(t AS BIGINT) BETWEEN 1 AND 60000
           THEN CAST(DATE '1899-12-30' + CAST(TRY_CAST(t AS BIGINT) AS INTEGER) AS TIMESTAMP) END
    ELSE TRY_CAST(t AS TIMESTAMP) END AS d
  FROM spelled)
SELECT o_orderkey, CASE WHEN year(d) BETWEEN 1678 AND 2261 THEN CAST(d AS TIMESTAMP) END
  AS last_used FROM parsed""",
    }


def all_oracles() -> dict[str, str]:
    """SQL by query name."""
    names = sorted(f"{REGIONS[nation % 5]}-{nation}" for nation in range(25))
    found = scalars()
    for comp in (GL, CC):
        per_component = {
            "loaded": loaded(comp),
            "loaded_table": loaded(comp),
            "schema_violations": schema_violations(comp),
            "schema_refusal": schema_refusal(comp),
            "kept": kept(comp),
            "rejected": rejected(comp),
            "kept_whitelist": kept_whitelist(comp),
            "filter_counts": filter_counts(comp),
            "filter_summary": filter_summary(comp),
            "presence_long": presence_long(comp),
            "presence_totals": presence_totals(comp),
            "presence_binary": presence_binary(comp, names),
            "presence_enriched": presence_enriched(comp, names),
            "number_mismatches": number_mismatches(comp),
            "number_details": number_details(comp),
            "conflict_values": conflict_values(comp),
            "gap_actions": gap_actions(comp),
            "create_actions": actions_of(comp, "Create"),
            "review_actions": actions_of(comp, "Review"),
            "alignment_actions": alignment_actions(comp),
            "merge_conflicts": merge_conflicts(comp),
            "merge_actions": merge_actions(comp),
            "merge_mappings": merge_mappings(comp),
            "run_summary": run_summary(comp),
            "run_report": run_report(comp, names),
            "run_manifest": manifest(run_tables(comp, names)),
        }
        for strategy in STRATEGIES:
            per_component[f"merge_unified_{strategy}"] = merge_unified(comp, strategy)
        for name, sql in per_component.items():
            found[f"{comp.code.lower()}_{name}"] = sql
    found["gl_type_mismatches"] = type_mismatches(GL)
    found["gl_type_details"] = type_details(GL)
    found["merge_report"] = merge_report()
    found["merge_manifest"] = manifest(merge_tables())
    return found
