"""The same answers in DuckDB SQL, reached another way.

What a parser should give is taken from the number the text was printed from, not from the text;
cells are worked on in long form; newest rows are found by maximum and join.
"""

from __future__ import annotations

from checks import driver_tables as d
from fallowfunds import contracts
from fallowfunds.mappings import PINNED

AS_OF = "DATE '1999-06-30'"
RUN_AT = "TIMESTAMP '2026-01-15 12:00:00'"
BATCH = 100

# Weights of the check digit, from the last digit on; written here once more so that a
# wrong one in the library shows.
WEIGHTS = [3, 7, 13, 17, 19, 23, 29, 37, 41, 43, 47, 53, 59, 67, 71]


def quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def sha(text: str) -> str:
    return f"substr(sha256({text}), 1, 16)"


def check_digit(text: str) -> str:
    total = (
        f"list_sum([CAST(substr({text}, length({text}) + 1 - i, 1) AS BIGINT) * "
        f"({WEIGHTS})[i] FOR i IN range(1, length({text}) + 1)])"
    )
    return f"CAST(([0,1,9,8,7,6,5,4,3,2,1])[1 + CAST({total} % 11 AS BIGINT)] AS VARCHAR)"


def canonical(text: str) -> str:
    return (
        f"CASE WHEN length({text}) IN (9, 10) AND "
        f"{check_digit(f'left({text}, length({text}) - 1)')} = right({text}, 1) "
        f"THEN left({text}, length({text}) - 1) ELSE {text} END"
    )


# --- the projection of the driver's tables ------------------------------------------------

PUB = f"""li AS (
  SELECT l_orderkey AS o, l_partkey AS p, l_suppkey AS s, l_linenumber AS n, l_returnflag AS flag,
    l_linestatus AS line_status, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
    CAST(l_shipdate AS DATE) AS d,
    (year(l_shipdate) + 22) || '-' || (CASE WHEN month(l_shipdate) <= 6 THEN 1 ELSE 2 END) AS period
  FROM lineitem),
pub AS (
  SELECT *, 'raw/deposits/' || period || '/list-' || (o // 1000) || '.xlsx' AS key,
    {d.SHEET_RULE} AS sheet,
    (p * 100 + s % 100) * 10000 + (o % 1000) * 10 + n AS source_row,
    cents // 100 AS whole
  FROM li)"""

STG = f"""{PUB},
stg AS (
  SELECT {sha('key')} AS capture_id, key, period, sheet, source_row,
    CASE WHEN o % 97 <> 0 THEN CAST(o * 10 + n AS VARCHAR) END AS deposit_no,
    flag AS deposit_type,
    CASE WHEN p % 17 <> 0 THEN CASE line_status WHEN 'O' THEN 'Ordinario' ELSE 'Especial' END END
      AS classification,
    o % 7 <> 0 AS has_account,
    CASE WHEN o % 7 > 1 THEN '0' || (58092000000 + o % 4999) END AS account,
    CASE WHEN p % 29 <> 0 THEN 'Juzgado ' || (o % 4999) ||
      CASE WHEN period < '2020-1' THEN ' Civil' ELSE ' Civil Municipal' END END AS court_name,
    CASE WHEN p % 13 = 0 THEN NULL
      WHEN p % 3 = 0 THEN (900000000 + p) || {check_digit("CAST(900000000 + p AS VARCHAR)")}
      WHEN p % 3 = 1 THEN '860034313' ELSE CAST(900000000 + p AS VARCHAR) END AS plaintiff_id,
    CASE WHEN s % 9 = 0 THEN NULL WHEN s % 10 = 1 THEN CAST(900000000 + s AS VARCHAR)
      ELSE CAST(80000000 + s AS VARCHAR) END AS defendant_id,
    CASE WHEN p % 31 <> 0 THEN whole END AS amount_cop,
    CASE WHEN s % 33 <> 0 THEN d END AS origin_date,
    CASE WHEN p % 7 = 0 THEN NULL WHEN p % 5 = 0 THEN 'Seccional X' || (p % 3)
      ELSE 'Seccional ' || (o % 4999 % 23) END AS seccional,
    CASE WHEN p % 4 = 0 THEN 'Dpto X' || (p % 2) ELSE 'Dpto ' || (o % 4999 % 32) END AS department,
    CASE WHEN p % 11 <> 0 THEN 'Ciudad ' || (o % 4999 % 100) END AS city,
    'Distrito ' || (p % 6) AS judicial_district,
    CASE WHEN p % 19 = 0 THEN 'nota "' || n || '"' END AS source_extra
  FROM pub)"""

EVENTS = f"""hist AS (
  SELECT {sha(canonical("CAST(900000000 + event_id // 3 AS VARCHAR)"))} AS party_id,
    CASE WHEN event_id % 10 = 9 THEN 'OTHER' ELSE 'RUES' END AS source, ts AS queried_at,
    CASE WHEN event_type = 'view' THEN '{{"registros":[{{"razon_social":"Empresa ' || user_id || '"}}]}}'
      WHEN event_type IN ('signup', 'click') THEN '{{"registros":[]}}'
      ELSE '{{"error":"Timeout"}}' END AS result,
    CASE WHEN event_type = 'view' THEN 'Empresa ' || user_id END AS name,
    CASE WHEN event_type = 'view' THEN value > 50 END AS active,
    CASE event_type WHEN 'view' THEN 'found' WHEN 'signup' THEN 'not_found' WHEN 'error' THEN 'error'
      END AS status,
    event_type IN ('view', 'signup', 'click') AS answered,
    CASE WHEN event_type = 'view' AND user_id % 3 = 0 THEN 'legal_entity'
      WHEN event_type = 'view' AND user_id % 3 = 1 THEN 'natural_person' END AS document_type,
    CASE WHEN event_type = 'view' AND user_id % 3 < 2 THEN 1.0::DOUBLE END
      AS document_type_confidence,
    CASE WHEN event_type = 'view' THEN CASE WHEN user_id % 3 < 2 THEN 'rues_categoria'
      ELSE 'rues_categoria_unrecognized' END WHEN event_type = 'signup' THEN 'rues_not_found' END
      AS document_type_rule_id
  FROM events)"""

PARTIES = f"""raw_ids AS (
  SELECT plaintiff_id AS raw FROM stg WHERE plaintiff_id IS NOT NULL
  UNION SELECT defendant_id FROM stg WHERE defendant_id IS NOT NULL),
resolved AS (SELECT raw AS document_number_raw, {canonical('raw')} AS document_number FROM raw_ids),
party AS (SELECT DISTINCT {sha('document_number')} AS party_id, document_number FROM resolved)"""

CLASSES = """cls AS (
  SELECT h.party_id, h.document_type, h.document_type_confidence, h.document_type_rule_id
  FROM hist h JOIN (SELECT party_id, max(queried_at) AS newest FROM hist
    WHERE source = 'RUES' AND document_type IS NOT NULL GROUP BY party_id) m
  ON h.party_id = m.party_id AND h.queried_at = m.newest
  WHERE h.source = 'RUES' AND h.document_type IS NOT NULL),
typed AS (
  SELECT party.party_id, document_number, document_type, document_type_confidence,
    document_type_rule_id FROM party LEFT JOIN cls ON cls.party_id = party.party_id)"""

CLAIM_ROWS = f"""base AS (
  SELECT *, {sha("coalesce(account, 'no_court_account') || ':' || deposit_no")} AS claim_id
  FROM stg WHERE period <> '2017-1' AND deposit_no IS NOT NULL)"""

CLAIMS = f"""{CLAIM_ROWS},
newest AS (
  SELECT claim_id, max(lpad(CAST(source_row AS VARCHAR), 20, '0')) AS source_row, period FROM base
  WHERE (claim_id, period) IN (SELECT (claim_id, max(period)) FROM base GROUP BY claim_id)
  GROUP BY claim_id, period),
claim AS (
  SELECT b.claim_id, 'judicial_deposit' AS type,
    CASE WHEN account IS NOT NULL THEN {sha('account')} END AS court_id,
    deposit_no, deposit_type, amount_cop, origin_date, CAST(NULL AS VARCHAR) AS case_number,
    CAST(NULL AS VARCHAR) AS legal_basis, CAST(NULL AS VARCHAR) AS claim_route,
    CAST(json_object('classification', classification, 'source_extra', source_extra) AS VARCHAR)
      AS attributes
  FROM base b JOIN newest n ON b.claim_id = n.claim_id AND b.period = n.period
    AND b.source_row = CAST(n.source_row AS BIGINT))"""

BRIDGE = f"""claim_party AS (
  SELECT claim_id, {sha(canonical('plaintiff_id'))} AS party_id, 'plaintiff' AS procedural_role
  FROM base WHERE plaintiff_id IS NOT NULL
  UNION SELECT claim_id, {sha(canonical('defendant_id'))}, 'defendant'
  FROM base WHERE defendant_id IS NOT NULL)"""

COURT_NAMES = f"""court_name AS (
  SELECT {sha('account')} AS court_id, account AS court_account, court_name AS name,
    min(period) AS first_period, max(period) AS last_period, count(*) AS row_count
  FROM stg WHERE account IS NOT NULL AND court_name IS NOT NULL GROUP BY account, court_name),
office AS (
  SELECT court_id, min(name) AS court_office FROM court_name c
  WHERE last_period = (SELECT max(last_period) FROM court_name x WHERE x.court_id = c.court_id)
  GROUP BY court_id)"""

COURTS = f"""votes AS (
  SELECT account, 's' AS slot, seccional AS value, count(*) AS n FROM stg
    WHERE account IS NOT NULL AND seccional IS NOT NULL GROUP BY ALL
  UNION ALL SELECT account, 'd', department, count(*) FROM stg
    WHERE account IS NOT NULL AND department IS NOT NULL GROUP BY ALL
  UNION ALL SELECT account, 'c', city, count(*) FROM stg
    WHERE account IS NOT NULL AND city IS NOT NULL GROUP BY ALL
  UNION ALL SELECT account, 'j', judicial_district, count(*) FROM stg
    WHERE account IS NOT NULL AND judicial_district IS NOT NULL GROUP BY ALL),
win AS (SELECT account, slot, value FROM votes
  QUALIFY row_number() OVER (PARTITION BY account, slot ORDER BY n DESC, value) = 1),
court AS (
  SELECT {sha('a.account')} AS court_id, a.account AS court_account,
    (SELECT value FROM win w WHERE w.account = a.account AND slot = 's') AS seccional,
    (SELECT value FROM win w WHERE w.account = a.account AND slot = 'd') AS department,
    (SELECT value FROM win w WHERE w.account = a.account AND slot = 'c') AS city,
    (SELECT value FROM win w WHERE w.account = a.account AND slot = 'j') AS judicial_district,
    a.row_count
  FROM (SELECT account, count(*) AS row_count FROM stg WHERE account IS NOT NULL GROUP BY account) a)"""

LAST_PERIOD = "last_seen AS (SELECT claim_id, max(period) AS period FROM base GROUP BY claim_id)"

DEPOSITS = """deposit AS (
  SELECT cp.party_id, cp.claim_id, office.court_office, claim.amount_cop, claim.origin_date,
    cp.procedural_role, last_seen.period
  FROM claim_party cp JOIN claim ON claim.claim_id = cp.claim_id
  LEFT JOIN last_seen ON last_seen.claim_id = cp.claim_id
  LEFT JOIN office ON office.court_id = claim.court_id)"""

_TOTALS = """count(*) AS deposit_count,
    CAST(coalesce(sum(amount_cop), 0) AS BIGINT) AS total_amount_cop,
    count(DISTINCT coalesce(court_office, '<none>')) AS court_office_count,
    max(period) AS last_period,
    count(*) FILTER (procedural_role = 'plaintiff') AS plaintiff_count,
    CAST(coalesce(sum(amount_cop) FILTER (procedural_role = 'plaintiff'), 0) AS BIGINT)
      AS plaintiff_amount_cop,
    count(*) FILTER (procedural_role = 'defendant') AS defendant_count,
    CAST(coalesce(sum(amount_cop) FILTER (procedural_role = 'defendant'), 0) AS BIGINT)
      AS defendant_amount_cop"""

SUMMARY = f"""summary AS (SELECT party_id, {_TOTALS} FROM deposit GROUP BY party_id),
by_period AS (SELECT party_id, {_TOTALS} FROM deposit WHERE period IS NOT NULL
  GROUP BY party_id, period)"""

WINDOWS = """ordered AS (
  SELECT (year(o_orderdate) + 22) || '-' || (CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END)
    AS period, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS priority FROM orders),
win_dates AS (SELECT period, max(d) + 30 AS closes_on FROM ordered
  WHERE period NOT LIKE '%9-2' GROUP BY period)"""

ALL_SEARCH = ",\n".join([STG, CLAIMS, BRIDGE, COURT_NAMES, LAST_PERIOD, DEPOSITS, SUMMARY])

REGISTRY = """registry AS (
  SELECT CASE WHEN c % 10 = 3 THEN (900000000 + c) // 10 ELSE 900000000 + c END AS nit,
    c % 23 <> 0 AND c % 29 <> 7 AS has_record, c % 29 = 7 AS broken, c_name AS company,
    CASE c % 4 WHEN 0 THEN true WHEN 2 THEN true ELSE false END AS is_active,
    CASE c % 5 WHEN 0 THEN 'Persona Natural' WHEN 1 THEN 'PERSONA JURÍDICA NACIONAL'
      WHEN 2 THEN 'ESTABLECIMIENTO DE COMERCIO' WHEN 3 THEN 'persona juridica' END AS category,
    c AS id_rm, CASE WHEN c % 6 = 0 THEN ',{"razon_social":"second"}' ELSE '' END AS more,
    CASE c % 4 WHEN 0 THEN '" activa "' WHEN 1 THEN '"CANCELADA"' WHEN 2 THEN '"ACTIVA"'
      ELSE 'null' END AS state_json,
    CASE WHEN c % 2 = 0 THEN c_nationkey END AS staff,
    CASE WHEN c % 17 = 5 THEN 'Timeout: read ' || c
      WHEN c % 29 = 7 THEN 'ValueError: the answer is no JSON object'
      WHEN c % 31 = 11 AND c % 23 <> 0 THEN 'ValueError: the detail is no JSON' END AS error,
    CASE WHEN c % 31 = 11 THEN '{"empleados":'
      WHEN c % 2 = 0 THEN '{"empleados":' || c_nationkey || ',"ciiu":["a","b"]}' END AS detail
  FROM (SELECT c_custkey AS c, c_name, c_nationkey FROM customer)
  UNION ALL
  SELECT 80000000 + s_suppkey, true, false, s_name, true, 'Persona Natural Comerciante', s_suppkey, '',
    '"Activa"', NULL, NULL, NULL FROM supplier),
snapshot AS (
  SELECT *, CASE WHEN broken THEN '<html>busy</html>'
    WHEN NOT has_record THEN '{"registros":[],"total":' || id_rm || '}' ELSE
    '{"registros":[{"razon_social":"' || company || '","estado_matricula":' || state_json ||
    CASE WHEN category IS NOT NULL THEN ',"categoria":"' || category || '"' ELSE '' END ||
    ',"id_rm":' || id_rm || '}' || more || ']}' END AS response,
    '{' || CASE WHEN category IS NOT NULL THEN '"categoria":"' || category || '",' ELSE '' END ||
    '"id_rm":' || id_rm || CASE WHEN staff IS NOT NULL
      THEN ',"detail":{"ciiu":["a","b"],"empleados":' || staff || '}' ELSE '' END || '}'
      AS attributes
  FROM registry)"""

LOOKUP = """tries AS (
  SELECT party_id, document_number, CAST(document_number AS BIGINT) AS nit, 0 AS pos FROM target
  UNION ALL SELECT party_id, document_number,
    CAST(left(document_number, length(document_number) - 1) AS BIGINT), 1 FROM target
  WHERE length(document_number) IN (9, 10)),
hits AS (
  SELECT tries.party_id, tries.pos, r.*, r.error IS NOT NULL OR r.has_record AS decided
  FROM tries JOIN snapshot r ON r.nit = tries.nit),
chosen AS (
  SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY party_id
    ORDER BY NOT decided, CASE WHEN decided THEN pos ELSE -pos END) = 1),
answer AS (
  SELECT t.party_id, t.document_number, CASE WHEN decided THEN CAST(h.nit AS VARCHAR) END AS matched,
    h.* EXCLUDE (party_id) FROM target t LEFT JOIN chosen h ON h.party_id = t.party_id)"""

PENDING = """pending AS (
  SELECT party_id, document_number FROM party WHERE party_id NOT IN (
    SELECT party_id FROM hist WHERE source = 'RUES' AND answered))"""

ATTEMPTS = f"""attempt AS (
  SELECT party_id, 'RUES' AS source, {RUN_AT} AS queried_at,
    CASE WHEN error IS NOT NULL THEN '{{"error":"' || error || '"}}'
      ELSE coalesce(response, '{{"registros":[]}}') END AS result,
    CASE WHEN error IS NULL AND has_record THEN company END AS name,
    CASE WHEN error IS NULL AND has_record THEN is_active END AS active,
    CASE WHEN error IS NULL AND has_record THEN attributes END AS attributes,
    CASE WHEN error IS NOT NULL THEN 'error' WHEN has_record THEN 'found' ELSE 'not_found' END
      AS status,
    CASE WHEN error IS NULL AND has_record THEN category END AS categoria,
    CASE WHEN error IS NULL AND has_record THEN
      CASE WHEN category ILIKE '%jur_dica%' THEN 'legal_entity'
           WHEN category ILIKE '%natural%' THEN 'natural_person' END END AS document_type,
    CASE WHEN error IS NULL AND has_record
      AND (category ILIKE '%jur_dica%' OR category ILIKE '%natural%') THEN 1.0::DOUBLE END
      AS document_type_confidence,
    CASE WHEN error IS NOT NULL THEN NULL WHEN has_record IS NOT TRUE THEN 'rues_not_found'
      WHEN category IS NULL THEN 'rues_categoria_missing'
      WHEN category ILIKE '%jur_dica%' OR category ILIKE '%natural%' THEN 'rues_categoria'
      ELSE 'rues_categoria_unrecognized' END AS document_type_rule_id
  FROM answer)"""

ENRICH = ",\n".join(
    [
        STG, PARTIES, EVENTS, PENDING, REGISTRY,
        "target AS (SELECT * FROM pending)", LOOKUP, ATTEMPTS,
    ]
)

# --- raw sheets, in long form -------------------------------------------------------------


def _layout_values() -> str:
    rows = []
    for layout in d.sheet_layouts():
        for pos, (name, field) in enumerate(zip(layout["names"], layout["fields"])):
            rows.append(
                f"({quoted(layout['period'])}, {quoted(layout['sheet'])}, {pos}, "
                f"{quoted(name)}, {quoted(field)})"
            )
    return ",\n    ".join(rows)


def _mapping_values() -> str:
    """The field each mapped column feeds; where two feed one field, the later one."""
    rows = []
    for period, sheet, columns, reason in PINNED:
        rows += [
            f"({quoted(period)}, {quoted(sheet)}, {quoted(source)}, {quoted(field)}, {i})"
            for i, (source, field) in enumerate(columns.items())
        ]
    return ",\n    ".join(rows)


def _sheet_values() -> str:
    return ",\n    ".join(
        f"({quoted(period)}, {quoted(sheet)}, {quoted(reason)})"
        for period, sheet, _, reason in PINNED
    )


# Per printed text: what it should mean. Truth about a text comes from its number.
_DOTS = "replace(format('{:,}', whole), ',', '.')"
_AMOUNT_TEXT = f"""CASE (p + n) % 12
  WHEN 0 THEN '$ ' || {_DOTS} || ',oo' WHEN 1 THEN {_DOTS} || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
  WHEN 2 THEN format('{{:,}}', whole) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
  WHEN 3 THEN {_DOTS} WHEN 4 THEN whole || '.5'
  WHEN 5 THEN chr(160) || '$ ' || chr(160) || ' ' || {_DOTS} || ',00' || chr(160)
  WHEN 6 THEN 'abc' WHEN 7 THEN NULL WHEN 8 THEN '-' || {_DOTS} || ',00'
  WHEN 9 THEN whole || '.199999999' WHEN 10 THEN '$' || {_DOTS} || '.oO '
  ELSE {_DOTS} || '.1234,5' END"""
_AMOUNT_MEANS = """CASE (p + n) % 12 WHEN 4 THEN whole + whole % 2 WHEN 6 THEN NULL
  WHEN 7 THEN NULL WHEN 8 THEN -whole WHEN 11 THEN NULL ELSE whole END"""
_NUMBER_TEXT = """CASE WHEN p % 2 = 0 THEN whole || '.5'
  ELSE whole || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END"""
_NUMBER_MEANS = """CASE WHEN p % 2 = 0 THEN whole + whole % 2
  WHEN cents % 100 = 50 THEN whole + whole % 2 WHEN cents % 100 > 50 THEN whole + 1 ELSE whole END"""
# The same digits in a column that one text has turned to text.
_NUMBER_AS_TEXT_MEANS = "CASE WHEN p % 2 = 0 THEN whole + whole % 2 ELSE whole END"
_ODD = "(o // 1000 % 3 = 0 AND n = 7 AND p % 12 = 6)"
_ISO = "strftime(d, '%Y-%m-%d')"
_DMY = "day(d) || '/' || month(d) || '/' || year(d)"
_DATE_TEXT = f"""CASE s % 6 WHEN 0 THEN {_ISO} || ' 00:00:00' WHEN 1 THEN strftime(d, '%d/%m/%Y')
  WHEN 2 THEN {_DMY} WHEN 3 THEN strftime(d, '%Y%m%d')
  WHEN 4 THEN CASE WHEN p % 5 = 0 THEN NULL ELSE {_ISO} END
  ELSE CASE WHEN p % 8 = 0 THEN '2026-13-01' ELSE {_ISO} || 'T10:20' END END"""
_DATE_MEANS = """CASE WHEN s % 6 = 4 AND p % 5 = 0 THEN NULL WHEN s % 6 = 5 AND p % 8 = 0 THEN NULL
  ELSE d END"""

_FIELD_TEXT = {
    "deposit_no": "CASE WHEN period IN ('2020-1', '2020-2') THEN CAST(o * 10 + n AS VARCHAR) || '.0' "
    "WHEN o % 97 = 0 THEN 'S/N' ELSE 'D-' || o || '.' || n END",
    "deposit_type": "flag",
    "classification": "CASE line_status WHEN 'O' THEN 'Ordinario' ELSE 'Especial' END",
    "court_account": "CASE WHEN period = '2021-1' "
    "THEN CAST((58092000000 + o % 4999) / 1e10 AS VARCHAR) || 'E10' "
    "WHEN o % 7 = 0 THEN NULL WHEN o % 7 = 1 THEN CAST(o % 10 AS VARCHAR) "
    "WHEN p % 3 = 0 THEN CAST(58092000000 + o % 4999 AS VARCHAR) "
    "WHEN p % 3 = 1 THEN '0' || (58092000000 + o % 4999) "
    "ELSE '58-092-' || lpad(CAST(o % 4999 AS VARCHAR), 6, '0') END",
    "court_name": "'Juzgado ' || (o % 4999)",
    "plaintiff_id": "CASE WHEN p % 13 = 0 THEN 'Desconocido' WHEN p % 3 = 0 THEN "
    f"(900000000 + p) || '-' || {check_digit('CAST(900000000 + p AS VARCHAR)')} "
    "WHEN p % 3 = 1 THEN '860.034.313' ELSE CAST(900000000 + p AS VARCHAR) END",
    "plaintiff_id_type": "CASE WHEN p % 3 = 0 THEN 'NIT' ELSE 'CC' END",
    "plaintiff_name": "'Señor \"P' || (p % 100) || '\"'",
    "defendant_id": "CASE WHEN s % 9 <> 0 THEN (80000000 + s) || "
    "CASE WHEN period = '2022-1' THEN '.0' ELSE '' END END",
    "defendant_id_type": "'CC'",
    "defendant_name": "'D' || (s % 100)",
    "amount_cop": f"CASE WHEN period = '2022-2' THEN CASE WHEN {_ODD} THEN 'abc' "
    f"ELSE {_NUMBER_TEXT} END ELSE {_AMOUNT_TEXT} END",
    "origin_date": "CASE period WHEN '2023-2' THEN CASE WHEN p % 50 = 0 THEN '56634-01-01' "
    f"ELSE {_ISO} END || ' 00:00:00' WHEN '2020-1' THEN strftime(d, '%Y%m%d') || '.0' "
    f"ELSE {_DATE_TEXT} END",
    "case_action_date": f"CASE WHEN p % 9 = 0 THEN '31/02/2016' ELSE {_DMY} END",
    "case_number": "lpad(CAST(o AS VARCHAR), 23, '0')",
    "seccional": "'Seccional ' || (o % 23)",
    "department": "'Dpto ' || (o % 32)",
    "city": "'Ciudad ' || (o % 100)",
    "judicial_district": "'Distrito ' || (o % 6)",
    "source_extra": "CASE WHEN p % 4 <> 1 THEN 'extra A' || n END",
    "source_extra_2": "CASE WHEN p % 4 <> 3 THEN 'extra B' || n END",
    "remark": "CASE WHEN p % 3 <> 0 THEN 'x' END",
}

_NUMBER_FIELD = (
    "(field = 'deposit_no' AND period IN ('2020-1', '2020-2')) OR "
    "(field = 'court_account' AND period = '2021-1') OR "
    "(field = 'defendant_id' AND period = '2022-1') OR "
    "(field = 'origin_date' AND period = '2020-1')"
)

_unpivot = " UNION ALL ".join(
    f"SELECT key, period, sheet, source_row, '{field}' AS field, {text} AS text, "
    f"{_ODD} AS odd, o, p, s, n, cents, whole, d FROM pub"
    for field, text in _FIELD_TEXT.items()
)

RAW = f"""{PUB},
layout(period, sheet, pos, name, field) AS (VALUES
    {_layout_values()}),
mapped(period, sheet, source, target, rank) AS (VALUES
    {_mapping_values()}),
pinned(period, sheet, skip_reason) AS (VALUES
    {_sheet_values()}),
named AS (
  SELECT l.*, CASE WHEN name IS NULL THEN '__UNNAMED__' || pos
    WHEN EXISTS (SELECT 1 FROM layout x WHERE x.period = l.period AND x.sheet = l.sheet
      AND x.name = l.name AND x.pos < l.pos) THEN name || '_1' ELSE name END AS column_name
  FROM layout l),
target_field AS (
  SELECT n.period, n.sheet, n.pos, m.target FROM named n
  JOIN mapped m ON m.period = n.period AND m.sheet = n.sheet AND m.source = n.column_name
  WHERE NOT EXISTS (SELECT 1 FROM mapped later WHERE later.period = m.period
    AND later.sheet = m.sheet AND later.target = m.target AND later.rank > m.rank)),
texts AS ({_unpivot}),
odd_sheet AS (SELECT key, sheet, bool_or({_ODD}) AS mixed FROM pub GROUP BY key, sheet),
cell AS (
  SELECT t.key, t.period, t.sheet, t.source_row, l.pos, l.column_name, t.field, t.text,
    CASE WHEN t.field = 'amount_cop' AND t.period = '2022-2' AND NOT mixed THEN 'number'
      WHEN {_NUMBER_FIELD.replace('field', 't.field').replace('period', 't.period')} THEN 'number'
      WHEN t.field = 'origin_date' AND t.period = '2023-2' THEN 'datetime' ELSE 'text' END AS kind,
    CASE WHEN t.field = 'court_account' AND t.period = '2021-1'
      THEN CAST(CAST(CAST(t.text AS DOUBLE) AS BIGINT) AS VARCHAR) ELSE
    regexp_replace(t.text, CASE WHEN {_NUMBER_FIELD.replace('field', 't.field').replace('period', 't.period')}
      OR (t.field = 'amount_cop' AND t.period = '2022-2') THEN '\\.0+$' ELSE '^$' END, '') END AS shown
  FROM texts t JOIN named l ON l.period = t.period AND l.sheet = t.sheet AND l.field = t.field
  JOIN odd_sheet o ON o.key = t.key AND o.sheet = t.sheet)"""

_HAS = "period || '/' || sheet"


def _sheets_with(field: str) -> str:
    """(period, sheet) pairs whose mapping gives a field."""
    pairs = [
        f"({quoted(period)}, {quoted(sheet)})"
        for period, sheet, columns, _ in PINNED
        if field in columns.values()
    ]
    return f"(period, sheet) IN ({', '.join(pairs)})"


def _when_mapped(field: str, expr: str) -> str:
    return f"CASE WHEN {_sheets_with(field)} THEN {expr} END"


# Staging from the numbers behind the texts; only the raw twins come from the texts.
_shown = {
    f: (
        f"regexp_replace({t}, CASE WHEN period IN ('2020-1', '2020-2', '2021-1', '2022-1') "
        "THEN '\\.0$' ELSE '^$' END, '')"
        if f in ("deposit_no", "defendant_id", "origin_date")
        else t
    )
    for f, t in _FIELD_TEXT.items()
}
_shown["court_account"] = (
    "CASE WHEN period = '2021-1' THEN CAST(58092000000 + o % 4999 AS VARCHAR) "
    f"ELSE {_FIELD_TEXT['court_account']} END"
)
_shown["amount_cop"] = (
    f"CASE WHEN period = '2022-2' THEN regexp_replace({_FIELD_TEXT['amount_cop']}, '\\.0+$', '') "
    f"ELSE {_FIELD_TEXT['amount_cop']} END"
)
_shown["source_extra"] = (
    f"CASE WHEN sheet = 'D J NO RECLAMADOS' THEN {_FIELD_TEXT['source_extra_2']} "
    f"ELSE {_FIELD_TEXT['source_extra']} END"
)
_amount = (
    f"CASE WHEN period <> '2022-2' THEN {_AMOUNT_MEANS} WHEN {_ODD} THEN NULL "
    f"WHEN mixed THEN {_NUMBER_AS_TEXT_MEANS} ELSE {_NUMBER_MEANS} END"
)
_origin = (
    "CASE period WHEN '2023-2' THEN CASE WHEN p % 50 <> 0 THEN d END "
    f"WHEN '2020-1' THEN d ELSE {_DATE_MEANS} END"
)
_action = "CASE WHEN p % 9 <> 0 THEN d END"
_PASS = (
    "deposit_type", "classification", "court_account", "court_name", "plaintiff_id_type",
    "plaintiff_name", "defendant_id_type", "defendant_name", "case_number", "seccional",
    "department", "city", "judicial_district", "source_extra",
)
_RAW_TWINS = (
    "deposit_no", "plaintiff_id", "defendant_id", "amount_cop", "origin_date", "case_action_date",
)

NORMAL = f"""{PUB},
odd_sheet AS (SELECT key, sheet, bool_or({_ODD}) AS mixed FROM pub GROUP BY key, sheet),
parsed AS (
  SELECT pub.key, {sha('pub.key')} AS capture_id, period, pub.sheet, source_row, mixed, p,
    {", ".join(f"{_when_mapped(f, _shown[f])} AS {f}" for f in _PASS)},
    {", ".join(f"{_when_mapped(f, _shown[f])} AS {f}_raw" for f in _RAW_TWINS)},
    CASE WHEN period IN ('2020-1', '2020-2') OR o % 97 <> 0 THEN CAST(o * 10 + n AS VARCHAR) END
      AS deposit_no,
    CASE WHEN p % 13 = 0 THEN NULL
      WHEN p % 3 = 0 THEN (900000000 + p) || {check_digit("CAST(900000000 + p AS VARCHAR)")}
      WHEN p % 3 = 1 THEN '860034313' ELSE CAST(900000000 + p AS VARCHAR) END AS plaintiff_id,
    CASE WHEN s % 9 <> 0 THEN CAST(80000000 + s AS VARCHAR) END AS defendant_id,
    {_when_mapped('amount_cop', _amount)} AS amount_cop,
    {_when_mapped('origin_date', _origin)} AS origin_date,
    {_when_mapped('case_action_date', _action)} AS case_action_date,
    CASE WHEN {_sheets_with('court_account')} AND (o % 7 > 1 OR period = '2021-1')
      THEN '0' || (58092000000 + o % 4999) END AS account,
    CASE WHEN period IN ('2017-2', '2019-2')
      THEN 'no column mapping for period=''' || period || ''' sheet=''Hoja1'''
      WHEN period = '2018-2' AND pub.sheet = 'Hoja1'
      THEN {quoted(next(reason for _, _, _, reason in PINNED if reason))} END AS sheet_reason
  FROM (SELECT * FROM pub JOIN odd_sheet USING (key, sheet)) AS pub),
judged AS (
  SELECT *, CASE WHEN sheet_reason IS NOT NULL THEN NULL
    WHEN amount_cop IS NULL AND amount_cop_raw IS NOT NULL THEN 'amount_cop'
    WHEN origin_date IS NULL AND origin_date_raw IS NOT NULL THEN 'origin_date'
    WHEN case_action_date IS NULL AND case_action_date_raw IS NOT NULL THEN 'case_action_date'
    END AS bad
  FROM parsed),
ok AS (SELECT * FROM judged WHERE sheet_reason IS NULL AND bad IS NULL)"""

# The original row as JSON, rebuilt from the long form of its cells.
_JSON_STRING = (
    "'\"' || replace(replace({0}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"') || '\"'"
)
RAW_JSON = f"""raw_json AS (
  SELECT key, sheet, source_row, '{{' || string_agg({_JSON_STRING.format('column_name')} || ':' ||
    coalesce(CASE WHEN kind = 'number' THEN shown || CASE WHEN regexp_matches(shown, '^-?[0-9]{{1,16}}$') THEN '.0'
      ELSE '' END ELSE {_JSON_STRING.format('text')} END, 'null'), ',' ORDER BY pos) || '}}' AS raw_row
  FROM cell GROUP BY key, sheet, source_row)"""

ERRORS = f"""{WINDOWS},
bad_object AS (
  SELECT DISTINCT 'raw/deposits/' || period || '/bad-' || left(priority, 1) || '.xlsx' AS key,
    period, CASE WHEN left(priority, 1) IN ('1', '2') THEN NULL ELSE 'Hoja' || left(priority, 1) END
      AS sheet, 'CalamineError: broken ' || priority AS error FROM ordered)"""


def _unmapped_sheet_cells() -> str:
    """NORMAL without its leading PUB and odd_sheet, to follow RAW."""
    return NORMAL[NORMAL.index("parsed AS ("):]


_REJECTS = (
    "judged.key, judged.period, judged.sheet, judged.source_row, "
    "coalesce(sheet_reason, 'could not parse ' || bad || ' from ''' || "
    "CASE bad WHEN 'amount_cop' THEN amount_cop_raw WHEN 'origin_date' THEN origin_date_raw "
    "ELSE case_action_date_raw END || '''') AS reason, raw_row"
)

_STAGING_COLUMNS = (
    "capture_id, period, sheet, source_row, deposit_no_raw, deposit_no, deposit_type, "
    "classification, court_account, court_name, plaintiff_id_raw, plaintiff_id, "
    "plaintiff_id_type, plaintiff_name, defendant_id_raw, defendant_id, defendant_id_type, "
    "defendant_name, amount_cop_raw, amount_cop, origin_date_raw, origin_date, "
    "case_action_date_raw, case_action_date, case_number, seccional, department, city, "
    "judicial_district, source_extra"
)

CAPTURES = f"""{ERRORS},
{NORMAL},
keys AS (
  SELECT DISTINCT key FROM pub UNION ALL SELECT key FROM bad_object
  UNION ALL SELECT 'raw/deposits/2024-1/empty-' || n_nationkey || '.xlsx' FROM nation),
capture AS (
  SELECT {sha('keys.key')} AS capture_id, {sha('keys.key')} AS file_id, 'backfill' AS code_version,
    '1' AS schema_version, {RUN_AT} AS executed_at,
    count(j.key) + count(b.key) AS rows_read,
    count(j.key) FILTER (sheet_reason IS NULL AND bad IS NULL) AS rows_ok,
    count(j.key) FILTER (sheet_reason IS NOT NULL OR bad IS NOT NULL) + count(b.key)
      AS rows_rejected,
    CASE WHEN count(b.key) > 0 THEN 'read_error' ELSE 'ok' END AS status
  FROM keys LEFT JOIN judged j ON j.key = keys.key LEFT JOIN bad_object b ON b.key = keys.key
  GROUP BY keys.key)"""

HEADERS = """title AS (
  SELECT DISTINCT key, sheet, CAST(regexp_extract(key, 'list-([0-9]+)', 1) AS BIGINT) % 8 AS header_row
  FROM pub)"""

PROFILE = f"""{RAW},
sheet_size AS (SELECT key, period, sheet, count(*) AS height FROM pub GROUP BY ALL),
stat AS (
  SELECT key, sheet, pos, count(text) AS present,
    count(DISTINCT CASE WHEN kind = 'number' THEN CAST(CAST(text AS DOUBLE) AS VARCHAR) ELSE shown END)
      AS distinct_values,
    max(kind) FILTER (text IS NOT NULL) AS kind
  FROM cell GROUP BY key, sheet, pos),
prof AS (
  SELECT z.key AS file, z.period, z.sheet, n.column_name AS column, CAST(n.pos AS BIGINT) AS position,
    CASE stat.kind WHEN 'number' THEN 'Float64'
      WHEN 'datetime' THEN 'Datetime(time_unit=''ms'', time_zone=None)' ELSE 'String' END AS dtype,
    round((height - present) / height, 4) AS null_rate,
    distinct_values + CASE WHEN present < height THEN 1 ELSE 0 END AS distinct_count
  FROM sheet_size z JOIN named n ON n.period = z.period AND n.sheet = z.sheet
  JOIN stat ON stat.key = z.key AND stat.sheet = z.sheet AND stat.pos = n.pos)"""

REQUESTS = f"""request AS (
  SELECT DISTINCT CASE c_custkey % 5 WHEN 0 THEN CAST(900000000 + c_custkey AS VARCHAR)
    WHEN 1 THEN replace(format('{{:,}}', 900000000 + c_custkey), ',', '.') || '-' ||
      {check_digit("CAST(900000000 + c_custkey AS VARCHAR)")}
    WHEN 2 THEN 'NIT ' || replace(format('{{:,}}', 900000000 + c_custkey), ',', '.')
    WHEN 3 THEN '8' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') ELSE 'sin numero' END AS raw_value
  FROM customer),
asked AS (
  SELECT raw_value, nullif(regexp_replace(raw_value, '[^0-9]', '', 'g'), '') AS digits FROM request),
matched AS (
  SELECT raw_value, digits, coalesce(x.party_id, y.party_id) AS party_id,
    coalesce(x.document_number, y.document_number) AS document_number,
    CASE WHEN x.party_id IS NOT NULL THEN x.document_type ELSE y.document_type END AS document_type
  FROM asked LEFT JOIN typed x ON x.document_number = digits
  LEFT JOIN typed y ON length(digits) IN (9, 10)
    AND y.document_number = left(digits, length(digits) - 1))"""

LATEST = """latest AS (
  SELECT party_id, name AS party_name, active AS rues_active FROM hist h
  WHERE queried_at = (SELECT max(queried_at) FROM hist x WHERE x.party_id = h.party_id))"""

_ROW = "o, p, s, n, source_row"


def _row_digests(tables: dict[contracts.Contract, str]) -> str:
    """Table name and digest of every row of some core tables."""
    parts = []
    for contract, query in tables.items():
        shown = ", ".join(
            f"coalesce({_shown(f)}, '~')" for f in contract.fields
        )
        parts.append(f"SELECT '{contract.name}' AS \"table\", sha256(concat_ws('|', {shown})) AS row_sha256 FROM ({query})")
    return " UNION ALL ".join(parts)


def _shown(field: contracts.Field) -> str:
    if field.type.typeName() == "timestamp_ntz":
        return f"strftime({field.name}, '%Y-%m-%d %H:%M:%S')"
    return f"CAST({field.name} AS VARCHAR)"


def build() -> dict[str, str]:
    plaintiff_canonical = canonical("plaintiff_id")
    defendant_canonical = canonical("defendant_id")
    scalars = {
        "period_from_key": f"WITH {PUB} SELECT {_ROW}, key, period AS found_period FROM pub",
        "hash_ids": f"WITH {PUB} SELECT {_ROW}, {sha('key')} AS file_id FROM pub",
        "parse_currency": f"WITH {PUB} SELECT {_ROW}, {_AMOUNT_MEANS} AS amount FROM pub",
        "parse_currency_numeric": f"WITH {PUB} SELECT {_ROW}, {_NUMBER_MEANS} AS amount, "
        "CAST(NULL AS BIGINT) AS amount_of_bool FROM pub",
        "parse_date": f"WITH {PUB} SELECT {_ROW}, {_DATE_MEANS} AS text_date, d AS number_date "
        "FROM pub",
        "normalize_id": f"WITH {PUB} SELECT {_ROW}, CASE WHEN p % 13 <> 0 THEN o || '' || n END "
        "AS text_id, CAST(58092000000 + o AS VARCHAR) AS number_id FROM pub",
        "stringify_values": f"WITH {PUB} SELECT {_ROW}, CASE p % 4 WHEN 0 THEN "
        "CAST(58092000000 + o AS VARCHAR) WHEN 1 THEN CAST(o AS VARCHAR) WHEN 2 THEN o || '.25' "
        "ELSE '1' || lpad(CAST(o AS VARCHAR), 9, '0') || repeat('0', 31 + n) END AS shown FROM pub",
        "nit_check_digit": f"WITH {PUB} SELECT {_ROW}, "
        f"{check_digit('CAST(900000000 + p * 7919 + s AS VARCHAR)')} AS digit FROM pub",
        "canonical_document_number": f"WITH {STG} SELECT capture_id, sheet, source_row, "
        f"{plaintiff_canonical} AS plaintiff, {defendant_canonical} AS defendant FROM stg",
        "canonical_court_account": f"WITH {STG} SELECT capture_id, sheet, source_row, account "
        "FROM stg",
        "claim_ids": f"WITH {STG} SELECT capture_id, sheet, source_row, coalesce(account, "
        "'no_court_account') || ':' || deposit_no AS claim_key, "
        f"{sha(chr(40) + 'coalesce(account, ' + quoted('no_court_account') + ') || ' + quoted(':') + ' || deposit_no' + chr(41))} "
        "AS claim_id FROM stg",
        "claim_attributes": f"WITH {STG} SELECT capture_id, sheet, source_row, "
        "'{\"classification\":' || coalesce('\"' || classification || '\"', 'null') || "
        "',\"source_extra\":' || coalesce('\"' || replace(source_extra, '\"', chr(92) || '\"') || '\"', "
        "'null') || '}' AS json FROM stg",
        "classify_category": """SELECT c_custkey,
          CASE c_custkey % 7 WHEN 0 THEN 'natural_person' WHEN 1 THEN 'legal_entity'
            WHEN 3 THEN 'legal_entity' WHEN 4 THEN 'legal_entity' WHEN 5 THEN 'natural_person' END
            AS document_type,
          CASE WHEN c_custkey % 7 IN (0, 1, 3, 4, 5) THEN 1.0::DOUBLE END AS confidence,
          CASE c_custkey % 7 WHEN 2 THEN 'rues_categoria_unrecognized'
            WHEN 6 THEN 'rues_categoria_missing' ELSE 'rues_categoria' END AS rule_id
          FROM customer""",
        "lookup_candidates": f"WITH {STG}, {PARTIES} "
        "SELECT document_number, 0 AS pos, CAST(CAST(document_number AS HUGEINT) AS VARCHAR) AS nit "
        "FROM party UNION ALL SELECT document_number, 1, CAST(CAST(left(document_number, "
        "length(document_number) - 1) AS HUGEINT) AS VARCHAR) FROM party "
        "WHERE length(document_number) IN (9, 10)",
        "format_cop": f"WITH {PUB} SELECT {_ROW}, '$ ' || replace(format('{{:,}}', "
        "(cents - 5000000) * 37), ',', '.') AS shown FROM pub",
        "document_type_label": f"WITH {EVENTS} SELECT CASE coalesce(document_type, CASE WHEN "
        "source = 'OTHER' THEN status END) WHEN 'legal_entity' THEN 'Persona jurídica' "
        "WHEN 'natural_person' THEN 'Persona natural' ELSE coalesce(document_type, CASE WHEN "
        "source = 'OTHER' THEN status END, 'Sin clasificar') END AS label, count(*) AS attempts "
        "FROM hist GROUP BY 1",
    }
    sources = {
        "enrichment_union_by_name": f"WITH {EVENTS} SELECT party_id, source, queried_at, result, "
        "CASE WHEN source <> 'OTHER' AND status IS NOT NULL THEN name END AS name, "
        "CASE WHEN source <> 'OTHER' AND status IS NOT NULL THEN active END AS active, "
        "CASE WHEN source <> 'OTHER' THEN status END AS status, "
        "CASE WHEN source <> 'OTHER' AND status <> 'error' THEN document_type END AS document_type "
        "FROM hist",
        "contract_violations": f"WITH {EVENTS}, "
        "missing AS (SELECT count(*) AS n FROM hist WHERE status IS NULL) "
        "SELECT rule, CASE WHEN rule = 'status:not_null' THEN (SELECT n FROM missing) ELSE 0 END "
        "AS violations FROM (VALUES ('party_id:not_null'), ('source:not_null'), "
        "('queried_at:not_null'), ('result:not_null'), ('status:not_null'), ('status:one_of'), "
        "('document_type:one_of'), ('document_type_confidence:at_least'), "
        "('document_type_confidence:at_most')) AS v(rule)",
    }
    raw = {
        "detect_header_row": f"WITH {PUB}, {HEADERS} SELECT key, sheet, header_row FROM title",
        "assemble_rows": f"WITH {RAW} SELECT key, sheet, source_row, column_name AS column, kind, "
        "text FROM cell",
        "profile_columns": f"WITH {PROFILE} SELECT file, sheet, \"column\", position, dtype, "
        "null_rate, distinct_count FROM prof",
        "profile_read_errors": f"WITH {ERRORS} SELECT key AS file, coalesce(sheet, '<unknown>') "
        "AS sheet, '<READ_ERROR>' AS \"column\", CAST(-1 AS BIGINT) AS position, error AS dtype, "
        "0.0::DOUBLE AS null_rate, CAST(0 AS BIGINT) AS distinct_count FROM bad_object",
        "schema_matrix": f"WITH {PROFILE} SELECT \"column\", "
        + ", ".join(
            f"coalesce(string_agg(DISTINCT dtype, '|' ORDER BY dtype) FILTER (period = '{p}'), '') "
            f"AS \"{p}\""
            for p in d.PERIODS
        )
        + ' FROM prof GROUP BY "column"',
        "mapping_outcome": f"WITH {RAW} SELECT DISTINCT pub.key, pub.sheet, pub.period, "
        "CASE WHEN pinned.sheet IS NULL THEN 'unmapped' WHEN skip_reason IS NOT NULL THEN 'skipped' "
        "ELSE 'mapped' END AS outcome, skip_reason FROM pub LEFT JOIN pinned "
        "ON pinned.period = pub.period AND pinned.sheet = pub.sheet",
        "project_canonical": f"WITH {RAW} SELECT c.key, c.sheet, c.source_row, "
        + ", ".join(
            f"max(shown) FILTER (target = '{f}') AS {f}" for f in _FIELD_TEXT
            if f not in ("source_extra_2", "remark")
        )
        + " FROM cell c LEFT JOIN target_field t ON t.period = c.period AND t.sheet = c.sheet "
        "AND t.pos = c.pos GROUP BY c.key, c.sheet, c.source_row",
        "normalize_ok": f"WITH {NORMAL} SELECT {_STAGING_COLUMNS} FROM ok",
        "normalize_rejects": f"WITH {RAW}, {_unmapped_sheet_cells()}, {RAW_JSON} SELECT {_REJECTS} "
        "FROM judged JOIN raw_json r ON r.key = judged.key AND r.sheet = judged.sheet "
        "AND r.source_row = judged.source_row WHERE bad IS NOT NULL",
        "sheet_rejects": f"WITH {RAW}, {_unmapped_sheet_cells()}, {RAW_JSON} SELECT {_REJECTS} "
        "FROM judged JOIN raw_json r ON r.key = judged.key AND r.sheet = judged.sheet "
        "AND r.source_row = judged.source_row WHERE sheet_reason IS NOT NULL",
        "unreadable_rejects": f"WITH {ERRORS} SELECT key, period, coalesce(sheet, '<unknown>') AS "
        "sheet, CAST(NULL AS BIGINT) AS source_row, CASE WHEN sheet IS NULL THEN 'file' ELSE 'sheet' "
        "END || ' unreadable: ' || error AS reason, CAST(NULL AS VARCHAR) AS raw_row FROM bad_object",
        "reconciliation": f"WITH {CAPTURES} SELECT capture_id, key, rows_read, rows_ok, "
        "rows_rejected, CAST(NULL AS VARCHAR) AS error FROM capture "
        f"JOIN (SELECT key, {sha('key')} AS id FROM keys) ON id = capture_id WHERE rows_read > 0",
    }
    raw["reconciliation_total"] = (
        "SELECT count(*) AS files, CAST(sum(rows_read) AS BIGINT) AS rows_read, "
        "CAST(sum(rows_ok) AS BIGINT) AS rows_ok, CAST(sum(rows_rejected) AS BIGINT) AS rows_rejected, "
        f"count(error) AS files_in_error FROM ({raw['reconciliation']})"
    )
    lineage = {
        "build_files": f"WITH {PUB} SELECT {sha('key')} AS file_id, 'judicial_deposits' AS source, "
        "period, 's3://bucket/' || key AS uri, sha256(key || ':' || count(*)) AS content_hash, "
        "CAST(max(d) AS TIMESTAMP) AS detected_at FROM pub GROUP BY key, period",
        "build_captures": f"WITH {CAPTURES} SELECT * FROM capture",
        "capture_status": f"WITH {CAPTURES} SELECT status, count(*) AS captures FROM capture "
        "GROUP BY status",
    }
    identity = {
        "resolve_document_numbers": f"WITH {STG}, {PARTIES} SELECT document_number_raw, "
        f"document_number, {sha('document_number')} AS party_id FROM resolved",
        "build_parties": f"WITH {STG}, {PARTIES} SELECT party_id, document_number, CAST(NULL AS "
        "VARCHAR) AS document_type, CAST(NULL AS DOUBLE) AS document_type_confidence, "
        "CAST(NULL AS VARCHAR) AS document_type_rule_id FROM party",
        "latest_classification": f"WITH {STG}, {PARTIES}, {EVENTS}, {CLASSES} SELECT * FROM cls",
        "apply_classification": f"WITH {STG}, {PARTIES}, {EVENTS}, {CLASSES} SELECT * FROM typed",
        "build_courts": f"WITH {STG}, {COURTS} SELECT * FROM court",
        "build_court_names": f"WITH {STG}, {COURT_NAMES} SELECT * FROM court_name",
        "identity_summary": f"WITH {STG}, {PARTIES}, {EVENTS}, {CLASSES} SELECT count(*) AS parties, "
        "count(*) FILTER (document_type = 'legal_entity') AS legal_entities, "
        "count(*) FILTER (document_type = 'natural_person') AS natural_persons, "
        "count(*) FILTER (document_type IS NULL) AS unclassified, "
        "(SELECT count(DISTINCT account) FROM stg) AS courts, "
        "(SELECT count(*) FROM stg WHERE NOT has_account) AS rows_without_account FROM typed",
    }
    lifecycle = {
        "build_claims": f"WITH {STG}, {CLAIMS} SELECT * FROM claim",
        "build_observations": f"WITH {STG}, {CLAIM_ROWS} SELECT capture_id, sheet, source_row, "
        "claim_id FROM base",
        "build_claim_parties": f"WITH {STG}, {CLAIM_ROWS}, {BRIDGE} SELECT *, CAST(NULL AS VARCHAR) "
        "AS attributes FROM claim_party",
        "measure_persistence": f"WITH {STG}, {CLAIM_ROWS}, seen AS (SELECT DISTINCT claim_id, "
        "period FROM base), sizes AS (SELECT period, count(*) AS n FROM seen GROUP BY period), "
        "steps AS (SELECT a.period AS prev_period, b.period, a.n AS prev_count, b.n AS count "
        "FROM sizes a JOIN sizes b ON b.period = (SELECT min(c.period) FROM sizes c "
        "WHERE c.period > a.period)), "
        "both_sides AS (SELECT s.period, count(*) AS overlap FROM steps s "
        "JOIN seen x ON x.period = s.prev_period JOIN seen y ON y.period = s.period "
        "AND y.claim_id = x.claim_id GROUP BY s.period) "
        "SELECT prev_period, s.period, prev_count, s.count, coalesce(overlap, 0) AS overlap, "
        "round(coalesce(overlap, 0) / prev_count * 100, 2) AS overlap_pct "
        "FROM steps s LEFT JOIN both_sides o ON o.period = s.period",
        "lifecycle_summary": f"WITH {STG}, {CLAIM_ROWS}, {BRIDGE} SELECT "
        "count(DISTINCT claim_id) AS claims, count(*) AS observations, "
        "(SELECT count(*) FROM claim_party) AS claim_party_links, "
        "round(count(*) / count(DISTINCT claim_id), 2) AS avg_observations FROM base",
        "key_collisions": f"WITH {STG}, {CLAIM_ROWS}, groups AS (SELECT period, claim_id, "
        "count(*) AS n, count(DISTINCT (deposit_type, amount_cop, origin_date, classification, "
        "source_extra, plaintiff_id, defendant_id, court_name)) AS contents FROM base "
        "GROUP BY period, claim_id) SELECT period, count(*) FILTER (n > 1) AS repeated_keys, "
        "CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS repeated_rows, "
        "count(*) FILTER (n > 1 AND contents > 1) AS differing_keys FROM groups GROUP BY period",
    }
    enrichment = {
        "parties_to_enrich": f"WITH {STG}, {PARTIES}, {EVENTS}, {PENDING} SELECT party_id, "
        f"document_number FROM pending ORDER BY party_id LIMIT {BATCH}",
        "registry_lookup": f"WITH {STG}, {PARTIES}, {REGISTRY}, target AS (SELECT * FROM party), "
        f"{LOOKUP} SELECT party_id, document_number, matched AS matched_nit, response, detail, error "
        "FROM answer",
        "enrichment_rows": f"WITH {ENRICH} SELECT * FROM attempt WHERE status <> 'error'",
        "enrichment_errors": f"WITH {ENRICH} SELECT * FROM attempt WHERE status = 'error'",
        "enrichment_summary": f"WITH {ENRICH} SELECT count(*) AS queried, count(name) AS found, "
        "count(*) - count(name) AS not_found_or_error, "
        "count(*) FILTER (document_type = 'legal_entity') AS legal_entities, "
        "count(*) FILTER (document_type = 'natural_person') AS natural_persons FROM attempt",
    }
    typed = f"{PARTIES}, {EVENTS}, {CLASSES}"
    search = {
        "find_party": f"WITH {STG}, {typed}, {REQUESTS} SELECT * FROM matched",
        "latest_enrichment": f"WITH {EVENTS}, {LATEST} SELECT * FROM latest",
        "claim_last_period": f"WITH {STG}, {CLAIM_ROWS}, {LAST_PERIOD} SELECT * FROM last_seen",
        "current_court_name": f"WITH {STG}, {COURT_NAMES} SELECT * FROM office",
        "party_deposits": f"WITH {ALL_SEARCH} SELECT * FROM deposit",
        "party_summary": f"WITH {ALL_SEARCH} SELECT * FROM summary",
        "party_period_summary": f"WITH {ALL_SEARCH} SELECT * RENAME (last_period AS period) "
        "FROM by_period",
        "corpus_stats": f"WITH {STG}, {PARTIES}, {CLAIMS} SELECT "
        "(SELECT max(period) FROM stg) AS latest_period, "
        "(SELECT count(*) FROM base) AS observation_count, "
        "(SELECT count(DISTINCT account) FROM stg) AS court_count, "
        "(SELECT count(*) FROM party) AS party_count, "
        "(SELECT CAST(coalesce(sum(amount_cop), 0) AS BIGINT) FROM claim) AS total_amount_cop, "
        "(SELECT round(count(*) / 1000000, 3) FROM party) AS party_count_millions, "
        "(SELECT split_part(max(period), '-', 1) FROM stg) AS latest_year",
        "claim_status": f"WITH {ALL_SEARCH}, {WINDOWS} SELECT party_id, last_period, closes_on, "
        f"CASE WHEN closes_on IS NOT NULL THEN CASE WHEN {AS_OF} <= closes_on THEN 'reclamable' "
        "ELSE 'no_reclamable' END END AS claim_status FROM summary LEFT JOIN win_dates w "
        "ON w.period = last_period",
        "party_currency": f"WITH {ALL_SEARCH} SELECT party_id, last_period, "
        "(SELECT max(period) FROM pub) AS corpus_latest_period, "
        "last_period = (SELECT max(period) FROM pub) AS is_current_publication FROM summary",
        "party_search": f"WITH {ALL_SEARCH}, {typed}, {REQUESTS}, {LATEST}, {WINDOWS} "
        "SELECT raw_value, m.party_id IS NOT NULL AS found, document_number, document_type, "
        "party_name, rues_active, CASE WHEN m.party_id IS NOT NULL THEN coalesce(s.deposit_count, 0) "
        "END AS deposit_count, CASE WHEN m.party_id IS NOT NULL THEN coalesce(s.total_amount_cop, 0) "
        "END AS total_amount_cop, s.court_office_count, s.last_period, "
        "s.plaintiff_count, s.defendant_count, b.deposit_count AS last_period_deposit_count, "
        "b.total_amount_cop AS last_period_amount_cop, "
        f"CASE WHEN closes_on IS NOT NULL THEN CASE WHEN {AS_OF} <= closes_on THEN 'reclamable' "
        "ELSE 'no_reclamable' END END AS claim_status, "
        "s.last_period = (SELECT max(period) FROM pub) AS is_current_publication "
        "FROM matched m LEFT JOIN latest l ON l.party_id = m.party_id "
        "LEFT JOIN summary s ON s.party_id = m.party_id "
        "LEFT JOIN by_period b ON b.party_id = s.party_id AND b.last_period = s.last_period "
        "LEFT JOIN win_dates w ON w.period = s.last_period",
        "raw_to_party_summary": f"WITH {NORMAL}, stg AS (SELECT * FROM ok), {CLAIMS}, {BRIDGE}, "
        f"{COURT_NAMES}, {LAST_PERIOD}, {DEPOSITS}, {SUMMARY} SELECT * FROM summary",
    }
    trips = {
        "staging_round_trip": raw["normalize_ok"],
        "core_round_trip": identity["apply_classification"],
        "history_by_party": identity["latest_classification"],
        "profile_round_trip": raw["profile_columns"],
        "enrichment_round_trip": f"WITH {ENRICH} SELECT * FROM attempt",
        "staging_versions": f"WITH {NORMAL}, seen AS (SELECT 1 AS version, period, amount_cop FROM ok "
        "UNION ALL SELECT 3, period, amount_cop FROM ok WHERE period < '2023-1' "
        "AND (CAST(period[1:4] AS INTEGER) % 2 = 1 OR source_row % 3 > 0)) "
        "SELECT CAST(version AS BIGINT) AS version, period, count(*) AS n, "
        "CAST(sum(amount_cop) AS BIGINT) AS total FROM seen GROUP BY version, period",
        "core_tables_round_trip": _row_digests(
            {
                contracts.FILE: lineage["build_files"],
                contracts.CAPTURE: lineage["build_captures"],
                contracts.PARTY: identity["apply_classification"],
                contracts.COURT: identity["build_courts"],
                contracts.COURT_NAME: identity["build_court_names"],
                contracts.CLAIM: lifecycle["build_claims"],
                contracts.OBSERVATION: lifecycle["build_observations"],
                contracts.CLAIM_PARTY: lifecycle["build_claim_parties"],
            }
        ),
        "read_objects": "WITH line AS (SELECT year(o_orderdate) + 22 || '-' || "
        "CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS period, left(o_orderpriority, 1) AS list, "
        "o_orderkey || ',' || o_custkey || ',' || o_orderstatus AS value FROM orders), "
        "object AS (SELECT period, list, string_agg(value || chr(10), '' ORDER BY value) AS content "
        "FROM line GROUP BY period, list) SELECT 'raw/period=' || period || '/list=' || list AS folder, "
        "strlen(content) AS length, sha256(content) AS content_hash FROM object",
    }
    return {**trips, **scalars, **sources, **raw, **lineage, **identity, **lifecycle, **enrichment, **search}
