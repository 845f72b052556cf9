"""Base relations of the oracle queries, as DuckDB common table expressions."""

from __future__ import annotations

import re

from lowtide.model import METRICS, MODES
from lowtide.sources import vocabulary as V
from lowtide.sources.clinical import STUDY


def lit(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def values(name: str, columns: list[str], rows: list[tuple]) -> str:
    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"{name}({', '.join(columns)}) AS (VALUES {body})"


def _mrn(column: str) -> str:
    return f"lpad(cast({column} as varchar), 9, '0')"


DIAG = f"(o_orderkey * 7 + o_custkey) % {len(V.DIAGNOSES)}"
D0, D1 = STUDY.start.isoformat(), STUDY.end.isoformat()
FROM, ADM_TO = STUDY.service_from.isoformat(), STUDY.admissions_to.isoformat()

BASE: list[tuple[str, str]] = []


def add(sql: str) -> None:
    BASE.append((sql.split("(")[0].split(" ")[0].strip(), sql))


add(values("diag", ["i", "ten", "nine"], [(i, t, n) for i, (t, n) in enumerate(V.DIAGNOSES)]))
add(values("proc", ["i", "code"], list(enumerate(V.PROCEDURES))))
add(values("written9", ["role", "metric", "cls", "code"], V.RULES[9]))
add(values("written10", ["role", "metric", "cls", "code"], V.RULES[10]))
add(values("demo", ["key", "agemin", "agemax", "gendercrit"], V.DEMOGRAPHICS))
add(values("surg", ["metric", "code"], V.SURGERY))
add(values("gem", ["ICD9_CODE", "ICD10_CODE", "ICD9_subcode", "ICD10_subcode", "ICD9_TYPE", "ICD10_TYPE", "ICD9_DESC",
                   "ICD10_DESC", "RELATION_TYPE", "MAPPING_EXPIRATION_DATE"], V.crosswalk_rows()))
for _kind in ("hcc", "ccs"):
    for _g in (9, 10):
        add(values(f"{_kind}{_g}", ["subcode", f"{_kind}lev"], V.levels(_kind, _g)))
add(values("drug_map", ["token", "drug"], V.DRUG_NAMES))
add(values("fee", ["HCPCS", "MOD", "DESCRIPTION", "TOTAL", "DOLLARS"], V.fee_rows()))
add(values("price", ["token", "drug", "unit"], V.DRUG_PRICES))
add(values("settings", ["metric", "source", "win", "lookback", "dx_tied", "after_dx", "monthly", "needs_claim",
                        "secondary", "secwin", "admission", "repeat_scan", "cull"],
           [(m.name, m.source, m.window, m.lookback, m.dx_tied, m.after_dx, m.monthly, m.needs_claim, m.secondary,
             m.secondary_window, m.admission, m.repeat_scan, m.cull_old_complaint) for m in METRICS.values()]))
add(values("modes", ["mode", "basis", "moves", "xname", "procs"],
           [(m.name, m.basis, m.moves, m.crosswalk, m.procedures) for m in MODES.values()]))
add(f"""patient AS (
  SELECT {_mrn('c_custkey')} AS MRN, DATE '1920-01-01' + cast((c_custkey * 7919) % 25000 as int) AS DOB,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS GENDER FROM customer)""")
add(f"""raw_claim AS (
  SELECT {_mrn('o_custkey')} AS MRN, cast(o_orderkey as varchar) AS ENC_ID, o_orderdate AS EVT_DATE,
         d.ten AS CODE, d.nine AS ICD9_CODE FROM orders JOIN diag d ON d.i = {DIAG})""")
add("""claim AS (
  SELECT r.*, p.GENDER, p.DOB, date_diff('day', p.DOB, cast(r.EVT_DATE as date)) AS AGEATCLAIM
  FROM raw_claim r JOIN patient p USING (MRN))""")
add(f"""proc_claim AS (
  SELECT r.*, p.GENDER, p.DOB, date_diff('day', p.DOB, cast(r.EVT_DATE as date)) AS AGEATCLAIM FROM (
    SELECT * FROM raw_claim UNION ALL
    SELECT {_mrn('o_custkey')}, cast(o_orderkey as varchar), o_orderdate, '{V.FEEDING_TUBE_PCS}', '43.11' FROM orders
    WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 29 = 0) r JOIN patient p USING (MRN))""")
add(f"""older_raw AS (
  SELECT {_mrn('o_custkey')} AS MRN, cast(o_orderkey as varchar) AS ENC_ID, o_orderdate AS EVT_DATE, d.nine AS CODE
  FROM orders JOIN diag d ON d.i = {DIAG})""")
add(f"""raw_service AS (
  SELECT {_mrn('o_custkey')} AS MRN, cast(l_orderkey as varchar) AS ENC_ID, c.code AS CODE, l_shipdate AS EVT_DATE
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN proc c ON c.i = l_partkey % 20)""")
add("""service AS (
  SELECT r.*, p.GENDER, p.DOB, date_diff('day', p.DOB, cast(r.EVT_DATE as date)) AS AGEATCLAIM
  FROM raw_service r JOIN patient p USING (MRN))""")
add(f"""raw_rx AS (
  SELECT {_mrn('o_custkey')} AS MRN, p_name AS MED_NAME, l_shipdate AS ENTRY_DATE
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R')""")
add("""rx AS (
  SELECT r.*, p.GENDER, p.DOB, date_diff('day', p.DOB, cast(r.ENTRY_DATE as date)) AS AGEATCLAIM
  FROM raw_rx r JOIN patient p USING (MRN))""")
add(f"""encounter AS (
  SELECT {_mrn('o_custkey')} AS MRN, cast(o_orderkey as varchar) AS ENC_ID, o_orderdate AS ADM_DT,
         o_orderdate + to_days(cast(o_orderkey % 6 + 1 as int)) AS DIS_DT,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'I' WHEN '2' THEN 'O' WHEN '3' THEN 'E' WHEN '4' THEN 'I'
              WHEN '5' THEN 'P' END AS PT_CLASS,
         CASE WHEN o_orderkey % 2 = 0 THEN 'GMD' ELSE 'OUT' END AS SRV_CODE
  FROM orders WHERE o_orderstatus = 'F')""")
add("""qualified AS (
  SELECT * FROM encounter WHERE PT_CLASS NOT IN ('O','B','E','P','N','U')
     OR (PT_CLASS = 'O' AND SRV_CODE IN ('GMD','HEM','PGS','TXN')))""")
add(f"""adm AS (
  SELECT MRN, ADM_DT, DIS_DT FROM qualified
  WHERE ADM_DT >= TIMESTAMP '{FROM}' AND ADM_DT <= TIMESTAMP '{ADM_TO}')""")
# normalised, bounded tables
add(f"""claims AS (
  SELECT MRN, EVT_DATE, replace(CODE, '.', '') AS ICD10_subcode, replace(ICD9_CODE, '.', '') AS ICD9_subcode,
         round(AGEATCLAIM / 365.25, 1) AS age, GENDER FROM claim
  WHERE EVT_DATE >= TIMESTAMP '{FROM}' AND EVT_DATE < TIMESTAMP '{D1}')""")
add(f"""proc_claims AS (
  SELECT MRN, EVT_DATE, replace(CODE, '.', '') AS ICD10_subcode, replace(ICD9_CODE, '.', '') AS ICD9_subcode,
         round(AGEATCLAIM / 365.25, 1) AS age, GENDER FROM proc_claim
  WHERE EVT_DATE >= TIMESTAMP '{FROM}' AND EVT_DATE < TIMESTAMP '{D1}')""")
add(f"""services AS (
  SELECT MRN, ENC_ID, CODE, EVT_DATE, round(AGEATCLAIM / 365.25, 1) AS age, GENDER FROM service
  WHERE (ENC_ID IS NULL OR ENC_ID <> '') AND EVT_DATE >= TIMESTAMP '{FROM}' AND EVT_DATE < TIMESTAMP '{D1}')""")
add(f"""drugs AS (
  SELECT MRN, cast(NULL as varchar) AS ENC_ID,
         CASE WHEN lower(MED_NAME) = 'old widget' THEN 'd03431' ELSE m.drug END AS CODE, ENTRY_DATE AS EVT_DATE,
         round(AGEATCLAIM / 365.25, 1) AS age, GENDER
  FROM rx LEFT JOIN drug_map m ON m.token = split_part(lower(MED_NAME), ' ', 1)
  WHERE ENTRY_DATE >= TIMESTAMP '{FROM}' AND ENTRY_DATE < TIMESTAMP '{D1}'
    AND (lower(MED_NAME) = 'old widget' OR m.drug IS NOT NULL))""")
add(f"""scans AS (
  SELECT r.MRN, r.ENC_ID, r.EVT_DATE, p.GENDER,
         round(date_diff('day', p.DOB, cast(r.EVT_DATE as date)) / 365.2425, 1) AS age
  FROM raw_service r LEFT JOIN patient p USING (MRN)
  WHERE CODE IN ('0028T','76075','76076','77080','77081')
    AND EVT_DATE >= TIMESTAMP '{FROM}' AND EVT_DATE < TIMESTAMP '{D1}')""")
# rules
add("""rules9 AS (
  SELECT DISTINCT role, metric, cls, regexp_replace(replace(code, '.', ''), '[xX]', '', 'g') AS subcode,
         lower(right(replace(code, '.', ''), 1)) = 'x' AS sw FROM written9)""")
add("""rules10 AS (
  SELECT DISTINCT role, metric, cls, replace(replace(code, '.', ''), '_', '') AS subcode,
         contains(code, '_') AS sw FROM written10)""")
# crosswalks
add("""live AS (SELECT ICD9_subcode AS nine, replace(ICD10_subcode, 'x', 'X') AS ten, ICD9_TYPE, ICD10_TYPE
  FROM gem WHERE MAPPING_EXPIRATION_DATE IS NULL)""")
add("""best9 AS (SELECT nine, ten FROM (SELECT nine, ten, row_number() OVER (PARTITION BY nine
    ORDER BY cast(h.hcclev as int) ASC NULLS LAST, ten DESC) AS n
  FROM live LEFT JOIN hcc10 h ON h.subcode = ten WHERE ICD9_TYPE = 'ICD_9_CM_CODE') WHERE n = 1)""")
add("""reimb AS (SELECT nine, ten FROM (SELECT nine, ten, row_number() OVER (PARTITION BY ten
    ORDER BY cast(h.hcclev as int) DESC NULLS LAST, nine ASC) AS n
  FROM live LEFT JOIN hcc9 h ON h.subcode = nine WHERE ICD10_TYPE = 'ICD10CM_CODE') WHERE n = 1)""")
add("""pairs AS (
  SELECT 'gems' AS xname, nine, ten FROM live WHERE ICD9_TYPE = 'ICD_9_CM_CODE'
  UNION ALL SELECT 'bestMap9', nine, ten FROM best9
  UNION ALL SELECT 'bestMap10', nine, ten FROM live WHERE ICD10_TYPE = 'ICD10CM_CODE'
  UNION ALL SELECT 'reimburse', nine, ten FROM reimb)""")
add("""xwalk AS (
  SELECT p.*, h9.hcclev AS h9, c9.ccslev AS c9, h10.hcclev AS h10, c10.ccslev AS c10 FROM pairs p
  LEFT JOIN hcc9 h9 ON h9.subcode = nine LEFT JOIN ccs9 c9 ON c9.subcode = nine
  LEFT JOIN hcc10 h10 ON h10.subcode = ten LEFT JOIN ccs10 c10 ON c10.subcode = ten)""")
# gold
add(f"""owner AS (SELECT code, min(metric) AS metric FROM written10 WHERE role = 'service' AND cls = 'CPT' GROUP BY code)""")
add(f"""gold AS (
  SELECT 'CW_' || w.metric AS Metric, {_mrn('o_custkey')} AS MRN, c.code AS TEST_CODE,
         cast(l_shipdate as date) AS TEST_DATE_a, year(l_shipdate) || '_' || month(l_shipdate) AS TEST_DATE_month,
         CASE WHEN l_linenumber = 7 THEN 'See comment' WHEN l_quantity >= 25 THEN 'Numer' ELSE 'Not_Numer' END AS Term_assessed,
         'Y' AS Gold_Standard
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN proc c ON c.i = l_partkey % 20 JOIN owner w ON w.code = c.code
  WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01')""")
_LETTER = "chr(cast(65 + l_partkey % 26 as int))"
add(f"""wide AS (
  SELECT *, replace(ICD9_CODE, '.', '') AS ICD9_subcode, replace(ICD10_CODE, '.', '') AS ICD10_subcode,
         'nine ' || ICD9_CODE AS ICD9_DESC, 'ten ' || ICD10_CODE AS ICD10_DESC FROM (
    SELECT lpad(cast(l_suppkey % 1000 as varchar), 3, '0') || '.' || (l_suppkey % 7) AS ICD9_CODE,
           {_LETTER} || lpad(cast(l_partkey % 100 as varchar), 2, '0') || '.' || l_partkey
             || CASE WHEN l_partkey % 4 = 0 THEN 'x' ELSE '' END AS ICD10_CODE,
           CASE WHEN l_suppkey % 10 = 0 THEN 'ICD_9_PROC_CODE' ELSE 'ICD_9_CM_CODE' END AS ICD9_TYPE,
           CASE WHEN l_partkey % 10 = 0 THEN 'ICD10PCS_CODE' ELSE 'ICD10CM_CODE' END AS ICD10_TYPE,
           CASE WHEN (l_partkey + l_suppkey) % 5 = 0 THEN 'Approximate' ELSE 'Equal' END AS RELATION_TYPE,
           CASE WHEN (l_partkey + l_suppkey) % 7 = 0 THEN DATE '2014-09-30' END AS MAPPING_EXPIRATION_DATE
    FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)))""")


def with_base(body: str, extra: list[str] | None = None, given: frozenset[str] = frozenset()) -> str:
    """``body`` under the base relations it reaches (found by name), but for those ``given`` as tables."""
    extra = extra or []
    text = " ".join(extra) + " " + body
    needed: set[str] = set()
    frontier = [text]
    words = {name: re.compile(rf"\b{name}\b") for name, _ in BASE}
    while frontier:
        chunk = frontier.pop()
        for name, sql in BASE:
            if name not in needed and name not in given and words[name].search(chunk):
                needed.add(name)
                frontier.append(sql)
    parts = [sql for name, sql in BASE if name in needed] + extra
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
