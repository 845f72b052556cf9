"""Row-level SQL of the metrics: every visit is paired with every claim, as the
measure is defined. Only meant for small tables; the Spark plans avoid the pairs."""

from __future__ import annotations

from oracle.base import D0, D1, lit, with_base

MATCH = "((NOT r.sw AND x.icd = r.subcode) OR (r.sw AND starts_with(x.icd, r.subcode)))"
DAY = "86400000000.0"


def gap(a: str, b: str) -> str:
    return f"(epoch_us({a}) - epoch_us({b})) / {DAY}"


def cells(metrics, modes, claims: str = "claims") -> list[str]:
    """Common table expressions ending in ``result``."""
    wanted = ", ".join(f"({lit(mode)}, {lit(metric)})" for mode in modes for metric in metrics)
    return [
        f"cell(mode, metric) AS (VALUES {wanted})",
        """rule AS (
  SELECT 'refto10' AS _, m.mode, r.role, r.metric, r.cls, r.sw, x.ten AS subcode
    FROM modes m JOIN rules9 r ON m.moves = 'rules' AND r.cls = 'ICD' AND NOT r.sw AND NOT (r.role='service' AND r.metric='feed' AND r.subcode LIKE '%\\_p' ESCAPE '\\')
    JOIN xwalk x ON x.xname = m.xname AND x.nine = r.subcode
  UNION SELECT '', m.mode, r.role, r.metric, r.cls, r.sw, x.ten
    FROM modes m JOIN rules9 r ON m.moves = 'rules' AND r.cls = 'ICD' AND r.sw
    JOIN xwalk x ON x.xname = m.xname AND starts_with(x.nine, r.subcode)
  UNION SELECT '', m.mode, r.role, r.metric, r.cls, r.sw, x.h10
    FROM modes m JOIN rules9 r ON m.moves = 'rules' AND r.cls = 'HCC'
    JOIN xwalk x ON x.xname = m.xname AND x.h9 = r.subcode WHERE x.h10 IS NOT NULL
  UNION SELECT '', m.mode, r.role, r.metric, r.cls, r.sw, x.c10
    FROM modes m JOIN rules9 r ON m.moves = 'rules' AND r.cls = 'CCS'
    JOIN xwalk x ON x.xname = m.xname AND x.c9 = r.subcode WHERE x.c10 IS NOT NULL
  UNION SELECT '', m.mode, r.role, r.metric, r.cls, r.sw, r.subcode
    FROM modes m JOIN rules9 r ON m.moves = 'rules' AND r.cls NOT IN ('ICD','HCC','CCS')
  UNION SELECT '', m.mode, r.role, r.metric, r.cls, r.sw, coalesce(g.ICD10_subcode, replace(r.subcode, '_p', ''))
    FROM modes m JOIN rules9 r ON m.moves = 'rules' AND m.procs AND r.role='service' AND r.metric='feed' AND r.subcode LIKE '%\\_p' ESCAPE '\\'
    LEFT JOIN gem g ON g.ICD9_TYPE = 'ICD_9_PROC_CODE' AND g.MAPPING_EXPIRATION_DATE IS NULL AND g.ICD9_subcode = replace(r.subcode, '_p', '')
  UNION SELECT '', m.mode, r.role, r.metric, r.cls, r.sw, r.subcode FROM modes m JOIN rules9 r ON m.moves = 'claims'
  UNION SELECT '', m.mode, r.role, r.metric, r.cls, r.sw, r.subcode FROM modes m JOIN rules10 r ON m.moves = 'none')""",
        f"""view AS (
  SELECT m.mode, c.MRN, c.EVT_DATE, c.age, c.GENDER, c.ICD10_subcode AS icd, h.hcclev AS hcc, s.ccslev AS ccs
    FROM modes m, {claims} c LEFT JOIN hcc10 h ON h.subcode = c.ICD10_subcode LEFT JOIN ccs10 s ON s.subcode = c.ICD10_subcode
    WHERE m.moves = 'rules'
  UNION ALL SELECT m.mode, c.MRN, c.EVT_DATE, c.age, c.GENDER, c.ICD10_subcode, NULL, NULL FROM modes m, {claims} c WHERE m.moves = 'none'
  UNION ALL SELECT m.mode, c.MRN, c.EVT_DATE, c.age, c.GENDER, x.nine, x.h9, x.c9
    FROM modes m JOIN xwalk x ON m.moves = 'claims' AND x.xname = m.xname JOIN {claims} c ON c.ICD10_subcode = x.ten)""",
        """c AS MATERIALIZED (
  SELECT e.mode, e.metric, v.MRN, v.EVT_DATE, v.icd, v.hcc, v.ccs FROM cell e JOIN view v ON v.mode = e.mode
  JOIN demo d ON d.key = e.metric WHERE v.age >= d.agemin AND v.age < d.agemax AND (d.gendercrit = 'All' OR v.GENDER = d.gendercrit))""",
        """s AS MATERIALIZED (
  SELECT e.mode, e.metric, v.MRN, v.ENC_ID, v.CODE, v.EVT_DATE, v.age FROM cell e JOIN settings t ON t.metric = e.metric
  JOIN demo d ON d.key = e.metric JOIN (SELECT 'service' AS source, * FROM services UNION ALL SELECT 'drug', * FROM drugs) v ON v.source = t.source
  WHERE v.age >= d.agemin AND v.age < d.agemax AND (d.gendercrit = 'All' OR v.GENDER = d.gendercrit))""",
        f"""dx AS MATERIALIZED (
  SELECT x.mode, x.metric, x.MRN, min(x.EVT_DATE) AS first_dx FROM c x
  JOIN rule r ON r.mode = x.mode AND r.metric = x.metric AND r.role = 'indication' AND {MATCH} GROUP BY ALL)""",
        """cs AS (
  SELECT s.* FROM s JOIN settings t USING (metric) WHERE NOT t.dx_tied
  UNION ALL SELECT s.* FROM s JOIN settings t USING (metric) JOIN dx USING (mode, metric, MRN)
  WHERE t.dx_tied AND (NOT t.after_dx OR s.EVT_DATE >= dx.first_dx))""",
        """t0 AS MATERIALIZED (
  SELECT cs.mode, cs.metric, cs.MRN, cs.ENC_ID, cs.CODE AS TEST_CODE, cs.EVT_DATE AS TEST_DATE, cs.age FROM cs
  WHERE EXISTS (SELECT 1 FROM rule r WHERE r.mode = cs.mode AND r.metric = cs.metric AND r.role = 'service' AND r.subcode = cs.CODE))""",
        """op AS (
  SELECT s.mode, s.metric, s.MRN, s.EVT_DATE AS SURG_DATE FROM s JOIN surg g ON g.metric = s.metric AND g.code = s.CODE)""",
        """withadm AS (
  SELECT t.*, op.SURG_DATE, op.SURG_DATE AS idx,
         CASE WHEN cast(a.ADM_DT as date) <> cast(op.SURG_DATE as date) THEN a.ADM_DT END AS adm,
         CASE WHEN cast(a.ADM_DT as date) <> cast(op.SURG_DATE as date) THEN a.DIS_DT END AS dis
    FROM t0 t JOIN settings e ON e.metric = t.metric AND e.admission = 'surgery'
    JOIN op ON op.mode = t.mode AND op.metric = t.metric AND op.MRN = t.MRN AND t.TEST_DATE < op.SURG_DATE
    LEFT JOIN adm a ON a.MRN = t.MRN
  UNION ALL
  SELECT t.*, cast(NULL as timestamp), t.TEST_DATE, a.ADM_DT, a.DIS_DT
    FROM t0 t JOIN settings e ON e.metric = t.metric AND e.admission = 'test' LEFT JOIN adm a ON a.MRN = t.MRN)""",
        f"""t1 AS MATERIALIZED (
  SELECT mode, metric, MRN, ENC_ID, TEST_CODE, TEST_DATE, age, SURG_DATE, cast(adm as date) AS ADM_DT_a,
         coalesce(date_diff('day', cast(adm as date), cast(idx as date)) < e.win, false)
           OR coalesce({gap('TEST_DATE', 'dis')} < e.win, false) AS flag
    FROM (SELECT *, rank() OVER (PARTITION BY mode, metric, MRN, TEST_CODE, TEST_DATE
                                 ORDER BY cast(adm as date) DESC NULLS LAST, dis DESC NULLS LAST) AS k
          FROM withadm WHERE (adm IS NULL OR idx >= adm) AND (dis IS NULL OR idx >= dis)) JOIN settings e USING (metric)
    WHERE k = 1
  UNION ALL SELECT t.mode, t.metric, t.MRN, t.ENC_ID, t.TEST_CODE, t.TEST_DATE, t.age, NULL, NULL, false
    FROM t0 t JOIN settings e ON e.metric = t.metric WHERE e.admission IS NULL)""",
        f"""trimmed AS (
  SELECT DISTINCT x.* FROM c x JOIN rule r ON r.mode = x.mode AND r.metric = x.metric
   AND ({MATCH} OR (NOT r.sw AND (x.hcc = r.subcode OR x.ccs = r.subcode))))""",
        """h AS MATERIALIZED (
  SELECT t.*, x.EVT_DATE AS CLAIM_DATE, x.icd, x.hcc, x.ccs FROM t1 t JOIN settings e ON e.metric = t.metric AND e.needs_claim
    JOIN c x ON x.mode = t.mode AND x.metric = t.metric AND x.MRN = t.MRN AND x.EVT_DATE <= t.TEST_DATE WHERE x.icd IS NOT NULL
  UNION ALL SELECT t.*, x.EVT_DATE, x.icd, x.hcc, x.ccs FROM t1 t JOIN settings e ON e.metric = t.metric AND NOT e.needs_claim
    JOIN trimmed x ON x.mode = t.mode AND x.metric = t.metric AND x.MRN = t.MRN AND x.EVT_DATE <= t.TEST_DATE WHERE t.metric <> 'feed'
  UNION ALL SELECT t.*, NULL, NULL, NULL, NULL FROM t1 t JOIN settings e ON e.metric = t.metric AND NOT e.needs_claim)""",
        """sec AS MATERIALIZED (
  SELECT DISTINCT e.mode, e.metric, v.MRN, v.EVT_DATE AS rDATE, v.CODE AS rCODE FROM cell e
    JOIN settings t ON t.metric = e.metric AND t.secondary IS NOT NULL
    JOIN rule r ON r.mode = e.mode AND r.metric = e.metric AND r.role <> 'service' AND r.cls IN ('CPT','DRUG')
    JOIN services v ON v.CODE = r.subcode JOIN demo d ON d.key = e.metric
    WHERE t.secondary = 'all' OR (v.age >= d.agemin AND v.age < d.agemax AND (d.gendercrit = 'All' OR v.GENDER = d.gendercrit)))""",
        f"""hs AS MATERIALIZED (
  SELECT h.*, sec.rCODE, {gap('h.TEST_DATE', 'sec.rDATE')} AS rgap FROM h JOIN settings e ON e.metric = h.metric
    LEFT JOIN sec ON sec.mode = h.mode AND sec.metric = h.metric AND sec.MRN = h.MRN
    WHERE (sec.rDATE IS NULL OR h.TEST_DATE >= sec.rDATE) AND NOT (e.admission = 'test' AND h.flag IS TRUE AND e.admission IS NOT NULL)
      AND (e.admission IS NULL OR e.admission <> 'surgery' OR {gap('h.SURG_DATE', 'h.TEST_DATE')} <= e.win))""",
        """lagged AS (
  SELECT MRN, ENC_ID, EVT_DATE, lag(EVT_DATE) OVER (PARTITION BY MRN ORDER BY EVT_DATE) AS prev FROM (
    SELECT v.MRN, v.EVT_DATE, min(v.ENC_ID) AS ENC_ID FROM scans v JOIN demo d ON d.key = 'dexa'
    WHERE v.age >= d.agemin AND v.age < d.agemax AND (d.gendercrit = 'All' OR v.GENDER = d.gendercrit) GROUP BY ALL))""",
        f"""rep AS (SELECT lagged.* FROM lagged JOIN settings e ON e.metric = 'dexa' WHERE {gap('EVT_DATE', 'prev')} < e.win)""",
        f"""n0 AS MATERIALIZED (
  SELECT hs.* FROM hs JOIN settings e ON e.metric = hs.metric
    LEFT JOIN (SELECT mode, metric, min(TEST_DATE) AS begin FROM hs GROUP BY ALL) b ON b.mode = hs.mode AND b.metric = hs.metric
  WHERE hs.TEST_DATE >= TIMESTAMP '{D0}' AND (NOT e.repeat_scan OR (
    hs.MRN IN (SELECT MRN FROM rep WHERE rep.EVT_DATE >= b.begin) AND hs.ENC_ID IN (SELECT ENC_ID FROM rep))))""",
        f"""outs AS MATERIALIZED (
  SELECT DISTINCT x.mode, x.metric, x.MRN FROM (SELECT *, {gap('TEST_DATE', 'CLAIM_DATE')} AS gap FROM n0) x JOIN settings e ON e.metric = x.metric
  JOIN rule r ON r.mode = x.mode AND r.metric = x.metric AND r.role = 'redflag'
  WHERE x.gap >= 0 AND x.gap <= e.lookback AND x.metric <> 'feed' AND (
    (r.cls = 'ICD' AND {MATCH}) OR (r.cls = 'HCC' AND x.hcc = r.subcode) OR (r.cls = 'CCS' AND x.ccs = r.subcode)
    OR (r.cls = 'CPT' AND x.rCODE = r.subcode AND NOT coalesce(x.rgap > e.secwin, false))))""",
        f"""n1 AS (
  SELECT x.* FROM n0 x JOIN settings e ON e.metric = x.metric
  WHERE NOT EXISTS (SELECT 1 FROM outs o WHERE o.mode = x.mode AND o.metric = x.metric AND o.MRN = x.MRN)
    AND NOT (e.admission IS NOT NULL AND x.flag)
    AND NOT (e.cull AND {gap('x.TEST_DATE', 'x.CLAIM_DATE')} >= e.win AND EXISTS (
      SELECT 1 FROM rule r WHERE r.mode = x.mode AND r.metric = x.metric AND r.role = 'indication' AND (
        (r.cls = 'ICD' AND x.icd = r.subcode) OR (r.cls = 'HCC' AND x.hcc = r.subcode) OR (r.cls = 'CCS' AND x.ccs = r.subcode)))))""",
        """firsts AS (SELECT c.mode, c.metric, c.MRN, min(EVT_DATE) AS first_any FROM c JOIN settings e USING (metric)
  WHERE e.needs_claim AND icd IS NOT NULL GROUP BY ALL)""",
        """terms AS (
  SELECT 'numerator' AS term, mode, metric, MRN, ENC_ID, TEST_CODE, TEST_DATE, age, ADM_DT_a, SURG_DATE FROM n1
  UNION ALL SELECT 'denominator', hs.mode, hs.metric, hs.MRN, hs.ENC_ID, hs.TEST_CODE, hs.TEST_DATE, hs.age, hs.ADM_DT_a, hs.SURG_DATE
    FROM hs JOIN settings e USING (metric) WHERE NOT e.monthly)""",
        """by_service AS (
  SELECT term, q.mode, q.metric, q.MRN, ENC_ID, TEST_CODE, TEST_DATE, age, ADM_DT_a, last_op AS SURG_DATE, f.first_any AS CLAIM_DATE
  FROM (SELECT *, max(SURG_DATE) OVER (PARTITION BY term, mode, metric, MRN, TEST_CODE, TEST_DATE) AS last_op,
               row_number() OVER (PARTITION BY term, mode, metric, MRN, cast(TEST_DATE as date), TEST_CODE
                                  ORDER BY TEST_DATE, ENC_ID NULLS FIRST, age) AS k FROM terms) q
  LEFT JOIN firsts f ON f.mode = q.mode AND f.metric = q.metric AND f.MRN = q.MRN WHERE k = 1)""",
        f"""monthly AS (
  SELECT mode, metric, MRN, ENC_ID, CODE AS TEST_CODE, EVT_DATE AS TEST_DATE, age FROM (
    SELECT cs.*, row_number() OVER (PARTITION BY cs.mode, cs.metric, MRN, date_trunc('month', EVT_DATE)
                                 ORDER BY EVT_DATE, CODE, ENC_ID NULLS FIRST) AS k
    FROM cs JOIN settings e USING (metric) WHERE e.monthly AND EVT_DATE >= TIMESTAMP '{D0}') WHERE k = 1)""",
        """evidence AS (
  SELECT DISTINCT x.mode, x.MRN, x.EVT_DATE, x.icd FROM c x JOIN modes m ON m.mode = x.mode AND m.procs
  JOIN dx ON dx.mode = x.mode AND dx.metric = x.metric AND dx.MRN = x.MRN
  JOIN rule r ON r.mode = x.mode AND r.metric = 'feed' AND r.role = 'service' AND NOT r.sw AND r.subcode = x.icd WHERE x.metric = 'feed')""",
        f"""coded AS (
  SELECT e.mode, e.MRN, e.EVT_DATE AS CLAIM_DATE, v.ENC_ID, v.TEST_CODE, v.TEST_DATE, v.age FROM evidence e
  JOIN (SELECT *, row_number() OVER (PARTITION BY mode, MRN ORDER BY TEST_DATE, TEST_CODE, ENC_ID) AS k FROM monthly WHERE metric = 'feed') v
    ON v.mode = e.mode AND v.MRN = e.MRN AND v.k = 1 WHERE e.EVT_DATE >= TIMESTAMP '{D0}')""",
        f"""everything AS (
  SELECT mode, metric, term, MRN, ENC_ID, TEST_CODE, TEST_DATE, age, CLAIM_DATE, ADM_DT_a, SURG_DATE,
         CASE WHEN metric = 'feed' THEN 'CPT' END AS based_on FROM by_service b
    WHERE NOT (metric = 'feed' AND EXISTS (SELECT 1 FROM evidence e WHERE e.mode = b.mode AND e.MRN = b.MRN))
  UNION ALL SELECT mode, 'feed', 'numerator', MRN, ENC_ID, TEST_CODE, TEST_DATE, age, CLAIM_DATE, NULL, NULL, 'ICD' FROM coded
  UNION ALL SELECT mode, metric, 'denominator', MRN, ENC_ID, TEST_CODE, TEST_DATE, age, NULL, NULL, NULL, NULL FROM monthly)""",
        f"""result AS MATERIALIZED (
  SELECT mode, metric, term, MRN, ENC_ID, TEST_CODE, TEST_DATE, cast(TEST_DATE as date) AS TEST_DATE_a,
         year(TEST_DATE) || '_' || month(TEST_DATE) AS TEST_DATE_month, age AS AgeAtTest,
         CLAIM_DATE, ADM_DT_a, SURG_DATE, based_on
  FROM everything WHERE TEST_DATE >= TIMESTAMP '{D0}' AND TEST_DATE < TIMESTAMP '{D1}')""",
    ]


SHOWN = """SELECT mode, metric, term, MRN, ENC_ID, TEST_CODE, cast(TEST_DATE_a as varchar) AS TEST_DATE_a, TEST_DATE_month,
  AgeAtTest, cast(cast(CLAIM_DATE as date) as varchar) AS CLAIM_DATE, cast(ADM_DT_a as varchar) AS ADM_DT_a,
  cast(cast(SURG_DATE as date) as varchar) AS SURG_DATE, based_on FROM result"""


def result_sql(metrics, modes, claims: str = "claims", body: str = SHOWN, extra: list[str] | None = None) -> str:
    return with_base(body, cells(metrics, modes, claims) + (extra or []))
