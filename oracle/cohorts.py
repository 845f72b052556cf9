"""Oracle SQL: cohorts, joins, denominators, numerators, windows."""

from lowtide.model import METRIC_NAMES, MODES
from oracle.base import D0, D1, with_base
from oracle.cells import cells, gap, result_sql
from oracle.tables import PART_RULES

RULE = cells(["lbp"], ["10to10"])[1]


def rules(metric: str, role: str, mode: str = "10to10", name: str = "r0") -> str:
    return f"{name} AS (SELECT * FROM rule WHERE mode = '{mode}' AND metric = '{metric}' AND role = '{role}')"


def hit(code: str, r: str = "r") -> str:
    return f"(({r}.sw AND starts_with({code}, {r}.subcode)) OR (NOT {r}.sw AND {code} = {r}.subcode))"


SVC = "MRN, ENC_ID, CODE, cast(EVT_DATE as varchar) AS EVT_DATE"
TEST = "t.MRN, t.ENC_ID, t.TEST_CODE, cast(t.TEST_DATE as varchar) AS TEST_DATE"
TESTS = "tests AS (SELECT row_number() OVER () AS id, MRN, ENC_ID, CODE AS TEST_CODE, EVT_DATE AS TEST_DATE FROM services)"


def tests_of(metric: str) -> list[str]:
    return [RULE, rules(metric, "service", name="rs"),
            """tests AS (SELECT row_number() OVER () AS id, MRN, ENC_ID, CODE AS TEST_CODE, EVT_DATE AS TEST_DATE FROM services
  WHERE CODE IN (SELECT subcode FROM rs))"""]


LEVELLED = """levelled AS (SELECT c.*, h.hcclev AS hcc, s.ccslev AS ccs FROM claims c LEFT JOIN hcc10 h ON h.subcode = c.ICD10_subcode
  LEFT JOIN ccs10 s ON s.subcode = c.ICD10_subcode)"""


def flagged(metric: str, role: str, mode: str) -> list[str]:
    return [RULE, rules(metric, role, mode), LEVELLED, f"""flagged AS (
  SELECT DISTINCT l.MRN, l.EVT_DATE FROM levelled l JOIN r0 r ON (r.cls = 'ICD' AND {hit('l.ICD10_subcode')})
    OR (r.cls = 'HCC' AND l.hcc = r.subcode) OR (r.cls = 'CCS' AND l.ccs = r.subcode))"""]


def _history(join: str) -> str:
    return with_base(f"""SELECT {TEST}, count(c.MRN) AS n_claims, cast(min(c.EVT_DATE) as varchar) AS first_claim,
  cast(max(c.EVT_DATE) as varchar) AS last_claim, {gap('t.TEST_DATE', 'min(c.EVT_DATE)')} AS first_gap, {gap('t.TEST_DATE', 'max(c.EVT_DATE)')} AS last_gap
  FROM tests t {join} JOIN claims c ON c.MRN = t.MRN AND c.EVT_DATE <= t.TEST_DATE AND c.ICD10_subcode IS NOT NULL
  GROUP BY t.id, t.MRN, t.ENC_ID, t.TEST_CODE, t.TEST_DATE""", [TESTS])


_OPS = "ops AS (SELECT MRN, EVT_DATE AS at FROM services v JOIN surg g ON g.code = v.CODE AND g.metric = 'nonpreop')"
_AHEAD = """ahead AS (SELECT t.id, t.MRN, t.ENC_ID, t.TEST_CODE, t.TEST_DATE, count(*) AS n_surgeries, min(o.at) AS next_surgery, max(o.at) AS last_surgery
  FROM tests t JOIN ops o ON o.MRN = t.MRN AND o.at > t.TEST_DATE GROUP BY ALL)"""
_RX = "rxt AS (SELECT row_number() OVER () AS id, MRN, CODE AS TEST_CODE, EVT_DATE AS TEST_DATE FROM drugs)"
_BEST = """best AS (SELECT t.*, cast(a.ADM_DT as date) AS ADM_DT_a, a.DIS_DT, row_number() OVER (PARTITION BY t.id
    ORDER BY cast(a.ADM_DT as date) DESC NULLS LAST, a.DIS_DT DESC NULLS LAST) AS k
  FROM rxt t LEFT JOIN adm a ON a.MRN = t.MRN WHERE a.MRN IS NULL OR (t.TEST_DATE >= a.ADM_DT AND t.TEST_DATE >= a.DIS_DT))"""
_BEST_KEEP = """best AS (SELECT t.*, cast(a.ADM_DT as date) AS ADM_DT_a, a.DIS_DT, row_number() OVER (PARTITION BY t.id
    ORDER BY cast(a.ADM_DT as date) DESC NULLS LAST, a.DIS_DT DESC NULLS LAST) AS k
  FROM rxt t LEFT JOIN adm a ON a.MRN = t.MRN AND t.TEST_DATE >= a.ADM_DT AND t.TEST_DATE >= a.DIS_DT)"""
_ADM_SHOW = "MRN, TEST_CODE, cast(TEST_DATE as varchar) AS TEST_DATE, cast(ADM_DT_a as varchar) AS ADM_DT_a, cast(DIS_DT as varchar) AS DIS_DT"
_FLAG = f"(coalesce(date_diff('day', ADM_DT_a, cast(TEST_DATE as date)) < 60, false) OR coalesce({gap('TEST_DATE', 'DIS_DT')} < 60, false))"
_SECOND = "second AS (SELECT MRN, CODE, EVT_DATE AS at FROM services WHERE CODE = '82310')"


def _secondary(where: str) -> list[str]:
    return [TESTS, _SECOND, f"""sh AS (SELECT t.id, {TEST}, count(s.MRN) AS n_secondary,
    arg_max(s.CODE, s.at) AS rCODE, {gap('t.TEST_DATE', 'max(s.at)')} AS rgap
  FROM tests t LEFT JOIN second s ON s.MRN = t.MRN AND s.at <= t.TEST_DATE {where}
  GROUP BY t.id, t.MRN, t.ENC_ID, t.TEST_CODE, t.TEST_DATE)"""]


_LATER = "WHERE EXISTS (SELECT 1 FROM second q WHERE q.MRN = t.MRN AND q.at <= t.TEST_DATE) OR NOT EXISTS (SELECT 1 FROM second q WHERE q.MRN = t.MRN)"
_LAG = """lagged AS (SELECT MRN, ENC_ID, EVT_DATE, lag(EVT_DATE) OVER (PARTITION BY MRN ORDER BY EVT_DATE) AS prev
  FROM (SELECT MRN, EVT_DATE, min(ENC_ID) AS ENC_ID FROM scans GROUP BY ALL))"""

_DX = f"dxt AS (SELECT c.MRN, min(c.EVT_DATE) AS first_dx FROM claims c JOIN r0 r ON {hit('c.ICD10_subcode')} GROUP BY c.MRN)"

_TEST = "mode, metric, MRN, TEST_CODE, TEST_DATE"
_STEPS = f"""steps AS (
  SELECT DISTINCT '1 tests' AS stage, s.mode, s.metric, s.MRN, s.CODE AS TEST_CODE, s.EVT_DATE AS TEST_DATE FROM s
    JOIN rule r ON r.mode = s.mode AND r.metric = s.metric AND r.role = 'service' AND r.subcode = s.CODE WHERE s.EVT_DATE >= TIMESTAMP '{D0}'
  UNION ALL SELECT DISTINCT '2 cohort', {_TEST} FROM t0 WHERE TEST_DATE >= TIMESTAMP '{D0}'
  UNION ALL SELECT DISTINCT '3 history', {_TEST} FROM t0 JOIN settings e USING (metric) WHERE TEST_DATE >= TIMESTAMP '{D0}'
    AND (NOT e.needs_claim OR EXISTS (SELECT 1 FROM c WHERE c.mode = t0.mode AND c.metric = t0.metric AND c.MRN = t0.MRN
         AND c.icd IS NOT NULL AND c.EVT_DATE <= t0.TEST_DATE))
    AND (NOT EXISTS (SELECT 1 FROM sec WHERE sec.mode = t0.mode AND sec.metric = t0.metric AND sec.MRN = t0.MRN)
         OR EXISTS (SELECT 1 FROM sec WHERE sec.mode = t0.mode AND sec.metric = t0.metric AND sec.MRN = t0.MRN AND sec.rDATE <= t0.TEST_DATE))
  UNION ALL SELECT DISTINCT '4 admission', {_TEST} FROM hs WHERE TEST_DATE >= TIMESTAMP '{D0}'
  UNION ALL SELECT DISTINCT '5 scored', {_TEST} FROM n0
  UNION ALL SELECT DISTINCT '6 unflagged', n0.mode, n0.metric, n0.MRN, TEST_CODE, TEST_DATE FROM n0
    LEFT JOIN outs o ON o.mode = n0.mode AND o.metric = n0.metric AND o.MRN = n0.MRN WHERE o.MRN IS NULL
  UNION ALL SELECT DISTINCT '7 numerator', {_TEST} FROM n1)"""

SQL = {
    "coh1_demographics": with_base(f"SELECT {SVC}, age AS AgeAtTest, GENDER FROM services WHERE age >= 40 AND age < 80 AND GENDER = 'M'"),
    "coh2_metric_rules": with_base("SELECT p_partkey, role, cls, subcode, cast(sw as bigint) AS startWith FROM part_rules WHERE metric = 'lbp'", PART_RULES),
    "coh3_diagnosis_cohort": with_base("SELECT MRN, cast(first_dx as varchar) AS first_dx FROM dxt", [RULE, rules("lbp", "indication"), _DX]),
    "coh4_after_diagnosis": with_base(f"""SELECT {SVC}, cast(first_dx as varchar) AS first_dx FROM services JOIN dxt USING (MRN)
  WHERE EVT_DATE >= first_dx""", [RULE, rules("narc", "indication"), _DX]),
    "coh5_service_codes": with_base(f"SELECT {SVC} FROM services WHERE CODE IN ('93015', '93000')"),
    "coh6_trimmed_claims": with_base(f"""SELECT MRN, cast(EVT_DATE as varchar) AS EVT_DATE, ICD10_subcode, hcc AS hcclev, ccs AS ccslev
  FROM levelled l WHERE EXISTS (SELECT 1 FROM rule r WHERE r.mode = 'refto10_gems' AND r.metric = 'card'
    AND ({hit('l.ICD10_subcode')} OR (NOT r.sw AND (l.hcc = r.subcode OR l.ccs = r.subcode))))""", [RULE, LEVELLED]),
    "coh7_study_window": with_base(f"""SELECT MRN, ENC_ID, CODE, cast(cast(EVT_DATE as date) as varchar) AS TEST_DATE_a FROM services
  WHERE EVT_DATE >= TIMESTAMP '{D0}' AND EVT_DATE < TIMESTAMP '{D1}'"""),
    "jn1_claim_history": _history("INNER"),
    "jn2_claim_history_all": _history("LEFT"),
    "jn3_test_surgery": with_base(f"""SELECT {TEST}, n_surgeries, cast(next_surgery as varchar) AS next_surgery,
  cast(last_surgery as varchar) AS last_surgery FROM ahead t""", [TESTS, _OPS, _AHEAD]),
    "jn4_latest_admission": with_base(f"SELECT {_ADM_SHOW} FROM best WHERE k = 1", [_RX, _BEST]),
    "jn4_latest_admission_keep": with_base(f"SELECT {_ADM_SHOW} FROM best WHERE k = 1", [_RX, _BEST_KEEP]),
    "jn4_surgery_admission": with_base("""SELECT MRN, cast(SURG_DATE as varchar) AS SURG_DATE, cast(ADM_DT_a as varchar) AS ADM_DT_a,
  cast(dis as varchar) AS DIS_DT FROM (
    SELECT MRN, SURG_DATE, cast(adm as date) AS ADM_DT_a, dis, row_number() OVER (PARTITION BY MRN, SURG_DATE
      ORDER BY cast(adm as date) DESC NULLS LAST, dis DESC NULLS LAST) AS k
    FROM (SELECT s.MRN, s.SURG_DATE, CASE WHEN cast(a.ADM_DT as date) <> cast(s.SURG_DATE as date) THEN a.ADM_DT END AS adm,
                 CASE WHEN cast(a.ADM_DT as date) <> cast(s.SURG_DATE as date) THEN a.DIS_DT END AS dis
          FROM (SELECT DISTINCT MRN, EVT_DATE AS SURG_DATE FROM services) s LEFT JOIN adm a ON a.MRN = s.MRN)
    WHERE (adm IS NULL OR SURG_DATE >= adm) AND (dis IS NULL OR SURG_DATE >= dis)) WHERE k = 1"""),
    "jn5_recent_admission": with_base(f"SELECT {_ADM_SHOW}, cast({_FLAG} as bigint) AS adms_flag FROM best WHERE k = 1", [_RX, _BEST]),
    "jn6_secondary_codes": with_base("SELECT * EXCLUDE (id) FROM sh", _secondary(_LATER)),
    "jn6_secondary_codes_keep": with_base("SELECT * EXCLUDE (id) FROM sh", _secondary("")),
    "jn7_before_surgery": with_base(f"""SELECT {TEST}, cast(next_surgery as varchar) AS next_surgery FROM ahead t
  WHERE {gap('next_surgery', 'TEST_DATE')} <= 30""", [TESTS, _OPS, _AHEAD]),
    "den1_patient_months": with_base(f"""SELECT MRN, ENC_ID, CODE AS TEST_CODE, cast(EVT_DATE as varchar) AS TEST_DATE,
  year(EVT_DATE) || '_' || month(EVT_DATE) AS TEST_DATE_month FROM (
    SELECT s.*, row_number() OVER (PARTITION BY MRN, date_trunc('month', EVT_DATE) ORDER BY EVT_DATE, ENC_ID, CODE) AS k
    FROM services s JOIN dxt USING (MRN) WHERE EVT_DATE >= first_dx AND EVT_DATE >= TIMESTAMP '{D0}') WHERE k = 1""",
                                     [RULE, rules("lbp", "indication"), _DX]),
    "den2_services": with_base("""SELECT MRN, ENC_ID, TEST_CODE, cast(TEST_DATE as varchar) AS TEST_DATE,
  cast(cast(TEST_DATE as date) as varchar) AS TEST_DATE_a, year(TEST_DATE) || '_' || month(TEST_DATE) AS TEST_DATE_month FROM (
    SELECT *, row_number() OVER (PARTITION BY MRN, cast(TEST_DATE as date), TEST_CODE ORDER BY TEST_DATE, ENC_ID) AS k FROM tests t
    WHERE EXISTS (SELECT 1 FROM claims c WHERE c.MRN = t.MRN AND c.EVT_DATE <= t.TEST_DATE)) WHERE k = 1""", tests_of("vitd")),
    "num1_matching_patients": with_base("SELECT DISTINCT MRN FROM flagged", flagged("card", "redflag", "refto10_gems")),
    "num2_red_flags": with_base(f"""SELECT {TEST} FROM tests t WHERE NOT EXISTS (
  SELECT 1 FROM tests u JOIN flagged f ON f.MRN = u.MRN WHERE u.MRN = t.MRN
    AND {gap('u.TEST_DATE', 'f.EVT_DATE')} BETWEEN 0 AND 365)""", flagged("card", "redflag", "refto10_gems") + tests_of("card")[1:]),
    "num3_stale_secondary": with_base("""SELECT MRN, ENC_ID, TEST_CODE, TEST_DATE, n_secondary, rgap,
  CASE WHEN rgap <= 365 THEN rCODE END AS rCODE FROM sh WHERE n_secondary > 0""", _secondary("")),
    "num4_indications": with_base(f"SELECT {TEST} FROM tests t WHERE MRN IN (SELECT MRN FROM flagged)",
                                  flagged("bph", "indication", "10to10") + tests_of("bph")[1:]),
    "num5_old_complaints": with_base(f"""SELECT {TEST} FROM tests t WHERE EXISTS (
  SELECT 1 FROM claims c WHERE c.MRN = t.MRN AND c.EVT_DATE <= t.TEST_DATE
    AND NOT ({gap('t.TEST_DATE', 'c.EVT_DATE')} >= 60 AND c.ICD10_subcode IN ('N401', 'R350')))""", [TESTS]),
    "num6_not_admitted": with_base(f"""SELECT MRN, TEST_CODE, cast(TEST_DATE as varchar) AS TEST_DATE FROM best
  WHERE k = 1 AND NOT {_FLAG}""", [_RX, _BEST]),
    "num7_one_per_service": with_base(f"""SELECT MRN, ENC_ID, TEST_CODE, cast(TEST_DATE as varchar) AS TEST_DATE,
  cast(cast(TEST_DATE as date) as varchar) AS TEST_DATE_a, year(TEST_DATE) || '_' || month(TEST_DATE) AS TEST_DATE_month FROM (
    SELECT *, row_number() OVER (PARTITION BY MRN, cast(TEST_DATE as date), TEST_CODE ORDER BY TEST_DATE, ENC_ID) AS k FROM tests
    WHERE TEST_DATE >= TIMESTAMP '{D0}') WHERE k = 1""", [TESTS]),
    "win1_event_gaps": with_base(f"""SELECT MRN, cast(EVT_DATE as varchar) AS EVT_DATE, {gap('lead(EVT_DATE) OVER w', 'EVT_DATE')} AS to_next,
  {gap('EVT_DATE', 'lag(EVT_DATE) OVER w')} AS since_last FROM (SELECT DISTINCT MRN, ENC_ID, EVT_DATE FROM scans)
  WINDOW w AS (PARTITION BY MRN ORDER BY EVT_DATE, ENC_ID)"""),
    "win2_repeat_scans": with_base(f"""SELECT {TEST} FROM tests t WHERE MRN IN (
    SELECT MRN FROM lagged WHERE {gap('EVT_DATE', 'prev')} < 730 AND EVT_DATE >= (SELECT min(TEST_DATE) FROM tests))
  AND ENC_ID IN (SELECT ENC_ID FROM lagged WHERE {gap('EVT_DATE', 'prev')} < 730)""", tests_of("dexa") + [_LAG]),
    "win3_feeding_tubes": result_sql(["feed"], ["refto10_gems"], "proc_claims", """SELECT MRN, TEST_CODE,
  cast(TEST_DATE_a as varchar) AS TEST_DATE_a, based_on, cast(cast(CLAIM_DATE as date) as varchar) AS CLAIM_DATE FROM result WHERE term = 'numerator'"""),
    "trc1_attrition": result_sql(METRIC_NAMES, list(MODES), extra=[_STEPS], body="""SELECT c.mode, c.metric, n.stage,
  count(k.MRN) AS rows, count(DISTINCT k.MRN) AS patients
  FROM cell c CROSS JOIN (VALUES ('1 tests'), ('2 cohort'), ('3 history'), ('4 admission'), ('5 scored'), ('6 unflagged'), ('7 numerator')) n(stage)
  LEFT JOIN steps k ON k.mode = c.mode AND k.metric = c.metric AND k.stage = n.stage GROUP BY c.mode, c.metric, n.stage"""),
}
