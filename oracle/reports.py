"""Oracle SQL: reports, costs, agreement, sampling, sinks."""

from lowtide.model import METRIC_NAMES, MODES, MONTHLY
from oracle.base import with_base
from oracle.cells import result_sql
from oracle.measures import RATE

ALL = list(MODES)
PERIOD = ", ".join(f"'1998_{m}'" for m in range(4, 10))
IS_MONTHLY = "{0} IN (" + ", ".join(f"'{m}'" for m in MONTHLY) + ")"
DAY = "cast(TEST_DATE_a as varchar) AS TEST_DATE_a"


def grid(body: str, extra: list[str] | None = None) -> str:
    return result_sql(METRIC_NAMES, ALL, body=body, extra=extra)


def by_mode(agg: str, source: str = "result") -> str:
    return f"SELECT metric, term, {', '.join(agg.format(m) + f' AS {chr(34)}{m}{chr(34)}' for m in ALL)} FROM {source} GROUP BY metric, term"


COSTED = """costed AS (
  SELECT r.*, CASE WHEN r.metric = 'vitd' THEN 40.0e0 ELSE f.DOLLARS END AS dollar_reimb FROM result r
    LEFT JOIN fee f ON f.HCPCS = r.TEST_CODE AND f.MOD IS NULL WHERE r.metric NOT IN ('psyc', 'narc')
  UNION ALL SELECT r.*, p.unit FROM result r LEFT JOIN price p ON p.drug = r.TEST_CODE WHERE r.metric IN ('psyc', 'narc'))"""
NOTNUM = f"""notnum AS (
  SELECT d.* FROM result d WHERE d.term = 'denominator' AND NOT EXISTS (SELECT 1 FROM result n WHERE n.term = 'numerator'
    AND n.mode = d.mode AND n.metric = d.metric AND n.MRN = d.MRN AND n.TEST_DATE_month = d.TEST_DATE_month
    AND ({IS_MONTHLY.format('d.metric')} OR (n.TEST_CODE = d.TEST_CODE AND n.TEST_DATE_a = d.TEST_DATE_a))))"""
LABELLED = """labelled AS (
  SELECT mode, metric, MRN, TEST_CODE, TEST_DATE_a, TEST_DATE_month, 'Numer' AS label FROM result WHERE term = 'numerator'
  UNION ALL SELECT mode, metric, MRN, TEST_CODE, TEST_DATE_a, TEST_DATE_month, 'Not_Numer' FROM notnum)"""
GOLD = f"""au AS (
  SELECT metric, MRN, TEST_CODE, TEST_DATE_month, Term_assessed, Gold_Standard FROM (
    SELECT *, row_number() OVER (PARTITION BY metric, MRN, TEST_DATE_month, Term_assessed,
        CASE WHEN {IS_MONTHLY.format('metric')} THEN '' ELSE TEST_CODE END ORDER BY TEST_CODE, Gold_Standard) AS k
    FROM (SELECT DISTINCT substr(g.Metric, 4) AS metric, MRN, TEST_CODE, TEST_DATE_month, Term_assessed, Gold_Standard FROM gold g
          WHERE Term_assessed IN ('Numer', 'Not_Numer'))) WHERE k = 1)"""
JUDGED = f"""judged AS (
  SELECT l.mode, l.metric, l.MRN, cast(NULL as varchar) AS TEST_CODE, l.TEST_DATE_month, l.label, a.Term_assessed
    FROM labelled l JOIN au a ON a.metric = l.metric AND a.MRN = l.MRN AND a.TEST_DATE_month = l.TEST_DATE_month
    WHERE {IS_MONTHLY.format('l.metric')} AND l.label = 'Not_Numer'
  UNION ALL
  SELECT l.mode, l.metric, l.MRN, l.TEST_CODE, l.TEST_DATE_month, l.label, a.Term_assessed
    FROM labelled l JOIN au a ON a.metric = l.metric AND a.MRN = l.MRN AND a.TEST_DATE_month = l.TEST_DATE_month AND a.TEST_CODE = l.TEST_CODE
    WHERE NOT ({IS_MONTHLY.format('l.metric')} AND l.label = 'Not_Numer'))"""
AGREE = "CASE WHEN label = Term_assessed THEN 'T' ELSE 'F' END || label"
DOCS = f"""docs AS (SELECT 'documents' AS mode, lang AS metric, {AGREE} AS agreement FROM (
  SELECT d.lang, CASE WHEN d.n_chars > 500 THEN 'Numer' ELSE 'Not_Numer' END AS label,
         CASE WHEN l.quality = 1 THEN 'Numer' ELSE 'Not_Numer' END AS Term_assessed FROM documents d JOIN labels l USING (doc_id)))"""
BOTH = f"""both_sets AS (SELECT mode, metric, {AGREE} AS agreement FROM judged)"""
CONF = """conf AS (SELECT mode, metric, count(*) FILTER (agreement = 'TNumer') AS tp, count(*) FILTER (agreement = 'FNumer') AS fp,
  count(*) FILTER (agreement = 'TNot_Numer') AS tn, count(*) FILTER (agreement = 'FNot_Numer') AS fn FROM both_sets GROUP BY mode, metric)"""
CHAIN = [NOTNUM, LABELLED, GOLD, JUDGED, BOTH, CONF]


def ratio(top: str, bottom: str) -> str:
    return f"coalesce(({top}) * 1.0e0 / nullif({bottom}, 0), 0)"


SENS, SPEC = ratio("tp", "tp + fn"), ratio("tn", "tn + fp")
STUDIED = f"""studied AS (SELECT * FROM labelled WHERE TEST_DATE_month IN ({PERIOD}))"""
DRAWN = """drawn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mode, metric, label
    ORDER BY md5('54|' || metric || '|' || MRN || '|' || cast(TEST_DATE_a as varchar) || '|' || TEST_CODE), metric, MRN, TEST_DATE_a, TEST_CODE) AS k
  FROM studied) WHERE k <= 5)"""
COST_SHOW = f"SELECT mode, metric, term, MRN, TEST_CODE, {DAY}, dollar_reimb FROM costed"
QUOTA = "asked AS (SELECT mode, key AS metric, l.label, 40 AS needed FROM modes, demo, (VALUES ('Numer'), ('Not_Numer')) l(label))"
NOTES = "notes AS (SELECT substr(g.Metric, 4) AS metric, MRN, TEST_CODE, TEST_DATE_a, TEST_DATE_month, Term_assessed FROM gold g)"

SQL = {
    "rpt1_tally": grid("""SELECT mode, metric, count(*) FILTER (term = 'numerator') AS numerator,
  count(*) FILTER (term = 'denominator') AS denominator FROM result GROUP BY mode, metric"""),
    "rpt2_monthly_rate": grid(RATE.replace("TEST_DATE_month LIKE '1998%'", f"TEST_DATE_month IN ({PERIOD})")),
    "rpt3_monthly_patients": grid(f"""SELECT mode, 'CW_' || metric AS Long_Metric, metric AS Metric, MRN, TEST_DATE_month, cast(d.agemin as bigint) AS agemin,
  cast(d.agemax as bigint) AS agemax, d.gendercrit, term FROM result JOIN demo d ON d.key = metric WHERE TEST_DATE_month IN ({PERIOD})"""),
    "rpt4_stitched": grid(f"""SELECT mode, 'CW_' || metric AS Metric, ENC_ID, regexp_replace(MRN, '^0{{1,2}}', '') AS MRN, TEST_CODE, {DAY},
  TEST_DATE_month, cast(cast(CLAIM_DATE as date) as varchar) AS CLAIM_DATE, cast(ADM_DT_a as varchar) AS ADM_DT_a, AgeAtTest
  FROM result WHERE term = 'numerator'"""),
    "rpt5_count_table": grid(by_mode("count(*) FILTER (mode = '{0}')")),
    "rpt6_cost_check": grid(by_mode("count(MRN) FILTER (mode = '{0}')", "costed"), [COSTED]),
    "cst1_fee_schedule": with_base("""SELECT c.code || '-' || p_partkey AS HCPCS, p_name AS DESCRIPTION,
  cast(p_size as double) AS "FACILITY TOTAL", p_retailprice AS dollar_reimb FROM part JOIN proc c ON c.i = p_partkey % 20 WHERE p_partkey % 3 <> 0"""),
    "cst2_service_cost": grid(COST_SHOW + " WHERE metric NOT IN ('psyc', 'narc', 'vitd')", [COSTED]),
    "cst3_drug_cost": grid(COST_SHOW + " WHERE metric IN ('psyc', 'narc')", [COSTED]),
    "cst4_flat_cost": grid(COST_SHOW + " WHERE metric = 'vitd'", [COSTED]),
    "cst5_dollar_table": grid(by_mode("round(coalesce(sum(dollar_reimb) FILTER (mode = '{0}'), 0.0e0), 2)", "costed"), [COSTED]),
    "evl1_not_numerator": grid(f"SELECT mode, metric, MRN, TEST_CODE, {DAY}, TEST_DATE_month FROM notnum", [NOTNUM]),
    "evl2_unshared_rows": grid(f"""SELECT mode, metric, MRN, {DAY}, TEST_CODE, min(term) AS term, min(ENC_ID) AS ENC_ID,
  min(TEST_DATE_month) AS TEST_DATE_month FROM result GROUP BY mode, metric, MRN, TEST_DATE_a, TEST_CODE HAVING count(*) = 1"""),
    "evl3_available": grid("SELECT metric, label, " + ", ".join(f"count(*) FILTER (mode = '{m}') AS \"{m}\"" for m in ALL)
                           + " FROM labelled GROUP BY metric, label", [NOTNUM, LABELLED]),
    "evl4_gold": with_base("SELECT * FROM au", [GOLD]),
    "evl5_joined_gold": grid("SELECT * FROM judged", CHAIN[:4]),
    "evl6_agreement": grid(f"SELECT mode, metric, {AGREE} AS agreement, count(*) AS n FROM judged GROUP BY ALL", CHAIN[:4]),
    "evl6_agreement_documents": with_base("SELECT mode, metric, agreement, count(*) AS n FROM docs GROUP BY ALL", [DOCS]),
    "evl7_two_by_two": grid("""SELECT mode, metric, '+ Numer' AS result, tp AS truth_numer, fp AS truth_not_numer FROM conf WHERE tp + fp > 0
  UNION ALL SELECT mode, metric, '- Not Numer', fn, tn FROM conf WHERE fn + tn > 0""", CHAIN),
    "evl8_sensitivity": grid(f"SELECT mode, metric, round({SENS}, 9) AS sensitivity, round({SPEC}, 9) AS specificity FROM conf", CHAIN),
    "evl9_predictive": grid(f"SELECT mode, metric, round({ratio('tp', 'tp + fp')}, 9) AS ppv, round({ratio('tn', 'tn + fn')}, 9) AS npv FROM conf", CHAIN),
    "evl10_accuracy": grid(f"""SELECT mode, metric, tp + tn AS true_cases, fp + fn AS false_cases,
  round({ratio('tp + tn', 'tp + tn + fp + fn')}, 9) AS accuracy FROM conf""", CHAIN),
    "evl11_likelihood": grid(f"""SELECT mode, metric, round({SENS}, 9) AS sensitivity, round({SPEC}, 9) AS specificity,
  round({SENS} / nullif(1 - {SPEC}, 0), 9) AS lr_plus, round((1 - {SENS}) / nullif({SPEC}, 0), 9) AS lr_minus FROM conf""", CHAIN),
    "evl11_accuracy_table": grid(f"""SELECT mode, metric, tp, fp, tn, fn, round({SENS}, 9) AS sensitivity, round({SPEC}, 9) AS specificity,
  round({ratio('tp', 'tp + fp')}, 9) AS ppv, round({ratio('tn', 'tn + fn')}, 9) AS npv, round({ratio('tp + tn', 'tp + tn + fp + fn')}, 9) AS accuracy,
  round({SENS} / nullif(1 - {SPEC}, 0), 9) AS lr_plus, round((1 - {SENS}) / nullif({SPEC}, 0), 9) AS lr_minus FROM conf""", CHAIN),
    "evl12_uncovered_gold": grid("""SELECT m.mode, a.metric, count(*) AS omitted FROM modes m, au a WHERE NOT EXISTS (
  SELECT 1 FROM labelled l WHERE l.mode = m.mode AND l.metric = a.metric AND l.MRN = a.MRN AND l.TEST_CODE = a.TEST_CODE
    AND l.TEST_DATE_month = a.TEST_DATE_month) GROUP BY m.mode, a.metric""", CHAIN[:3]),
    "evl13_annotation_counts": with_base("""SELECT metric, count(*) FILTER (Term_assessed = 'Numer') AS Numer,
  count(*) FILTER (Term_assessed = 'Not_Numer') AS Not_Numer FROM au GROUP BY metric""", [GOLD]),
    "smp1_stratified_sample": grid(f"SELECT mode, metric, MRN, TEST_CODE, {DAY}, TEST_DATE_month FROM drawn", [NOTNUM, LABELLED, STUDIED, DRAWN]),
    "smp2_missed_quota": grid("""SELECT a.mode, a.metric, a.label, cast(a.needed as bigint) AS needed, count(n.MRN) AS available FROM asked a
  LEFT JOIN studied n ON n.mode = a.mode AND n.metric = a.metric AND n.label = a.label GROUP BY a.mode, a.metric, a.label, a.needed HAVING count(n.MRN) < a.needed""",
                              [NOTNUM, LABELLED, STUDIED, QUOTA]),
    "smp3_annotation_period": with_base(f"SELECT metric, MRN, TEST_CODE, {DAY}, TEST_DATE_month, Term_assessed FROM notes WHERE TEST_DATE_month IN ({PERIOD})", [NOTES]),
    "snk1_result_table": result_sql(["lbp"], ["10to10"]),
    "snk2_report_file": grid("""SELECT mode, metric, count(*) FILTER (term = 'numerator') AS numerator,
  count(*) FILTER (term = 'denominator') AS denominator FROM result GROUP BY mode, metric"""),
    "snk3_sheets": grid(f"SELECT metric, MRN, TEST_CODE, {DAY}, metric AS sheet FROM drawn WHERE mode = '10to10'", [NOTNUM, LABELLED, STUDIED, DRAWN]),
}
