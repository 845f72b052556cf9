"""Oracle SQL: sources, base tables, normalisation."""

from lowtide.model import METRIC_NAMES
from oracle.base import ADM_TO, D1, FROM, values, with_base

AGE = "date_diff('day', p.DOB, cast({0} as date))"
_CLAIM_BUILD = f"""current_claims AS (
  SELECT r.MRN, r.ENC_ID, r.EVT_DATE, r.CODE, g.ICD9_CODE, p.GENDER, p.DOB, {AGE.format('r.EVT_DATE')} AS AGEATCLAIM
  FROM raw_claim r JOIN gem g ON g.ICD10_CODE = r.CODE JOIN patient p ON p.MRN = r.MRN)"""
_OLDER_BUILD = f"""older AS (
  SELECT r.MRN, r.ENC_ID, r.EVT_DATE, g.ICD10_CODE AS CODE, r.CODE AS ICD9_CODE, p.GENDER, p.DOB,
         {AGE.format('r.EVT_DATE')} AS AGEATCLAIM
  FROM older_raw r JOIN gem g ON g.ICD9_CODE = r.CODE AND g.MAPPING_EXPIRATION_DATE IS NULL JOIN patient p ON p.MRN = r.MRN
  WHERE r.EVT_DATE > TIMESTAMP '1996-12-31' AND r.EVT_DATE < TIMESTAMP '1997-04-02')"""
_SHOW_CLAIM = """MRN, ENC_ID, cast(EVT_DATE as varchar) AS EVT_DATE, CODE, ICD9_CODE, GENDER, cast(DOB as varchar) AS DOB, AGEATCLAIM"""
_SVC = "MRN, ENC_ID, CODE, cast(EVT_DATE as varchar) AS EVT_DATE"
_STAY = "ENC_ID, cast(ADM_DT as varchar) AS ADM_DT, cast(DIS_DT as varchar) AS DIS_DT"
_YEARS = """1999 - year(DOB) - cast(strftime(DATE '1999-01-01', '%m%d') < strftime(DOB, '%m%d') as int) AS current_age"""

_PART = """part_codes AS (
  SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'x' ELSE '' END || d.nine
           || CASE p_partkey % 3 WHEN 0 THEN 'x' WHEN 1 THEN 'X' ELSE '' END AS nine,
         CASE WHEN p_partkey % 7 = 0 THEN '_' ELSE '' END || d.ten || CASE WHEN p_partkey % 3 = 0 THEN '_' ELSE '' END AS ten
  FROM part JOIN diag d ON d.i = p_partkey % 24)"""
_NAMES = values("metric_names", ["i", "metric"], list(enumerate(sorted(METRIC_NAMES))))
PART_RULES = [_NAMES, """part_rules AS (
  SELECT p_partkey, p_name, CASE p_partkey % 3 WHEN 0 THEN 'service' WHEN 1 THEN 'redflag' ELSE 'indication' END AS role,
         m.metric, CASE p_partkey % 5 WHEN 0 THEN 'ICD' WHEN 1 THEN 'CPT' WHEN 2 THEN 'DRUG' WHEN 3 THEN 'HCC' ELSE 'CCS' END AS cls,
         CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN '' ELSE d.ten END AS subcode,
         p_partkey % 4 = 0 AS sw
  FROM part JOIN metric_names m ON m.i = p_partkey % 11 JOIN diag d ON d.i = p_partkey % 24)"""]

SQL = {
    "src1_bounded_scan": with_base(f"""SELECT {_SVC} FROM raw_service
  WHERE EVT_DATE >= TIMESTAMP '{FROM}' AND EVT_DATE < TIMESTAMP '{D1}'"""),
    "src2_admission_scan": with_base(f"""SELECT MRN AS ADM_MRN, ENC_ID AS ADM_ENC_ID, cast(ADM_DT as varchar) AS ADM_DT,
  cast(DIS_DT as varchar) AS DIS_DT FROM encounter WHERE ADM_DT >= TIMESTAMP '{FROM}' AND ADM_DT <= TIMESTAMP '{ADM_TO}'"""),
    "src3_seen_patients": with_base(f"""SELECT MRN, cast(DOB as varchar) AS DOB, GENDER, {_YEARS} FROM patient
  WHERE MRN IN (SELECT lpad(cast(o_custkey as varchar), 9, '0') FROM orders
                WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-03-01')
     OR MRN IN (SELECT lpad(cast(o_custkey as varchar), 9, '0') FROM orders WHERE o_orderstatus = 'O'
                AND o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-03-01')"""),
    "src4_lookup_files": """SELECT kind, p_name AS name, 'd' || lpad(cast(p_partkey as varchar), 5, '0') AS code
  FROM part, (VALUES ('csv'), ('tsv')) k(kind)""",
    "bld1_prescriptions": with_base(f"""SELECT MRN, MED_NAME, cast(ENTRY_DATE as varchar) AS ENTRY_DATE, GENDER,
  cast(DOB as varchar) AS DOB, AGEATCLAIM FROM rx WHERE ENTRY_DATE > TIMESTAMP '1996-06-30'"""),
    "bld2_claims": with_base(f"SELECT {_SHOW_CLAIM} FROM current_claims", [_CLAIM_BUILD]),
    "bld3_active_crosswalk": with_base("SELECT ICD9_CODE, ICD10_CODE, RELATION_TYPE FROM wide WHERE MAPPING_EXPIRATION_DATE IS NULL"),
    "bld4_older_claims": with_base(f"SELECT {_SHOW_CLAIM} FROM older", [_OLDER_BUILD]),
    "bld5_unified_claims": with_base(
        f"SELECT {_SHOW_CLAIM} FROM (SELECT * FROM current_claims UNION ALL SELECT * FROM older) WHERE AGEATCLAIM > 5475",
        [_CLAIM_BUILD, _OLDER_BUILD]),
    "bld6_services": with_base(f"SELECT {_SVC}, GENDER, cast(DOB as varchar) AS DOB, AGEATCLAIM FROM service"),
    "bld7_scans": with_base(f"SELECT {_SVC} FROM raw_service WHERE CODE IN ('0028T','76075','76076','77080','77081')"),
    "bld8_admissions": with_base(f"SELECT MRN, {_STAY}, PT_CLASS, SRV_CODE FROM qualified"),
    "nrm1_strip_dots": with_base("""SELECT MRN, ENC_ID, replace(CODE, '.', '') AS ICD10_subcode,
  replace(ICD9_CODE, '.', '') AS ICD9_subcode FROM claim"""),
    "nrm2_x_stems": with_base("""SELECT p_partkey, nine, replace(replace(replace(nine, '.', ''), 'x', ''), 'X', '') AS subcode,
  cast(right(nine, 1) IN ('x', 'X') as bigint) AS startWith FROM part_codes""", [_PART]),
    "nrm3_underscore_stems": with_base("""SELECT p_partkey, ten, replace(replace(ten, '.', ''), '_', '') AS subcode,
  cast(contains(ten, '_') as bigint) AS startWith FROM part_codes""", [_PART]),
    "nrm4_dedupe_rules": with_base("""SELECT p_partkey, p_name, metric, cls, subcode, cast(sw as bigint) AS startWith FROM (
  SELECT *, row_number() OVER (PARTITION BY cls, metric, subcode, sw ORDER BY p_partkey) AS k FROM part_rules) WHERE k = 1""", PART_RULES),
    "nrm5_clean_levels": with_base("""SELECT d.ten || '-' || p_partkey AS subcode,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE cast(p_partkey % 300 as varchar) END AS ccslev FROM part JOIN diag d ON d.i = p_partkey % 24"""),
    "nrm6_extend_levels": with_base("""SELECT d.ten AS subcode,
  CASE WHEN p_partkey % 2 = 0 THEN cast(p_partkey % 300 as varchar) ELSE '8' END AS hcclev,
  CASE WHEN p_partkey % 2 = 0 THEN p_name END AS label FROM part JOIN diag d ON d.i = p_partkey % 24"""),
    "nrm7_attach_levels": with_base("""SELECT MRN, cast(EVT_DATE as varchar) AS EVT_DATE, ICD10_subcode, hcclev, ccslev, age AS AgeAtTest
  FROM claims LEFT JOIN hcc10 h ON h.subcode = ICD10_subcode LEFT JOIN ccs10 s ON s.subcode = ICD10_subcode"""),
    "nrm8_drug_codes": with_base("""SELECT MRN, cast(ENTRY_DATE as varchar) AS EVT_DATE, lower(MED_NAME) AS MED_NAME,
  split_part(lower(MED_NAME), ' ', 1) AS FIRST_NAME, CASE WHEN lower(MED_NAME) = 'old widget' THEN 'd03431' ELSE drug END AS CODE
  FROM raw_rx LEFT JOIN drug_map ON token = split_part(lower(MED_NAME), ' ', 1)
  WHERE drug IS NOT NULL OR lower(MED_NAME) = 'old widget'"""),
    "nrm9_claim_age": with_base("""SELECT MRN, cast(EVT_DATE as varchar) AS EVT_DATE, AGEATCLAIM,
  round(AGEATCLAIM / 365.25, 1) AS AgeAtTest FROM claim"""),
    "nrm10_scan_age": with_base(f"""SELECT {_SVC}, p.GENDER, cast(p.DOB as varchar) AS DOB,
  round({AGE.format('EVT_DATE')} / 365.2425, 1) AS AgeAtTest FROM raw_service LEFT JOIN patient p USING (MRN)
  WHERE CODE IN ('0028T','76075','76076','77080','77081')"""),
    "nrm11_current_age": with_base(f"SELECT MRN, cast(DOB as varchar) AS DOB, GENDER, {_YEARS} FROM patient"),
    "nrm12_month_label": with_base("SELECT MRN, ENC_ID, year(EVT_DATE) || '_' || month(EVT_DATE) AS EVT_DATE_month FROM raw_claim"),
    "nrm13_with_encounter": with_base(f"SELECT {_SVC} FROM raw_service WHERE cast(ENC_ID as bigint) % 13 <> 0"),
    "nrm14_trim_zeros": with_base("SELECT MRN, regexp_replace(MRN, '^0{1,2}', '') AS short FROM patient"),
    "nrm15_metric_name": with_base("SELECT Metric, substr(Metric, 4) AS name, MRN, TEST_CODE FROM gold"),
}
