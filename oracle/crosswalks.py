"""Oracle SQL: crosswalk operators and data-quality checks."""

from oracle.base import with_base
from oracle.cells import cells
from oracle.tables import PART_RULES

_LIVE = "w9 AS (SELECT * FROM wide WHERE MAPPING_EXPIRATION_DATE IS NULL AND ICD9_TYPE = 'ICD_9_CM_CODE')"


def _lev(kind: str, g: int) -> str:
    return f"""wide_{kind}{g} AS (SELECT DISTINCT ICD{g}_subcode AS subcode, cast(ascii(ICD{g}_subcode) % 20 as varchar) AS lev
  FROM wide WHERE ascii(ICD{g}_subcode) % 3 <> 0)"""


def _unique(order: str) -> str:
    return with_base(f"""SELECT ICD9_subcode, ICD10_subcode FROM (
  SELECT ICD9_subcode, ICD10_subcode, row_number() OVER (PARTITION BY ICD9_subcode ORDER BY {order}) AS k
  FROM (SELECT DISTINCT ICD9_subcode, ICD10_subcode FROM w9) LEFT JOIN wide_hcc10 h ON h.subcode = ICD10_subcode) WHERE k = 1""",
                     [_LIVE, _lev("hcc", 10)])


def _mapped(where: str, claims: str = "claims") -> str:
    """Forward-mapped rules and the claims under them."""
    rule = cells(["lbp"], ["refto10_gems"])[1]
    return with_base(f"""SELECT r.role, r.metric, r.cls, r.subcode, cast(r.sw as bigint) AS startWith,
  (SELECT count(*) FROM {claims} c WHERE (r.sw AND starts_with(c.ICD10_subcode, r.subcode)) OR (NOT r.sw AND c.ICD10_subcode = r.subcode)) AS n_claims
  FROM (SELECT DISTINCT role, metric, cls, subcode, sw FROM rule WHERE mode = 'refto10_gems') r WHERE {where}""", [rule])


_PROC = "r.role = 'service' AND r.metric = 'feed' AND r.cls = 'ICD'"
SQL = {
    "gem1_simplify": with_base("""SELECT '9d' AS part, ICD9_CODE, ICD10_CODE FROM wide WHERE MAPPING_EXPIRATION_DATE IS NULL AND ICD9_TYPE = 'ICD_9_CM_CODE'
  UNION ALL SELECT '10d', ICD9_CODE, ICD10_CODE FROM wide WHERE MAPPING_EXPIRATION_DATE IS NULL AND ICD10_TYPE = 'ICD10CM_CODE'
  UNION ALL SELECT '9p', ICD9_CODE, ICD10_CODE FROM wide WHERE MAPPING_EXPIRATION_DATE IS NULL AND ICD9_TYPE = 'ICD_9_PROC_CODE'"""),
    "gem2_mixed_relations": with_base("""SELECT ICD9_CODE, count(DISTINCT RELATION_TYPE) AS relation_types FROM w9
  GROUP BY ICD9_CODE HAVING count(DISTINCT RELATION_TYPE) > 1""", [_LIVE]),
    "gem3_random_map": with_base("""SELECT ICD9_subcode, ICD10_subcode FROM (
  SELECT *, row_number() OVER (PARTITION BY ICD9_subcode ORDER BY md5('1873|' || ICD9_subcode || '|' || ICD10_subcode), ICD10_subcode) AS k
  FROM (SELECT DISTINCT ICD9_subcode, ICD10_subcode FROM w9)) WHERE k = 1""", [_LIVE]),
    "gem4_upcode_map": _unique("cast(h.lev as int) ASC NULLS LAST, ICD10_subcode DESC"),
    "gem5_downcode_map": _unique("cast(h.lev as int) DESC NULLS LAST, ICD10_subcode ASC"),
    "gem6_ambiguous_maps": with_base("""SELECT RELATION_TYPE, ICD9_CODE, ICD10_CODE, ICD9_DESC, ICD10_DESC, t.targets,
  (SELECT max(targets) FROM t) AS max_targets FROM w9 JOIN t USING (ICD9_CODE)""",
                                     [_LIVE, "t AS (SELECT ICD9_CODE, count(DISTINCT ICD10_CODE) AS targets FROM w9 GROUP BY 1 HAVING count(DISTINCT ICD10_CODE) >= 2)"]),
    "gem7_attach_levels": with_base("""SELECT ICD9_subcode, ICD10_subcode, a.lev AS hcclev9, b.lev AS ccslev9, c.lev AS hcclev10, d.lev AS ccslev10
  FROM w9 LEFT JOIN wide_hcc9 a ON a.subcode = ICD9_subcode LEFT JOIN wide_ccs9 b ON b.subcode = ICD9_subcode
  LEFT JOIN wide_hcc10 c ON c.subcode = ICD10_subcode LEFT JOIN wide_ccs10 d ON d.subcode = ICD10_subcode""",
                                    [_LIVE, _lev("hcc", 9), _lev("ccs", 9), _lev("hcc", 10), _lev("ccs", 10)]),
    "gem8_upper_placeholders": with_base("SELECT ICD9_CODE, ICD10_CODE, replace(ICD10_subcode, 'x', 'X') AS ICD10_subcode FROM wide"),
    "gem9_forward_exact": _mapped(f"r.cls = 'ICD' AND NOT r.sw AND NOT ({_PROC})"),
    "gem10_forward_stems": _mapped("r.cls = 'ICD' AND r.sw"),
    "gem11_forward_levels": with_base("""SELECT r.role, r.metric, r.cls, r.subcode, cast(r.sw as bigint) AS startWith, (
    SELECT count(*) FROM claims c LEFT JOIN hcc10 h ON h.subcode = c.ICD10_subcode LEFT JOIN ccs10 s ON s.subcode = c.ICD10_subcode
    WHERE (r.cls = 'HCC' AND h.hcclev = r.subcode) OR (r.cls = 'CCS' AND s.ccslev = r.subcode)) AS n_claims
  FROM (SELECT DISTINCT role, metric, cls, subcode, sw FROM rule WHERE mode = 'refto10_gems' AND cls IN ('HCC', 'CCS')) r""",
                                      [cells(["lbp"], ["refto10_gems"])[1]]),
    "gem12_forward_procedures": _mapped(_PROC, "proc_claims"),
    "gem13_forward_rules": _mapped("true"),
    "gem14_backward_claims": with_base("""SELECT MRN, cast(EVT_DATE as varchar) AS EVT_DATE, ICD10_subcode, x.nine AS ICD9_subcode, x.h9 AS hcclev, x.c9 AS ccslev
  FROM claims JOIN xwalk x ON x.xname = 'bestMap10' AND x.ten = ICD10_subcode"""),
    "gem15_native_claims": with_base("""SELECT MRN, cast(EVT_DATE as varchar) AS EVT_DATE, ICD10_subcode, cast(NULL as varchar) AS hcclev,
  cast(NULL as varchar) AS ccslev FROM claims"""),
    "qa1_placeholder_conflicts": with_base("""SELECT CODE, stem, count(*) AS n_claims FROM raw_claim
  JOIN (SELECT DISTINCT left(ICD10_subcode, 3) AS stem FROM wide) ON starts_with(CODE, stem) GROUP BY CODE, stem"""),
    "qa2_procedure_codes": with_base("""SELECT * FROM (SELECT MRN, ENC_ID, CODE, ICD9_CODE,
  CASE WHEN regexp_matches(CODE, '^\\w{7}') AND regexp_matches(ICD9_CODE, '^\\w{2}[.]') THEN 'both'
       WHEN regexp_matches(CODE, '^\\w{7}') THEN 'icd10' WHEN regexp_matches(ICD9_CODE, '^\\w{2}[.]') THEN 'icd9' END AS kind
  FROM proc_claim) WHERE kind IS NOT NULL"""),
    "qa3_stem_violations": with_base("""SELECT 'service stem' AS "check", role, cast(NULL as varchar) AS cls, count(*) AS n FROM part_rules WHERE sw AND role = 'service' GROUP BY role
  UNION ALL SELECT 'stems of several classes', role, NULL, count(*) FROM part_rules WHERE sw AND role <> 'service' GROUP BY role HAVING count(DISTINCT cls) > 1
  UNION ALL SELECT 'stem outside ICD', role, cls, count(*) FROM part_rules WHERE sw AND cls <> 'ICD' GROUP BY role, cls""", PART_RULES),
    "qa4_empty_codes": with_base("""SELECT role, count(*) FILTER (length(subcode) > 0) AS kept, count(*) FILTER (subcode IS NULL) AS null_codes,
  count(*) FILTER (subcode = '') AS empty_codes FROM part_rules GROUP BY role""", PART_RULES),
    "qa5_native_levels": with_base("""SELECT role, metric, cls, count(*) AS n FROM part_rules WHERE role <> 'service' AND cls IN ('HCC', 'CCS')
  GROUP BY role, metric, cls""", PART_RULES),
    "qa6_stray_cpt": with_base("""SELECT role, metric, count(*) AS n FROM part_rules WHERE role <> 'service' AND cls = 'CPT'
  AND metric NOT IN ('dexa', 'narc', 'vitd') GROUP BY role, metric""", PART_RULES),
}
