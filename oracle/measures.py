"""Oracle SQL: metrics, modes, grid."""

from lowtide.catalog.measures import ORDER
from lowtide.model import METRIC_NAMES, MODES
from oracle.cells import result_sql

RATE = """SELECT mode, metric, TEST_DATE_month, count(DISTINCT CASE WHEN term = 'numerator' THEN MRN END) AS numerator,
  count(DISTINCT CASE WHEN term = 'denominator' THEN MRN END) AS denominator,
  coalesce(count(DISTINCT CASE WHEN term = 'numerator' THEN MRN END) * 1.0e0
    / nullif(count(DISTINCT CASE WHEN term = 'denominator' THEN MRN END), 0), 0) AS proportion,
  cast(d.agemin as bigint) AS agemin, cast(d.agemax as bigint) AS agemax, d.gendercrit
FROM result JOIN demo d ON d.key = metric WHERE TEST_DATE_month LIKE '1998%' GROUP BY mode, metric, TEST_DATE_month, d.agemin, d.agemax, d.gendercrit"""

SQL = {
    **{f"met{i}_{name}": result_sql([name], ["10to10"], "proc_claims" if name == "feed" else "claims")
       for i, name in enumerate(ORDER, 1)},
    **{f"run{i}_{name}": result_sql(METRIC_NAMES, [name]) for i, name in enumerate(MODES, 1)},
    "run6_grid": result_sql(METRIC_NAMES, list(MODES)),
    "lbp_monthly_rate": result_sql(["lbp"], ["10to10"], body=RATE),
}
