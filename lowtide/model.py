"""Schemas and metric settings."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import types as T

STRING, INT, DOUBLE, BOOL = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TS, DATE = T.TimestampType(), T.DateType()


def schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PATIENT = schema(MRN=STRING, DOB=DATE, GENDER=STRING)
CLAIM = schema(MRN=STRING, ENC_ID=STRING, EVT_DATE=TS, CODE=STRING, ICD9_CODE=STRING,
               GENDER=STRING, DOB=DATE, AGEATCLAIM=INT)
SERVICE = schema(MRN=STRING, ENC_ID=STRING, CODE=STRING, EVT_DATE=TS, GENDER=STRING, DOB=DATE, AGEATCLAIM=INT)
RULE = schema(role=STRING, metric=STRING, cls=STRING, subcode=STRING, startWith=BOOL)
DRUG_MAP = T.StructType([T.StructField("Drug Names", STRING), T.StructField("Drug Codes", STRING)])
FEE = T.StructType([T.StructField("HCPCS", STRING), T.StructField("MOD", STRING),
                    T.StructField("DESCRIPTION", STRING), T.StructField("FACILITY TOTAL", DOUBLE),
                    T.StructField("Calc_reimb_GPCIof1", DOUBLE)])
DRUG_PRICE = T.StructType([T.StructField("old_names_tokenized", STRING), T.StructField("Drug Codes", STRING),
                           T.StructField("NDC", STRING), T.StructField("Median_Per_Unit_Cost", DOUBLE)])

#: The long result, one row per (mode, metric, term) and grain key.
RESULT_SCHEMA = schema(mode=STRING, metric=STRING, term=STRING, MRN=STRING, ENC_ID=STRING, TEST_CODE=STRING,
                       TEST_DATE=TS, TEST_DATE_a=DATE, TEST_DATE_month=STRING, AgeAtTest=DOUBLE, CLAIM_DATE=TS,
                       ADM_DT_a=DATE, SURG_DATE=TS, based_on=STRING)
RESULT_COLUMNS = RESULT_SCHEMA.names


@dataclass(frozen=True)
class Metric:
    """What one metric reads and which steps it takes.

    ``window`` is the metric's own day window (admissions, symptom onset, repeat
    scans, surgery); ``lookback`` bounds how old a red flag may be.
    """

    name: str
    source: str = "service"          # service | drug
    window: int | None = None
    lookback: int = 365
    dx_tied: bool = False            # cohort = patients with an indication
    after_dx: bool = False           # only services on/after the first indication
    monthly: bool = False            # denominator per patient-month, else per service
    needs_claim: bool = True         # services without an earlier claim are dropped
    secondary: str | None = None     # reference services: 'all' table or 'own' (age-limited)
    secondary_window: int | None = None
    admission: str | None = None     # index of the latest prior admission: 'test' or 'surgery'
    repeat_scan: bool = False
    cull_old_complaint: bool = False

    def __post_init__(self) -> None:
        needs_window = {"lbp", "bph", "dexa", "narc", "catpreop", "nonpreop"}
        if self.name not in METRIC_NAMES:
            raise ValueError(f"unknown metric {self.name!r}")
        if self.name in needs_window and not (isinstance(self.window, int) and self.window > 0):
            raise ValueError(f"metric {self.name!r} needs a positive window in days")
        if self.lookback < 0:
            raise ValueError("lookback must not be negative")


METRIC_NAMES = ("cerv", "card", "vitd", "bph", "lbp", "feed", "psyc", "dexa", "narc", "nonpreop", "catpreop")

METRICS: dict[str, Metric] = {
    m.name: m
    for m in (
        Metric("cerv"),
        Metric("card", needs_claim=False),
        Metric("vitd", secondary="own", secondary_window=365),
        Metric("bph", window=60, dx_tied=True, after_dx=True, monthly=True, cull_old_complaint=True),
        Metric("lbp", window=42, dx_tied=True, after_dx=True, monthly=True, cull_old_complaint=True),
        Metric("feed", dx_tied=True, monthly=True, needs_claim=False),
        Metric("psyc", source="drug", dx_tied=True, after_dx=True, monthly=True, needs_claim=False, secondary="all"),
        Metric("dexa", window=730, secondary="own", secondary_window=730, repeat_scan=True),
        Metric("narc", source="drug", window=60, dx_tied=True, after_dx=True, monthly=True, needs_claim=False,
               secondary="all", secondary_window=60, admission="test"),
        Metric("nonpreop", window=30, admission="surgery"),
        Metric("catpreop", window=30, admission="surgery"),
    )
}

#: Metrics counted per patient-month; the others per (patient, day, code).
MONTHLY = tuple(m.name for m in METRICS.values() if m.monthly)


@dataclass(frozen=True)
class Mode:
    """How ICD-9 rules and ICD-10 claims are brought together."""

    name: str
    basis: int                       # generation the rules are written in
    moves: str                       # 'rules' forward, 'claims' backward, or 'none'
    crosswalk: str | None = None
    procedures: bool = False         # also map procedure codes (feeding tubes)

    def __post_init__(self) -> None:
        if self.basis not in (9, 10):
            raise ValueError("basis must be 9 or 10")
        if (self.moves == "none") != (self.basis == 10):
            raise ValueError("only rules on the ICD-10 basis are used unmapped")
        if self.moves != "none" and self.crosswalk is None:
            raise ValueError("a mapping mode needs a crosswalk")


MODES: dict[str, Mode] = {
    m.name: m
    for m in (
        Mode("refto10_gems", 9, "rules", "gems", procedures=True),
        Mode("refto10_bestMap9", 9, "rules", "bestMap9"),
        Mode("claimto9_bestMap10", 9, "claims", "bestMap10"),
        Mode("claimto9_reimb", 9, "claims", "reimburse"),
        Mode("10to10", 10, "none"),
    )
}


@dataclass(frozen=True)
class Study:
    """Dates of a run; ends are exclusive except ``admissions_to``."""

    service_from: dt.date
    claim_from: dt.date
    start: dt.date
    end: dt.date
    admissions_to: dt.date
