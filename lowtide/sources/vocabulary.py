"""Fixed values of the test mapping: vocabularies, rules, crosswalk, prices.

The driver tables carry no clinical codes; these lists give them some.
"""

from __future__ import annotations

# (ICD-10, ICD-9) by position. The last fifteen set the modes apart.
DIAGNOSES = [
    ("M54.5", "724.2"), ("M54.30", "724.3"), ("N40.1", "600.01"), ("R35.0", "788.41"),
    ("G43.909", "346.90"), ("F03.90", "294.20"), ("I10", "401.9"), ("G83.4", "344.60"),
    ("C61", "185"), ("R07.9", "786.50"), ("M81.0", "733.01"), ("E55.9", "268.9"),
    ("Z01.818", "V72.83"), ("K21.9", "530.81"), ("I25.10", "414.01"), ("H25.9", "366.10"),
    ("N18.3", "585.3"), ("E11.9", "250.00"), ("J45.909", "493.90"), ("D64.9", "285.9"),
    ("R51", "784.0"), ("S22.000A", "805.2"), ("C79.51", "198.5"), ("R63.4", "783.21"),
    ("M54.9", "724.9"), ("G43.111", "346.11"), ("F03.91", "294.22"), ("I25.2", "414.9"),
    ("M54.31", "724.3"), ("G43.901", "346.90"), ("I25.700", "414.02"), ("I25.710", "414.02"),
    ("I25.810", "414.05"), ("M54.16", "724.4"), ("F03.911", "294.21"), ("C80.1", "199.1"), ("R07.2", "786.51"),
    ("F03.92", "294.20"), ("S22.001A", "805.2"),
]
# without a crosswalk row: only rules written in ICD-10 reach them
UNMAPPED = {"M54.9", "G43.111", "F03.91", "I25.2"}

# CPT by position.
PROCEDURES = ["72148", "72100", "76770", "74176", "93015", "93000", "88142", "82306", "77080", "71020",
              "66984", "66830", "29881", "29827", "43246", "70450", "99213", "99214", "82310", "80053"]

SCAN_CODES = ["0028T", "76075", "76076", "77080", "77081"]
FEEDING_TUBE_PCS = "0DH63UZ"

# first drug-name token -> drug code
DRUG_NAMES = [("red", "d03431"), ("blue", "d03428"), ("hot", "d04825"), ("cold", "d00198"), ("large", "d00012")]
DRUG_OVERRIDES = [("old widget", "d03431")]

# metric, age from, age to (exclusive), gender
DEMOGRAPHICS = [
    ("lbp", 18, 80, "All"), ("bph", 40, 80, "M"), ("card", 18, 80, "All"), ("cerv", 65, 80, "F"),
    ("vitd", 18, 80, "All"), ("dexa", 18, 80, "F"), ("nonpreop", 18, 80, "All"), ("catpreop", 50, 80, "All"),
    ("feed", 50, 80, "All"), ("psyc", 50, 80, "All"), ("narc", 18, 80, "All"),
]

# role, metric, class, code as written in the reference of that generation
_SERVICES = [
    ("lbp", "CPT", "72148"), ("lbp", "CPT", "72100"), ("bph", "CPT", "76770"), ("bph", "CPT", "74176"),
    ("card", "CPT", "93015"), ("card", "CPT", "93000"), ("cerv", "CPT", "88142"), ("vitd", "CPT", "82306"),
    ("dexa", "CPT", "77080"), ("nonpreop", "CPT", "93000"), ("nonpreop", "CPT", "71020"),
    ("catpreop", "CPT", "93000"), ("catpreop", "CPT", "80053"), ("feed", "CPT", "43246"),
    ("psyc", "DRUG", "d04825"), ("psyc", "DRUG", "d00198"), ("narc", "DRUG", "d03431"), ("narc", "DRUG", "d03428"),
]
_RULES_10 = [
    ("indication", "lbp", "ICD", "M54_"), ("indication", "bph", "ICD", "N40.1"),
    ("indication", "bph", "ICD", "R35.0"), ("indication", "feed", "ICD", "F03_"),
    ("indication", "psyc", "ICD", "F03_"), ("indication", "narc", "ICD", "G43_"),
    ("redflag", "lbp", "ICD", "G83.4"), ("redflag", "lbp", "ICD", "C79_"), ("redflag", "bph", "ICD", "C61"),
    ("redflag", "card", "ICD", "I25_"), ("redflag", "card", "ICD", "R07.9"), ("redflag", "cerv", "ICD", "C79_"),
    ("redflag", "vitd", "ICD", "N18.3"), ("redflag", "vitd", "ICD", "M81_"), ("redflag", "vitd", "CPT", "82310"),
    ("redflag", "dexa", "ICD", "S22_"), ("redflag", "dexa", "CPT", "99214"), ("redflag", "nonpreop", "ICD", "I25_"),
    ("redflag", "catpreop", "ICD", "I25_"), ("redflag", "psyc", "ICD", "R63.4"), ("redflag", "narc", "ICD", "C79_"),
    ("redflag", "narc", "CPT", "70450"),
]
_RULES_9 = [
    ("indication", "lbp", "ICD", "724x"), ("indication", "bph", "ICD", "600.01"),
    ("indication", "bph", "ICD", "788.41"), ("indication", "feed", "ICD", "294x"),
    ("indication", "psyc", "ICD", "294x"), ("indication", "narc", "ICD", "346x"),
    ("redflag", "lbp", "ICD", "344.60"), ("redflag", "lbp", "HCC", "8"), ("redflag", "bph", "ICD", "185"),
    ("redflag", "card", "ICD", "414x"), ("redflag", "card", "CCS", "102"), ("redflag", "cerv", "HCC", "8"),
    ("redflag", "vitd", "ICD", "585.3"), ("redflag", "vitd", "ICD", "733x"), ("redflag", "vitd", "CPT", "82310"),
    ("redflag", "dexa", "ICD", "805x"), ("redflag", "dexa", "CPT", "99214"), ("redflag", "nonpreop", "ICD", "414x"),
    ("redflag", "catpreop", "ICD", "414x"), ("redflag", "psyc", "ICD", "783.21"), ("redflag", "narc", "HCC", "8"),
    ("redflag", "narc", "CPT", "70450"),
]
RULES = {
    9: [("service", *row) for row in _SERVICES] + [("service", "feed", "ICD", "4311_p")] + _RULES_9,
    10: [("service", *row) for row in _SERVICES] + _RULES_10,
}

SURGERY = [("nonpreop", "29881"), ("nonpreop", "29827"), ("catpreop", "66984"), ("catpreop", "66830")]

# ICD-9, ICD-10, kind, expired
CROSSWALK = (
    [(nine, ten, "d", None) for ten, nine in DIAGNOSES if ten not in UNMAPPED]
    + [("733.00", "M81.0", "d", None), ("414.00", "I25.10", "d", None), ("414.01", "I25.110", "d", None),
       # a second ICD-9 code outside the rules, which the one-target map of claims takes
       ("411.89", "I25.810", "d", None), ("353.4", "M54.16", "d", None), ("290.40", "F03.911", "d", None),
       ("339.00", "R51", "d", "2014-09-30"), ("43.11", FEEDING_TUBE_PCS, "p", None)]
)
# Codes with several unexpired or expired targets; their rows are approximate.
MANY_TARGETS = {"M81.0", "I25.10", "724.3", "414.01", "R51", "346.90", "414.02", "294.20", "805.2", "I25.810", "M54.16", "F03.911"}

# ICD-10 code -> level; the ICD-9 partner in DIAGNOSES has the same level.
HCC_LEVELS = [("C79.51", "8"), ("C61", "12"), ("E11.9", "19"), ("N18.3", "138"), ("S22.000A", "169")]
CCS_LEVELS = [("M54.5", "205"), ("M54.30", "205"), ("N40.1", "164"), ("R35.0", "163"), ("R07.9", "102"),
              ("I25.10", "101"), ("F03.90", "653"), ("G43.909", "84")]
# codes whose level differs between the generations: rules that name a level widen when they are mapped forward
OWN_LEVELS = {("hcc", 10): [("C80.1", "8")], ("hcc", 9): [("199.1", "12"), ("290.40", "52")],
              ("ccs", 10): [("R07.2", "102")], ("ccs", 9): [("786.51", "133")]}

# drug, unit price
DRUG_PRICES = [("red", "d03431", 0.5), ("blue", "d03428", 0.75), ("hot", "d04825", 1.25),
               ("cold", "d00198", 2.0), ("cold", "d00198", 3.0)]
FEE_BASE, FEE_STEP, UNPRICED = 10.0, 7.25, "82306"

VITD_COST = 40.0


def levels(kind: str, generation: int) -> list[tuple[str, str]]:
    """(dot-free code, level) pairs of one generation."""
    pairs = HCC_LEVELS if kind == "hcc" else CCS_LEVELS
    partner = dict(DIAGNOSES)
    shared = [(code if generation == 10 else partner[code], level) for code, level in pairs]
    return [(code.replace(".", ""), level) for code, level in shared + OWN_LEVELS[kind, generation]]


def crosswalk_rows() -> list[tuple]:
    """Crosswalk rows with types, descriptions and relation type."""
    out = []
    for nine, ten, kind, expired in CROSSWALK:
        approximate = nine in MANY_TARGETS or ten in MANY_TARGETS
        out.append((nine, ten, nine.replace(".", ""), ten.replace(".", ""),
                    "ICD_9_CM_CODE" if kind == "d" else "ICD_9_PROC_CODE",
                    "ICD10CM_CODE" if kind == "d" else "ICD10PCS_CODE",
                    f"nine {nine}", f"ten {ten}", "Approximate" if approximate else "Equal", expired))
    return out


def fee_rows() -> list[tuple]:
    out = []
    for i, code in enumerate(PROCEDURES):
        if code == UNPRICED:
            continue
        full = FEE_BASE + FEE_STEP * i
        out.append((code, None, f"procedure {code}", round(full / 36, 4), full))
        out.append((code, "26", f"procedure {code}", round(full / 72, 4), full / 2))
    return out
