"""The whole grid on random patients with times of day, repeats and null codes,
against the row-pairing SQL. The driver tables only have whole days."""

import datetime as dt
import itertools
import random

import pandas as pd
import pytest

from lowtide import model as M
from lowtide.catalog import study
from lowtide.catalog.measures import shown
from lowtide.plans.metrics import Inputs, evaluate
from lowtide.sources import clinical as C
from lowtide.sources import sinks
from lowtide.sources import vocabulary as V
from oracle.base import with_base
from oracle.cells import SHOWN, cells
from support import assert_same, duck

START = dt.datetime(1996, 1, 1)
DAYS = 1096


def moments(rng, n):
    # half on the hour grid of a few days, so that ties and exact day gaps occur
    return [START + dt.timedelta(days=rng.randrange(DAYS), hours=rng.choice([0, 0, 6, 12, rng.randrange(24)]),
                                 minutes=rng.choice([0, 0, rng.randrange(60)])) for _ in range(n)]


def patients(seed: int, n: int = 60):
    rng = random.Random(seed)
    who = [f"{i:09d}" for i in range(n)]
    # one patient holds a third of the rows
    pick = lambda: who[0] if rng.random() < 0.33 else rng.choice(who)
    age = {m: rng.choice([25.0, 45.5, 52.0, 66.1, 70.0, 79.9]) for m in who}
    sex = {m: rng.choice("FM") for m in who}
    icd = [t.replace(".", "") for t, _ in V.DIAGNOSES] + ["I25110"]

    claims = [(m, t, rng.choice(icd) if rng.random() > 0.03 else None, age[m], sex[m])
              for t in moments(rng, 900) for m in [pick()]]
    services = [(m, f"e{rng.randrange(400)}", rng.choice(V.PROCEDURES), t, age[m], sex[m])
                for t in moments(rng, 2500) for m in [pick()]]
    drugs = [(m, None, rng.choice([d for _, d in V.DRUG_NAMES]), t, age[m], sex[m]) for t in moments(rng, 600) for m in [pick()]]
    scans = [(m, e, t, a, g) for m, e, c, t, a, g in services if c == "77080"]
    stays = []
    for t in moments(rng, 250):
        m = pick()
        stays.append((m, t, t + dt.timedelta(hours=rng.choice([2, 10, 24, 48, 100]))))
    # an admission on the day of a surgery
    for m, _, c, t, *_ in services:
        if c in dict(map(reversed, V.SURGERY)) and rng.random() < 0.2:
            stays.append((m, t.replace(hour=1, minute=0), t + dt.timedelta(hours=rng.choice([1, 30]))))
    frame = lambda rows, names: pd.DataFrame(rows, columns=names)
    return {
        "claims": frame(claims, ["MRN", "EVT_DATE", "ICD10_subcode", "AgeAtTest", "GENDER"]),
        "services": frame(services, ["MRN", "ENC_ID", "CODE", "EVT_DATE", "AgeAtTest", "GENDER"]),
        "drugs": frame(drugs, ["MRN", "ENC_ID", "CODE", "EVT_DATE", "AgeAtTest", "GENDER"]),
        "scans": frame(scans, ["MRN", "ENC_ID", "EVT_DATE", "AgeAtTest", "GENDER"]),
        "adm": frame(stays, ["MRN", "ADM_DT", "DIS_DT"]),
    }


SCHEMAS = {
    "claims": M.schema(MRN=M.STRING, EVT_DATE=M.TS, ICD10_subcode=M.STRING, AgeAtTest=M.DOUBLE, GENDER=M.STRING),
    "services": M.schema(MRN=M.STRING, ENC_ID=M.STRING, CODE=M.STRING, EVT_DATE=M.TS, AgeAtTest=M.DOUBLE, GENDER=M.STRING),
    "drugs": M.schema(MRN=M.STRING, ENC_ID=M.STRING, CODE=M.STRING, EVT_DATE=M.TS, AgeAtTest=M.DOUBLE, GENDER=M.STRING),
    "scans": M.schema(MRN=M.STRING, ENC_ID=M.STRING, EVT_DATE=M.TS, AgeAtTest=M.DOUBLE, GENDER=M.STRING),
    "adm": M.schema(MRN=M.STRING, ADM_DT=M.TS, DIS_DT=M.TS),
}


def told_apart(result):
    """Pairs of modes that agree in all metrics but two or fewer: a mode wired to another's crosswalk would be one."""
    rows = {}
    for r in shown(result).collect():
        rows.setdefault(r["mode"], {}).setdefault(r["metric"], set()).add(tuple(r[1:]))
    return [(a, b) for a, b in itertools.combinations(M.MODES, 2) if sum(rows[a].get(m) != rows[b].get(m) for m in M.METRIC_NAMES) < 3]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_grid(spark, seed):
    tables = patients(seed)
    frames = {k: spark.createDataFrame(v, SCHEMAS[k]) for k, v in tables.items()}
    con = duck()
    for name, table in tables.items():
        renamed = table.rename(columns={"AgeAtTest": "age"})
        con.register(f"{name}_in", renamed)
        typed = ", ".join(f"cast({c} as varchar) AS {c}" if c in ("ENC_ID", "ICD10_subcode") else c for c in renamed.columns)
        con.execute(f"CREATE TABLE {name} AS SELECT {typed} FROM {name}_in")
    inputs = Inputs(frames["claims"], frames["services"], frames["drugs"], frames["scans"], frames["adm"], C.STUDY)
    result = sinks.stage(evaluate(inputs, study.full_book(spark), sinks.stage), "random")
    assert result.select("mode", "metric", "term").distinct().count() >= 100  # of 110: the cells are not empty
    assert told_apart(result) == []
    sql = with_base(SHOWN, cells(M.METRIC_NAMES, list(M.MODES)), frozenset(tables))
    assert_same(shown(result), con, sql)
