"""A stored grid of results that is kept up to date cell by cell.

Beside the stored cells lies a manifest with the state of each (mode, metric):
a hash of its rules, its metric's settings, the study dates and the input files
(name, size and time). An update computes the cells whose state differs, in one
pass, and replaces their folders; the others are not touched.

The manifest names a cell only after its rows are written, and forgets it before
they are removed, so a run that is killed leaves cells that the next one
computes again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lowtide.model import RESULT_SCHEMA, Study
from lowtide.plans.metrics import Inputs, Stage, evaluate
from lowtide.plans.rulebook import ALL_CODES, Rulebook, scope_of
from lowtide.session import exists, files_below, remove
from lowtide.sources.sinks import write_result

Cell = tuple[str, str]
MANIFEST = "mode string, metric string, state string"


def input_state(spark: SparkSession, paths: list[str]) -> str:
    """Names, sizes and times of the files of the input tables."""
    found = sorted(f for path in paths for f in files_below(spark, path))
    return hashlib.sha256(repr(found).encode()).hexdigest()


def rule_hashes(book: Rulebook) -> dict[tuple[str, str, str], str]:
    """A hash of the rows of each tag table by table, mode and metric; row order does not matter.

    Crosswalk scopes have a key without a metric. One row a cell and table
    comes to the driver.
    """
    def hashed(rows: DataFrame, table: str, mode, metric) -> DataFrame:
        row = F.xxhash64(*[F.col(c) for c in rows.columns]).cast("decimal(38,0)")
        return rows.groupBy(mode.alias("mode"), metric.alias("metric")).agg(
            F.concat_ws("/", F.sum(row).cast("string"), F.count(F.lit(1)).cast("string")).alias("hash")).withColumn("table", F.lit(table))

    facts = book.code_facts
    old = facts.select("probe", F.explode("old_in").alias("cell"))
    scopes = facts.select("probe", F.explode("scopes").alias("scope"))
    parts = [hashed(book.claim_tags, "claims", F.col("mode"), F.col("metric")),
             hashed(book.service_tags, "services", F.col("mode"), F.col("metric")),
             hashed(old, "old", F.split_part("cell", F.lit("|"), F.lit(1)), F.split_part("cell", F.lit("|"), F.lit(2))),
             hashed(scopes, "scopes", F.col("scope"), F.lit(""))]
    return {(r.table, r["mode"], r.metric): r.hash for r in reduce(DataFrame.unionByName, parts).collect()}


def cell_states(book: Rulebook, hashes: dict[tuple[str, str, str], str], study: Study, inputs: str) -> dict[Cell, str]:
    """The state of every cell of the rulebook."""
    out = {}
    for mode in book.modes:
        for metric in book.metrics:
            rules = [hashes.get((table, m, metric.name)) for table in ("claims", "services", "old") for m in (mode.name, ALL_CODES)]
            parts = (mode, metric, book.limits[metric.name], metric.name in book.cpt_flagged, rules, hashes.get(("scopes", scope_of(mode), "")),
                     study, inputs)
            out[mode.name, metric.name] = hashlib.sha256(repr(parts).encode()).hexdigest()
    return out


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}-cells"


def stored_states(spark: SparkSession, path: str) -> dict[Cell, str]:
    if not exists(spark, f"{_manifest(path)}/_SUCCESS"):
        return {}
    return {(r["mode"], r.metric): r.state for r in spark.read.schema(MANIFEST).parquet(_manifest(path)).collect()}


def _note(spark: SparkSession, path: str, states: dict[Cell, str]) -> None:
    rows = spark.createDataFrame([(*cell, state) for cell, state in sorted(states.items())], MANIFEST)
    rows.coalesce(1).write.mode("overwrite").parquet(_manifest(path))


def update(spark: SparkSession, path: str, book: Rulebook, wanted: dict[Cell, str], inputs: Callable[[tuple[str, ...]], Inputs],
           stage: Stage) -> list[Cell]:
    """Bring the cells stored at ``path`` to the states ``wanted``; returns those that were computed.

    ``inputs`` gives the tables that some metrics read. Cells that are no longer
    wanted are removed.
    """
    known = stored_states(spark, path)
    stale = sorted(c for c in {*known, *wanted} if known.get(c) != wanted.get(c))
    if not stale:
        return []
    kept = {c: s for c, s in known.items() if c not in stale}
    _note(spark, path, kept)
    for mode, metric in stale:
        remove(spark, f"{path}/mode={mode}/metric={metric}")
    due = [c for c in stale if c in wanted]
    if due:
        modes, metrics = sorted({m for m, _ in due}), tuple(sorted({m for _, m in due}))
        result = evaluate(inputs(metrics), book.subset(list(metrics), modes), stage)
        cell = F.concat_ws("|", "mode", "metric")
        write_result(result.filter(cell.isin(["|".join(c) for c in due])).select(*RESULT_SCHEMA.names), path, mode="append")
        _note(spark, path, {**kept, **{c: wanted[c] for c in due}})
    return due
