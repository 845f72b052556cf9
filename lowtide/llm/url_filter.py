"""URL filter by the likelihood ratio of two character models.

Rules on host and path decide where one fits. Their verdicts label the training
rows: one variable-order Markov model (up to three characters of context,
Witten-Bell smoothing down to a uniform start) is counted over all accepted and
one over all rejected URLs. A URL without a rule is allowed when its
log-likelihood difference per character reaches a threshold, calibrated on a
fifth of the labelled rows that is kept out of the counts.

Symbols are 40 (letters in one case, digits, ``. / -`` and one for all else), so
a model has 40^4 cells at most whatever the input; counts come from all labelled
rows. Without rows of either class, or of held-out ones, the threshold is zero
and the ratio is what the counts give.

Null URLs and URLs without ``://`` have an empty host and path, no rule and
ratio zero. Rows are independent; repeated ones get equal answers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lowtide.llm.arrays import Block, blocks

SYMBOLS = 40
ORDER = 4
OTHER = SYMBOLS - 1
HELD_OUT = 5
BINS = 1000
_CODES = np.full(256, OTHER, np.int64)
_CODES[97:123] = _CODES[65:91] = np.arange(26)
_CODES[48:58] = np.arange(26, 36)
_CODES[[46, 47, 45]] = (36, 37, 38)


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains when the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# fixed values: the rules of the query
RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def parts(urls: DataFrame) -> DataFrame:
    """``page_id, host, path`` of ``urls(page_id, url)``; A-Z of the host lower-cased."""
    url = F.coalesce("url", F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return urls.select("page_id", F.translate(F.regexp_extract(url, _PARTS, 1), upper, lower).alias("host"),
                       F.regexp_extract(url, _PARTS, 2).alias("path"))


def ruled(urls: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``urls(host, path)`` with the longest rule that fits and its verdict, null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith(f".{rule.host}")) & F.col("path").startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return urls.withColumn("rule", name).withColumn("ruled", verdict)


def grams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """For each character its code together with the three before it, and its owner."""
    owner = np.repeat(np.arange(block.n), np.diff(block.offsets))
    codes = _CODES[block.data]
    place = np.arange(len(codes)) - block.offsets[owner]
    out = codes.copy()
    for back in range(1, ORDER):
        before = np.full(len(codes), OTHER)
        before[back:] = codes[:-back]
        out += np.where(place >= back, before, OTHER) * SYMBOLS**back
    return out, owner


def counts(rows: DataFrame) -> DataFrame:
    """``(ruled, gram, n)`` over ``rows(name, ruled)``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = batch.column(1).to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(0)):
                found, owner = grams(block)
                label = (verdicts[block.first: block.first + block.n] == "allow")[owner]
                key, n = np.unique(found * 2 + label, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key % 2 == 1), pa.array(key // 2), pa.array(n)], ["allowed", "gram", "n"])

    found = rows.select("name", "ruled").mapInArrow(run, "allowed boolean, gram long, n long")
    return found.groupBy("allowed", "gram").agg(F.sum("n").alias("n"))


def log_likelihood(table: np.ndarray) -> np.ndarray:
    """Log probability of each gram's last character after the others, from gram counts."""
    table = table.reshape((SYMBOLS,) * ORDER).astype(np.float64)
    below = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order in range(1, ORDER + 1):
        seen = table.sum(axis=tuple(range(ORDER - order)))
        total, kinds = seen.sum(-1, keepdims=True), (seen > 0).sum(-1, keepdims=True)
        below = np.where(total > 0, (seen + kinds * below) / np.maximum(total + kinds, 1), below)
    return np.log(below).ravel()


def ratio_table(found: Iterable[tuple[bool, int, int]]) -> np.ndarray:
    """Accepted minus rejected log likelihood of each gram; at most two rows a cell come in."""
    tables = np.zeros((2, SYMBOLS**ORDER))
    for allowed, gram, n in found:
        tables[int(allowed), gram] = n
    return (log_likelihood(tables[1]) - log_likelihood(tables[0])).astype(np.float32)


def scored(rows: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``rows`` with ``ratio``, the mean over the characters of ``name`` (zero without any)."""
    shared, at = rows.sparkSession.sparkContext.broadcast(ratios), rows.columns.index("name")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(at)):
                found, owner = grams(block)
                sums = np.bincount(owner, weights=shared.value[found], minlength=block.n)
                part = batch.slice(block.first, block.n)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sums / np.maximum(np.diff(block.offsets), 1))],
                                                 [*batch.schema.names, "ratio"])

    return rows.mapInArrow(run, rows.schema.simpleString()[7:-1].replace(":", " ") + ", ratio double")


def threshold(held: DataFrame) -> float:
    """The middle of the bins where both classes together are wrong least often, each counted as a share of its rows."""
    place = F.greatest(F.lit(-5 * BINS), F.least(F.lit(5 * BINS), F.floor(F.col("ratio") * BINS)))
    found = held.groupBy((F.col("ruled") == "allow").alias("allowed"), place.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    table = np.zeros((2, 10 * BINS + 1))
    for row in found:
        table[int(row["allowed"]), row["bin"] + 5 * BINS] = row["n"]
    if not table.sum(1).all():
        return 0.0
    rejected_good = np.concatenate(([0], np.cumsum(table[1]))) / table[1].sum()
    kept_bad = 1 - np.concatenate(([0], np.cumsum(table[0]))) / table[0].sum()
    wrong = rejected_good + kept_bad
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float((best[len(best) // 2] - 5 * BINS) / BINS)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, ratio, threshold`` of every row."""
    rows = ruled(parts(pages.select("page_id", "url")), rules).withColumn("name", F.concat("host", "path"))
    labelled = rows.filter("ruled is not null")
    fold: Column = F.pmod(F.xxhash64("name"), F.lit(HELD_OUT))
    table = ratio_table((r["allowed"], r["gram"], r["n"]) for r in counts(labelled.filter(fold != 0)).collect())
    limit = threshold(scored(labelled.filter(fold == 0).select("name", "ruled"), table))
    return scored(rows, table).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("ratio") >= limit, "allow").otherwise("block")).alias("verdict"),
        "ratio", F.lit(limit).alias("threshold"))
