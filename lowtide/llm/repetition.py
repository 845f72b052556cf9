"""Quality rules on repeated passages, by suffix arrays.

The words of each text are ranked by suffix (prefix doubling over a block of
texts at once, refining only ties). The longest-common-prefix values of
neighbours in that order give the LCP intervals; every maximal repeated run of
at least ``min_run`` words is an interval, and its occurrences are exactly the
spans ``[i, i + lcp(i))`` of its suffixes. The union of these spans is the
covered part of the text.

Null and empty texts have no words and fail the base rule. Repeated rows are
measured one by one. Extra columns pass through ``keep_clean`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lowtide.llm.arrays import LEADING, Block, blocks

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """Bounds of the rules; percentages of the words of a text."""

    min_words: int = 20
    window: int = 8
    window_percent: int = 30
    min_run: int = 5
    covered_percent: int = 40
    longest_run: int = 50


def longest_matches(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest run that starts there and occurs again in the same text."""
    n = len(words)
    found = np.zeros(n, np.int64)
    if n < 2:
        return found
    order = np.lexsort((words, owner))
    new = np.ones(n, bool)
    new[1:] = (words[order[1:]] != words[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    rank = np.empty(n, np.int64)
    heads = np.flatnonzero(new)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    levels, size = [rank], 1
    ties = _tied(rank, np.arange(n))
    ends = np.searchsorted(owner, owner, side="right")
    while len(ties):
        ahead = ties + size
        inside = ahead < ends[ties]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[ties] * (n + 2) + second
        by = np.argsort(key, kind="stable")
        ties, key = ties[by], key[by]
        group = rank[ties]
        fresh = np.ones(len(ties), bool)
        fresh[1:] = key[1:] != key[:-1]
        outer = np.ones(len(ties), bool)
        outer[1:] = group[1:] != group[:-1]
        place = np.arange(len(ties))
        offset = place - np.maximum.accumulate(np.where(outer, place, 0))
        head = np.maximum.accumulate(np.where(fresh, place, 0))
        rank = rank.copy()
        rank[ties] = group + offset[head]
        size *= 2
        levels.append(rank)
        ties = _tied(rank, ties)
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    left, right = suffixes[:-1], suffixes[1:]
    same = np.flatnonzero(levels[0][left] == levels[0][right])
    left, right = left[same], right[same]
    common = np.zeros(len(same), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left + common, right + common
        inside = (a < ends[left]) & (b < ends[right])
        a, b = np.minimum(a, n - 1), np.minimum(b, n - 1)
        common += np.where(inside & (levels[k][a] == levels[k][b]), 1 << k, 0)
    np.maximum.at(found, left, common)
    np.maximum.at(found, right, common)
    return found


def _tied(rank: np.ndarray, among: np.ndarray) -> np.ndarray:
    ranks = np.sort(rank[among])
    twice = ranks[1:][ranks[1:] == ranks[:-1]]
    return among[np.isin(rank[among], twice)] if len(twice) else among[:0]


def covered(matches: np.ndarray, owner: np.ndarray, texts: int, least: int, width: int | None = None) -> np.ndarray:
    """Words of each text inside a repeated run of ``least`` words or more (or in its first ``width`` words)."""
    at = np.flatnonzero(matches >= least)
    change = np.zeros(len(matches) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + (matches[at] if width is None else width), -1)
    return np.bincount(owner, weights=np.cumsum(change[:-1]) > 0, minlength=texts).astype(np.int64)


def measure_block(block: Block, limits: Limits) -> dict[str, np.ndarray]:
    starts, ends, owner = block.words
    n_words = np.bincount(owner, minlength=block.n).astype(np.int64)
    matches = longest_matches(block.hashes(starts, ends), owner)
    repeated = covered(matches, owner, block.n, limits.window, limits.window)
    spans = covered(matches, owner, block.n, limits.min_run)
    longest = np.zeros(block.n, np.int64)
    np.maximum.at(longest, owner, matches)

    lines, line_ends, line_owner = block.lines
    words_before = np.concatenate(([0], np.cumsum(block.is_word)))
    real = words_before[line_ends] > words_before[lines]
    lines, line_ends, line_owner = lines[real], line_ends[real], line_owner[real]
    hashed = block.hashes(lines, line_ends)
    order = np.lexsort((hashed, line_owner))
    again = (hashed[order[1:]] == hashed[order[:-1]]) & (line_owner[order[1:]] == line_owner[order[:-1]])
    dup_lines = np.bincount(line_owner[order[1:]][again], minlength=block.n).astype(np.int64)

    failed = (n_words < limits.min_words) | (100 * repeated > limits.window_percent * n_words)
    clean = ~failed & (100 * spans <= limits.covered_percent * n_words) & (longest <= limits.longest_run)
    return {"n_words": n_words, "word_chars": block.totals(block.is_word & LEADING[block.data]),
            "n_symbols": block.totals(SYMBOLS[block.data]), "n_dup_lines": dup_lines, "n_repeat_words": repeated,
            "base_failed": failed, "kept": clean, "covered_words": spans, "longest_run": longest}


def measure(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept``, and the covered words and longest run behind the verdict."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                ids = batch.column(0).slice(block.first, block.n)
                out = measure_block(block, limits)
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, out.values())], ["doc_id", *out])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, kept boolean, covered_words long, longest_run long")


def keep_clean(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` whose text passes, with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(at)):
                yield batch.slice(block.first, block.n).filter(pa.array(measure_block(block, limits)["kept"]))

    return docs.mapInArrow(run, docs.schema)
