"""Joins of event rows with per-key facts when one key may hold most of the events.

Keys are counted in a sketch: every key falls into one of ``CELLS`` cells by its
hash, and the cells are counted with map-side combining. A cell's count is never
below that of any of its keys, so no heavy key is missed; light keys that share a
heavy cell are split as well, which costs a few copies of facts and nothing else.
A cell above an even share of a shuffle partition is dealt into as many pieces as
its count has shares.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 1 << 14


@dataclass(frozen=True)
class Deal:
    """Cells of ``keys`` to split, and the pieces of each; fewer than the shuffle has partitions."""

    keys: tuple[str, ...]
    pieces: dict[int, int]

    def _pieces(self) -> Column:
        held = F.create_map(*(F.lit(x) for x in chain.from_iterable(self.pieces.items())))
        return F.coalesce(F.element_at(held, _cell(self.keys)), F.lit(1))

    def salted(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_piece``, even over the pieces of the row's cell; equal rows meet in one piece."""
        return rows.withColumn("_piece", F.pmod(F.xxhash64(*rows.columns), self._pieces()).cast("int"))

    def copied(self, facts: DataFrame) -> DataFrame:
        """``facts`` once for each piece of their cell."""
        return facts.withColumn("_piece", F.explode(F.sequence(F.lit(0), self._pieces() - 1)))


def _cell(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(CELLS)).cast("int")


def deal(rows: DataFrame, keys: Sequence[str], parts: int | None = None) -> Deal:
    """Count ``rows`` by cell and find the cells to split, for a shuffle of ``parts`` partitions.

    At most ``CELLS`` counts come to the driver.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy(_cell(keys).alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()
    share = max(1, -(-sum(r.n for r in counts) // parts))
    return Deal(tuple(keys), {r.cell: -(-r.n // share) for r in counts if r.n > share})


def join_facts(rows: DataFrame, facts: DataFrame, keys: list[str], how: str = "inner", by: Deal | None = None) -> DataFrame:
    """Join events with facts that have one row per key.

    Facts come straight out of a grouping, where adaptive execution cannot split
    a skewed partner, so the events of heavy keys are dealt into pieces and the facts of
    those keys copied to each. ``by`` is a deal of some of ``keys``, made from
    rows like these; without one, ``rows`` are counted first.
    """
    by = by or deal(rows, keys)
    if not set(by.keys) <= set(keys):
        raise ValueError(f"dealt by {by.keys}, joined by {keys}")
    if not by.pieces:
        return rows.join(facts, keys, how)
    return by.salted(rows).join(by.copied(facts), [*keys, "_piece"], how).drop("_piece")
