"""Mixing sources to target weights by entropy balancing.

Each source has a target of words. Of all document rates with those totals, the
ones of least relative entropy to "every document once" are exponentially
tilted by size, ``min(most, exp(multiplier * size))``; the multiplier of a
source solves the convex dual of its word constraint. Newton steps on the
logarithm of the total, kept inside a bracket, find all multipliers at once: each
step is one aggregation over (source, size) cells, never over documents, so a
source with a third of the rows costs as many rows as it has sizes.

Rates become whole copies cell by cell: running totals over sizes are rounded,
so errors cancel, and the last words are settled by single copies of fitting
size. Inside a cell copies are dealt by a hash order; large cells are split by
hash first. Sums are decimals, so reruns agree bit by bit.

Null text has no words; null is a source of its own, ordered last. A document
without words has rate one and takes no words. Rows with equal ids are separate
documents; equal rows share out their copies.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lowtide.sources.sinks import stage

WORD = r"[^\x20\x09-\x0D]+"
CELL_ROWS = 100_000
STEPS = 60
CLOSE = 1e-9
SETTLE_STEPS = 4


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source`` and ``size``, the words of each row."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(totals: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``target`` words of each row of ``totals(source, source_size)``; one row a source.

    The sum of all sizes is shared by weight; a share above ``most`` times its
    source stops there. With sources in order of that bound per weight, the
    water level after giving the first ones their bound is a running sum; it
    rises up to the first source that stays below its bound and falls after it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    rows = totals.withColumn("weight", weight).withColumn("bound", most * F.col("source_size"))
    level = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = level.rowsBetween(Window.unboundedPreceding, -1), level.rowsBetween(0, Window.unboundedFollowing)
    whole = level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("bound").over(before), F.lit(0)))
                           / F.sum("weight").over(after))
    final = F.max(F.when(F.col("bound") > F.col("weight") * F.col("level"), F.col("level"))).over(whole)
    return rows.withColumn("final", final).select(
        "source", "source_size", F.coalesce(F.least(F.col("bound").cast("double"), F.col("weight") * F.col("final")),
                                            F.col("bound").cast("double")).alias("target"))


def _rate(most: int):
    return F.exp(F.least(F.col("multiplier") * F.col("size") / F.col("largest"), F.lit(math.log(most))))


def multipliers(cells: DataFrame, goals: DataFrame, most: int) -> DataFrame:
    """``(source, largest, multiplier)``: Newton steps on all sources with words at once."""
    spans = cells.filter("size > 0").groupBy("source").agg(F.max("size").alias("largest"), F.min("size").alias("smallest"))
    ratio = F.log(F.col("target") / F.col("source_size"))
    near, far = F.lit(0.0), F.col("largest") / F.col("smallest")
    state = goals.join(spans, goals["source"].eqNullSafe(spans["source"])).select(
        goals["source"], "source_size", "target", "largest",
        F.when(ratio < 0, ratio * far).otherwise(near).alias("low"),
        F.when(ratio < 0, near).otherwise(F.lit(math.log(most)) * far).alias("high"),
        F.when(F.col("target") >= most * F.col("source_size"), F.lit(math.log(most)) * far).otherwise(near).alias("multiplier"))
    state = stage(state, "multipliers")
    exact = "decimal(38,9)"
    for _ in range(STEPS):
        s = state.alias("s")
        rows = cells.filter("size > 0").alias("c").join(s, F.col("c.source").eqNullSafe(F.col("s.source"))).select(
            "c.size", "c.n", "s.*", _rate(most).alias("rate"))
        words = F.col("n") * F.col("size") * F.col("rate")
        slope = F.when(F.col("rate") < most, words * F.col("size") / F.col("largest")).otherwise(F.lit(0.0))
        sums = rows.groupBy("source", "source_size", "target", "largest", "low", "high", "multiplier").agg(
            F.sum(words.cast(exact)).cast("double").alias("got"), F.sum(slope.cast(exact)).cast("double").alias("slope"))
        over = F.col("got") > F.col("target")
        sums = sums.withColumn("low", F.when(over, F.col("low")).otherwise(F.col("multiplier"))).withColumn(
            "high", F.when(over, F.col("multiplier")).otherwise(F.col("high")))
        newton = F.col("multiplier") + F.log(F.col("target") / F.col("got")) * F.col("got") / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        done = F.abs(F.col("got") - F.col("target")) <= CLOSE * F.col("target")
        state = stage(sums.select(
            "source", "source_size", "target", "largest", "low", "high",
            F.when(done, F.col("multiplier")).when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2).alias("multiplier"),
            done.alias("done")), "multipliers")
        if state.filter("not done").isEmpty():
            break
        state = state.drop("done")
    return state.select("source", "target", "largest", "multiplier")


def _settle(shares: DataFrame, most: int) -> DataFrame:
    """Add or take single copies in the cell that brings each source closest to its target."""
    for _ in range(SETTLE_STEPS):
        off = shares.groupBy("source", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("got")).select(
            "source", (F.col("target") - F.col("got")).alias("missing"))
        o = off.alias("o")
        rows = shares.alias("s").join(o, F.col("s.source").eqNullSafe(F.col("o.source"))).select("s.*", "missing")
        room = F.when(F.col("missing") > 0, F.col("copies") < most * F.col("n")).otherwise(F.col("copies") > 0)
        gap = F.abs(F.abs(F.col("missing")) - F.col("size"))
        fitting = rows.filter(room & (F.col("size") > 0) & (gap < F.abs(F.col("missing")))).groupBy("source").agg(
            F.min(F.struct(gap.alias("gap"), "size", "sub", "missing")).alias("best"))
        b = fitting.alias("b")
        here = (F.col("best.size") == F.col("s.size")) & (F.col("best.sub") == F.col("s.sub"))
        shares = stage(shares.alias("s").join(b, F.col("s.source").eqNullSafe(F.col("b.source")), "left").select(
            "s.source", "s.target", "s.size", "s.sub", "s.n",
            (F.col("s.copies") + F.when(here, F.signum("best.missing").cast("long")).otherwise(F.lit(0))).alias("copies")), "shares")
    return shares


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` of every row; ``taken`` is ``copies * size``."""
    base = stage(sizes(docs), "sizes")
    cells = stage(base.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "subs", F.expr(f"(n + {CELL_ROWS - 1}) div {CELL_ROWS}")), "cells")
    totals = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    goals = stage(targets(totals, weights, most), "targets")
    tilt = multipliers(cells, goals, most)

    d, c = base.alias("d"), cells.alias("c")
    draw = F.xxhash64(F.col("d.doc_id"), F.lit(11))
    placed = stage(d.join(c, F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.size") == F.col("c.size"))).select(
        "d.doc_id", "d.source", "d.size", draw.alias("draw"), F.pmod(draw, F.col("subs")).alias("sub")), "placed")
    groups = placed.groupBy("source", "size", "sub").agg(F.count(F.lit(1)).alias("n")).alias("g")
    t = tilt.alias("t")
    rated = groups.join(t, F.col("g.source").eqNullSafe(F.col("t.source"))).filter("size > 0").select(
        "g.*", "target", (F.col("n") * _rate(most)).cast("decimal(38,9)").alias("expected"))
    running = Window.partitionBy("source").orderBy("size", "sub").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("expected").over(running)
    half = F.lit(0.5).cast("decimal(2,1)")
    shares = rated.withColumn("upto", upto).select(
        "source", "target", "size", "sub", "n", (F.floor(F.col("upto") + half) - F.floor(F.col("upto") - F.col("expected") + half))
        .cast("long").alias("copies"))
    shares = _settle(stage(shares.withColumn("copies", F.least("copies", most * F.col("n"))), "shares"), most).alias("h")

    ranked = placed.withColumn("place", F.row_number().over(Window.partitionBy("source", "size", "sub").orderBy("draw", "doc_id"))).alias("r")
    dealt = ranked.join(shares, F.col("r.source").eqNullSafe(F.col("h.source")) & (F.col("r.size") == F.col("h.size"))
                        & (F.col("r.sub") == F.col("h.sub")), "left").select(
        "r.doc_id", "r.source", "r.size",
        F.when(F.col("h.n").isNull(), F.lit(1)).otherwise(F.expr("copies div n + if(place <= copies % n, 1, 0)")).cast("long").alias("copies")).alias("x")
    g = goals.alias("g")
    return dealt.join(g, F.col("x.source").eqNullSafe(F.col("g.source"))).select(
        "x.doc_id", "x.source", "x.size", "source_size", "target", "copies")


def repeat(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them (none to ``most`` times), with all their columns."""
    mark = "mix_" + "_".join(docs.columns)
    size, place, times = mark + "_size", mark + "_place", mark + "_times"
    same = Window.partitionBy("doc_id", "source", size)
    found = mix(docs, weights, most).select("doc_id", "source", F.col("size").alias(size), F.col("copies").alias(times)).withColumn(
        place, F.row_number().over(same.orderBy(times))).alias("m")
    rows = docs.withColumn(size, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")).withColumn(
        place, F.row_number().over(same.orderBy("text"))).alias("d")
    on = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & F.col("d.source").eqNullSafe(F.col("m.source"))
    for name in (size, place):
        on = on & (F.col(f"d.`{name}`") == F.col(f"m.`{name}`"))
    taken = rows.join(found, on).filter(F.col(f"`{times}`") > 0)
    return taken.select(*(F.col(f"d.`{c}`") for c in docs.columns), F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"`{times}`")))
                        .alias(times)).select(*(F.col(f"`{c}`") for c in docs.columns))
