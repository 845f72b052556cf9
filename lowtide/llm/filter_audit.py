"""Interaction of document filters: what each removes, alone and after the others, in every order.

Filters, in the order of their letters: A few words, B few distinct words, C many
capitals, D a mark of markup, E a text that a smaller ``doc_id`` has too. A
document's failures are one mask of five bits; the table of counts by (part,
mask) is additive, and all orders and steps follow from it alone.

E runs behind a prepass with a counting Bloom filter. The hash of a text names a
block of 32,768 counters and four counters in it; the counters are added over
all documents, and those of two or more are kept as one bit each. A text with a
counter below two is unique for sure and never moves. The others, some of them
by accident, shuffle with their whole text for the least id of each text. The
bits are at most ``MOST_BLOCKS`` rows of 4 KB (32 MB), which bounds the
broadcast; 16 counters a document are taken below that bound, beyond it more
unique texts shuffle and the result stays the same.

Null text is empty text, null source the empty part. Rows without an id never
fail E and are no smaller id; they have no labels. Rows repeated with one id do
not make each other fail E and count each. An id with several label rows is good (toxic)
when one of them says so. Very long texts are whole rows of the shuffle. An
empty table has no parts and no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lowtide.sources.sinks import release, stage

LETTERS = "ABCDE"
MASKS = 1 << len(LETTERS)
#: counters of a block, as many as the bits of one of Spark's bitmaps
BLOCK = 32768
MOST_BLOCKS = 8192
PER_DOCUMENT = 16
PROBES = 4


@dataclass(frozen=True)
class Limits:
    """``words`` at least; ``distinct`` words and ``capitals`` as percentages of words and characters; ``marks`` a pattern."""

    words: int = 50
    distinct: int = 65
    capitals: int = 5
    marks: str = r"[#$%&*|]"


def text_mask(text: Column, limits: Limits = Limits()) -> Column:
    """Bits of the filters that read one text: A 1, B 2, C 4, D 8."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")

    def judged(ws: Column) -> Column:
        n = F.size(ws)
        few = F.when(n < limits.words, 1).otherwise(0)
        same = F.when(100 * F.size(F.array_distinct(ws)) < limits.distinct * n, 2).otherwise(0)
        return few + same

    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text).cast("long") * limits.capitals
    # one binding of the words, which codegen would else split anew for each use
    return (F.element_at(F.transform(F.array(words), judged), 1) + F.when(capitals, 4).otherwise(0)
            + F.when(F.regexp_like(text, F.lit(limits.marks)), 8).otherwise(0))


def _block(h: Column, blocks: int) -> Column:
    return F.pmod(h, F.lit(blocks)).cast("int")


def _slots(h: Column) -> list[Column]:
    second = F.xxhash64(h, F.lit(1))
    return [F.shiftrightunsigned(second, 15 * k).bitwiseAND(F.lit(BLOCK - 1)).cast("int") for k in range(PROBES)]


def blocks_for(documents: int) -> int:
    """Blocks of the sketch, a power of two."""
    wanted = -(-documents * PER_DOCUMENT // BLOCK)
    return min(MOST_BLOCKS, 1 << max(0, wanted - 1).bit_length())


def sketch(hashes: DataFrame, blocks: int) -> DataFrame:
    """``block, bits`` of the counters that ``hashes(h)`` raise to two or more."""
    h = F.col("h")
    slots = hashes.select(_block(h, blocks).alias("block"), F.explode(F.array_distinct(F.array(*_slots(h)))).alias("slot"))
    twice = slots.groupBy("block", "slot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return twice.groupBy("block").agg(F.bitmap_construct_agg(F.col("slot").cast("long")).alias("bits"))


def _raised(bits: Column, slot: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(slot, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, slot.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1)) == 1


def maybe_repeated(hashed: DataFrame, bits: DataFrame, blocks: int) -> DataFrame:
    """``hashed`` with ``maybe``: all counters of ``h`` are two or more."""
    found = F.lit(True)
    for slot in _slots(F.col("h")):
        found = found & _raised(F.col("_bits"), slot)
    bits = F.broadcast(bits.select(F.col("block").alias("_block"), F.col("bits").alias("_bits")))
    joined = hashed.withColumn("_at", _block(F.col("h"), blocks)).join(bits, F.col("_at") == F.col("_block"), "left")
    return joined.withColumn("maybe", F.coalesce(found, F.lit(False))).drop("_at", "_block", "_bits")


def failures(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``doc_id, part, mask`` of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    hashed = rows.withColumn("h", F.xxhash64("text"))
    blocks = blocks_for(docs.count())
    seen = maybe_repeated(hashed, sketch(hashed.select("h"), blocks), blocks)
    # the text stays with possible repeats only
    seen = stage(seen.select("doc_id", "part", "h", text_mask(F.col("text"), limits).cast("int").alias("mask"), "maybe",
                             F.when(F.col("maybe"), F.col("text")).alias("text")), "text-masks")
    repeats = seen.filter("maybe").drop("maybe")
    # written, so that a text with very many copies can be split over tasks in the join
    first = stage(repeats.groupBy("h", "text").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
                  .filter("n > 1").drop("n"), "first-ids")
    last = F.when(F.col("doc_id") > F.col("first"), 16).otherwise(0)
    whole = repeats.join(first, ["h", "text"], "left").select("doc_id", "part", (F.col("mask") + last).alias("mask"))
    out = stage(seen.filter("not maybe").select("doc_id", "part", "mask").unionByName(whole), "masks")
    release(seen, first)
    return out


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: rows, and rows whose id is labelled of good quality and toxic."""
    marks = labels.groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                                         F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).filter("good + toxic > 0")
    none = F.lit(0).cast("long")
    rows = masks.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n")).select("part", "mask", "n", none.alias("good"), none.alias("toxic"))
    marked = masks.join(stage(marks, "label-marks"), "doc_id").groupBy("part", "mask").agg(
        F.sum("good").alias("good"), F.sum("toxic").alias("toxic")).select("part", "mask", none.alias("n"), "good", "toxic")
    return rows.unionByName(marked)


def report(counts: DataFrame) -> DataFrame:
    """The audit of every part, order and step from ``counts(part, mask, n, good, toxic)``.

    ``kept_n[S]`` counts the rows that fail no filter of the set S. What a filter
    removes after the filters S is ``kept[S] - kept[S and the filter]``.
    """
    kept = counts.groupBy("part").agg(*(
        F.array(*(F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) == 0, F.col(c)).otherwise(0)) for s in range(MASKS))).alias(f"kept_{c}")
        for c in ("n", "good", "toxic")))
    at = lambda c, s: F.get(f"kept_{c}", s if isinstance(s, Column) else F.lit(s))
    shares = []
    for f in range(len(LETTERS)):
        others = [s for s in range(MASKS) if not s >> f & 1]
        orders = {s: factorial(s.bit_count()) * factorial(len(LETTERS) - 1 - s.bit_count()) for s in others}
        shares.append(sum((orders[s] * (at("n", s) - at("n", s | 1 << f)) for s in others), F.lit(0)))
    rows = kept.withColumn("shares", F.array(*shares)).withColumn(
        "filter_order", F.explode(F.array(*(F.lit("".join(p)) for p in permutations(LETTERS))))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
    place = lambda j: F.instr(F.lit(LETTERS), F.substring("filter_order", j, F.lit(1))) - 1
    bit = lambda j: F.call_function("shiftleft", F.lit(1), place(j))
    before = F.lit(0)
    for j in range(1, len(LETTERS)):
        before = before + F.when(F.col("step") > j, bit(F.lit(j))).otherwise(0)
    rows = rows.withColumns({"own": bit(F.col("step")), "before": before, "share": F.get("shares", place(F.col("step")))})
    own, before = F.col("own"), F.col("before")
    removed = lambda c: at(c, before) - at(c, before.bitwiseOR(own))
    whole = F.lit(MASKS - 1)
    return rows.select(
        "part", "filter_order", "step", at("n", before.bitwiseOR(own)).alias("kept"), removed("n").alias("removed"),
        (at("n", 0) - at("n", own) - removed("n")).alias("redundant"), (at("n", whole.bitwiseXOR(own)) - at("n", whole)).alias("unique_fails"),
        removed("good").alias("good_lost"), removed("toxic").alias("toxic_lost"), F.col("share").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Counts of every part, order of the filters and step; see the module."""
    return report(mask_counts(failures(docs, limits), labels))
