"""Sets of keys as bitmaps: a filter of bounded size in front of a join.

A key's hash names a block of 32,768 bits and two bits in it. A set of keys is a
table of at most ``BLOCKS`` rows of 4 KB, built by aggregation (partial bitmaps
are or-ed) whatever the number of keys. A key of the set always passes; the share of others that
pass grows with the set, so an exact join has to follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = 1024
BITS = 32768


def _places(key: Column) -> tuple[Column, list[Column]]:
    h = F.xxhash64(key)
    slots = [F.shiftrightunsigned(h, 10 + 15 * k).bitwiseAND(F.lit(BITS - 1)) for k in range(2)]
    return h.bitwiseAND(F.lit(BLOCKS - 1)), slots


def bit_at(bits: Column, slot: Column) -> Column:
    """Whether the bit at ``slot`` of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(slot, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, slot.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1


def key_set(rows: DataFrame, column: str) -> DataFrame:
    """``_block, _bits`` of the values of ``column``."""
    block, slots = _places(F.col(column))
    marks = rows.filter(F.col(column).isNotNull()).select(block.alias("_block"), F.explode(F.array(*slots)).alias("_slot"))
    return marks.groupBy("_block").agg(F.bitmap_construct_agg(F.col("_slot")).alias("_bits"))


def filtered(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``column`` is not in the set ``keys``; null never is.

    The set is broadcast: 4 MB at most.
    """
    block, slots = _places(F.col(column))
    joined = rows.withColumn("_at", block).join(F.broadcast(keys), F.col("_at") == F.col("_block"))
    for slot in slots:
        joined = joined.filter(bit_at(F.col("_bits"), slot))
    return joined.filter(F.col(column).isNotNull()).select(*rows.columns)
