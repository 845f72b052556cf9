"""Document fingerprints from SpotSigs.

At every anchor, a very common word, stands a signature: the anchor and a chain
of the next content words, every ``STEP``-th of them, ``CHAIN`` at most. Words
are taken without closing punctuation and with A-Z lower-cased. A text's
fingerprint is its set of distinct signatures, as sorted 8-digit hashes; a text
without an anchor has one signature of its whole wording, so different texts do
not meet in an empty set. Likeness is the Jaccard coefficient of two sets.

``near_pairs`` finds all pairs above a threshold: sets fall into partitions by
size such that partners lie in the same or the next one, only the rarest
signatures of a set probe, and the size bound prunes before sets are compared.

Null text is the empty text; equal texts have equal fingerprints. Rows of equal
``doc_id`` stand in order of their texts; rows without one come first.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lowtide.llm.arrays import LEADING, U64, Block, blocks, mix
from lowtide.sources.sinks import stage

STEP = 1
CHAIN = 2
THRESHOLD = 0.75

# fixed values: common words of the four languages
ANCHORS = (
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass "
    "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec "
    "el los y del se las un por con no una su para es al lo como más o pero sus").split()

def _anchor_hashes() -> np.ndarray:
    words = sorted(set(ANCHORS))
    block = Block(np.frombuffer("".join(words).encode(), np.uint8), np.concatenate(([0], np.cumsum([len(w.encode()) for w in words]))), 0)
    return np.sort(block.hashes(block.offsets[:-1], block.offsets[1:], fold=True))


def signatures(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 32-bit signatures of each text, sorted by text and value, and their owners."""
    words, owner = block.bare_words
    anchors = _anchor_hashes()
    at = np.searchsorted(anchors, words)
    common = np.append(anchors, 0)[at] == words
    content = np.flatnonzero(~common)
    spots = np.flatnonzero(common)
    found = words[spots]
    here = np.searchsorted(content, spots)
    length = np.zeros(len(spots), np.int64)
    for k in range(CHAIN):
        place = here + k * STEP + (STEP - 1)
        word = content[np.minimum(place, max(len(content) - 1, 0))] if len(content) else np.zeros(len(spots), np.int64)
        inside = (place < len(content)) & (owner[word] == owner[spots]) if len(content) else np.zeros(len(spots), bool)
        found = np.where(inside, mix(found * U64(0x9FB21C651E98DF25) + words[word]) if len(content) else found, found)
        length += inside
    found, spot_owner = found[length > 0], owner[spots][length > 0]
    bare = np.flatnonzero(np.bincount(spot_owner, minlength=block.n) == 0)
    if len(bare):
        sums = np.concatenate((np.zeros(1, U64), np.cumsum(mix(words + np.arange(1, len(words) + 1, dtype=U64) - np.searchsorted(owner, owner).astype(U64)), dtype=U64)))
        low, high = np.searchsorted(owner, bare), np.searchsorted(owner, bare, side="right")
        found, spot_owner = np.concatenate((found, mix(sums[high] - sums[low]))), np.concatenate((spot_owner, bare))
    key = np.unique((spot_owner.astype(U64) << U64(32)) | (found >> U64(32)))
    return (key & U64(0xFFFFFFFF)).astype(np.uint32), (key >> U64(32)).astype(np.int64)


_HEX = np.array([list(f"{i:02x}".encode()) for i in range(256)], np.uint8)


def _strings(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    digits = _HEX[values.astype(">u4").view(np.uint8)].ravel()
    ends = np.searchsorted(owner, np.arange(n + 1)) * 8
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(digits.tobytes())]).cast(pa.string())


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Jaccard coefficient of each of ``n`` pairs of sets (value, owner)."""
    keys = [(x[1].astype(U64) << U64(32)) | x[0].astype(U64) for x in (a, b)]
    both = np.bincount((np.intersect1d(*keys, assume_unique=True) >> U64(32)).astype(np.int64), minlength=n)
    total = np.bincount(a[1], minlength=n) + np.bincount(b[1], minlength=n) - both
    return both / np.maximum(total, 1)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of each row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.n), _strings(*signatures(block), block.n)],
                                                 ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def _flat(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def edited(block: Block) -> tuple[Block, np.ndarray]:
    """Each text but the last with its last quarter replaced by the start of the next one; code points of all texts."""
    leads = np.append(np.flatnonzero(LEADING[block.data]), len(block.data))
    chars = block.totals(LEADING[block.data])
    first = np.cumsum(chars) - chars
    keep = chars[:-1] - chars[:-1] // 4
    take = np.minimum(chars[:-1] // 4, chars[1:])
    spans = np.stack((block.offsets[:-2], leads[first[:-1] + keep] - block.offsets[:-2], block.offsets[1:-1], leads[first[1:] + take] - block.offsets[1:-1]), 1)
    data = block.data[_flat(spans[:, [0, 2]].ravel(), spans[:, [1, 3]].ravel())]
    return Block(data, np.concatenate(([0], np.cumsum(spans[:, 1] + spans[:, 3]))), 0), chars


def _neighbourhoods(docs: DataFrame) -> DataFrame:
    """``(bucket, extra, at, doc_id, text)``: rows in ranges of ``doc_id``, each range followed by its successor's first row.

    The range bounds are ids of the table, as many as shuffle partitions; they
    and nothing else come to the driver.
    """
    spark = docs.sparkSession
    ids = docs.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("at"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = ids.agg(F.percentile_approx("at", [i / parts for i in range(1, parts)] or [0.5], 10 * parts + 1000).alias("b"),
                     F.min("at").alias("low")).first()
    heads = np.array(sorted({bounds["low"], *(bounds["b"] or [])} - {None}), np.int64)
    shared = spark.sparkContext.broadcast(heads)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).fill_null(-(2**63)).to_numpy()
            bucket = np.searchsorted(shared.value, at, side="right") - 1
            head = np.flatnonzero(shared.value[bucket] == at)
            rows = batch.take(pa.array(np.concatenate((np.arange(len(at)), head))))
            extra = np.arange(rows.num_rows) >= len(at)
            before = np.where(extra, np.concatenate((bucket, bucket[head])) - 1, np.concatenate((bucket, bucket[head])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(before % len(shared.value)), pa.array(extra), pa.array(np.concatenate((at, at[head]))), *rows.columns],
                ["bucket", "extra", "at", "doc_id", "text"])

    placed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "bucket long, extra boolean, at long, doc_id long, text string")
    return placed.repartition(parts, "bucket").sortWithinPartitions("bucket", "extra", "at", "text")


def compare_edited(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting is not None:
                batch = pa.concat_batches([waiting, batch])
            waiting = batch.slice(batch.num_rows - 1)
            yield from pairs(batch)

    def pairs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = 0
        for block in blocks(batch.column(4)):
            # the block and the row after it, which the last of its texts needs
            end = min(block.first + block.n + 1, batch.num_rows)
            own = next(iter(blocks(batch.column(4).slice(at, end - at), 1 << 62)))
            ids, extra = batch.column(3).slice(at, end - at - 1), batch.column(1).slice(at, end - at - 1).to_numpy(zero_copy_only=False)
            at = block.first + block.n
            n = own.n - 1
            if n < 1:
                continue
            changed, chars = edited(own)
            values, owner = signatures(own)
            new = signatures(changed)
            mine = values[owner < n], owner[owner < n]
            after = values[owner > 0], owner[owner > 0] - 1
            data, ends = changed.data.tobytes(), changed.offsets.tolist()
            rows = pa.RecordBatch.from_arrays(
                [ids, pa.array(chars[:-1]), pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])]),
                 _strings(*mine, n), _strings(*new, n), pa.array(likeness(mine, new, n)), pa.array(likeness(mine, after, n))],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            yield rows.filter(pa.array(~extra))

    return _neighbourhoods(docs).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")


def near_pairs(prints: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(a, b, likeness)`` of ``prints(doc_id, fingerprint)``: least ids of all pairs of different sets at or above ``threshold``.

    Equal fingerprints are one class under their least id.
    """
    tokens = F.regexp_extract_all("fingerprint", F.lit(".{8}"), F.lit(0))
    size = (F.length("fingerprint") / 8).cast("long")
    classes = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("id")).select(
        "id", size.alias("size"), tokens.alias("set"), F.floor(F.log(size) / -math.log(threshold)).alias("part")), "spot-classes")
    rows = classes.select("id", "size", "part", F.explode("set").alias("sig"))
    often = stage(rows.groupBy("sig").agg(F.count(F.lit(1)).alias("df")), "spot-counts")
    rank = F.row_number().over(Window.partitionBy("id").orderBy("df", "sig"))
    prefix = rows.join(often, "sig").withColumn("rank", rank).filter(
        (F.col("rank") <= F.col("size") - F.ceil(F.lit(threshold) * F.col("size") - 1e-9) + 1) & (F.col("df") > 1))
    prefix = stage(prefix.select("id", "size", "part", "sig"), "spot-prefix")
    a, b = prefix.alias("a"), prefix.select(
        "id", "size", "sig", F.explode(F.array("part", F.col("part") - 1)).alias("part")).alias("b")
    smaller = (F.col("a.size") < F.col("b.size")) | ((F.col("a.size") == F.col("b.size")) & (F.col("a.id") < F.col("b.id")))
    pairs = a.join(b, (F.col("a.sig") == F.col("b.sig")) & (F.col("a.part") == F.col("b.part")) & smaller
                   & (F.col("a.size") >= threshold * F.col("b.size") - 1e-9)).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    sets = classes.select("id", "set")
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    out = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (shared / (F.size("sa") + F.size("sb") - shared)).alias("likeness"))
    return out.filter(F.col("likeness") >= threshold - 1e-9)
