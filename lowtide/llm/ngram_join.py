"""Similarity self-join of documents on word shingles, with signature trees.

A document's set is its distinct five-word shingles (A-Z lower-cased; the whole
sequence when there are fewer words; nothing without words). Two documents link
when ``100 * |A & B| >= percent * |A | B|``; the result is the least ``doc_id``
that links reach.

1. Equal sets become one class, so copies are never paired.
2. Classes that can have no partner are left out. Two linked sets share at least
   ``least_shared`` shingles of their leading parts in hash order (``leading``),
   hence a class whose leading shingles occur nowhere else is alone. Only leading
   shingles are shuffled; a shingle of many texts of one block is sent once as a
   mark, so a passage that stands everywhere gives few rows a task.
3. The rest, with whole sets: shingles in rising frequency, the first
   ``n - ceil(percent n) + 1`` of a set are its prefix, and linked sets have a
   prefix shingle in common. Shingles of one set only come first and are only counted. A star of edges for each prefix shingle and its
   connected components give groups that no link leaves.
4. Inside groups, signature trees: nodes hold OR-ed shingle bitmaps and size
   ranges, the dual traversal drops node pairs whose largest possible overlap is
   too small, exact overlaps decide between the leaves that remain, and pairs
   already connected are skipped. A group larger than ``BLOCK`` sets is cut by
   hash into blocks that are each joined with themselves and one anchor block;
   sets outside the group's main part then meet all its blocks.

Null, empty and word-less texts have no shingles and link with nothing, nor do
rows without ``doc_id``. Rows with the same ``doc_id`` are separate documents
that share their id. Sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lowtide.functions.bitmaps import filtered, key_set
from lowtide.llm.arrays import Block, blocks, mix
from lowtide.llm.components import components
from lowtide.sources.sinks import release, stage

SHINGLE = 5
PERCENT = 75
BLOCK = 256
ANCHOR = 64
FREQUENT = 16
FANOUT = 8


def needed(n, percent: int):
    """Least overlap that a set of n shingles has with any set it links to."""
    return (percent * n + 99) // 100


def leading(n, percent: int):
    """How many of its least hashes a set sends in step 2."""
    return n - needed(n, percent) + (15 * n) // 100 + 1


def least_shared(n, percent: int):
    """How many of them a linked set sends too: the partner has ``needed`` shingles at least."""
    return (15 * needed(n, percent)) // 100 + 1


def sets_of(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles sorted by text and hash, their owners, and size and set hash of each text."""
    tokens, owner = block.shingles(SHINGLE)
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    tokens, owner = tokens[new], owner[new]
    sizes = np.bincount(owner, minlength=block.n).astype(np.int64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)))
    ends = np.cumsum(sizes)
    ids = mix(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64))
    return tokens, owner, sizes, ids.view(np.int64)


def profiles(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``set_id`` of each document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                _, _, sizes, ids = sets_of(block)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.n), pa.array(sizes), pa.array(ids)],
                                                 ["doc_id", "n_shingles", "set_id"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_id long")


def _postings(docs: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for block in blocks(batch.column(0)):
                tokens, owner, sizes, ids = sets_of(block)
                fresh = np.zeros(block.n, bool)
                for i, set_id in enumerate(ids.tolist()):
                    if set_id not in seen:
                        seen.add(set_id)
                        fresh[i] = True
                place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                sent = fresh[owner] & (place < leading(sizes, percent)[owner])
                tokens, owner = tokens[sent], owner[sent]
                order = np.argsort(tokens, kind="stable")
                tokens, found = tokens[order], ids[owner[order]]
                heads = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else np.zeros(0, np.int64)
                counts = np.diff(np.append(heads, len(tokens)))
                rare = np.repeat(counts <= FREQUENT, counts)
                marks = tokens[heads][counts > FREQUENT]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((tokens[rare], marks)).view(np.int64)),
                     pa.array(np.append(found[rare], np.zeros(len(marks), np.int64)),
                              mask=np.append(np.zeros(int(rare.sum()), bool), np.ones(len(marks), bool)))], ["token", "set_id"])

    return docs.select("text").mapInArrow(run, "token long, set_id long")


def _alone(postings: DataFrame) -> DataFrame:
    """For each set, how many of the shingles it sent no other set sent."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).is_null().to_numpy(zero_copy_only=False), b.column(1).fill_null(0).to_numpy())
                 for b in batches if b.num_rows]
        if not parts:
            return
        tokens, marks, sets = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((sets, marks, tokens))
        tokens, marks, sets = tokens[order], marks[order], sets[order]
        head = np.append(True, tokens[1:] != tokens[:-1])
        distinct = head | marks | np.append(True, sets[1:] != sets[:-1])
        group = np.cumsum(head) - 1
        lone = np.bincount(group, weights=distinct) == 1
        yield pa.RecordBatch.from_arrays([pa.array(sets[head & ~marks & lone[group]])], ["set_id"])

    found = postings.repartition("token").mapInArrow(run, "set_id long")
    return found.groupBy("set_id").agg(F.count(F.lit(1)).alias("alone"))


def _whole_sets(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``set_id`` and sorted shingles of the chosen classes, read from the text of their first document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0)):
                tokens, owner, sizes, ids = sets_of(block)
                wanted = ids == batch.column(1).to_numpy()[block.first: block.first + block.n]
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, tokens.view(np.int64))
                rows = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sizes), lists], ["set_id", "n", "tokens"])
                yield rows.filter(pa.array(wanted))

    # texts of other documents are left out before the join moves any
    texts = filtered(docs.select(F.col("doc_id").alias("first_id"), "text"), "first_id", key_set(chosen, "first_id"))
    texts = texts.join(chosen.select("first_id", "set_id"), "first_id")
    return texts.select("text", "set_id").mapInArrow(run, "set_id long, n long, tokens array<long>")


def _groups(sets: DataFrame, percent: int) -> DataFrame:
    """``(node, root)`` of classes that share a prefix shingle, directly or in a chain."""
    tokens = sets.select("set_id", "n", F.explode("tokens").alias("token"))
    counts = stage(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "shingle-counts")
    common = stage(tokens.join(counts, "token"), "shingles-common")
    release(counts)
    of_set = Window.partitionBy("set_id")
    ranked = common.withColumns({"place": F.row_number().over(of_set.orderBy("df", "token")),
                                 "common": F.count(F.lit(1)).over(of_set)})  # the n - common others stand before them
    prefix = stage(ranked.filter(F.col("place") <= F.col("common") - F.expr(f"({percent} * n + 99) div 100") + 1)
                   .select("token", "set_id"), "prefix")
    release(common)
    least = stage(prefix.groupBy("token").agg(F.min("set_id").alias("b")), "prefix-least")
    groups = components(prefix.join(least, "token").select(F.col("set_id").alias("a"), "b"), "groups")
    release(prefix, least)
    return groups


class Tree:
    """Levels of nodes over sets in order of size; level 0 holds the sets. ``bits`` are OR-ed, sizes are ranges."""

    def __init__(self, sets: list[np.ndarray], width: int):
        bits = np.zeros((len(sets), width // 8), np.uint8)
        for row, tokens in zip(bits, sets):
            marked = np.zeros(width, bool)
            marked[(tokens.view(np.uint64) % np.uint64(width)).astype(np.int64)] = True
            row[:] = np.packbits(marked)
        n = np.array([len(x) for x in sets], np.int64)
        self.levels = [(bits, n, n, n - np.bitwise_count(bits).sum(1, dtype=np.int64))]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, slack = self.levels[-1]
            at = np.arange(0, len(bits), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                                np.maximum.reduceat(slack, at)))


def dual_traversal(left: Tree, right: Tree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaf pairs whose largest possible overlap suffices for a link."""
    top = max(len(left.levels), len(right.levels)) - 1
    a = b = np.zeros(1, np.int64)
    for level in range(top, -1, -1):
        sides = []
        for tree in (left, right):
            depth = min(level, len(tree.levels) - 1)
            sides.append(tree.levels[depth])
        (bits_a, low_a, high_a, slack_a), (bits_b, low_b, high_b, slack_b) = sides
        keep = (100 * high_a[a] >= percent * low_b[b]) & (100 * high_b[b] >= percent * low_a[a])
        a, b = a[keep], b[keep]
        most = np.concatenate([np.bitwise_count(bits_a[a[i: i + 4096]] & bits_b[b[i: i + 4096]]).sum(1, dtype=np.int64)
                               for i in range(0, len(a), 4096)] or [np.zeros(0, np.int64)])
        most = np.minimum(most + np.minimum(slack_a[a], slack_b[b]), np.minimum(high_a[a], high_b[b]))
        keep = (100 + percent) * most >= percent * (low_a[a] + low_b[b])
        a, b = a[keep], b[keep]
        if level:
            a, b = _children(a, b, left, right, level)
    return a, b


def _children(a, b, left: Tree, right: Tree, level: int):
    for tree, first in ((left, True), (right, False)):
        if level > len(tree.levels) - 1:
            continue
        below = len(tree.levels[level - 1][0])
        nodes = a if first else b
        spread = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        other = np.repeat(b if first else a, FANOUT)
        real = spread < below
        a, b = (spread[real], other[real]) if first else (other[real], spread[real])
    return a, b


def connect(ids: np.ndarray, sets: list[np.ndarray], labels: np.ndarray, one: np.ndarray, two: np.ndarray,
            percent: int) -> list[tuple[int, int]]:
    """Links that join parts not joined before, between the sets at ``one`` and those at ``two``; labels are known parts."""
    sizes = np.array([len(x) for x in sets])
    one, two = one[np.argsort(sizes[one], kind="stable")], two[np.argsort(sizes[two], kind="stable")]
    width = 1 << int(max(8, np.ceil(np.log2(4 * sizes.max()))))
    trees = [Tree([sets[i] for i in side], width) for side in (one, two)]
    a, b = dual_traversal(*trees, percent)
    a, b = one[a], two[b]
    both_ways = np.isin(b, one)
    a, b = a[~both_ways | (a < b)], b[~both_ways | (a < b)]
    parent = np.unique(labels, return_index=True, return_inverse=True)
    parent = parent[1][parent[2]].tolist()

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = find(x), find(y)
        if rx == ry:
            continue
        both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
            parent[max(rx, ry)] = min(rx, ry)
            links.append((int(ids[x]), int(ids[y])))
    return links


def _joined(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links ``(a, b)`` inside each key's rows ``(set_id, tokens, label, side)``: side 0 with itself, and side 0 with side 1."""

    def run(table: pa.Table) -> pa.Table:
        ids, first = np.unique(table["set_id"].to_numpy(), return_index=True)
        table = table.take(first)
        lists = table["tokens"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        sets = [flat[i:j] for i, j in zip(offsets[:-1], offsets[1:])]
        side, labels = table["side"].to_numpy(), table["label"].to_numpy()
        own = np.flatnonzero(side == 0)
        links = connect(ids, sets, labels, own, np.arange(len(ids)), percent) if len(own) else []
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return rows.select(*keys, "set_id", "tokens", "label", "side").groupBy(*keys).applyInArrow(run, "a long, b long")


def _links(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Enough links to connect what all links connect."""
    roots = groups.select(F.col("root").alias("node"), "root").distinct()
    members = stage(groups.unionByName(roots).select(F.col("node").alias("set_id"), F.col("root").alias("group")), "members")
    totals = stage(members.groupBy("group").agg(F.count(F.lit(1)).alias("total")), "group-sizes")
    placed = members.join(totals, "group").withColumn("n_blocks", F.expr(f"(total + {BLOCK - 1}) div {BLOCK}")).withColumn(
        "block", F.pmod(F.xxhash64("set_id"), "n_blocks"))
    placed = stage(sets.join(placed, "set_id").withColumn("label", F.col("set_id")), "blocks")
    anchor = F.when(F.pmod(F.xxhash64("set_id", F.lit(1)), F.greatest(F.expr(f"total div {ANCHOR}"), F.lit(1))) == 0,
                    F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    anchors = placed.filter("n_blocks > 1").select(
        "group", "set_id", "tokens", "label", F.explode(anchor).alias("to"), "block", F.lit(1).alias("side")).filter(
        "to <> block").drop("block").withColumnRenamed("to", "block")
    own = placed.select("group", "set_id", "tokens", "label", "block", F.lit(0).alias("side"))
    first = stage(_joined(own.unionByName(anchors), ["group", "block"], percent), "links")
    large = placed.filter("n_blocks > 1").drop("label")
    if large.isEmpty():
        return first
    parts = components(first, "parts").select(F.col("node").alias("set_id"), F.col("root").alias("label"))
    large = stage(large.join(parts, "set_id", "left").withColumn("label", F.coalesce("label", "set_id")), "parts-large")
    counts = large.groupBy("group", "label").agg(F.count(F.lit(1)).alias("rows"))
    main = stage(counts.groupBy("group").agg(F.max_by("label", F.struct("rows", "label")).alias("main")), "main")
    large = large.join(main, "group")
    rest_sizes = stage(large.filter("label <> main").groupBy("group").agg(F.count(F.lit(1)).alias("others")), "rest-sizes")
    if rest_sizes.isEmpty():
        return first
    large = large.join(rest_sizes, "group").withColumn("n_rest", F.expr(f"(others + {BLOCK - 1}) div {BLOCK}"))
    large = large.withColumn("own_rest", F.when(F.col("label") != F.col("main"), F.pmod(F.xxhash64("set_id", F.lit(2)), "n_rest")))
    probes = large.filter("own_rest is not null").select(
        "group", F.col("own_rest").alias("rest"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block"),
        "set_id", "tokens", "label", F.lit(0).alias("side"))
    whole = large.select(
        "group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_rest") - 1)).alias("rest"), "block",
        "set_id", "tokens", "label", F.lit(1).alias("side"), "own_rest").filter("not own_rest <=> rest").drop("own_rest")
    keys = ["group", "rest", "block"]
    return first.unionByName(stage(_joined(probes.unionByName(whole), keys, percent), "rest-links"))


def join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every document."""
    known = stage(profiles(docs), "profiles")
    classes = stage(known.filter("n_shingles > 0 and doc_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n")), "classes")
    alone = _alone(_postings(docs, percent))
    n, need = F.col("n"), F.expr(f"({percent} * n + 99) div 100")
    sent = n - need + F.expr("(15 * n) div 100") + 1
    shared = (F.expr(f"(15 * (({percent} * n + 99) div 100)) div 100") + 1)
    chosen = classes.join(alone, "set_id", "left").filter(sent - F.coalesce("alone", F.lit(0)) >= shared)
    chosen = stage(chosen.select("set_id", "first_id", "n"), "chosen")
    sets = stage(_whole_sets(docs, chosen), "sets")
    links = _links(sets, _groups(sets, percent), percent)
    parts = components(links, "linked").select(F.col("node").alias("set_id"), "root")
    rooted = stage(classes.join(parts, "set_id", "left").select("set_id", "first_id", F.coalesce("root", "set_id").alias("root")), "rooted")
    least = stage(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    by_set = stage(rooted.join(least, "root").select("set_id", "component_id"), "by-set")
    return known.join(by_set, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose id is the least of their component; of rows with the same id, the one of least text.

    Rows without an id stay.
    """
    found = join(docs, percent).filter("doc_id is not null")
    kept = found.groupBy("doc_id").agg(F.min("component_id").alias("least")).filter("doc_id = least").select("doc_id")
    place = "place_" + "_".join(docs.columns)
    rows = docs.join(kept, "doc_id", "left_semi").withColumn(
        place, F.row_number().over(Window.partitionBy("doc_id").orderBy("text")))
    return rows.filter(F.col(f"`{place}`") == 1).select(docs.columns).unionByName(docs.filter("doc_id is null"))
