"""Line deduplication by a segment-partition edit join.

A line goes when an equal line stands earlier, whatever its length. A line of at
least ``least`` characters goes too when a different such line within ``distance``
edits has its first place earlier; by default that is two edits from 24
characters on, at most one character in twelve. "Earlier" is the order of (doc_id, line
number). Lines without a word (white space only) are layout and stay.

Two lines within t edits share one of the t + 1 even segments of the shorter one,
near the same place (multi-match-aware windows). Segments of each length are the
index, the substrings of each line in those windows the probes; both are hash
keys. A key's least line is enough to find the lines that have any partner.
These meet the first line of each of their keys, and the lines still without an
earlier partner then meet all lines of their keys, so a group of near copies of
its first line makes no pairs among itself. A key with more than ``HEAVY`` index
lines (log lines, table rows) is not joined but refined: what lies before and
after the shared segment is cut into segments again, as many as the edits left
for it plus one, and a shared one of these extends the key. This goes on, first
lines first, until a key is light or leaves no more characters open than edits.
Pairs are taken under their length and letter-count bounds, cut to where they
differ, and checked with a bit-parallel edit distance on the band of 2t + 1
diagonals.

Refining loses no pair. Of the t + 1 segments of the shorter line take the first
one, the i-th, before which there are i - 1 edits: it is untouched, and t - i + 1
edits are left behind it. The same holds inside each of the two gaps.

Null text has no lines, empty text one without a word. Very long lines are
compared whole; their keys hold a hash, not the segment. Rows of equal id and text
are one place: their lines go or stay together. Rows without an id come first.
Other columns pass through ``drop_lines`` untouched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lowtide.functions.bitmaps import filtered, key_set
from lowtide.sources.sinks import release, stage

DISTANCE = 2
#: length from which near copies count
LEAST = 24
#: index lines of a key up to which all its pairs are taken; larger keys are refined, with the same result
HEAVY = 64
WORD = r"[^\x20\x09-\x0D]"
#: groups of characters whose counts bound the distance from below, eight to a long
LETTERS = (*(x + x.upper() for x in "abcdefghijklmnopqrstuvwxyz"), " ", ".,", "01234", "56789", "-_/:;", "áéíóúñüöä")


def lines_of(docs: DataFrame) -> DataFrame:
    """``doc_id, body`` (hash of the text), ``at`` (line number from 0), ``line``."""
    return docs.select("doc_id", F.xxhash64("text").alias("body"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))


def _worded(docs: DataFrame) -> DataFrame:
    """Lines with a word, with their length, two hashes and place."""
    place = F.expr("cast(coalesce(doc_id, -9223372036854775808) as decimal(20,0)) * 2147483648 + at").cast("decimal(38,0)")
    return lines_of(docs).filter(F.regexp_like("line", F.lit(WORD))).withColumn("size", F.length("line")).select(
        "doc_id", "body", "at", "line", "size", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
        place.alias("place"))


def _windows(distance: int, index_only: bool = False) -> list[tuple[int, int, int, bool]]:
    """(shorter by, segment from 1, shift, is_index) of a line's keys; the unshifted segments of its own length are
    index and probe in one."""
    parts = distance + 1
    return [(shorter, part, shift, shorter == 0 and shift == 0)
            for shorter in range(1 if index_only else parts) for part in range(1, parts + 1)
            for shift in ([0] if index_only else range(-(part - 1), part)) if abs(shift - shorter) <= parts - part]


def _gaps(*gaps: tuple[Column, Column, Column, Column]) -> Column:
    """(place, size, size in the index line, edits left) of the open parts beside a segment; those without edits are empty."""
    names = ("at", "size", "of", "edits")
    return F.filter(F.array(*(F.struct(*(x.cast("int").alias(n) for x, n in zip(gap, names))) for gap in gaps)), lambda g: g["edits"] > 0)


def _keyed(lines: DataFrame, distance: int, index_only: bool = False, gaps: bool = False) -> DataFrame:
    """``lines`` once for each window inside the line, with ``key`` and ``is_index`` and without the line.

    Segments are as even as can be, the last ones longer by one; starts count from 1.
    ``gaps`` adds what the key leaves open.
    """
    parts = distance + 1
    windows = F.array(*(F.struct(F.lit(x).alias("shorter"), F.lit(y).alias("part"), F.lit(z).alias("shift"), F.lit(w).alias("is_index"))
                        for x, y, z, w in _windows(distance, index_only)))
    rows = lines.withColumn("w", F.explode(windows)).withColumn("of", F.col("size") - F.col("w.shorter"))
    short, base = F.lit(parts) - F.col("of") % parts, F.expr(f"of div {parts}")
    start = (F.col("w.part") - 1) * base + F.greatest(F.col("w.part") - 1 - short, F.lit(0)) + 1 + F.col("w.shift")
    length = base + F.when(F.col("w.part") > short, 1).otherwise(0)
    rows = rows.withColumns({"start": start.cast("int"), "length": length.cast("int")})
    rows = rows.filter((F.col("start") >= 1) & (F.col("start") + F.col("length") - 1 <= F.col("size")))
    key = F.xxhash64("of", "w.part", F.substring(F.col("line"), F.col("start"), F.col("length")))
    at, part, own = F.col("start"), F.col("w.part"), F.col("start") - F.col("w.shift")
    left = (F.lit(1), at - 1, own - 1, part - 1)
    right = (at + F.col("length"), F.col("size") - at - F.col("length") + 1, F.col("of") - own - F.col("length") + 1, parts - part)
    return rows.select(*(c for c in lines.columns if c != "line"), key.alias("key"), F.col("w.is_index").alias("is_index"),
                       *([_gaps(left, right).alias("gaps")] if gaps else []))


def _refined(rows: DataFrame) -> DataFrame:
    """``rows`` with their line, once for each window of their longest gap: ``key`` takes in its text, ``gaps`` what stays open."""
    longest = F.array_max(F.transform("gaps", lambda g, i: F.struct(F.when(g["of"] > g["edits"], g["of"]).otherwise(-1).alias("of"), (-i).alias("i"))))
    rows = rows.withColumn("pick", -longest["i"]).withColumn("g", F.get("gaps", F.col("pick")))
    rows = rows.withColumn("parts", F.col("g.edits") + 1).withColumn("part", F.explode(F.expr("sequence(1, parts)")))
    rows = rows.withColumn("shift", F.explode(F.expr("sequence(1 - part, part - 1)")))
    rows = rows.filter("abs(shift - (g.size - g.of)) <= parts - part")
    rows = rows.withColumn("base", F.expr("g.of div parts")).withColumn("short", F.expr("parts - g.of % parts"))
    rows = rows.withColumn("before", F.expr("(part - 1) * base + greatest(part - 1 - short, 0)")).withColumn(
        "length", F.expr("base + if(part > short, 1, 0)"))
    rows = rows.filter("before + shift >= 0 and before + shift + length <= g.size")
    g, before, shift, length = F.col("g"), F.col("before"), F.col("shift"), F.col("length")
    start = (g["at"] + before + shift).cast("int")
    left = (g["at"], before + shift, before, F.col("part") - 1)
    right = (start + length, g["size"] - before - shift - length, g["of"] - before - length, F.col("parts") - F.col("part"))
    others = F.filter("gaps", lambda x, i: i != F.col("pick"))
    new = {"key": F.xxhash64("key", "pick", "part", F.substring(F.col("line"), start, length.cast("int"))),
           "is_index": F.col("is_index") & (shift == 0), "gaps": F.concat(others, _gaps(left, right))}
    gone = {"line", "pick", "g", "parts", "part", "shift", "base", "short", "before", "length"}
    return rows.select(*(new[c].alias(c) if c in new else F.col(c) for c in rows.columns if c not in gone))


def _common(a: Column, b: Column, most: Column) -> Column:
    """Characters that two texts have in common at the front, ``most`` at most, by halving steps."""
    def step(done: Column, more: Column) -> Column:
        longer = done + more
        return F.when((longer <= most) & (F.substring(a, F.lit(1), longer) == F.substring(b, F.lit(1), longer)), longer).otherwise(done)

    return F.aggregate(F.array(*(F.lit(1 << k) for k in range(24, -1, -1))), F.lit(0), step)


def trimmed(pairs: DataFrame, distance: int) -> DataFrame:
    """``pairs`` of texts ``rline``, ``sline`` (the first not longer) without common front and end, which edits never
    need; at least ``distance`` characters of the first stay."""
    pairs = pairs.withColumn("front", _common(F.col("rline"), F.col("sline"), F.length("rline") - distance))
    cut = {c: F.substring(c, F.col("front") + 1, F.length(c)) for c in ("rline", "sline")}
    pairs = pairs.withColumns(cut)
    pairs = pairs.withColumn("back", _common(F.reverse("rline"), F.reverse("sline"), F.length("rline") - distance))
    return pairs.withColumns({c: F.substring(c, F.lit(1), F.length(c) - F.col("back")) for c in ("rline", "sline")})


def within(a: Column, b: Column, distance: int) -> Column:
    """Whether two columns of character arrays, the first not longer, are within ``distance`` edits: bit vectors along the band.

    Bit k of column j stands for row ``j - distance + k`` of the first line; the
    vectors hold the vertical differences of the distance table, the running
    score follows the lowest diagonal and then the last row.
    """
    width, mask = 2 * distance + 1, (1 << (2 * distance + 1)) - 1
    def step(state: Column, j: Column) -> Column:
        equal = F.lit(0).cast("long")
        rows, here = F.size(a), F.get(b, j - 1)
        for k in range(width):
            equal = equal + F.when(F.get(a, j - distance + k - 1) == here, F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
        vp, vn = state["vp"], state["vn"]
        start = F.transform(F.array(equal), lambda x: F.struct(
            x.bitwiseOR(vn).bitwiseOR((x.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseAND(F.lit(mask)).alias("d0"), vp.alias("vp"), vn.alias("vn")))
        across = F.transform(start, lambda x: F.struct(
            x["d0"].alias("d0"), x["vn"].bitwiseOR(F.bitwise_not(x["d0"].bitwiseOR(x["vp"]))).bitwiseAND(F.lit(mask)).alias("hp"),
            x["d0"].bitwiseAND(x["vp"]).alias("hn")))
        bit = (rows - j + distance).cast("int")

        def close(x: Column) -> Column:
            down = F.shiftright(x["d0"], 1)
            on = lambda v: F.call_function("shiftright", v, F.greatest(bit, F.lit(0))).bitwiseAND(F.lit(1))
            score = F.when(j <= rows - distance, 1 - F.shiftright(x["d0"], width - 1).bitwiseAND(F.lit(1))).otherwise(on(x["hp"]) - on(x["hn"]))
            return F.struct(x["hn"].bitwiseOR(F.bitwise_not(down.bitwiseOR(x["hp"]))).bitwiseAND(F.lit(mask)).alias("vp"),
                            down.bitwiseAND(x["hp"]).alias("vn"), (state["score"] + score).cast("long").alias("score"))

        return F.transform(across, close)[0]

    begin = F.struct(F.lit(mask & ~((1 << distance) - 1)).cast("long").alias("vp"), F.lit(0).cast("long").alias("vn"),
                     F.lit(distance).cast("long").alias("score"))
    return F.aggregate(F.sequence(F.lit(1), F.size(b)), begin, step)["score"] <= distance


def _near(lines: DataFrame, firsts: DataFrame, distance: int) -> DataFrame:
    """``(h1, h2)`` of the distinct lines that have an earlier line within ``distance`` edits."""
    keyed = _keyed(lines.select("h1", "line", "size"), distance).select("key", "h1")
    index = _keyed(lines.select("h1", "line", "size"), distance, index_only=True)
    heads = stage(index.groupBy("key").agg(F.min("h1").alias("head")), "segment-heads")
    met = stage(keyed.join(heads, "key").filter("h1 <> head").select(
        F.explode(F.array("h1", "head")).alias("h1")).distinct(), "lines-met")
    release(heads)
    # copies fall together before they meet the semi join, and most lines without a shared key before they move
    some = filtered(lines, "h1", key_set(met, "h1")).select("h1", "h2", "line").distinct().join(met.hint("merge"), "h1", "left_semi")
    some = stage(some.join(firsts, ["h1", "h2"]).select(
        "h1", "h2", "line", F.length("line").alias("size"), "first", *_counts()), "lines-some")
    release(met)
    counts = [f"c{i}" for i in range(len(_counts()))]
    narrow = ["first", "h1", "h2", "size", *counts]
    keyed = _keyed(some, distance)
    heads = keyed.filter("is_index").groupBy("key").agg(F.min(F.struct(*narrow)).alias("r")).select("key", "r.*")
    near = _checked(keyed, heads, some, distance, F.lit(True))
    unmarked, some = some, stage(some.join(near.withColumn("done", F.lit(True)), ["h1", "h2"], "left").withColumn(
        "open", F.col("done").isNull()).drop("done"), "lines-open")
    release(unmarked)
    keyed = _keyed(some, distance)
    heavy = _keyed(some, distance, index_only=True).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    heavy = stage(heavy.filter(F.col("n") > HEAVY).select("key"), "keys-heavy")
    found = [near, _checked(keyed, keyed.filter("is_index").join(heavy, "key", "left_anti"), some, distance, _still_open())]
    if not heavy.isEmpty():
        found += _near_in_heavy(_keyed(some, distance, gaps=True).join(heavy, "key", "left_semi"), some, narrow, distance)
    release(heavy, some)
    return reduce(DataFrame.unionByName, found).distinct()


def _still_open() -> Column:
    return F.when(F.col("s.first") > F.col("r.first"), F.col("s.open")).otherwise(F.col("r.open"))


def _near_in_heavy(rows: DataFrame, lines: DataFrame, narrow: list[str], distance: int) -> list[DataFrame]:
    """``(h1, h2)`` as in ``_near``, from rows whose keys have too many lines: refined level by level.

    Open parts get shorter on each level, so the levels end; a light key's pairs
    are all taken, and so are those of a key that cannot be refined any more: its
    index lines differ in ``distance`` characters at most, so all but the first
    are done and only longer lines without a partner meet them.
    """
    found, level = [], stage(rows, "segment-level")
    while not level.isEmpty():
        finer = stage(_refined(level.join(lines.select("h1", "h2", "line"), ["h1", "h2"])), "segment-finer")
        release(level)
        heads = finer.filter("is_index").groupBy("key").agg(F.min(F.struct(*narrow, "open")).alias("r")).select("key", "r.*")
        near = _checked(finer, heads, lines, distance, _still_open())
        left = stage(finer.join(near.withColumn("done", F.lit(True)), ["h1", "h2"], "left").withColumn(
            "open", F.col("open") & F.col("done").isNull()).drop("done"), "segment-open")
        release(finer)
        more = F.max(F.exists("gaps", lambda g: g["of"] > g["edits"]))
        heavy = stage(left.groupBy("key").agg(F.count_if("is_index").alias("n"), F.max("open").alias("open"), more.alias("more")).filter(
            (F.col("n") > HEAVY) & F.col("open") & F.col("more")).select("key"), "keys-heavy")
        found += [near, _checked(left, left.filter("is_index").join(heavy, "key", "left_anti"), lines, distance, _still_open())]
        level = stage(left.join(heavy, "key", "left_semi"), "segment-level")
        release(left, heavy)
    release(level)
    return found


def _checked(probes: DataFrame, index: DataFrame, lines: DataFrame, distance: int, wanted: Column) -> DataFrame:
    """``(h1, h2)`` of the later lines of the pairs of ``probes`` s and ``index`` r that are within ``distance`` edits."""
    s, r = probes.alias("s"), index.alias("r")
    apart = F.lit(0).cast("long")
    for i, letters in enumerate(LETTERS):
        one, two = (F.shiftright(F.col(f"{x}.c{i // 8}"), 8 * (i % 8)).bitwiseAND(F.lit(255)) for x in "sr")
        around = (one - two).bitwiseAND(F.lit(255))  # counts are kept modulo 256
        apart = apart + F.least(around, 256 - around)
    pairs = s.join(r, (F.col("s.key") == F.col("r.key")) & (F.col("s.first") != F.col("r.first")) & wanted
                   & (F.col("s.size") - F.col("r.size")).between(0, distance) & (apart <= 2 * distance))
    pairs = pairs.select(*(F.col(f"{x}.{h}").alias(f"{x}{h}") for x in "sr" for h in ("h1", "h2")),
                         (F.col("s.first") > F.col("r.first")).alias("s_later")).distinct()
    left = lines.select(F.col("h1").alias("sh1"), F.col("h2").alias("sh2"), F.col("line").alias("sline"))
    right = lines.select(F.col("h1").alias("rh1"), F.col("h2").alias("rh2"), F.col("line").alias("rline"))
    both = stage(pairs.join(left, ["sh1", "sh2"]).join(right, ["rh1", "rh2"]), "line-pairs")
    cut = trimmed(both, distance).withColumns({"rline": F.split("rline", ""), "sline": F.split("sline", "")})
    later = F.col("s_later")
    near = cut.select(F.when(later, F.col("sh1")).otherwise(F.col("rh1")).alias("h1"),
                      F.when(later, F.col("sh2")).otherwise(F.col("rh2")).alias("h2"),
                      within(F.col("rline"), F.col("sline"), distance).alias("near"))
    # filtered after the grouping: before it, the filter would take in the cuts and make them anew for each use
    found = stage(near.groupBy("h1", "h2").agg(F.max("near").alias("near")).filter("near").select("h1", "h2"), "lines-near")
    release(both)
    return found


def _counts() -> list[Column]:
    """How often each group of ``LETTERS`` stands in the line, modulo 256, packed as ``c0, c1, ...``."""
    def count(letters: str) -> Column:
        return (F.length("line") - F.length(F.translate("line", letters, ""))).cast("long").bitwiseAND(F.lit(255))

    packed = []
    for at in range(0, len(LETTERS), 8):
        word = F.lit(0).cast("long")
        for k, letters in enumerate(LETTERS[at: at + 8]):
            word = word.bitwiseOR(F.shiftleft(count(letters), 8 * k))
        packed.append(word.alias(f"c{at // 8}"))
    return packed


def dropped(docs: DataFrame, distance: int = DISTANCE, least: int = LEAST) -> DataFrame:
    """``doc_id, body, at, is_copy, is_near`` of the lines that go."""
    lines = _worded(docs)
    narrow = stage(lines.select("doc_id", "body", "at", "h1", "h2", "place"), "lines")
    known = stage(narrow.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), "lines-distinct")
    near = _near(lines.filter(F.col("size") >= least), known.select("h1", "h2", "first"), distance)
    marked = known.join(near.withColumn("is_near", F.lit(True)), ["h1", "h2"], "left").filter("n > 1 or is_near")
    marked = stage(marked.select("h1", "h2", "first", F.coalesce("is_near", F.lit(False)).alias("is_near")), "lines-marked")
    release(known)
    return narrow.join(marked, ["h1", "h2"]).filter("place > first or is_near").select(
        "doc_id", "body", "at", (F.col("place") > F.col("first")).alias("is_copy"), "is_near")


def report(docs: DataFrame, distance: int = DISTANCE, least: int = LEAST) -> DataFrame:
    """For each id and text: its lines, those dropped as copies and as near copies, and the dropped numbers (from 0) as text."""
    gone = dropped(docs, distance, least).groupBy("doc_id", "body").agg(
        F.collect_set(F.when(F.col("is_copy"), F.col("at"))).alias("copies"), F.collect_set("at").alias("all"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("body"),
                       F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines")).distinct()
    r, g = rows.alias("r"), gone.alias("g")
    return r.join(g, F.col("r.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("r.body") == F.col("g.body")), "left").select(
        "r.doc_id", "n_lines", F.coalesce(F.size("copies"), F.lit(0)).cast("long").alias("n_copies"),
        F.coalesce(F.size("all") - F.size("copies"), F.lit(0)).cast("long").alias("n_near"),
        F.coalesce(F.array_join(F.array_sort("all"), ","), F.lit("")).alias("dropped"))


def drop_lines(docs: DataFrame, distance: int = DISTANCE, least: int = LEAST) -> DataFrame:
    """``docs`` with the remaining lines as text (``n_chars`` follows); a row all of whose words went is removed."""
    g = dropped(docs, distance, least).groupBy("doc_id", "body").agg(F.collect_set("at").alias("all")).alias("g")
    d = docs.alias("d")
    text = F.col("d.text")
    left = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(F.col("g.all"), i)), "\n")
    new = F.when(F.col("g.all").isNull(), text).otherwise(left)
    joined = d.join(g, F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.xxhash64("d.text") == F.col("g.body")), "left")
    joined = joined.filter(F.col("g.all").isNull() | F.regexp_like(left, F.lit(WORD)))
    return joined.select(*(new.alias(c) if c == "text" else F.when(F.col("g.all").isNull(), F.col("d.n_chars")).otherwise(
        F.length(new).cast("long")).alias(c) if c == "n_chars" else F.col(f"d.`{c}`") for c in docs.columns))
