"""Filter audit, toxicity model and bit-plane clustering against brute force on small tables."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lowtide.llm import bit_kmeans as K
from lowtide.llm import filter_audit as A
from lowtide.llm import toxicity as T

DOCS = "doc_id long, text string, source string, part string, mask string, h string"


def brute_audit(rows, labels):
    def fails(i, text):
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        out = "A" * (len(ws) < 50) + "B" * (100 * len(set(ws)) < 65 * len(ws))
        out += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        return out + "E" * (i is not None and any(j is not None and j < i and t == text for j, t, _ in rows))

    rows = [(i, t or "", s or "") for i, t, s in rows]
    good, toxic = ({x[0] for x in labels if x[0] is not None and x[c] == 1} for c in (1, 2))
    judged = [(s, fails(i, t), i in good, i in toxic) for i, t, s in rows]
    out = {}
    for part in {s for _, _, s in rows}:
        mine, shapley = [r for r in judged if r[0] == part], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in r[1] for r in mine) - len(gone), sum(r[1] == f for r in mine),
                                                   sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return out


def audit_rows():
    rng = random.Random(7)
    words = [f"w{k}" for k in range(90)]
    pool = [None, "", " \n\t", "SHOUT", "a # b", "é 😀 " * 40, "x" * 70_000]
    pool += [" ".join(rng.choices(words[: rng.choice([5, 90])], k=rng.choice([3, 49, 50, 51, 120]))) + rng.choice(["", " A" * 9, "|"]) for _ in range(25)]
    rows = [(i, rng.choice(pool), rng.choice(["s", "s", "s", "t", "", None])) for i in range(150)]
    rows += [(None, pool[9], "s"), (None, pool[9], "s"), rows[5], rows[5], (500, rows[5][1], "alone")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 160, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return rows, labels


def test_audit_is_brute_force(spark):
    rows, labels = audit_rows()
    # columns of the operator's own names are not mistaken
    docs = spark.createDataFrame([(*r, "p", "m", "h") for r in rows], DOCS)
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    columns = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    got = {(r.part, r.filter_order, r.step): [r[c] for c in columns] for r in A.audit(docs, marks).collect()}
    assert got == brute_audit(rows, labels)
    assert A.audit(docs.limit(0), marks).count() == 0
    bare = A.audit(docs, marks.limit(0)).agg(F.sum("good_lost"), F.count(F.lit(1))).first()
    assert tuple(bare) == (0, 4 * 600)


@pytest.mark.parametrize("blocks", [1, 4])
def test_sketch_never_clears_a_repeat(spark, blocks):
    texts = [f"t{k}" for k in range(20_000)] + [f"t{k}" for k in range(0, 20_000, 20)]
    hashed = spark.createDataFrame([(t,) for t in texts], "text string").select("text", F.xxhash64("text").alias("h"))
    seen = A.maybe_repeated(hashed, A.sketch(hashed.select("h"), blocks), blocks)
    maybe = {r.text for r in seen.filter("maybe").collect()}
    again = {f"t{k}" for k in range(0, 20_000, 20)}
    assert again <= maybe and len(maybe) < (20_000 if blocks == 1 else 5_000)
    assert seen.count() == len(texts)
    assert [A.blocks_for(n) for n in (0, 1, 2048, 2049, 10**12)] == [1, 1, 1, 2, A.MOST_BLOCKS]


def brute_clusters(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((r for r in kept if r[0] is not None), key=lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())
    centres = [v for _, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            apart = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            out.append((apart.index(min(apart)), min(apart)))
        return out

    for _ in range(rounds):
        best = assign()
        for c in range(len(centres)):
            mine = [v for (_, v), (b, _) in zip(kept, best) if b == c]
            if mine:
                centres[c] = [sum(x) // len(mine) for x in zip(*mine)]
    best = assign()
    own = {c: sum(d for b, d in best if b == c) for c in range(len(centres))}
    return sorted(((-1 if i is None else i), b, d, own[b], sum(own.values()), hashlib.sha256(",".join(map(str, centres[b])).encode()).hexdigest())
                  for (i, _), (b, d) in zip(kept, best))


def test_clusters_are_brute_force(spark):
    rng = random.Random(8)
    middle = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [m + rng.gauss(0, 0.7) for m in rng.choice(middle)]) for i in range(120)]
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [float("nan")] * 64), (204, [1.0] * 63 + [float("inf")]), (205, [1.0] * 63 + [None]),
             (206, [0.0] * 64), (207, [-40.0] * 64), (208, [rows[0][1][0]] * 64), (209, [900.0] + [0.5] * 63), rows[3], (None, rows[4][1])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, cluster int")
    got = sorted((-1 if r.vec_id is None else r.vec_id, *r[1:]) for r in K.cluster(frame).collect())
    # a repeated row is a vector of its own, also among the starts
    assert got == brute_clusters(rows)
    assert K.cluster(frame.limit(0)).count() == 0
    few = frame.filter("vec_id in (1, 2, 206)")
    assert sorted(map(tuple, K.cluster(few).collect())) == brute_clusters([r for r in rows if r[0] in (1, 2, 206)])
    huge = K.cluster(spark.createDataFrame([(1, [1e30] * 64), (2, [-1e30] * 64)], "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.distance) for r in huge) == [(1, 0), (2, 0)]


def test_plane_dots(spark):
    rng = np.random.default_rng(9)
    for low, high in ((-1, 0), (-1025, 1023), (-(1 << 27) - 1, 1 << 27)):
        n = K.planes_needed(low, high)
        a, b = rng.integers(low, high + 1, (50, 64)), rng.integers(low, high + 1, (50, 64))
        assert (K.dots(K.pack(a, n), K.pack(b, n)) == (a * b).sum(axis=1)).all()
        assert (K.plane_weights(n) @ K.bits_of(K.pack(a, n)) == a.sum(axis=0)).all()


def slow_mean(text, numbers, how):
    """The same bag in plain Python: every n-gram of every word, one at a time."""
    total, words = 0.0, 0
    for word in re.findall(r"[a-z0-9'@$*!À-῿⁰-⿿、-￿\U00010000-\U0010ffff]+", (text or "").lower()):
        ends, bag = [0, *map(ord, word), 0], []
        for n in range(how.least, how.most + 1):
            for at in range(len(ends) - n + 1):
                value = 0
                for k, c in enumerate(ends[at: at + n]):
                    x = (c * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64)
                    value += (x ^ x >> 29) * pow(0xD6E8FEB86659FD93, k, 1 << 64)
                value = value * 0xBF58476D1CE4E5B9 % (1 << 64)
                bag.append(((value ^ value >> 32) * 0x94D049BB133111EB % (1 << 64)) >> (64 - how.bits))
        if bag:
            total, words = total + sum(float(numbers[b]) for b in bag) / len(bag), words + 1
    return total / max(1, words + how.blank)


def test_bags_are_brute_force():
    how = T.Training(bits=10)
    numbers = np.random.default_rng(1).normal(size=1 << 10).astype(np.float32)
    texts = ["", " ", "a", "I", "ab cd", "Émile, 😀x ÀB!", "x" * 300, "one-two\nthree four—five", "a b c d e f", "İstanbul ß"]
    assert T.means(texts, numbers, how) == pytest.approx([slow_mean(t, numbers, how) for t in texts])
    for text in texts:
        ids, weights = T.entries(text, how)
        assert float(weights @ numbers[ids]) == pytest.approx(slow_mean(text, numbers, how), abs=1e-5)


def test_gradient_is_that_of_the_loss():
    """One step of a batch of two texts goes where finite differences of the loss point."""
    how = T.Training(bits=6, size=2, least_texts=1, passes=1, batch=2, rate=1e-4, shrink=0.0)
    bag = [(np.array([1, 5], np.int32), np.array([0.4, 0.6], np.float32)), (np.array([5, 9], np.int32), np.array([0.5, 0.5], np.float32))]
    numbers, bias = T.train(bag, np.array([0, 1]), how)
    # the table starts at zero, so a bucket of class 1 only rises, one of class 0 only falls, the shared one takes its heavier side
    assert numbers[9] > 0 > numbers[1] and abs(bias) < 1e-3 and numbers[5] < 0
    assert not numbers[[0, 2, 3, 4, 6, 7, 8]].any()


def test_unseen_misspellings(spark):
    rng = random.Random(10)
    plain = ["river", "stone", "table", "green", "window", "paper", "morning", "letter", "garden", "bridge"]
    bad = ["grumblefax", "snorkwit", "dunderpate"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = rng.choices(plain, k=rng.randint(15, 60)) + (rng.choices(bad, k=2) if toxic else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), 1))
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    spelt = [(1000 + k, "the river stone table " + w + " window paper") for k, w in enumerate(("grumblefaxx", "snorkw1t", "dunderpates"))]
    more = [(2000, None), (2001, ""), (2002, "river " * 30_000), (None, "green window"), rows[0], rows[0]]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows + spelt + more], "doc_id long, text string, score double")
    marks = spark.createDataFrame([*labels, (None, 1, 1), (2001, None, 1)], "doc_id long, toxic int, score int")
    how = T.Training(rows=400)
    got = T.judge(docs, marks, how).collect()
    assert len(got) == len(rows + spelt + more) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    by = {r.doc_id: r for r in got}
    assert {i for i, _ in rows if by[i].held_out} == held
    assert sum(by[i].predicted == t for i, t, _ in labels if i in held) >= 0.97 * len(held)
    assert all(by[i].predicted for i, _ in spelt)
    assert not any(by[i].predicted for i in (2000, 2001, 2002, None)) and by[2000].score == by[2001].score
    # labels of held-out rows change nothing
    other = spark.createDataFrame([(i, 1 - t if i in held else t, 1) for i, t, _ in labels], "doc_id long, toxic int, score int")
    again = {r.doc_id: r.score for r in T.judge(docs, other, how).collect()}
    assert all(again[i] == by[i].score for i, _ in rows)
    one = T.judge(docs, marks.filter("toxic = 0"), how).agg(F.min("score"), F.max("score")).first()
    assert one[0] == one[1] < 0.01
    assert {r.score for r in T.judge(docs, marks.limit(0), how).collect()} == {0.5}
    assert T.judge(docs.limit(0), marks, how).count() == 0
