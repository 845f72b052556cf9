"""Toxicity scores from subword bags: embeddings of character n-grams, averaged, into a linear softmax.

A word is a run of letters, digits and the marks that stand in for letters,
lower-cased. Its bag holds its character n-grams of 3 to 5 characters, ends
marked; each falls into one of ``2 ** bits`` buckets with an embedding. A word is
the mean of its bag, a text the mean of its words and of some blank ones (so that
a few words prove little), and a softmax over two classes reads that mean. Embeddings and softmax are trained together by
gradient steps in numpy, so a spelling that no training text has is placed by
the n-grams that it shares with known ones.

Since all layers are linear up to the softmax, the model reduces to one number
a bucket; a score is a mean of these numbers over the whole text.

Training takes at most ``rows`` labelled documents of at most ``chars``
characters, half of them of each class as far as there are so many, chosen by a
hash of the id; the score is corrected for that choice by the class counts of
all training labels. Rows of held-out ids are never read for it.

Null and empty text, and text without words, have the score of a mean of zero.
Very long texts are scored whole, a megabyte at a time with others, alone if longer.
Repeated rows are scored each; of training rows with one id the least text
counts once, and an id is toxic when one of its label rows says so. Rows without
an id are scored and not held out. Without labels of both classes all scores
are the share of toxic labels, with one more of each kind. An empty table has an
empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: characters of a text that are put together for one numpy step
PART = 1 << 20
_LETTER = np.zeros(128, bool)
_LETTER[[*range(48, 58), *range(97, 123), *map(ord, "'@$*!")]] = True


@dataclass(frozen=True)
class Training:
    """Settings of bags, sample and steps.

    ``bits`` of the bucket number, ``size`` of an embedding, n-grams of ``least``
    to ``most`` characters, ``blank`` words of zero mean in every text; ``rows`` and
    ``chars`` bound the sample. Buckets of fewer than ``least_texts`` texts are left
    out; a step takes ``shrink`` off the length of each embedding it moves, so
    n-grams that say nothing stay at zero.
    """

    bits: int = 17
    size: int = 4
    least: int = 3
    most: int = 5
    rows: int = 3000
    chars: int = 20_000
    least_texts: int = 3
    blank: int = 20
    shrink: float = 8e-6
    passes: int = 18
    batch: int = 16
    rate: float = 3.0
    seed: int = 12


def held_out(doc_id: Column) -> Column:
    """Whether an id is kept from training: the crc32 of its decimal text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bags(texts: list[str], how: Training) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each n-gram length: ``buckets``, the ``word`` each n-gram is of; and for all, the text and bag size of each word."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer(("\n" + "".join(t + "\n" for t in lowered)).encode("utf-32-le"), "<u4")
    ends = np.cumsum([len(t) + 1 for t in lowered])
    inside = np.zeros(len(codes), bool)
    ascii_ = codes < 128
    inside[ascii_] = _LETTER[codes[ascii_]]
    inside |= (codes >= 0xC0) & ((codes < 0x2000) | (codes > 0x206F)) & (codes != 0x3000)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    word = np.cumsum(begins) - 1
    owner = np.searchsorted(ends, np.flatnonzero(begins) - 1, side="right")
    breaks = np.cumsum(~inside)
    letters = np.where(inside, codes, 0).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    letters ^= letters >> np.uint64(29)
    sums, factor, found = letters[:-1] * np.uint64(1), 1, []
    sizes = np.zeros(len(owner), np.int64)
    for n in range(2, how.most + 1):
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
        sums = sums[: max(0, len(codes) - n + 1)] + letters[n - 1:] * np.uint64(factor)
        if n < how.least or not len(sums):
            continue
        # no break between the first and the last character, which may be the ends of the word
        at = np.flatnonzero(breaks[n - 2: n - 2 + len(sums)] == breaks[: len(sums)])
        at = at[inside[at + 1]]
        hashed = sums[at] * np.uint64(0xBF58476D1CE4E5B9)
        hashed ^= hashed >> np.uint64(32)
        buckets = (hashed * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - how.bits)).astype(np.int32)
        found.append((buckets, word[at + 1]))
        sizes += np.bincount(found[-1][1], minlength=len(owner))
    for buckets, of in found:
        yield buckets, of, owner, sizes


def entries(text: str, how: Training) -> tuple[np.ndarray, np.ndarray]:
    """The text's mean of words as weights of buckets: ``buckets, weights``, the weights adding up to 1."""
    ids, weights = [np.zeros(0, np.int32)], [np.zeros(0)]
    for buckets, of, owner, sizes in bags([text], how):
        ids.append(buckets)
        weights.append(1 / (sizes[of] * (np.count_nonzero(sizes) + how.blank)))
    ids, inverse = np.unique(np.concatenate(ids), return_inverse=True)
    return ids.astype(np.int32), np.bincount(inverse, weights=np.concatenate(weights), minlength=len(ids)).astype(np.float32)


def means(texts: list[str], numbers: np.ndarray, how: Training) -> np.ndarray:
    """Mean over the words of each text of the mean of ``numbers`` over a word's bag; 0 without words."""
    total = words = None
    for buckets, of, owner, sizes in bags(texts, how):
        if total is None:
            total, words = np.zeros(len(owner)), (owner, sizes)
        total += np.bincount(of, weights=numbers[buckets], minlength=len(owner))
    out = np.zeros(len(texts))
    if words is None:
        return out
    owner, sizes = words
    used = sizes > 0
    counts = np.bincount(owner[used], minlength=len(texts))
    out += np.bincount(owner[used], weights=total[used] / sizes[used], minlength=len(texts))
    return out / np.maximum(counts + how.blank, 1)


@dataclass(frozen=True)
class Model:
    """The score is the logistic function of ``bias`` plus the mean of ``numbers``."""

    numbers: np.ndarray
    bias: float
    how: Training

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + means(texts, self.numbers, self.how), -700, 700)))


@dataclass(frozen=True)
class _Batch:
    """Some texts: entry e gives ``weights[e]`` of feature ``rows[inverse[e]]`` to a text; texts start at ``starts``.

    ``order`` sorts the entries by feature, whose runs start at ``runs``.
    """

    rows: np.ndarray
    inverse: np.ndarray
    weights: np.ndarray
    text: np.ndarray
    starts: np.ndarray
    order: np.ndarray
    runs: np.ndarray
    labels: np.ndarray


def _batches(bag: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, number: np.ndarray, how: Training) -> list[_Batch]:
    order, out = np.random.default_rng(how.seed).permutation(len(bag)), []
    for at in range(0, len(order), how.batch):
        known = [(number[bag[i][0]] >= 0) for i in order[at: at + how.batch]]
        some = [i for i, k in zip(order[at: at + how.batch], known) if k.any()]
        known = [k for k in known if k.any()]
        if not some:
            continue
        sizes = [int(k.sum()) for k in known]
        ids = np.concatenate([number[bag[i][0][k]] for i, k in zip(some, known)])
        rows, inverse = np.unique(ids, return_inverse=True)
        sort = np.argsort(inverse, kind="stable")
        out.append(_Batch(rows, inverse.astype(np.int32), np.concatenate([bag[i][1][k] for i, k in zip(some, known)]),
                          np.repeat(np.arange(len(some), dtype=np.int32), sizes), np.cumsum([0, *sizes[:-1]]), sort.astype(np.int32),
                          np.searchsorted(inverse[sort], np.arange(len(rows))), labels[some]))
    return out


def train(bag: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, how: Training) -> tuple[np.ndarray, float]:
    """Numbers of the buckets and bias, from texts given as ``entries`` and labels 0 or 1.

    Buckets of fewer than ``least_texts`` training texts keep the number 0. Steps
    follow the mean loss of a few texts, divided by the root of the squared
    gradients so far; embeddings start and batches are dealt as ``seed`` says.
    """
    texts_of = np.bincount(np.concatenate([b for b, _ in bag]), minlength=1 << how.bits)
    known = np.flatnonzero(texts_of >= how.least_texts)
    number = np.full(1 << how.bits, -1, np.int32)
    number[known] = np.arange(len(known))
    batches = _batches(bag, labels, number, how)
    rng = np.random.default_rng(how.seed)
    # embeddings start at zero: what a bucket has learnt nothing about adds nothing
    table = np.zeros((len(known), how.size), np.float32)
    outs, bias = rng.uniform(-1, 1, (how.size, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen = [np.full(len(table), 1e-6, np.float32), np.full(outs.shape, 1e-6, np.float32), np.full(2, 1e-6, np.float32)]
    for _ in range(how.passes):
        for k in rng.permutation(len(batches)):
            b = batches[k]
            hidden = np.add.reduceat(table[b.rows][b.inverse] * b.weights[:, None], b.starts)
            logits = hidden @ outs + bias
            wrong = np.exp(logits - logits.max(axis=1, keepdims=True))
            wrong /= wrong.sum(axis=1, keepdims=True)
            wrong[np.arange(len(b.labels)), b.labels] -= 1
            wrong /= len(b.labels)
            grads = (hidden.T @ wrong, wrong.sum(axis=0))
            change = np.add.reduceat((wrong @ outs.T)[b.text[b.order]] * b.weights[b.order][:, None], b.runs)
            seen[0][b.rows] += (change * change).mean(axis=1)
            moved = table[b.rows] - how.rate * change / np.sqrt(seen[0][b.rows])[:, None]
            length = np.sqrt((moved * moved).sum(axis=1)) + 1e-30
            table[b.rows] = moved * np.maximum(0, 1 - how.rate * how.shrink / (np.sqrt(seen[0][b.rows]) * length))[:, None]
            for value, grad, sums in zip((outs, bias), grads, seen[1:]):
                sums += grad * grad
                value -= how.rate * grad / np.sqrt(sums)
    apart = outs[:, 1] - outs[:, 0]
    numbers = np.zeros(1 << how.bits, np.float32)
    numbers[known] = table @ apart
    return numbers, float(bias[1] - bias[0])


def sample(docs: DataFrame, labels: DataFrame, how: Training) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, toxic, text`` of the training rows, and the number of training labels of each class.

    Ids are chosen from the labels, so only the chosen texts move: those of least
    hash, out of the share of a class that holds a quarter more than are wanted.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.xxhash64("doc_id", F.lit(how.seed))
    parts = []
    for c in (0, 1):
        share = min(1.0, 1.25 * (how.rows // 2) / max(1, counts.get(c, 0)))
        some = known.filter((F.col("toxic") == c) & (F.pmod(place, F.lit(1 << 20)) < math.ceil(share * (1 << 20))))
        parts.append(some.orderBy(F.pmod(place, F.lit(1 << 20)), place, "doc_id").limit(how.rows // 2))
    # at most ``rows`` ids
    ids = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select("doc_id", "text").filter(F.length("text") <= how.chars).join(ids, "doc_id")
    return texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), counts


def fit(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> Model:
    """The model of the training rows of ``labels``; reruns agree."""
    chosen, counts = sample(docs, labels, how)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bag = [entries(t, how) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([b for b, _ in bag], pa.list_(pa.int32())),
                                              pa.array([w for _, w in bag], pa.list_(pa.float32()))], ["doc_id", "toxic", "buckets", "weights"])

    # at most ``rows`` rows, of at most 4 entries a character
    found = chosen.mapInArrow(run, "doc_id long, toxic int, buckets array<int>, weights array<float>").toArrow()
    found = found.sort_by("doc_id").combine_chunks()
    truth = found.column("toxic").to_numpy().astype(np.int64)
    none = np.zeros(1 << how.bits, np.float32)
    if len(set(truth.tolist())) < 2:
        ones = counts.get(1, 0) + 1
        return Model(none, math.log(ones / (sum(counts.values()) + 2 - ones)), how)
    bag = [(b.values.to_numpy(), w.values.to_numpy()) for b, w in zip(found.column("buckets"), found.column("weights"))]
    numbers, bias = train(bag, truth, how)
    share = math.log(counts[1] / counts[0]) - math.log(truth.sum() / (len(truth) - truth.sum()))
    return Model(numbers, bias + share, how)


def _parts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    at, held, size = 0, [], 0
    for i, scalar in enumerate(column):
        text = scalar.as_py() or ""
        if held and size + len(text) > PART:
            yield at, held
            at, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield at, held


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _parts(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(model.scores(texts))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def judge(docs: DataFrame, labels: DataFrame, how: Training = Training(), least: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, by a model of the training labels."""
    return score(docs, fit(docs, labels, how)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"))
