"""Exact k-means on integer vectors by bit planes and population counts.

A vector of 64 components keeps bit p of all of them in one 64-bit word, its
plane p (two's complement: the top plane counts negatively). The dot product of
a vector with a centroid is the sum over pairs of planes of the plane weights
times the number of common bits, so dot products, norms and squared distances
are exact integers; the sums of a cluster are counts of set bits, plane by plane.

The planes are packed once into a table of the shared folder. A round is one
pass over it: each task adds up its vectors by cluster, Spark adds the tasks, and
``k`` rows of sums reach the driver. A round that changes no centroid ends the
rounds, since all later ones would repeat it.

Rows are kept when the vector has exactly 64 components, none null, NaN or
infinite; a null vector, an empty one and one of another length go. Components
beyond 2^27 after scaling count as 2^27 (-2^27 - 1 likewise), else distances would not
fit a long; sums of distances that do not fit are null. Repeated rows are
vectors of their own. Rows without an id are clustered too, but are no start
while others are left. With fewer than ``k`` vectors there are fewer centroids;
an empty table has an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lowtide.sources.sinks import release, stage

COMPONENTS = 64
#: components are floor(SCALE * x)
SCALE = 1024
LARGEST = 1 << 27
_RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def kept(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the usable rows."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("vec_id", "embedding").filter((F.size("embedding") == COMPONENTS) & usable)


def scaled(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -LARGEST - 1, LARGEST).astype(np.int64)


def planes_needed(low: int, high: int) -> int:
    """Planes of two's complement that hold all integers from ``low`` to ``high``."""
    return 1 + max((x if x >= 0 else -x - 1).bit_length() for x in (low, high))


def plane_weights(n: int) -> np.ndarray:
    weights = np.int64(1) << np.arange(n, dtype=np.int64)
    weights[-1] = -weights[-1]
    return weights


def pack(values: np.ndarray, n: int) -> np.ndarray:
    """Planes (n, rows) of integer vectors (rows, 64); bit j of a plane belongs to component j."""
    out = np.empty((n, len(values)), "<u8")
    for p in range(n):
        bits = ((values >> p) & 1).astype(np.uint8)
        out[p] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def bits_of(planes: np.ndarray) -> np.ndarray:
    """Set bits by plane and component, added over the rows of ``planes`` (n, rows)."""
    n, rows = planes.shape
    spread = np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(n, rows, 8), axis=2, bitorder="little")
    return spread.sum(axis=1, dtype=np.int64)


def dots(planes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Dot products of each row of ``planes`` (n, rows) with the vector of planes ``others`` (m,) or, row by row, (m, rows)."""
    left, right = plane_weights(len(planes)), plane_weights(len(others))
    out = np.zeros(planes.shape[1], np.int64)
    for other, weight in zip(others, right):
        common = np.bitwise_count(planes & other)
        out += weight * (left[:, None] * common).sum(axis=0)
    return out


def nearest(planes: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller one of equals) and its squared distance."""
    packed = pack(centroids, len(planes))
    apart = np.stack([norms + int((c * c).sum()) - 2 * dots(planes, packed[:, i]) for i, c in enumerate(centroids)])
    best = apart.argmin(axis=0)
    return best, apart[best, np.arange(len(best))]


def _planes_of(column: pa.Array, n: int) -> np.ndarray:
    """Planes (n, rows) of a binary column with n words a row."""
    data = b"".join(column.to_pylist())
    return np.ascontiguousarray(np.frombuffer(data, "<u8").reshape(-1, n).T)


def packed_table(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The table ``vec_id, planes, norm`` of the kept vectors, and the planes a vector has."""
    good = kept(vectors)
    ends = good.agg(F.min(F.array_min("embedding")).alias("low"), F.max(F.array_max("embedding")).alias("high")).first()
    n = planes_needed(*(int(scaled(np.array([x or 0.0]))[0]) for x in ends))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = scaled(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, COMPONENTS))
            planes = pack(values, n)
            words = [row.tobytes() for row in np.ascontiguousarray(planes.T)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary()), pa.array(dots(planes, planes))],
                                             ["vec_id", "planes", "norm"])

    return stage(good.mapInArrow(run, "vec_id long, planes binary, norm long"), "bit-planes"), n


def starts(packed: DataFrame, n: int, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors of least hash of ``seed:vec_id``, in that order; equal hashes in the order of the planes."""
    first = packed.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "planes").limit(k)
    rows = [bytes(r.planes) for r in first.select("planes").collect()]
    planes = np.frombuffer(b"".join(rows), "<u8").reshape(-1, n).T
    return np.array([plane_weights(n) @ bits_of(planes[:, i: i + 1]) for i in range(len(rows))], np.int64).reshape(-1, COMPONENTS)


def cluster_sums(packed: DataFrame, n: int, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Number and component sums of the vectors of each cluster."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), COMPONENTS), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            planes = _planes_of(batch.column(0), n)
            best, _ = nearest(planes, batch.column(1).to_numpy(), centroids)
            counts += np.bincount(best, minlength=len(centroids))
            for c in np.unique(best):
                sums[c] += plane_weights(n) @ bits_of(planes[:, best == c])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(centroids)), pa.int32()), pa.array(counts), pa.array(sums.tolist(), pa.list_(pa.int64()))],
                                         ["cluster", "n", "sums"])

    parts = packed.select("planes", "norm").mapInArrow(run, "cluster int, n long, sums array<long>")
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.get("sums", F.lit(j))) for j in range(COMPONENTS))).alias("sums"))
    return {r.cluster: (r.n, r.sums) for r in total.collect() if r.n}


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: str = "3") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector."""
    packed, n = packed_table(vectors)
    centroids = starts(packed, n, k, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], _RESULT)
    for _ in range(rounds):
        moved = centroids.copy()
        for c, (count, sums) in cluster_sums(packed, n, centroids).items():
            moved[c] = [s // count for s in sums]
        if (moved == centroids).all():
            break
        centroids = moved

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                best, apart = nearest(_planes_of(batch.column(1), n), batch.column(2).to_numpy(), centroids)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int32()), pa.array(apart)], ["vec_id", "cluster", "distance"])

    out = stage(packed.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")
    release(packed)
    inertia = {r.cluster: int(r.s) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda x: x if x < 1 << 63 else None
    total = fits(sum(inertia.values()))
    listed = [(c, fits(s), total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in inertia.items()]
    facts = out.sparkSession.createDataFrame(listed, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # k rows
    return out.join(F.broadcast(facts), "cluster").select(*(f.split()[0] for f in _RESULT.split(", ")))
