"""Exact centroid clustering of integer vectors, filtered in a space rotated by principal components."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, small_frame

CENTROIDS, ROUNDS, DIMENSIONS, SCALE, SEED = 40, 5, 64, 256, "2"

#: Share of the variance that the leading rotated coordinates hold together.
SHARE = 0.8
#: Whole components beyond this could give squared distances that fit no long.
LARGEST = 1 << 27
#: Vectors that are compared at once, and pairs whose distances are verified at once.
TOGETHER, PAIRS = 8192, 32768


class Rotation:
    """An orthogonal basis; vectors become their leading coordinates and the norm of the rest.

    The distance between two such shorter vectors is never above the true one: leading
    coordinates are a projection, and the rests of two vectors are at least as far apart as
    their norms differ.
    """

    def __init__(self, mean: np.ndarray, covariance: np.ndarray, share: float = SHARE) -> None:
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")
        held = np.cumsum(np.maximum(values[order], 0.0))
        self.leading = min(int(np.searchsorted(held, share * held[-1])) + 1, len(mean))
        self.mean, self.axes = mean, np.ascontiguousarray(vectors[:, order])

    def short(self, vectors: np.ndarray) -> np.ndarray:
        turned = (vectors - self.mean) @ self.axes
        rest = np.sqrt(np.square(turned[:, self.leading :]).sum(axis=1))
        return np.column_stack([turned[:, : self.leading], rest])


def nearest(vectors: np.ndarray, short: np.ndarray, points: np.ndarray, short_points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest point of every whole vector, the squared distance, and how many were verified.

    The point with the least bound is measured first. Only points whose bound does not
    exceed that distance can be nearer or as near; these are verified in integers, and of
    equally near ones the smaller number wins. Bounds are floating-point numbers, so they
    are compared with some slack, which lets more points through and loses none.
    """
    bounds = np.empty((len(vectors), len(points)))
    for number, point in enumerate(short_points):
        bounds[:, number] = np.square(short - point).sum(axis=1)
    reach = _squares(vectors, points[np.argmin(bounds, axis=1)])
    span = np.sqrt(np.square(short).sum(axis=1)) + np.sqrt(np.square(short_points).sum(axis=1).max())
    limit = np.square(np.sqrt(reach) + 1e-9 * (1.0 + span))
    rows, numbers = np.nonzero(bounds <= limit[:, None])
    found = np.empty(len(rows), np.int64)
    for start in range(0, len(rows), PAIRS):
        part = slice(start, start + PAIRS)
        found[part] = _squares(vectors[rows[part]], points[numbers[part]])
    begins = np.searchsorted(rows, np.arange(len(vectors)))
    least = np.minimum.reduceat(found, begins)
    # pairs lie by row and then by number, so the first that is as near is the smallest number
    hits = np.flatnonzero(found == least[rows])
    first = hits[np.searchsorted(rows[hits], np.arange(len(vectors)))]
    return numbers[first], least, len(rows)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def _whole(column: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    scaled = np.floor(values.astype(np.float64) * scale)
    if len(scaled) and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a component times {scale} lies beyond {LARGEST}: squared distances would not fit a long")
    return scaled.astype(np.int64)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(start, TOGETHER)


def _unpacked(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _packed(values: np.ndarray, kind: str) -> pa.Array:
    values = np.ascontiguousarray(values, kind)
    return pa.array([row.tobytes() for row in values], pa.binary())


def fit_rotation(kept: DataFrame, dimensions: int, scale: int, share: float) -> Rotation | None:
    """Principal axes of all vectors ``(v)``; None if there are none.

    Sums and products are added up by task and then by Spark; the driver gets one number for
    each pair of dimensions. Rounding moves the axes a little, and no result with them.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimensions + 1, dimensions + 1))
        for part in _parts(batches):
            vectors = _whole(part.column(0), dimensions, scale).astype(np.float64)
            extended = np.column_stack([vectors, np.ones(len(vectors))])
            total += extended.T @ extended
        places = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total.ravel())], ["place", "total"])

    sums = kept.select("v").mapInArrow(summed, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    total = np.zeros((dimensions + 1) ** 2)
    for row in sums.collect():
        total[row["place"]] = row["total"]
    total = total.reshape(dimensions + 1, -1)
    count = total[-1, -1]
    if not count:
        return None
    mean = total[-1, :-1] / count
    return Rotation(mean, total[:-1, :-1] / count - np.outer(mean, mean), share)


def _assigning(rotation: Rotation, points: np.ndarray) -> Callable[[pa.RecordBatch], tuple]:
    short_points, width = rotation.short(points.astype(np.float64)), points.shape[1]

    def assign(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        vectors = _unpacked(part.column("v"), "<i4", width).astype(np.int64)
        short = _unpacked(part.column("short"), "<f8", rotation.leading + 1)
        number, distance, _ = nearest(vectors, short, points, short_points)
        return vectors, number, distance

    return assign


def moved(stored: DataFrame, rotation: Rotation, points: np.ndarray) -> np.ndarray:
    """The points after one round: each the floor of the mean of its vectors, or as it was without any."""
    assign, (k, width) = _assigning(rotation, points), points.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, width + 1), np.int64)
        for part in _parts(batches):
            vectors, number, _ = assign(part)
            order = np.argsort(number, kind="stable")
            held, begins = np.unique(number[order], return_index=True)
            total[held, :-1] += np.add.reduceat(vectors[order], begins)
            total[held, -1] += np.diff(np.append(begins, len(order)))
        cells = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total.ravel()[cells])], ["cell", "total"])

    sums = stored.select("v", "short").mapInArrow(summed, "cell int, total bigint").groupBy("cell").agg(F.sum("total").alias("total"))
    total = np.zeros(k * (width + 1), np.int64)
    for row in sums.collect():  # one number for each component of each point at most
        total[row["cell"]] = row["total"]
    total = total.reshape(k, -1)
    count = total[:, -1:]
    return np.where(count > 0, total[:, :-1] // np.maximum(count, 1), points)


def cluster(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS, scale: int = SCALE, seed: str = SEED, share: float = SHARE,
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid)`` of every kept vector.

    Kept are vectors of exactly ``dimensions`` components, none null or non-finite; each
    component becomes ``floor(scale * x)``. The first ``k`` by SHA-256 of ``seed:id`` are the
    centroids to begin with; each of ``rounds`` rounds moves them to the floor of the mean of
    their vectors. All distances, ties and means are those of whole numbers, so the result
    does not depend on the rotation, the order of rows or the number of tasks.

    Vectors of one id are clustered one by one; of equal hashes the lesser vector comes
    first, and null ids come last. Fewer vectors than ``k`` are as many centroids. No kept
    vector gives no row. Columns other than the two are not looked at, whatever their names.
    A component of more than 2**27 after scaling raises an error, because squared distances
    would not fit a long.

    Vectors are stored once, with their leading rotated coordinates and the norm of the
    rest, and read once a round. The driver holds the centroids; tasks return sums for each.
    """
    spark = df.sparkSession
    v = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    kept = df.select(F.col(f"`{vec_id}`").alias("id"), v.alias("v")).where((F.size(v) == dimensions) & finite)
    kind = kept.schema["id"].dataType.simpleString()
    rotation = fit_rotation(kept, dimensions, scale, share)
    if rotation is None:
        none = spark.range(0).select(F.lit(None).cast(kind).alias("vec_id"))
        added = {"cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint",
                 "centroid_sha256": "string", "centroid": "array<bigint>"}
        return none.select("*", *[F.lit(None).cast(t).alias(c) for c, t in added.items()])

    def stored_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            vectors = _whole(part.column("v"), dimensions, scale)
            short = rotation.short(vectors.astype(np.float64))
            yield pa.RecordBatch.from_arrays([part.column("id"), _packed(vectors, "<i4"), _packed(short, "<f8")], ["id", "v", "short"])

    stored = materialise(kept.mapInArrow(stored_parts, f"id {kind}, v binary, short binary"), "vectors")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = stored.select(digest.alias("digest"), "v").orderBy(F.asc_nulls_last("digest"), "v").limit(k).collect()
    points = np.array([np.frombuffer(row["v"], "<i4") for row in first], np.int64)
    for _ in range(rounds):
        points = moved(stored, rotation, points)

    assign = _assigning(rotation, points)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            _, number, distance = assign(part)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(number.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    result = materialise(stored.mapInArrow(assigned, f"vec_id {kind}, cluster int, distance bigint"), "clusters")
    sums = {row["cluster"]: row["total"] for row in result.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    facts = [
        {"cluster": number, "cluster_inertia": sums[number], "inertia": sum(sums.values()),
         "centroid_sha256": hashlib.sha256(",".join(map(str, point)).encode()).hexdigest(), "centroid": point}
        for number, point in enumerate(points.tolist()) if number in sums
    ]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string, centroid array<bigint>"
    return result.join(F.broadcast(small_frame(spark, facts, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"
    )
