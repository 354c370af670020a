"""Clusters around centroids, by equal-average equal-variance search.

Components become integers, so that every distance, mean and tie is exact. Of a vector x of d components take the sum S and
V = sqrt(d * sum of squares - S^2). For two vectors, d times the squared distance is at least (S - S')^2 + (V - V')^2. So
centroids are sorted by their sums; from the place of a vector's sum the search goes outward, ends on a side where the
first term alone is more than the best distance so far, and skips a centroid where both terms are. What is left is
measured in 64-bit integers. The bounds are floating point with their error taken off, so that nothing that could be as
near as the best is skipped, and of equals the smaller number wins.

Rounds read integer vectors stored once. Each task gives its sums and counts in one packed array, added up in a tree; the
centroids (a parameter's number of rows) are all that is broadcast or collected.

Defined results: vectors that are null, of another length, or with a null or non-finite component are left out. Components
are clamped to 2**27 in magnitude after scaling, so that no distance leaves 64 bits; inertia ends at 2**63 - 1. Equal rows each get their row; a null
id counts as an empty one when the first centroids are chosen. Fewer kept vectors than clusters give fewer clusters, none an
empty result. Only the id and the vector are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import added_up
from millrace.workdir import checkpointed, fresh_dir

#: Largest magnitude of an integer component.
LARGEST = 1 << 27
#: Vectors that are searched together.
TOGETHER = 4096


def integer_vectors(table: DataFrame, dims: int, scale: int, vector: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """(vec_id, packed): the vectors that are kept, as 32-bit integers ``floor(scale * x)``."""

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["vector"]
            batch = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(lists), dims), False))
            values = batch["vector"].flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)  # null: NaN
            whole = np.isfinite(values).all(axis=1)
            ints = np.clip(np.floor(scale * values[whole]), -LARGEST, LARGEST).astype(np.int32)
            packed = pa.array([row.tobytes() for row in ints], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["vec_id"].filter(pa.array(whole)), packed], ["vec_id", "packed"])

    narrow = table.select(F.col(f"`{id_column}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    kind = narrow.schema["vec_id"].dataType.simpleString()
    return narrow.mapInArrow(change, f"vec_id {kind}, packed binary")


def _shape(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums, deviations (times the square root of the length) and bounds of the latter's error."""
    sums = vectors.sum(axis=1)
    squares = vectors.shape[1] * np.square(vectors.astype(np.float64)).sum(axis=1)
    return sums, np.sqrt(np.maximum(squares - np.square(sums.astype(np.float64)), 0)), np.sqrt(squares) * 2.0**-24


@dataclass(frozen=True)
class Centroids:
    """Rows of 64-bit integers; their numbers are their places."""

    rows: np.ndarray

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest centroid of each vector, and the squared distance."""
        dims = vectors.shape[1]
        own_sums, own_devs, own_slack = _shape(vectors)
        sums, devs, slack = _shape(self.rows)
        order = np.argsort(sums, kind="stable")
        sums, devs, slack, rows = sums[order], devs[order], slack[order], self.rows[order]
        number = np.full(len(vectors), len(rows), np.int64)
        best = np.full(len(vectors), np.iinfo(np.int64).max)
        start = np.searchsorted(sums, own_sums)
        # The next place to the right and to the left of each vector whose search on that side is not over.
        sides = [(np.arange(len(vectors)), start, 1), (np.arange(len(vectors)), start - 1, -1)]
        while any(len(who) for who, _, _ in sides):
            rest = []
            for who, place, step in sides:
                open_ = (place >= 0) & (place < len(rows))
                who, place = who[open_], place[open_]
                gap = np.square((own_sums[who] - sums[place]).astype(np.float64))
                limit = best[who].astype(np.float64) * dims * (1 + 1e-9)
                open_ = gap <= limit
                who, place, gap, limit = who[open_], place[open_], gap[open_], limit[open_]
                spread = np.maximum(np.abs(own_devs[who] - devs[place]) - own_slack[who] - slack[place], 0)
                near = gap + np.square(spread) <= limit
                at, to = who[near], place[near]
                apart = vectors[at] - rows[to]
                distance = np.einsum("ij,ij->i", apart, apart)
                closer = (distance < best[at]) | ((distance == best[at]) & (order[to] < number[at]))
                best[at[closer]], number[at[closer]] = distance[closer], order[to[closer]]
                rest.append((who, place + step, step))
            sides = rest
        return number, best

    def sha256(self, number: int) -> str:
        return hashlib.sha256(",".join(map(str, self.rows[number].tolist())).encode()).hexdigest()


def _searched(batches: Iterator[pa.RecordBatch], centroids: Centroids, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(start, TOGETHER)
            vectors = np.frombuffer(b"".join(part["packed"].to_pylist()), np.int32).reshape(-1, dims).astype(np.int64)
            yield part, vectors, *centroids.nearest(vectors)


def first_centroids(vectors: DataFrame, clusters: int, dims: int, seed: int) -> Centroids:
    """The vectors whose seeded id has the smallest SHA-256, in this order."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    least = vectors.select("packed", F.sha2(named.cast("binary"), 256).alias("h")).orderBy("h", "packed").limit(clusters).collect()
    return Centroids(np.frombuffer(b"".join(row["packed"] for row in least), np.int32).reshape(-1, dims).astype(np.int64))


def moved(vectors: DataFrame, centroids: Centroids, dims: int) -> Centroids:
    """Every centroid that has vectors goes to the floor of their mean, component by component."""
    clusters = len(centroids.rows)
    sent = vectors.sparkSession.sparkContext.broadcast(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((clusters, dims + 1), np.int64)
        for _, ints, number, _ in _searched(batches, sent.value, dims):
            order = np.argsort(number, kind="stable")
            present, starts = np.unique(number[order], return_index=True)
            total[present, :dims] += np.add.reduceat(ints[order], starts, axis=0) if len(starts) else 0
            total[:, dims] += np.bincount(number, minlength=clusters)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["packed"])

    total = added_up(vectors.select("packed").mapInArrow(add, "packed binary"), clusters * (dims + 1)).reshape(clusters, dims + 1)
    sent.destroy()
    counts = total[:, dims:]
    return Centroids(np.where(counts > 0, total[:, :dims] // np.maximum(counts, 1), centroids.rows))


@dataclass(frozen=True)
class Clusters:
    """``vectors``: (vec_id, cluster, distance). ``summary``: one row for each cluster with its number, size, inertia and centroid."""

    vectors: DataFrame
    summary: DataFrame
    centroids: Centroids


def clustered(table: DataFrame, clusters: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, vector: str = "embedding",
              id_column: str = "vec_id") -> Clusters:
    spark = table.sparkSession
    path = fresh_dir(spark, "vectors")
    integer_vectors(table, dims, scale, vector, id_column).write.option("compression", "zstd").parquet(path)
    vectors = spark.read.parquet(path)
    centroids = first_centroids(vectors, clusters, dims, seed)
    if len(centroids.rows):
        for _ in range(rounds):
            centroids = moved(vectors, centroids, dims)
    sent = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, number, distance in _searched(batches, sent.value, dims):
            yield pa.RecordBatch.from_arrays([part["vec_id"], pa.array(number, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    assigned = checkpointed(vectors.mapInArrow(assign, f"vec_id {kind}, cluster int, distance bigint"))
    sums = assigned.groupBy("cluster").agg(F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)"))).collect()  # a row for each cluster
    rows = [(c, n, min(int(total), 2**63 - 1), centroids.rows[c].tolist(), centroids.sha256(c)) for c, n, total in sorted(sums)]
    summary = spark.createDataFrame(rows, "cluster int, size bigint, inertia bigint, centroid array<bigint>, centroid_sha256 string")
    return Clusters(assigned, summary, centroids)
