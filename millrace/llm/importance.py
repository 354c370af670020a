"""Importance resampling towards a target distribution.

Words are hashed into buckets and counted over the whole corpus and the whole target. A bucket's gain is its log ratio,
in thousandths, and an array of gains scores every document: the floored mean over its features. Gumbel noise from the
document's id turns "draw without replacement by weight" into "take the highest scores".

Where the k-th highest score lies is bracketed by a quantile sketch, which is mergeable and knows its rank error. Exact
counts of the scores above and inside validate the bracket, and it is widened until the k-th is in it. Only the bracket is
sorted to find the cutoff; what is above it is drawn without comparison. Ranks come from range partitions and their
counts, so that no task sees more than a share of the drawn rows.

Counts leave each task as one packed array and are added in a tree. The gains (8 bytes for each bucket) are the only
broadcast.

Defined results: a null or empty text has no features and weight 0, and is too short to be drawn unless ``min_words`` is 0.
A null id counts as an empty one for the noise and comes last among ties. Equal rows have equal scores and take ranks one
after the other. Empty tables give no rows. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import added_up, raw_texts
from millrace.workdir import checkpointed

BUCKETS, SEED = 10_000, 2024
#: Accuracy of the quantile sketch: ranks are known to one part in so many. The first bracket is twice that to either side.
ACCURACY = 10_000
#: Rows that one task sorts.
SORTED_ROWS = 1_000_000
#: Distinct features whose bucket a worker remembers.
REMEMBERED = 500_000

#: A-Z lower-cased, digits, a-z and everything beyond ASCII as they are, the rest a space.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class _Buckets(dict):
    """Buckets of features."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        found = crc32(feature) % self.buckets
        if len(feature) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[feature] = found
        return found


_buckets = cache(_Buckets)


def _features(words: list[bytes], longest: int) -> list[bytes]:
    """Runs of 1 to ``longest`` words."""
    runs = list(words)
    for n in range(2, longest + 1):
        runs += [b" ".join(words[k : k + n]) for k in range(len(words) - n + 1)]
    return runs


def _bucketed(batch: pa.RecordBatch, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, features of each text, and the buckets of all features."""
    bucket = _buckets(buckets).__getitem__
    n_words, n_features, found = [], [], []
    for raw in raw_texts(batch["text"]):
        words = (raw or b"").translate(_WORD_BYTES).split()
        runs = words if longest == 1 else _features(words, longest)
        n_words.append(len(words))
        n_features.append(len(runs))
        found.append(np.fromiter(map(bucket, runs), np.int32, len(runs)))
    return np.array(n_words, np.int64), np.array(n_features, np.int64), np.concatenate([np.array([], np.int32), *found])


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = 1) -> np.ndarray:
    """How many features of all documents each bucket has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in _parts(batches):
            total += np.bincount(_bucketed(batch, buckets, longest)[2], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["packed"])

    return added_up(docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "packed binary"), buckets)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's share in the target to that in the source, floored."""
    n, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    ratios = ((t + 1.0) * (all_source + n) / ((s + 1.0) * (all_target + n)) for s, t in zip(source.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def noise(doc_id: object, seed: int) -> int:
    """Gumbel noise in thousandths, from the id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, target: DataFrame, text: str = "text", id_column: str = "doc_id", buckets: int = BUCKETS, longest: int = 1,
           seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document."""
    counts = bucket_counts(docs, text, buckets, longest), bucket_counts(target, text, buckets, longest)
    array = docs.sparkSession.sparkContext.broadcast(gains(*counts))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            n_words, n_features, found = _bucketed(batch, buckets, longest)
            sums = np.concatenate(([0], np.cumsum(array.value[found])))
            ends = np.cumsum(n_features)
            weight = (sums[ends] - sums[ends - n_features]) // np.maximum(n_features, 1)
            score = weight + np.array([noise(i, seed) for i in batch["doc_id"].to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *map(pa.array, (n_words, n_features, weight, score))],
                                             ["doc_id", "n_words", "n_features", "weight", "score"])

    narrow = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(score, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint, score bigint")


def bracket(rows: DataFrame, score: str, k: int, size: int, accuracy: int = ACCURACY) -> tuple[Column, Column, int, int]:
    """Which rows are above and which inside a range of scores that surely holds the ``k``-th highest, and how many of each."""
    spread = 2.0 / accuracy
    while True:
        places = [1 - k / size - spread, 1 - k / size + spread]
        asked = [min(max(p, 0.0), 1.0) for p in places]
        low, high = rows.agg(F.percentile_approx(score, asked, accuracy)).first()[0]
        # A place beyond either end has no bound there.
        above = F.col(score) > high if places[1] < 1 else F.lit(False)
        inside = (~above & (F.col(score) >= low)) if places[0] > 0 else ~above
        n_above, n_inside = rows.agg(F.count_if(above), F.count_if(inside)).first()
        if n_above < k <= n_above + n_inside:
            return above, inside, n_above, n_inside
        spread *= 8


def numbered(rows: DataFrame, order: list[Column], count: int, start: int = 0) -> DataFrame:
    """The rows with their place in an order, from ``start`` + 1, as ``rank``. Ranges are sorted apart and counted."""
    ranges = max(1, -(-count // SORTED_ROWS))
    # Stored rows have their partition and place in the number Spark gives them.
    place = F.monotonically_increasing_id()
    placed = checkpointed(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)).withColumn("rank", place)
    part = F.shiftright("rank", 33)
    sizes = {row[0]: row[1] for row in placed.groupBy(part).count().collect()}  # one row for each range
    firsts, n = [], start + 1
    for key in sorted(sizes):
        firsts.append((key, n - (key << 33)))
        n += sizes[key]
    offsets = rows.sparkSession.createDataFrame(firsts, "_part bigint, _first bigint")
    joined = placed.join(F.broadcast(offsets), part == F.col("_part"))
    return joined.select(*rows.columns, (F.col("rank") + F.col("_first")).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, text: str = "text", id_column: str = "doc_id",
              accuracy: int = ACCURACY, **settings) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): every document, and the rank of those that are drawn.

    Of the documents with at least ``min_words`` words, the floor of ``percent`` percent with the highest scores are drawn;
    the smaller id goes first among equals.
    """
    found = checkpointed(scored(docs, target, text, id_column, **settings))
    nothing = F.lit(None).cast("bigint").alias("rank")
    eligible = F.col("n_words") >= min_words
    size = found.filter(eligible).count()
    k = percent * size // 100
    if not k:
        return found.select("*", nothing)
    # Equal rows differ by their stored place, so that a group of copies can be cut into ranges too.
    found = found.withColumn("_row", F.monotonically_increasing_id())
    candidates = found.filter(eligible)
    above, inside, n_above, n_inside = bracket(candidates, "score", k, size, accuracy)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    near = numbered(candidates.filter(inside), order, n_inside, n_above)
    near = near.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    drawn = numbered(candidates.filter(above), order, n_above)
    rest = found.filter(~eligible | ~(above | inside)).select("*", nothing)
    return drawn.unionByName(near).unionByName(rest).drop("_row")
