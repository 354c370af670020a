"""Texts dealt into blocks, for operators that look for repeats between documents.

Copies are folded first, task by task, into one text with its smallest id. The texts are dealt by their content into
blocks of some megabytes, each of which one task can hold, and stored once, bucketed by block, in the shared folder.
Later passes read the buckets in place: what is sent between blocks and answered again is the only thing shuffled.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_or_last, map_batches, raw_texts, text_bytes
from millrace.workdir import checkpointed, fresh_dir

#: Bytes of text in a block.
BLOCK_BYTES = 4_000_000
#: Buckets of the stored table; Spark takes no more than 100,000.
MOST_BUCKETS = 50_000
#: What comes back for every distinct text: its SHA-256 and smallest id, its size in units, and the removed runs of units.
RESULT = "sha string, first bigint, units bigint, n_removed bigint, kept_sha256 string, runs array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Stored:
    table: DataFrame
    name: str
    blocks: int

    def drop(self) -> None:
        self.table.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def store(docs: DataFrame, text: str, id_column: str, block_bytes: int = BLOCK_BYTES) -> Stored:
    spark = docs.sparkSession
    narrow = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), id_or_last(F.col(f"`{id_column}`")).alias("first"))
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(text_bytes(narrow, "text") / block_bytes))

    def fold(batch: pa.RecordBatch) -> pa.RecordBatch:
        least: dict[str, int] = {}
        for value, first in zip(batch["text"].to_pylist(), batch["first"].to_pylist(), strict=True):
            least[value] = min(first, least.get(value, first))
        return pa.RecordBatch.from_arrays([pa.array(least.keys(), pa.string()), pa.array(least.values(), pa.int64())], ["text", "first"])

    dealt = map_batches(narrow, fold, "text string, first bigint").withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks)).cast("int"))
    name = f"millrace_blocks_{uuid.uuid4().hex}"
    buckets = min(blocks, MOST_BUCKETS)  # beyond that a bucket holds several blocks, each still its own group
    writer = dealt.repartition(buckets, "block").write.bucketBy(buckets, "block").option("compression", "zstd")
    writer.option("path", fresh_dir(spark, "blocks")).saveAsTable(name)
    return Stored(spark.table(name), name, blocks)


class Block:
    """The distinct texts of a block in a fixed order, as one run of bytes."""

    def __init__(self, table: pa.Table):
        least: dict[bytes, int] = {}
        for raw, first in zip(raw_texts(table["text"]), table["first"].to_pylist(), strict=True):
            least[raw] = min(first, least.get(raw, first))
        self.texts = sorted(least)
        self.firsts = np.array([least[t] for t in self.texts], np.int64)
        self.data = b"".join(self.texts)
        self.ends = np.cumsum([len(t) for t in self.texts], dtype=np.int64)
        self.starts = self.ends - np.array([len(t) for t in self.texts], np.int64)


def by_bucket(buckets: np.ndarray, count: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the runs of a sorted array of buckets."""
    cuts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])) if len(buckets) else np.array([], np.int64)
    return list(zip(buckets[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(buckets)], strict=True)) if count else []


def runs_of(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def covered_by(windows: np.ndarray, width: int, units: int) -> np.ndarray:
    """Which units any of the windows that start at True covers."""
    steps = np.zeros(units + 1, np.int64)
    at = np.flatnonzero(windows)
    steps[at] += 1
    np.subtract.at(steps, at + width, 1)
    return np.cumsum(steps[:units]) > 0


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


#: Odd constants that scatter bits, as multipliers of 64-bit numbers.
SCATTER = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def scatter(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * SCATTER[1]
    x = (x ^ (x >> np.uint64(27))) * SCATTER[2]
    return x ^ (x >> np.uint64(31))


def with_copies(docs: DataFrame, results: DataFrame, units, width: int, text: str, id_column: str) -> DataFrame:
    """One row per document from the results of the distinct texts.

    A document whose id is not the smallest of its text is a copy: all of it goes if it has a window at all.
    """
    raw = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    narrow = docs.select(F.col(f"`{id_column}`").alias("doc_id"), id_or_last(F.col(f"`{id_column}`")).alias("id"), F.sha2(raw.cast("binary"), 256).alias("sha"))
    joined = narrow.join(checkpointed(results), "sha")
    copy = (F.col("id") > F.col("first")) & (F.col("units") >= width)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("units").cast("int").alias("end")))
    return joined.select(
        "doc_id", F.col("units").alias(units), F.when(copy, F.col("units")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, sha(b"")).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.col("runs")).alias("runs"),
    )
