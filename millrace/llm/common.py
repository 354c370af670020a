"""Small helpers that several operators here share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.workdir import checkpointed

#: A-Z to a-z, every other byte as it is.
ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def unused(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def raw_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    return column.cast(pa.large_binary()).to_pylist()


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``function`` over every Arrow batch; a batch for which it gives None is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = function(batch)
            if made is not None:
                yield made

    return df.mapInArrow(run, schema)


def text_bytes(df: DataFrame, text: str) -> int:
    """UTF-8 bytes of a text column, by one pass that reads this column only."""
    return int(df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0)


def id_or_last(column: Column) -> Column:
    """A bigint id; null comes after every other."""
    return F.coalesce(column.cast("bigint"), F.lit(2**63 - 1))


def free_unused(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of tables that nothing refers to any more.

    Its cleaner follows the JVM's collector, which has no reason to run while only disks fill.
    """
    gc.collect()
    spark._jvm.System.gc()


#: Packed arrays that are added up in one task.
ADDED_AT_ONCE = 64


def added_up(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of packed arrays of ``size`` 64-bit integers, one for each row of the only column.

    Rows are added in tasks of 64, level by level, so that the driver gets at most 64 arrays however many tasks made them.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for packed in batch[0].to_pylist():
                total += np.frombuffer(packed, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["packed"])

    parts = checkpointed(parts.toDF("packed"))
    count = parts.count()
    while count > ADDED_AT_ONCE:
        count = -(-count // ADDED_AT_ONCE)
        parts = parts.repartition(count).mapInArrow(add, "packed binary")
    return sum((np.frombuffer(row[0], np.int64) for row in parts.collect()), np.zeros(size, np.int64))
