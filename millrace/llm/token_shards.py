"""Token ids in training order, as binary shards of fixed stride.

Every document becomes ids with an end id, cut into sequences of ``length``; the last one is filled up with end ids and
knows its own length. Sequences are numbered from 0 without gaps, in the order in which they are stored. A keyed Feistel
network permutes these numbers: it is a bijection on the next even power of two, and a number that leaves the range is
sent through again until it is back (cycle-walking), so that every sequence has one global slot and every slot one
sequence, with nothing sorted or remembered. Shard ``slot // per_shard`` holds a sequence at record ``slot % per_shard``;
range partitions by slot write them in order.

A record is ``length`` unsigned 16-bit little-endian ids and one line end, so a reader finds slot s at byte
``s % per_shard * (2 * length + 1)`` of its shard, reads on from there, and resumes anywhere. Spark's text writer stores
the records as they are, in any store that it reaches.

Defined results: a null or empty text is one sequence with the end id alone. Equal rows each get their sequences. Null
ids are kept. Only the id and the text are read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.errors import ConfigError
from millrace.llm.blocks import SCATTER, scatter
from millrace.llm.bpe import read_ranks
from millrace.workdir import checkpointed, fresh_dir

LENGTH, PER_SHARD = 1024, 8192
#: Splits of the stored sequences up to which their offsets are broadcast.
BROADCAST_SPLITS = 1_000_000
#: Distinct words whose ids a worker remembers.
REMEMBERED = 400_000


class _Words(dict):
    """Ids of words after a space, by the library; the most frequent ones stay remembered."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        ranks = read_ranks(path)
        self.encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.end = len(ranks)
        if self.end > 0xFFFF:
            raise ConfigError("records hold 16-bit ids")

    def __missing__(self, word: str) -> bytes:
        ids = array("H", self.encode(" " + word)).tobytes()
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """Before a space that a word follows a match always starts, so that words are encoded one by one."""
        words = text.split(" ")
        if any(not w or w[0].isspace() for w in words[1:]):
            return array("H", self.encode(text)).tobytes()
        return array("H", self.encode(words[0])).tobytes() + b"".join(map(self.__getitem__, words[1:]))


_WORDS: dict[tuple[str, str], _Words] = {}


def sequences(docs: DataFrame, vocabulary: tuple[str, str], length: int = LENGTH, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc_id, part, n_tokens, ids): the sequences of every document."""
    kind = docs.select(F.col(f"`{id_column}`")).schema[0].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _WORDS:
            _WORDS[vocabulary] = _Words(*vocabulary)
        words = _WORDS[vocabulary]
        end = array("H", [words.end]).tobytes()
        stride = 2 * length
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                owner, part, sizes, ids = [], [], [], []
                for k, value in enumerate(some["text"].to_pylist()):
                    whole = words.ids(value or "") + end
                    for n, start in enumerate(range(0, len(whole), stride)):
                        piece = whole[start : start + stride]
                        owner.append(k)
                        part.append(n)
                        sizes.append(len(piece) // 2)
                        ids.append(piece + end * (length - len(piece) // 2))
                columns = [some["doc_id"].take(pa.array(owner, pa.int32())), pa.array(part, pa.int32()), pa.array(sizes, pa.int32()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "n_tokens", "ids"])

    narrow = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return narrow.mapInArrow(cut, f"doc_id {kind.simpleString()}, part int, n_tokens int, ids binary")


def permuted(numbers: np.ndarray, size: int, key: int, rounds: int = 4) -> np.ndarray:
    """Where each number below ``size`` goes."""
    half = max(1, -(-(max(1, size - 1)).bit_length() // 2))
    mask, bits = np.uint64((1 << half) - 1), np.uint64(half)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> bits, out[todo] & mask
        for r in range(rounds):
            salt = np.array([key * rounds + r], np.int64).astype(np.uint64) * SCATTER[0]
            left, right = right, left ^ (scatter(right + salt) & mask)
        out[todo] = left << bits | right
        todo = todo[out[todo] >= np.uint64(size)]
    return out.astype(np.int64)


def in_training_order(found: DataFrame, key: int, per_shard: int = PER_SHARD) -> DataFrame:
    """The sequences with slot, shard and record, range-partitioned and sorted by slot.

    They are numbered and stored first: everything after reads the stored numbers, which no later split changes.
    """
    spark = found.sparkSession
    path = fresh_dir(spark, "sequences")
    found.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    counts = checkpointed(stored.select(F.shiftright("row", 33).alias("split")).groupBy("split").agg(F.count(F.lit(1)).alias("rows")))
    size = int(counts.agg(F.sum("rows")).first()[0] or 0)
    earlier = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task that stored
    offsets = counts.select("split", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    if counts.count() <= BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)  # 16 bytes for each split; a join would shuffle all ids

    @F.pandas_udf("bigint")
    def slot(number: pd.Series) -> pd.Series:
        return pd.Series(permuted(number.to_numpy(), size, key))

    numbered = stored.withColumn("split", F.shiftright("row", 33)).join(offsets, "split")
    local = F.col("row") - F.call_function("shiftleft", F.col("split"), F.lit(33))
    placed = numbered.withColumn("slot", slot(F.col("offset") + local)).drop("row", "split", "offset")
    placed = placed.withColumn("shard", F.floor(F.col("slot") / per_shard)).withColumn("record", F.col("slot") % per_shard)
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return placed.repartitionByRange(partitions, "slot").sortWithinPartitions("slot")


def write_shards(ordered: DataFrame, path: str) -> None:
    """One folder for each shard, ``shard=n``, whose files hold its records in order of their names."""
    rows = ordered.repartition("shard").sortWithinPartitions("shard", "slot")
    rows.select(F.col("ids").cast("string").alias("value"), "shard").write.partitionBy("shard").text(path)


def read_records(spark: SparkSession, path: str, shard: int, length: int, first: int = 0) -> DataFrame:
    """Ids of a shard from a record on: (record, ids)."""
    stride = 2 * length + 1
    files = spark.read.format("binaryFile").load(f"{path}/shard={shard}")
    places = F.sequence(F.lit(first), (F.col("length") / stride).cast("int") - 1)
    return files.select("content", F.explode(places).alias("record")).select(
        "record", F.substring("content", F.col("record") * stride + 1, F.lit(2 * length)).alias("ids"))
