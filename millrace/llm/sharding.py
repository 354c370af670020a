"""Sharding by weighted rendezvous hashing.

A record goes to the shard where its score -ln(u) / weight is least, u being a uniform number made of the record's key
and the shard's number. Scores of different shards are independent, so another shard takes records only into itself, a
lost shard spreads only its own, and the shares follow the weights. The law is `key`: the key and the list of weights
decide alone, not the order or the number of records.

Slots number the records of a shard from 0 without gaps. Records are written once to the shared folder, in partitions
that stay as they are; the records of a shard are counted by partition, and a record's slot is the number of records in
earlier partitions plus its place in its own. No shard, key or group is ever in one task.

Defined results: a null key hashes as one value, so all of them share a shard; equal rows share a shard and get slots
of their own; a null text has no bytes and the checksum 0. Only the columns named are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.errors import ConfigError
from millrace.llm.common import unused
from millrace.workdir import checkpointed


def _uniform(key: list[Column], shard: int) -> Column:
    """A number above 0 and below 1 from 52 bits of a hash."""
    bits = F.shiftrightunsigned(F.xxhash64(*key, F.lit(shard)), 12)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def shard_of(key: list[Column], weights: list[float]) -> Column:
    """The shard of least score; the first of equals. A shard of weight 0 gets nothing."""
    if not weights or any(w < 0 or not math.isfinite(w) for w in weights) or not any(weights):
        raise ConfigError("weights must be finite and not negative, and one of them positive")
    scores = [F.struct((-F.ln(_uniform(key, k)) / F.lit(float(w))).alias("score"), F.lit(k).alias("shard")) for k, w in enumerate(weights) if w]
    return (scores[0] if len(scores) == 1 else F.least(*scores))["shard"]


def with_slots(records: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """The records with their slots. They are written to the shared folder first, since slots rest on their partitions."""
    row, part, place, offset = (unused(records, name) for name in ("_row", "_part", "_place", "_offset"))
    inputs = [F.col(f"`{name}`") for name in records.columns if name != slot]
    kept = checkpointed(records.withColumn(row, F.monotonically_increasing_id())).withColumn(part, F.shiftright(row, 33))
    counts = kept.groupBy(shard, part).agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, part, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(offset))
    inside = Window.partitionBy(shard, part).orderBy(row)
    placed = kept.withColumn(place, F.row_number().over(inside) - 1).join(offsets, [shard, part])
    return placed.select(*inputs, (F.col(offset) + F.col(place)).cast("bigint").alias(slot))


def sharded(docs: DataFrame, weights: list[float], text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (with one more shard of mean weight)."""
    key = [F.col(f"`{id_column}`")]
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    mean = sum(weights) / len(weights) if weights else 0.0
    placed = docs.select(
        key[0].alias("doc_id"), (F.octet_length(raw) + 8).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"),
        shard_of(key, weights).alias("shard"), shard_of(key, [*weights, mean]).alias("grown_shard"),
    )
    return with_slots(placed).withColumn("law", F.lit("key"))


def write_shards(docs: DataFrame, path: str, weights: list[float], id_column: str = "doc_id", shard: str = "shard") -> None:
    """The documents as Parquet, one folder per shard; large shards become several files (adaptive execution splits them)."""
    if shard in docs.columns:
        raise ConfigError(f"the documents already have a column {shard!r}; name another")
    rows = docs.withColumn(shard, shard_of([F.col(f"`{id_column}`")], weights))
    rows.hint("rebalance", shard).write.partitionBy(shard).parquet(path)
