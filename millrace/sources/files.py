"""Whole files, their first bytes, or files in pieces, as binary payloads."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import enum, non_negative, require, section
from millrace.errors import ConfigError, DataError
from millrace.operators.compress import decompress
from millrace.sources.lines import FILE_COLUMNS, stream_reader
from millrace.sources.ranges import BATCH_BYTES, BATCH_ROWS, MOST_TASKS, Opener, task_bound
from millrace.storage import arrow_reads, arrow_store, common_section, use_storage

STEP = "file_source"
_LARGEST = (1 << 31) - 1  # bytes of one binary value
_READ = 4 << 20
COMPRESSION = ("UNSPECIFIED", "NONE", "GZIP", "AUTO")


def file_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section(STEP, config, {"path": "", "compression": "UNSPECIFIED", "max_bytes": 0, "chunk_bytes": 0, "common": {}})
    require(STEP, cfg, "path")
    non_negative(STEP, cfg, "max_bytes", "chunk_bytes")
    cfg["compression"] = enum(STEP, cfg["compression"], "COMPRESSION_", COMPRESSION)
    cfg["common"] = common_section(STEP, cfg["common"])
    if cfg["chunk_bytes"] > _LARGEST:
        raise ConfigError(f"{STEP}: chunk_bytes must be below 2 GiB")
    return cfg


def read_files(
    spark: SparkSession, config: Mapping[str, Any], streaming: bool = False, max_files: int | None = None
) -> DataFrame:
    """Files → rows ``(path, payload)``, one payload per file, or with
    ``chunk_bytes`` rows ``(path, offset, payload)`` of at most so many bytes.

    ``compression`` is none, gzip or auto (gzip for ``.gz`` names);
    ``max_bytes`` keeps the first bytes of the decompressed content, and no more
    is read. Tasks stream the files themselves; a plain file in chunks is read
    by many tasks, each from its own offset, and has no largest size; of small
    files a task reads many. Empty files give no row.
    """
    cfg = file_config(config)
    path = use_storage(spark, cfg["path"], cfg["common"])
    reader = stream_reader(spark, max_files).schema(FILE_COLUMNS) if streaming else spark.read
    files = reader.format("binaryFile").load(path)
    if not arrow_reads(path):
        if cfg["chunk_bytes"]:
            raise ConfigError(f"{STEP}: chunk_bytes needs a store that tasks open themselves")
        return _by_spark(files, cfg)
    packed = {"GZIP": F.lit(True), "AUTO": F.col("path").endswith(".gz")}.get(cfg["compression"], F.lit(False))
    found = files.select("path", F.col("length").alias("size"), packed.alias("packed"))  # no content is read
    limit, chunk, store = cfg["max_bytes"], cfg["chunk_bytes"], arrow_store(cfg["path"], cfg["common"])
    if not chunk:
        return found.mapInArrow(lambda batches: _whole(batches, limit, store), "path string, payload binary")
    end = F.least("size", F.lit(limit)) if limit else F.col("size")
    # Neighbouring chunks of a plain file are read at once; a compressed one is read through.
    split_bytes = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    step = chunk * max(1, split_bytes // chunk)
    if not streaming:
        found = found.coalesce(MOST_TASKS)
    starts = F.when(F.col("packed"), F.array(F.lit(0).cast("bigint"))).when(end > 0, F.sequence(F.lit(0).cast("bigint"), end - 1, F.lit(step).cast("bigint")))
    pieces = found.select("path", "packed", F.explode(starts).alias("start"), end.alias("end"))
    if not streaming:
        count, total = pieces.agg(F.count(F.lit(1)), F.sum(F.least(F.col("end") - F.col("start"), F.lit(step)))).first()
        pieces = pieces.repartition(max(1, min(count, task_bound(total or 0, split_bytes))), "path", "start")
    return pieces.mapInArrow(lambda batches: _chunks(batches, chunk, step, limit, store), "path string, offset bigint, payload binary")


def _whole(batches: Iterator[pa.RecordBatch], limit: int, store) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            parts, size = [], 0
            with Opener("GZIP" if row["packed"] else "UNCOMPRESSED", store).open(row["path"]) as file:
                while (not limit or size < limit) and (part := file.read(min(_READ, limit - size) if limit else _READ)):
                    parts.append(part)
                    size += len(part)
                    if size > _LARGEST:
                        raise DataError(f"{row['path']} is too large for one payload; set chunk_bytes or max_bytes")
            yield pa.RecordBatch.from_arrays([pa.array([row["path"]]), pa.array([b"".join(parts)], pa.binary())], ["path", "payload"])


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int, step: int, limit: int, store) -> Iterator[pa.RecordBatch]:
    paths, offsets, parts, size = [], [], [], 0
    for batch in batches:
        for row in batch.to_pylist():
            with Opener("GZIP" if row["packed"] else "UNCOMPRESSED", store).open(row["path"]) as file:
                offset = row["start"]
                end = (limit or None) if row["packed"] else min(row["start"] + step, row["end"])
                if offset:
                    file.seek(offset)
                while (end is None or offset < end) and (part := _full(file, chunk if end is None else min(chunk, end - offset))):
                    if parts and (size + len(part) > BATCH_BYTES or len(parts) == BATCH_ROWS):
                        yield _chunk_batch(paths, offsets, parts)
                        paths, offsets, parts, size = [], [], [], 0
                    paths.append(row["path"])
                    offsets.append(offset)
                    parts.append(part)
                    offset, size = offset + len(part), size + len(part)
    if parts:
        yield _chunk_batch(paths, offsets, parts)


def _chunk_batch(paths: list[str], offsets: list[int], parts: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array(paths), pa.array(offsets, pa.int64()), pa.array(parts, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["path", "offset", "payload"])


def _full(file, size: int) -> bytes:
    """The next ``size`` bytes, fewer only where the file ends."""
    part = file.read(size)
    while part and len(part) < size and (more := file.read(size - len(part))):
        part += more
    return part


def _by_spark(files: DataFrame, cfg: Mapping[str, Any]) -> DataFrame:
    """For stores that only Spark opens: whole files, of at most 2 GiB."""
    limit = min(cfg["max_bytes"], _LARGEST)
    content = F.col("content")
    if cfg["compression"] in ("GZIP", "AUTO"):
        plain = F.lit(False) if cfg["compression"] == "GZIP" else ~F.col("path").endswith(".gz")
        unpacked = decompress(F.when(~plain, content), "GZIP", limit)
        payload = F.when(plain, content).otherwise(unpacked)
    else:
        payload = content
    if limit:
        payload = F.substring(payload, 1, limit)
    return files.select("path", payload.alias("payload"))
