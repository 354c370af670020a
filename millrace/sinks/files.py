"""Binary payloads → files."""

from __future__ import annotations

import json
import time
import uuid
import zlib
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from millrace.config import enum, non_negative, require, section
from millrace.errors import ConfigError
from millrace.operators.payload import drop_empty
from millrace.session import prepare
from millrace.storage import arrow_filesystem, arrow_store, common_section, qualified, use_storage

STEP = "file_sink"
COMPRESSION = ("UNSPECIFIED", "NONE", "GZIP")
LAYOUTS = ("PARTS", "SINGLE")
FORMAT = "millrace_files"
MANIFEST = "moves"
SMALL_MANIFEST = 256 << 10  # bytes of a manifest that one task works off
_RENAMES = 32  # files a task moves at a time


def files_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section(
        STEP,
        config,
        {"path": "", "append": False, "compression": "UNSPECIFIED", "compression_level": 0, "layout": "PARTS",
         "order_by": "", "path_column": "", "common": {}},
    )
    require(STEP, cfg, "path")
    non_negative(STEP, cfg, "compression_level")
    cfg["common"] = common_section(STEP, cfg["common"])
    cfg["compression"] = enum(STEP, cfg["compression"], "COMPRESSION_", COMPRESSION)
    cfg["layout"] = enum(STEP, cfg["layout"], "LAYOUT_", LAYOUTS)
    if cfg["compression_level"] > 9:
        raise ConfigError(f"{STEP}: gzip levels go up to 9")
    return cfg


def write_files(
    df: DataFrame, config: Mapping[str, Any], order_by: str | None = None, path_column: str | None = None
) -> None:
    """Write the ``payload`` column to ``path``, or below it to ``path_column``.

    Empty payloads are dropped. Without ``append`` every payload replaces the
    file, so the last one by ``order_by`` is written. With ``append`` the
    payloads follow each other by ``order_by``: layout "parts" makes a directory
    of part files whose names sort in that order, and a hot path is written by
    many tasks; layout "single" makes one file, written by one streaming task.
    """
    cfg = files_config(config)
    order_by, path_column = order_by or cfg["order_by"] or None, path_column or cfg["path_column"] or None
    spark = df.sparkSession
    base = use_storage(spark, cfg["path"], cfg["common"])
    path = F.col(path_column).cast("string") if path_column else F.lit("")
    path = F.coalesce(path, F.raise_error(F.lit(f"{STEP}: a payload has no path")).cast("string"))
    order = F.col(order_by) if order_by else F.lit(0)
    rows = drop_empty(df).select(path.alias("path"), order.alias("ord"), "payload")
    if not cfg["append"]:
        if order_by is not None:
            rows = last_payloads(rows)
        elif not rows.groupBy("path").count().where("count > 1").isEmpty():
            raise ConfigError(f"{STEP}: several payloads replace one file; say which is last with order_by")
        layout = "SINGLE"
    elif cfg["layout"] == "SINGLE":
        rows = rows.repartition("path").sortWithinPartitions("path", "ord")
        layout = "SINGLE"
    else:
        # By range, a path that holds much of the data is cut at its order values;
        # without an order, adaptive execution cuts it anywhere.
        if order_by is not None:
            rows = rows.repartitionByRange("path", "ord").sortWithinPartitions("path", "ord")
        elif path_column is not None:
            rows = rows.hint("rebalance", "path").sortWithinPartitions("path")
        layout = "PARTS"
    codec = "gzip" if cfg["compression"] == "GZIP" else "none"
    store = arrow_store(cfg["path"], cfg["common"])
    save_payloads(rows.select("path", "payload"), base, layout, codec, cfg["compression_level"], cfg["append"], store=store)


def last_payloads(rows: DataFrame) -> DataFrame:
    """The payload with the largest order value of every path; null orders come before all others.

    Only path and order are aggregated; payloads are not moved to find the last one.
    """
    last = rows.groupBy("path").agg(F.max("ord").alias("last")).withColumnRenamed("path", "of")
    match = F.col("path").eqNullSafe(F.col("of")) & F.col("ord").eqNullSafe(F.col("last"))
    return rows.join(last, match, "left_semi").dropDuplicates(["path"])


def save_payloads(
    rows: DataFrame, base: str, layout: str, codec: str, level: int = 0, append: bool = False, suffix: str = "", store: dict | None = None
) -> None:
    """Write rows ``(path, payload)`` in the order each task sees them.

    Tasks write below a staging folder, and the driver stores which files were committed, in a manifest that names each
    file's last place. Tasks then move the files. A job that dies before the manifest is there leaves nothing to see;
    moves can be repeated, so that one that dies later is finished by :func:`finish_moves`.
    """
    spark = prepare(rows.sparkSession)
    spark.dataSource.register(PayloadFiles)
    base = qualified(spark, base)
    parent, _, name = base.rstrip("/").rpartition("/")
    staging = f"{parent}/.{name}-staging-{uuid.uuid4().hex}"
    rows.write.format(FORMAT).mode("append").options(
        base=base, staging=staging, layout=layout, codec=codec, level=str(level), append=str(append).lower(), suffix=suffix, store=json.dumps(store)
    ).save()
    finish_moves(spark, staging, store)


def finish_moves(spark: SparkSession, staging: str, store: dict | None = None) -> None:
    """Move what a committed write left below its staging folder, by many tasks, and clear the folder."""
    filesystem, folder = arrow_filesystem(staging, store)
    manifest = filesystem.get_file_info(f"{folder}/{MANIFEST}")
    if manifest.type.name == "File" and manifest.size <= SMALL_MANIFEST:
        with filesystem.open_input_stream(manifest.path) as lines:
            _move([(move["staged"], move["target"]) for move in map(json.loads, lines.read().splitlines())], store)
    elif manifest.type.name == "File":
        moves = spark.read.schema("staged string, target string").json(f"{staging}/{MANIFEST}")
        moves = moves.repartition(-(-manifest.size // SMALL_MANIFEST))
        moves.mapInArrow(lambda batches: _moved(batches, store), "moved bigint").write.format("noop").mode("overwrite").save()
    _clear(filesystem, folder)


def _moved(batches: Iterator[pa.RecordBatch], store) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        moves = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        _move(moves, store)
        yield pa.RecordBatch.from_arrays([pa.array([len(moves)], pa.int64())], ["moved"])


def _move(moves, store) -> None:
    """Moves that are made already are left out."""
    if not moves:
        return
    filesystem = arrow_filesystem(moves[0][0], store)[0]
    pairs = [(arrow_filesystem(staged, store)[1], arrow_filesystem(target, store)[1]) for staged, target in moves]
    for parent in {target.rpartition("/")[0] for _, target in pairs}:
        filesystem.create_dir(parent, recursive=True)

    def move(pair: tuple[str, str]) -> None:
        try:
            filesystem.move(*pair)
        except OSError:
            if filesystem.get_file_info(pair[0]).type.name != "NotFound" or filesystem.get_file_info(pair[1]).type.name == "NotFound":
                raise

    with ThreadPoolExecutor(_RENAMES) as pool:
        list(pool.map(move, pairs))


def _clear(filesystem, folder: str) -> None:
    if filesystem.get_file_info(folder).type.name == "Directory":
        filesystem.delete_dir(folder)


class PayloadFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> PayloadFilesWriter:
        return PayloadFilesWriter(dict(self.options))


@dataclass
class StagedFiles(WriterCommitMessage):
    moves: list[tuple[str, str]]


class PayloadFilesWriter(DataSourceArrowWriter):
    """Tasks write below a staging folder; a lost or repeated task leaves files there only."""

    def __init__(self, options: dict[str, str]):
        options = {name.lower(): value for name, value in options.items()}
        self.base = options["base"].rstrip("/")
        self.layout = options["layout"]
        self.codec = options["codec"]
        self.level = int(options["level"])
        self.append = options["append"] == "true"
        self.suffix = options["suffix"]
        self.store = json.loads(options["store"])
        self.job = f"{time.time_ns():020d}"
        self.staging = options["staging"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> StagedFiles:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        filesystem, staging = arrow_filesystem(self.staging, self.store)
        filesystem.create_dir(staging, recursive=True)
        moves, current, out = [], None, None
        try:
            for batch in iterator:
                paths = batch.column(0).to_pylist()
                for path, value in zip(paths, batch.column(1)):
                    if path != current:
                        if out is not None:
                            out.close()
                        current = path
                        target = self._target(path, part)
                        name = f"{part:010d}-{attempt}-{len(moves):010d}"
                        moves.append((f"{self.staging}/{name}", target))
                        out = _FileOut(filesystem, f"{staging}/{name}", self.codec, self.level)
                        if self.append and self.layout == "SINGLE":
                            out.copy(arrow_filesystem(target, self.store))
                    out.write(value.as_buffer())
        finally:
            if out is not None:
                out.close()
        return StagedFiles(moves)

    def _target(self, path: str, part: int) -> str:
        target = f"{self.base}/{path}" if path else self.base
        if self.layout == "PARTS":
            target = f"{target}/part-{self.job}-{part:010d}{self.suffix}"
        return target

    def commit(self, messages) -> None:
        """Which files count, in one file that is there as a whole or not at all."""
        filesystem, staging = arrow_filesystem(self.staging, self.store)
        filesystem.create_dir(staging, recursive=True)
        with filesystem.open_output_stream(f"{staging}/{MANIFEST}.new", compression=None) as out:
            for message in messages:
                for staged, target in message.moves if message else ():
                    out.write(json.dumps({"staged": staged, "target": target}).encode() + b"\n")
        filesystem.move(f"{staging}/{MANIFEST}.new", f"{staging}/{MANIFEST}")

    def abort(self, messages) -> None:
        _clear(*arrow_filesystem(self.staging, self.store))


class _FileOut:
    """One output file: plain, gzip with a level, or another stream codec."""

    def __init__(self, filesystem, path: str, codec: str, level: int):
        self._raw = filesystem.open_output_stream(path, compression=None)
        self._gzip = zlib.compressobj(level if level > 0 else -1, zlib.DEFLATED, 31) if codec == "gzip" else None
        self._out = self._raw
        if codec not in ("none", "gzip"):
            self._out = pa.CompressedOutputStream(self._raw, codec)

    def copy(self, existing) -> None:
        """Start with the bytes of an existing file (appending to a compressed
        file adds another compressed member)."""
        from pyarrow import fs

        filesystem, name = existing
        if filesystem.get_file_info(name).type == fs.FileType.File:
            with filesystem.open_input_stream(name, compression=None) as source:
                while part := source.read(4 << 20):
                    self._raw.write(part)

    def write(self, data) -> None:
        self._out.write(self._gzip.compress(data) if self._gzip else data)

    def close(self) -> None:
        if self._raw.closed:
            return
        if self._gzip:
            self._raw.write(self._gzip.flush())
        if self._out is not self._raw:
            self._out.close()
        self._raw.close()
