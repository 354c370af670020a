"""Lines of text files, with and without Spark's own decompression."""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from millrace.errors import ConfigError, DataError
from millrace.storage import NATIVE_READ_SUFFIX, STREAM_CODECS, arrow_filesystem, arrow_reads, resolve_codec, stream_codec

#: What Spark's reader of whole files gives; a stream has to be told.
FILE_COLUMNS = "path string, modificationTime timestamp, length bigint, content binary"
_CHUNK = 4 << 20
_BATCH_BYTES = 8 << 20
_SPACE = re.compile(r"\s*")


def native_codec(spark: SparkSession, step: str, path: str, codec: str) -> bool:
    """Whether Spark's text readers decode the files by themselves.

    They go by the file name only: a gzip file named ``.csv`` would come back
    empty without any error, so the names are checked against the codec.
    """
    if codec not in ("AUTO", "UNCOMPRESSED"):
        stream_codec(step, codec)
    names = spark.read.format("binaryFile").load(path).inputFiles()
    wanted = {codec} if codec != "AUTO" else {"UNCOMPRESSED", *NATIVE_READ_SUFFIX}
    if codec != "AUTO" and codec != "UNCOMPRESSED" and codec not in NATIVE_READ_SUFFIX:
        return False
    return all(resolve_codec(name, "AUTO") in wanted for name in names)


def stream_reader(spark: SparkSession, max_files: int | None) -> DataStreamReader:
    """A file stream with at most ``max_files`` files per micro-batch."""
    reader = spark.readStream
    return reader if max_files is None else reader.option("maxFilesPerTrigger", str(max_files))


def text_lines(
    spark: SparkSession, path: str, line_sep: str | None = None, streaming: bool = False, max_files: int | None = None
) -> DataFrame:
    """One row per line (column ``value``); large plain files are split."""
    reader = stream_reader(spark, max_files) if streaming else spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return reader.text(path)


def without_leading(lines: DataFrame, skip: int, header: bool, after: int, ignore_empty: bool) -> DataFrame:
    """Drop the leading lines of every file of a text scan.

    Per file: ``skip`` lines, then the header line, then ``after`` lines. They
    all start in the file's first split, so later splits pass unchanged and the
    scan stays parallel; rows reach the task in file order.
    """
    tagged = lines.select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        (F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length") >= F.col("_metadata.file_size")).alias("to_end"),
    )

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, dropper, to_end = None, None, True
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = np.stack([batch.column(1).to_numpy(), batch.column(2).to_numpy()])
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for low, high in zip(edges, edges[1:]):
                key = (int(keys[0, low]), int(keys[1, low]))
                if key != current:
                    _require_done(dropper, to_end)
                    current, to_end = key, batch.column(3)[low].as_py()
                    dropper = LeadingLines(skip, header, after, ignore_empty) if key[1] == 0 else None
                run = batch.column(0).slice(low, high - low)
                if dropper is not None:
                    run = run.slice(dropper.count(run))
                if len(run):
                    yield pa.RecordBatch.from_arrays([run], ["value"])
        _require_done(dropper, to_end)

    return tagged.mapInArrow(drop, "value string")


def _require_done(dropper: LeadingLines | None, to_end: bool) -> None:
    if dropper is not None and not dropper.done and not to_end:
        raise DataError("the lines to skip do not fit the first split; raise spark.sql.files.maxPartitionBytes")


class LeadingLines:
    """Counts how many of a file's next lines belong to its preamble."""

    def __init__(self, skip: int, header: bool, after: int, ignore_empty: bool):
        self.skip, self.header, self.after, self.ignore_empty = skip, header, after, ignore_empty

    @property
    def done(self) -> bool:
        return not (self.skip or self.header or self.after)

    def count(self, lines: pa.Array) -> int:
        position = 0
        while position < len(lines) and not self.done:
            if self.skip:
                step = min(self.skip, len(lines) - position)
                self.skip -= step
            elif self.header:
                step = 1
                if not self.ignore_empty or lines[position].as_py():
                    self.header = False
            else:
                step = min(self.after, len(lines) - position)
                self.after -= step
            position += step
        return position


def decoded_lines(
    spark: SparkSession,
    path: str,
    codec: str,
    quote: str | None = None,
    escape: str | None = None,
    skip: int = 0,
    header: bool = False,
    after: int = 0,
    ignore_empty: bool = True,
    streaming: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """Lines of files whose codec the file name does not tell.

    Such files cannot be split by any reader, so one task streams one file,
    a few megabytes at a time. With ``quote``, line ends inside quotes belong
    to the record. In stores that only Spark opens, one file may have at most
    2 GiB compressed.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunks in _contents(batches, codec):
            dropper = LeadingLines(skip, header, after, ignore_empty)
            for lines in _batched(split_records(chunks, quote, escape)):
                values = pa.array(lines, pa.binary())
                text = pa.Array.from_buffers(pa.string(), len(values), values.buffers())
                text = text.slice(dropper.count(text))
                if len(text):
                    yield pa.RecordBatch.from_arrays([text], ["value"])

    return _contents_of(spark, path, streaming, max_files).mapInArrow(decode, "value string")


def decoded_objects(spark: SparkSession, path: str, codec: str) -> DataFrame:
    """JSON objects, one after the other, in files like those of :func:`decoded_lines`."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunks in _contents(batches, codec):
            for objects in _batched(split_object_stream(chunks)):
                yield pa.RecordBatch.from_arrays([pa.array(objects, pa.string())], ["value"])

    return _contents_of(spark, path).mapInArrow(decode, "value string")


def _contents_of(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    reader = stream_reader(spark, max_files).schema(FILE_COLUMNS) if streaming else spark.read
    files = reader.format("binaryFile").load(path)
    return files.select("path") if arrow_reads(path) else files.select("path", "content")


def _contents(batches: Iterator[pa.RecordBatch], codec: str) -> Iterator[Iterator[bytes]]:
    """Decoded chunks of each file; codec AUTO goes by each file's name."""
    for batch in batches:
        for k, path in enumerate(batch.column(0).to_pylist()):
            decoder = STREAM_CODECS.get(resolve_codec(path, codec))
            if batch.num_columns > 1:
                yield _chunks(pa.input_stream(batch.column(1)[k].as_buffer(), compression=decoder))
            else:
                filesystem, name = arrow_filesystem(path)
                yield _chunks(filesystem.open_input_stream(name, compression=decoder))


def split_object_stream(chunks: Iterable[bytes]) -> Iterator[str]:
    """Top-level JSON objects of a byte stream."""
    decoder, utf8 = json.JSONDecoder(), codecs.getincrementaldecoder("utf-8")()
    rest = ""
    for chunk in chunks:
        rest += utf8.decode(chunk)
        position = 0
        while True:
            start = _SPACE.match(rest, position).end()
            try:
                _, position = decoder.raw_decode(rest, start)
            except json.JSONDecodeError:
                break  # the object goes on in the next chunk
            yield rest[start:position]
        rest = rest[position:]
    if rest.strip():
        raise DataError(f"not a JSON object: {rest.strip()[:100]}")


def _chunks(content) -> Iterator[bytes]:
    with content as stream:
        while chunk := stream.read(_CHUNK):
            yield chunk


def split_records(chunks: Iterable[bytes], quote: str | None, escape: str | None) -> Iterator[bytes]:
    """Records of a byte stream: lines, or quote-aware lines when ``quote`` is set."""
    rest = b""
    for chunk in chunks:
        rest += chunk
        cut = rest.rfind(b"\n") + 1
        if quote is None:
            for line in rest[:cut].split(b"\n")[:-1]:
                yield line.removesuffix(b"\r")
            rest = rest[cut:]
        else:
            start = 0
            for end in _record_ends(rest, quote, escape):
                yield rest[start:end].removesuffix(b"\r")
                start = end + 1
            rest = rest[start:]
    if rest:
        yield rest.removesuffix(b"\n").removesuffix(b"\r")


def _record_ends(data: bytes, quote: str, escape: str | None) -> list[int]:
    """Positions of the line ends that have an even number of quotes before them."""
    if escape:
        data = re.sub(re.escape(escape.encode()) + b"(?s:.)", b"\x00\x00", data)
    flat = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(flat == ord(quote))
    ends = np.flatnonzero(flat == 10)
    return ends[np.searchsorted(quotes, ends) % 2 == 0].tolist()


def _batched(records: Iterable[bytes]) -> Iterator[list[bytes]]:
    batch, size = [], 0
    for record in records:
        batch.append(record)
        size += len(record)
        if size >= _BATCH_BYTES or len(batch) >= 10_000:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def first_line(lines: DataFrame, ignore_empty: bool) -> str:
    """The first line of the data (the header, if any), however many empty ones come before it."""
    row = (lines.where(F.length("value") > 0) if ignore_empty else lines).first()
    if row is None:
        raise ConfigError("no header line found")
    return row.value
