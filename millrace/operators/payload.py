"""Operators on binary payloads and on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.errors import ConfigError

# Default and largest sizes of a stream chunk and of a datagram.
CHUNK_BYTES = 65_536
MAX_CHUNK_BYTES = 1_048_576
DATAGRAM_BYTES = 65_507

ENCODED = "partition int, batch_no bigint, num_rows bigint, payload binary"


def drop_empty(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows whose payload has at least one byte."""
    return df.where(F.octet_length(payload) > 0)


def byte_cap(payload: str | Column = "payload", max_bytes: int = DATAGRAM_BYTES) -> Column:
    """The first ``max_bytes`` bytes of a payload, by default as many as a datagram holds."""
    if max_bytes <= 0:
        raise ConfigError("max_bytes must be positive")
    return F.substring(payload, 1, max_bytes)


def byte_chunks(df: DataFrame, keys: list[str], payload: str = "payload", size: int = CHUNK_BYTES) -> DataFrame:
    """Payload → rows ``(*keys, chunk_no, chunk)`` of at most ``size`` bytes.

    The chunks are cut before the rows are multiplied, so a long payload is not
    copied once per chunk.
    """
    if not 0 < size <= MAX_CHUNK_BYTES:
        raise ConfigError(f"the size of chunks must be from 1 to {MAX_CHUNK_BYTES}")
    column = F.col(payload)
    count = F.ceil(F.octet_length(column) / size).cast("int")
    numbers = F.sequence(F.lit(0), count - 1)
    pieces = F.transform(numbers, lambda n: F.substring(column, n * size + 1, F.lit(size)))
    return df.where(F.octet_length(column) > 0).select(*keys, F.posexplode(pieces).alias("chunk_no", "chunk"))


def field_extract(fields: str | Column, name: str | None = None) -> Column:
    """Value of the first field called ``name`` (or of the first field) in an
    ``array<struct<field, value>>``; null when there is none."""
    column = F.col(fields) if isinstance(fields, str) else fields
    if name:
        column = F.filter(column, lambda entry: entry["field"] == name)
    return F.try_element_at(column, F.lit(1))["value"]


def extract_payloads(df: DataFrame, keys: list[str], fields: str = "fields", name: str | None = None) -> DataFrame:
    """Log entries → payloads; entries without the field yield no row."""
    payload = field_extract(fields, name)
    return df.select(*keys, payload.alias("payload")).where("payload IS NOT NULL")


# ------------------------------------------------------------- Arrow batches
def arrow_encode(df: DataFrame, batch_size: int | None = None) -> DataFrame:
    """Table → Arrow IPC payloads.

    With ``batch_size`` each payload is one stream with exactly that many rows
    (the last one of a partition may have fewer). Without it, each payload is
    one of the batches Spark hands to Python, whose rows and bytes the
    ``spark.sql.execution.arrow.max*PerBatch`` settings bound.
    """
    if batch_size is not None and batch_size <= 0:
        raise ConfigError("batch_size must be positive")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        pieces = (b for b in batches if b.num_rows) if batch_size is None else rebatch(batches, batch_size)
        for number, batch in enumerate(pieces):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as stream:
                stream.write(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int64()),
                    pa.array([batch.num_rows], pa.int64()),
                    pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                ],
                ["partition", "batch_no", "num_rows", "payload"],
            )

    return df.mapInArrow(encode, ENCODED)


def rebatch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of exactly ``size`` rows, and the rest."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        start = 0
        while rows + batch.num_rows - start >= size:
            held.append(batch.slice(start, size - rows))
            start += size - rows
            yield _joined(held)
            held, rows = [], 0
        if start < batch.num_rows:
            held.append(batch.slice(start))
            rows += batch.num_rows - start
    if rows:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def arrow_decode(df: DataFrame, schema: T.StructType | str, payload: str = "payload") -> DataFrame:
    """Arrow IPC payloads → rows of the declared schema."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(struct)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                if not value.is_valid or not len(value.as_buffer()):
                    continue
                for part in pa.ipc.open_stream(value.as_buffer()):
                    columns = [part.column(f.name).cast(f.type) for f in target]
                    yield pa.RecordBatch.from_arrays(columns, schema=target)

    return df.select(payload).mapInArrow(decode, struct)


def payload_schema(df: DataFrame, payload: str = "payload") -> T.StructType:
    """Spark schema of the first Arrow payload (driver reads one schema only)."""
    from pyspark.sql.pandas.types import from_arrow_schema

    def schema_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                if value.is_valid and len(value.as_buffer()):
                    schema = pa.ipc.open_stream(value.as_buffer()).schema
                    yield pa.RecordBatch.from_arrays([pa.array([schema.serialize().to_pybytes()])], ["payload"])
                    return

    row = df.select(payload).mapInArrow(schema_only, "payload binary").first()
    if row is None:
        raise ConfigError("no Arrow payload to take a schema from")
    schema = pa.ipc.read_schema(pa.BufferReader(row.payload))
    return from_arrow_schema(schema, prefer_timestamp_ntz=True)
