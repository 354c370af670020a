"""Compression of binary columns."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.storage import stream_codec

_CHUNK = 1 << 20


def decompress(payload: Column, codec: str, max_bytes: int = 0) -> Column:
    """Decompressed payload; with ``max_bytes`` only its first bytes are produced."""
    name = stream_codec("decompress", codec)

    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if not v.is_valid else _read(v.as_buffer(), name, max_bytes) for v in values], pa.binary())

    return F.arrow_udf(run, "binary")(payload)


def compress(payload: Column, codec: str, level: int | None = None) -> Column:
    """Compressed payload. A level of None, zero or less is the codec's default."""
    name = stream_codec("compress", codec)

    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if not v.is_valid else pack([v.as_buffer()], name, level) for v in values], pa.binary())

    return F.arrow_udf(run, "binary")(payload)


def _read(data: pa.Buffer, codec: str, max_bytes: int) -> bytes:
    if data.size == 0:
        return b""
    parts, size = [], 0
    with pa.input_stream(data, compression=codec) as stream:
        while not max_bytes or size < max_bytes:
            part = stream.read(min(_CHUNK, max_bytes - size) if max_bytes else _CHUNK)
            if not part:
                break
            parts.append(part)
            size += len(part)
    return b"".join(parts)


def pack(parts, codec: str, level: int | None = None) -> bytes:
    """One compressed stream over the parts."""
    sink = pa.BufferOutputStream()
    if codec == "gzip" and level is not None and level > 0:
        import zlib

        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        for part in parts:
            sink.write(packer.compress(part))
        sink.write(packer.flush())
    else:
        option = pa.Codec(codec, compression_level=level) if level is not None and level > 0 else codec
        with pa.CompressedOutputStream(sink, option if isinstance(option, str) else codec) as stream:
            for part in parts:
                stream.write(part)
    return sink.getvalue().to_pybytes()
