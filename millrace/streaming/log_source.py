"""Persistent message logs as replayable sources, for batch and streaming reads."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from millrace.config import non_negative, require, section
from millrace.errors import ConfigError
from millrace.operators.payload import field_extract
from millrace.session import prepare
from millrace.sinks.messages import NATS_URL, redis_settings
from millrace.streaming.publish import load_client

FORMAT = "millrace_log"
SCHEMA = "id string, position decimal(38,0), fields array<struct<field: string, value: binary>>"
_ARROW = pa.schema(
    [
        ("id", pa.string()),
        ("position", pa.decimal128(38, 0)),
        ("fields", pa.list_(pa.struct([("field", pa.string()), ("value", pa.binary())]))),
    ]
)
_BATCH = 1_000


def read_log(
    spark: SparkSession,
    client: str,
    settings: Mapping[str, Any],
    streaming: bool = True,
    start: str = "0",
    partitions: int = 8,
    max_positions: int = 0,
) -> DataFrame:
    """Entries ``(id, position, fields)`` of a log.

    ``client`` names a factory ``module:function``; its result has ``tail()``,
    ``read(start, end)``, ``ack(end)`` and ``close()``. Offsets are positions in
    the log and live in the query's checkpoint: after a failure the same range
    is read again. ``start`` is a position or ``$`` for the end of the log, which
    is looked up once. A micro-batch takes what the log holds when it is planned,
    so that a run over what is available leaves nothing; it is cut into at least
    ``partitions`` tasks, between the first entry that is there and the end, and
    with ``max_positions`` into tasks of at most so many positions.
    """
    prepare(spark).dataSource.register(MessageLog)
    reader = spark.readStream if streaming else spark.read
    return (
        reader.format(FORMAT)
        .option("client", client)
        .option("settings", json.dumps(dict(settings)))
        .option("start", start)
        .option("partitions", str(partitions))
        .option("maxpositions", str(max_positions))
        .load()
    )


def jetstream_config(config: Mapping[str, Any]) -> dict[str, Any]:
    step = "nats_jetstream_source"
    cfg = section(step, config, {"url": "", "subject": "", "stream_name": "", "durable_name": "", "poll_timeout_ms": 0})
    require(step, cfg, "subject")
    non_negative(step, cfg, "poll_timeout_ms")
    return cfg


def redis_stream_source_config(config: Mapping[str, Any]) -> dict[str, Any]:
    step = "redis_stream_source"
    cfg = section(
        step,
        config,
        {"host": "", "port": 0, "stream": "", "username": "", "password": "", "database": 0, "start_id": "$",
         "block_timeout_ms": 0, "count": 0, "field_name": ""},
    )
    require(step, cfg, "stream")
    non_negative(step, cfg, "block_timeout_ms", "count")
    if not re.fullmatch(r"\$|\d+(-\d+)?", cfg["start_id"]):
        raise ConfigError(f"{step}: start_id is $, milliseconds, or milliseconds-number, got {cfg['start_id']}")
    return cfg | {"settings": redis_settings(step, cfg)}


def read_jetstream(spark: SparkSession, config: Mapping[str, Any], streaming: bool = True, client: str | None = None) -> DataFrame:
    """Messages of a JetStream subject as ``(id, payload)``."""
    cfg = jetstream_config(config)
    settings = {**cfg, "url": cfg["url"] or NATS_URL}
    log = read_log(spark, client or "millrace.streaming.clients:JetStreamLog", settings, streaming)
    return log.select("id", field_extract("fields").alias("payload")).where("payload IS NOT NULL")


def read_redis_stream(spark: SparkSession, config: Mapping[str, Any], streaming: bool = True, client: str | None = None) -> DataFrame:
    """Entries of a Redis stream as ``(id, payload)``: the named field, or the first.

    Entries without the field are skipped; every fetched entry is used.
    """
    cfg = redis_stream_source_config(config)
    settings = cfg["settings"] | {"stream": cfg["stream"], "count": cfg["count"], "block_ms": cfg["block_timeout_ms"]}
    start = cfg["start_id"]
    if start != "$" and "-" in start:
        ms, _, number = start.partition("-")
        start = str((int(ms) << 64) + int(number))
    elif start != "$":
        start = str(int(start) << 64)
    log = read_log(spark, client or "millrace.streaming.clients:RedisStreamLog", settings, streaming, start)
    return log.select("id", field_extract("fields", cfg["field_name"]).alias("payload")).where("payload IS NOT NULL")


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogReader:
        return LogReader(dict(self.options))

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(dict(self.options))


class LogRange(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


class _Log:
    def __init__(self, options: dict[str, str]):
        options = {name.lower(): value for name, value in options.items()}
        self.client = options["client"]
        self.settings = json.loads(options["settings"])
        self.start = options.get("start", "0")
        self.parts = max(int(options.get("partitions", "8")), 1)
        self.max_positions = int(options.get("maxpositions", "0"))

    def connect(self):
        return load_client(self.client, self.settings)

    def tail(self) -> int:
        client = self.connect()
        try:
            return client.tail()
        finally:
            client.close()

    def first(self) -> int:
        return self.tail() if self.start == "$" else int(self.start)

    def ranges(self, start: int, end: int) -> list[LogRange]:
        """The positions after ``start`` up to ``end``, in about equal ranges."""
        if end <= start:
            return []
        if end - start > self.parts:
            start = max(start, self._before_first(start))
        parts = min(max(self.parts, -(-(end - start) // self.max_positions) if self.max_positions else 0), end - start)
        edges = [start + (end - start) * i // parts for i in range(parts + 1)]
        return [LogRange(low, high) for low, high in zip(edges, edges[1:])]

    def _before_first(self, start: int) -> int:
        """The position before the first entry after ``start``, where the client can tell: real ids start far from zero."""
        client = self.connect()
        try:
            first = client.first(start) if hasattr(client, "first") else None
        finally:
            client.close()
        return start if first is None else first - 1

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        client = self.connect()
        try:
            rows = []
            for entry, fields in client.read(partition.start, partition.end):
                ms, _, number = entry.partition("-")
                position = (int(ms) << 64) + int(number) if number else int(ms)
                rows.append(
                    {"id": entry, "position": position, "fields": [{"field": name, "value": value} for name, value in fields]}
                )
                if len(rows) >= _BATCH:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)
        finally:
            client.close()


class LogReader(_Log, DataSourceReader):
    def partitions(self):
        return self.ranges(self.first(), self.tail()) or [LogRange(0, 0)]


class LogStreamReader(_Log, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"position": str(self.first())}

    def latestOffset(self) -> dict:
        return {"position": str(self.tail())}

    def partitions(self, start: dict, end: dict):
        return self.ranges(int(start["position"]), int(end["position"]))

    def commit(self, end: dict) -> None:
        client = self.connect()
        try:
            client.ack(int(end["position"]))
        finally:
            client.close()
