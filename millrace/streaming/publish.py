"""Sending message frames from tasks, in batch and in streams."""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from millrace.errors import DataError
from millrace.session import prepare

FORMAT = "millrace_publish"


def load_client(name: str, settings: Mapping[str, Any]):
    """Make the client that ``module:factory`` names."""
    module, _, factory = name.partition(":")
    return getattr(importlib.import_module(module), factory)(dict(settings))


def publish(frame: DataFrame, client: str, settings: Mapping[str, Any], checkpoint: str | None = None, trigger=None):
    """Send every row of a frame; a row that is not accepted fails the batch.

    ``client`` names a factory ``module:function`` that is called in each task
    with ``settings``; what it returns has ``send(row)``, ``flush()`` and
    ``close()``. Spark repeats failed tasks, so a message may be sent twice: put
    a key column in the frame where the receiver must tell repeats.
    """
    prepare(frame.sparkSession).dataSource.register(MessageSink)
    options = {"client": client, "settings": json.dumps(dict(settings))}
    if not frame.isStreaming:
        frame.write.format(FORMAT).mode("append").options(**options).save()
        return None
    if not checkpoint:
        raise DataError("a streaming publish needs a checkpoint folder")
    writer = frame.writeStream.format(FORMAT).options(**options).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


class MessageSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> MessageWriter:
        return MessageWriter(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> MessageStreamWriter:
        return MessageStreamWriter(dict(self.options))


@dataclass
class Sent(WriterCommitMessage):
    messages: int


class _Sender:
    def __init__(self, options: dict[str, str]):
        self.client = options["client"]
        self.settings = json.loads(options["settings"])

    def write(self, rows: Iterator[Row]) -> Sent:
        client = load_client(self.client, self.settings)
        sent = 0
        try:
            for row in rows:
                client.send(row.asDict(recursive=True))
                sent += 1
            client.flush()
        finally:
            client.close()
        return Sent(sent)


class MessageWriter(_Sender, DataSourceWriter):
    pass


class MessageStreamWriter(_Sender, DataSourceStreamWriter):
    def commit(self, messages, batchId: int) -> None:
        pass

    def abort(self, messages, batchId: int) -> None:
        pass


def send_with_status(frame: DataFrame, key: str, client: str, settings: Mapping[str, Any]) -> DataFrame:
    """Send a frame and return ``(key, status, ok, error)`` per row instead of failing."""
    settings = dict(settings)
    kind = frame.schema[key].dataType.simpleString()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = load_client(client, settings)
        try:
            for batch in batches:
                statuses, errors = [], []
                for row in batch.to_pylist():
                    try:
                        statuses.append(sender.send(row))
                        errors.append(None)
                    except Exception as error:  # one bad request must not hide the others
                        statuses.append(getattr(error, "status", None))
                        errors.append(str(error))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key),
                        pa.array(statuses, pa.int32()),
                        pa.array([error is None for error in errors], pa.bool_()),
                        pa.array(errors, pa.string()),
                    ],
                    [key, "status", "ok", "error"],
                )
        finally:
            sender.close()

    return frame.mapInArrow(send, f"`{key}` {kind}, status int, ok boolean, error string")
