"""Clients that tasks use to reach brokers, endpoints and landed logs.

Each is made by a factory named ``module:function``, so any other client with
the same methods can take its place. Broker libraries are imported when used.
"""

from __future__ import annotations

import asyncio
import http.client
import urllib.parse
from collections.abc import Iterator
from typing import Any

from millrace.errors import ConfigError, DataError


def _library(name: str):
    try:
        return __import__(name)
    except ImportError as error:
        raise ConfigError(f"the {name} package is needed on the workers") from error


# -------------------------------------------------------------------- HTTP
class HttpStatusError(DataError):
    def __init__(self, status: int):
        super().__init__(f"HTTP status {status}")
        self.status = status


class HttpClient:
    """One kept connection per task and host; only 2xx is success."""

    def __init__(self, settings: dict[str, Any]):
        self._timeout = settings["timeout_ms"] / 1000
        self._connections: dict[tuple[str, str], http.client.HTTPConnection] = {}

    def send(self, row: dict[str, Any]) -> int:
        url = urllib.parse.urlsplit(row["url"])
        key = (url.scheme, url.netloc)
        if key not in self._connections:
            kind = http.client.HTTPSConnection if url.scheme == "https" else http.client.HTTPConnection
            self._connections[key] = kind(url.netloc, timeout=self._timeout)
        target = urllib.parse.urlunsplit(("", "", url.path or "/", url.query, ""))
        headers = {header["name"]: header["value"] for header in row["headers"]}
        connection = self._connections[key]
        try:
            connection.request(row["method"], target, bytes(row["payload"] or b""), headers)
            response = connection.getresponse()
            response.read()
        except (OSError, http.client.HTTPException):
            connection.close()
            raise
        if not 200 <= response.status < 300:
            raise HttpStatusError(response.status)
        return response.status

    def flush(self) -> None:
        pass

    def close(self) -> None:
        for connection in self._connections.values():
            connection.close()


# ------------------------------------------------------------------- Redis
class RedisClient:
    def __init__(self, settings: dict[str, Any]):
        redis = _library("redis")
        self._redis = redis.Redis(
            host=settings["host"],
            port=settings["port"],
            username=settings["username"] or None,
            password=settings["password"] or None,
            db=settings["database"],
            socket_connect_timeout=settings["connect_ms"] / 1000,
            socket_timeout=settings["command_ms"] and settings["command_ms"] / 1000,
        )
        self._pipe = self._redis.pipeline(transaction=False)
        self._waiting = 0

    def send(self, row: dict[str, Any]) -> None:
        self._pipe.execute_command(*row["command"], bytes(row["payload"]))
        self._waiting += 1
        if self._waiting >= 1000:
            self.flush()

    def flush(self) -> None:
        self._pipe.execute()  # an error reply raises
        self._waiting = 0

    def close(self) -> None:
        self._redis.close()


class RedisStreamLog:
    """Entries of one Redis stream; a position is ``milliseconds * 2**64 + number``."""

    def __init__(self, settings: dict[str, Any]):
        redis = _library("redis")
        self._stream = settings["stream"]
        self._page = settings.get("count") or 1000
        self._redis = redis.Redis(
            host=settings["host"], port=settings["port"], username=settings["username"] or None,
            password=settings["password"] or None, db=settings["database"],
            socket_connect_timeout=settings["connect_ms"] / 1000,
            socket_timeout=max(settings.get("block_ms") or 0, 1000) / 1000 * 2,
        )

    @staticmethod
    def _position(entry: bytes) -> int:
        ms, _, number = entry.decode().partition("-")
        return (int(ms) << 64) + int(number or 0)

    @staticmethod
    def _id(position: int) -> str:
        return f"{position >> 64}-{position & (2**64 - 1)}"

    def tail(self) -> int:
        last = self._redis.xrevrange(self._stream, count=1)
        return self._position(last[0][0]) if last else 0

    def first(self, start: int) -> int | None:
        found = self._redis.xrange(self._stream, self._id(start + 1), "+", count=1)
        return self._position(found[0][0]) if found else None

    def read(self, start: int, end: int) -> Iterator[tuple[str, list[tuple[str, bytes]]]]:
        while start < end:
            page = self._redis.xrange(self._stream, self._id(start + 1), self._id(end), count=self._page)
            for entry, fields in page:
                start = self._position(entry)
                yield entry.decode(), [(name.decode(), value) for name, value in fields.items()]
            if len(page) < self._page:
                return

    def ack(self, end: int) -> None:
        pass

    def close(self) -> None:
        self._redis.close()


# -------------------------------------------------------------------- NATS
class NatsClient:
    """Core NATS publisher: one flush per task."""

    def __init__(self, settings: dict[str, Any]):
        nats = _library("nats")
        self._loop = asyncio.new_event_loop()
        self._flush_seconds = settings["flush_ms"] / 1000
        self._nats = self._loop.run_until_complete(nats.connect(settings["url"]))

    def send(self, row: dict[str, Any]) -> None:
        self._loop.run_until_complete(self._nats.publish(row["subject"], bytes(row["payload"])))

    def flush(self) -> None:
        self._loop.run_until_complete(self._nats.flush(timeout=self._flush_seconds))

    def close(self) -> None:
        self._loop.run_until_complete(self._nats.close())
        self._loop.close()


class JetStreamClient(NatsClient):
    """JetStream publisher: every message waits for the server's acknowledgement."""

    def send(self, row: dict[str, Any]) -> None:
        stream = self._nats.jetstream()
        self._loop.run_until_complete(stream.publish(row["subject"], bytes(row["payload"])))


class JetStreamLog(NatsClient):
    """Messages of one JetStream stream by sequence number."""

    def __init__(self, settings: dict[str, Any]):
        super().__init__({"flush_ms": 1000, **settings})
        self._js = self._nats.jetstream()
        self._subject = settings["subject"]
        self._durable = settings.get("durable_name") or None
        self._stream = settings.get("stream_name") or self._loop.run_until_complete(
            self._js.find_stream_name_by_subject(self._subject)
        )

    def tail(self) -> int:
        info = self._loop.run_until_complete(self._js.stream_info(self._stream))
        return info.state.last_seq

    def read(self, start: int, end: int) -> Iterator[tuple[str, list[tuple[str, bytes]]]]:
        from nats.js.errors import NotFoundError

        while start < end:
            try:
                message = self._loop.run_until_complete(
                    self._js.get_msg(self._stream, seq=start + 1, subject=self._subject, next=True)
                )
            except NotFoundError:
                return
            if message.seq > end:
                return
            start = message.seq
            yield str(message.seq), [("data", message.data)]

    def ack(self, end: int) -> None:
        pass
