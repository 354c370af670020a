"""Clients that keep what they are sent in files, instead of opening ports."""

from __future__ import annotations

import json
import uuid
from pathlib import Path


class Recorder:
    def __init__(self, settings):
        self.folder = Path(settings["folder"])
        self.rows = []

    def send(self, row):
        self.rows.append({k: v.decode() if isinstance(v, bytes) else v for k, v in row.items()})

    def flush(self):
        (self.folder / f"{uuid.uuid4().hex}.json").write_text(json.dumps(self.rows))

    def close(self):
        pass


class Endpoint:
    """Answers 503 to bodies that ask for it."""

    def __init__(self, settings):
        pass

    def send(self, row):
        if b"fail" in bytes(row["payload"]):
            error = RuntimeError("HTTP status 503")
            error.status = 503
            raise error
        return 201

    def flush(self):
        pass

    def close(self):
        pass


class StreamLog:
    """A Redis-like log: ids ``milliseconds-number``, several fields per entry."""

    def __init__(self, settings):
        self.entries = [
            ((ms << 64) + number, f"{ms}-{number}", fields)
            for ms, number, fields in (
                (1, 0, [("a", b"one"), ("b", b"uno")]),
                (1, 1, [("b", b"dos")]),
                (5, 0, [("a", b"three")]),
            )
        ]

    def tail(self):
        return self.entries[-1][0]

    def read(self, start, end):
        for position, entry, fields in self.entries:
            if start < position <= end:
                yield entry, fields

    def ack(self, end):
        pass

    def close(self):
        pass


class Sequence:
    """A log of numbered entries that starts far from zero."""

    def __init__(self, settings):
        self.low, self.high = settings.get("from", 1000), settings.get("to", 1100)

    def tail(self):
        return self.high

    def first(self, start):
        return max(start + 1, self.low) if start < self.high else None

    def read(self, start, end):
        for position in range(max(start + 1, self.low), min(end, self.high) + 1):
            yield str(position), [("data", b"x")]

    def ack(self, end):
        pass

    def close(self):
        pass
