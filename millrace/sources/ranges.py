"""Records of large files, read by byte range.

A file is cut into ranges, and each range is one task's work. A range owns the records that start in
it: it looks for the first cut byte (a line end, or a closing brace), and reads on past its end until its last record is
whole. Where a record can hold cut bytes of its own (line ends in quotes, braces in strings or in inner objects), a range
cannot know from its own bytes whether it starts inside a record. So one pass sums every range up for each state it might
start in; these sums are composed along each file, a few numbers for each range; and the second pass cuts records.

Tasks open the files themselves, through Arrow's file systems, and stream them. Compressed files are one range each.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.errors import DataError
from millrace.storage import STREAM_CODECS, SUFFIX_CODECS, arrow_filesystem, resolve_codec
from millrace.workdir import checkpointed

#: Bytes of a read, and of the records that are handed to Spark at a time.
READ_BYTES = 4 << 20
#: Bytes of a first read beyond what a range owns; each further one is twice as long.
AHEAD_BYTES = 64 << 10
BATCH_BYTES = 8 << 20
BATCH_ROWS = 10_000
#: Tasks of a read, and ranges of its files, however short their blocks; more only where each has a file split of bytes.
MOST_TASKS = 128

#: Where a record stands at a cut: in quotes (or a string) or not, and how many objects are open.
State = tuple[int, int]
OUTSIDE: State = (0, 0)


class Scanner(Protocol):
    """Finds the ends of records in bytes that start right after a cut byte (or with the file)."""

    cut: bytes
    #: States that differ other than by depth.
    starts: tuple[int, ...]

    def scan(self, data: bytes, state: State) -> tuple[State, np.ndarray]:
        """The state after ``data``, and the places of the last bytes of records."""

    def record(self, data: bytes) -> bytes | None:
        """What of the bytes up to an end is the record."""

    def rest(self, data: bytes, state: State) -> bytes | None:
        """What the file's last bytes after every end are."""


class Lines:
    """Every line is a record."""

    cut = b"\n"
    starts = (0,)

    def scan(self, data: bytes, state: State) -> tuple[State, np.ndarray]:
        return OUTSIDE, np.flatnonzero(np.frombuffer(data, np.uint8) == 10)

    def record(self, data: bytes) -> bytes | None:
        return data.removesuffix(b"\n").removesuffix(b"\r")

    def rest(self, data: bytes, state: State) -> bytes | None:
        return self.record(data) if data else None


class QuotedLines(Lines):
    """Lines, but a line end in quotes or after an escape is part of the record.

    Quotes count at the start of a field only; within quotes, doubled ones are text. While quotes alternate in this way,
    which they mostly do, the state at each line end is their parity. Otherwise the fields are walked one by one.
    """

    starts = (0, 1)

    def __init__(self, delimiter: str, quote: str, double_quote: bool = True, escape: str | None = None):
        sep, q = re.escape(delimiter.encode()), re.escape(quote.encode())
        e = re.escape(escape.encode()) if escape else None
        self.quote, self.delimiter, self.double_quote = ord(quote), ord(delimiter), double_quote
        self.escape = escape.encode() if escape else None
        inside = b"[^" + q + (e or b"") + b"]++" + (b"|" + q + q if double_quote else b"") + (b"|" + e + b"." if e else b"")
        self.close = re.compile(b"(?:" + inside + b")*+" + q, re.DOTALL).match
        if e:
            between = b"(?:" + e + b".|[^" + e + sep + b"\n]|[" + sep + b"\n](?!" + q + b"))*+[" + sep + b"\n]" + q
            self.open = re.compile(between, re.DOTALL).match
        else:
            self.open = re.compile(b"[" + sep + b"\n]" + q).search

    def scan(self, data: bytes, state: State) -> tuple[State, np.ndarray]:
        flat = np.frombuffer(data, np.uint8)
        found = self._by_parity(data, flat, state[0])
        inside, ends = found[:2] if found else self._walked(data, flat, state[0])
        return (inside, 0), ends

    def both(self, data: bytes) -> list[tuple[State, int]]:
        """For either start, the state after ``data`` and the number of ends."""
        flat = np.frombuffer(data, np.uint8)
        found = [self._by_parity(data, flat, start) for start in self.starts]
        out = []
        for start in self.starts:
            inside, ends = found[start][:2] if found[start] else self._walked(data, flat, start, found[1 - start])
            out.append(((inside, 0), len(ends)))
        return out

    def _by_parity(self, data: bytes, flat: np.ndarray, inside: int) -> tuple[int, np.ndarray, np.ndarray] | None:
        if self.escape and self.escape in data:
            return None
        quotes = np.flatnonzero(flat == self.quote)
        opening = quotes[inside::2]
        before = flat[opening[opening > 0] - 1]
        fits = (before == self.delimiter) | (before == 10)
        if self.double_quote:
            fits |= before == self.quote
        if not fits.all():
            return None
        ends = np.flatnonzero(flat == 10)
        return (inside + len(quotes)) & 1, ends[(np.searchsorted(quotes, ends) + inside) % 2 == 0], opening

    def _walked(self, data: bytes, flat: np.ndarray, inside: int, other: tuple | None = None) -> tuple[int, np.ndarray]:
        """Field by field. ``other``: what the other start gives; once both open a field at the same place, they agree."""
        ends = np.flatnonzero(flat == 10)
        if self.escape and self.escape in data:
            at = np.arange(len(flat))
            plain = np.maximum.accumulate(np.where(flat != self.escape[0], at, -1))
            before = ends[ends > 0]
            odd = before[(before - 1 - plain[before - 1]) % 2 == 1]
            ends = np.setdiff1d(ends, odd, assume_unique=True)
        spans, start, place = [], 0, 0
        if not inside and flat.size and flat[0] == self.quote:
            inside, place = 1, 1
        while True:
            if inside:
                found = self.close(data, place)
                spans.append((start, found.end() if found else len(data)))
                if not found:
                    break
                place, inside = found.end(), 0
            found = self.open(data, place)
            if not found:
                break
            start, place, inside = found.end() - 1, found.end(), 1
            if other and (k := np.searchsorted(other[2], start)) < len(other[2]) and other[2][k] == start:
                edges = np.array(spans, np.int64).reshape(-1, 2)
                mine = ends[ends < start]
                return other[0], np.concatenate([self._outside(mine, edges), other[1][other[1] > start]])
        return inside, self._outside(ends, np.array(spans, np.int64).reshape(-1, 2))

    @staticmethod
    def _outside(ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
        k = np.searchsorted(spans[:, 0], ends, side="right") - 1
        return ends[(k < 0) | (spans[np.maximum(k, 0), 1] <= ends)] if len(spans) else ends


class Objects:
    """JSON objects, whatever white space is between them."""

    cut = b"}"
    starts = (0, 1)

    def scan(self, data: bytes, state: State) -> tuple[State, np.ndarray]:
        inside, depth = state
        flat = np.frombuffer(data, np.uint8)
        quotes = np.flatnonzero(flat == 34)
        if b"\\" in data:
            at = np.arange(len(flat))
            plain = np.maximum.accumulate(np.where(flat != 92, at, -1))
            quotes = quotes[(quotes == 0) | ((quotes - 1 - plain[quotes - 1]) % 2 == 0)]
        braces = np.flatnonzero((flat == 123) | (flat == 125))
        braces = braces[(np.searchsorted(quotes, braces) + inside) % 2 == 0]
        depths = depth + np.cumsum(np.where(flat[braces] == 123, 1, -1))
        ends = braces[(depths == 0) & (flat[braces] == 125)]
        return ((inside + len(quotes)) & 1, int(depths[-1]) if len(depths) else depth), ends

    def record(self, data: bytes) -> bytes | None:
        return data.strip() or None

    def rest(self, data: bytes, state: State) -> bytes | None:
        if data.strip():
            raise DataError(f"not a JSON object: {data.strip()[:100].decode(errors='replace')}")
        return None


# ------------------------------------------------------------------ reading
@dataclass(frozen=True)
class Opener:
    """How tasks open files: the codec, and settings of the store."""

    codec: str = "UNCOMPRESSED"
    store: dict[str, Any] | None = None

    def open(self, path: str):
        filesystem, name = arrow_filesystem(path, self.store)
        codec = STREAM_CODECS.get(resolve_codec(path, self.codec))
        return filesystem.open_input_stream(name, compression=codec) if codec else filesystem.open_input_file(name)


def region(file, start: int, end: int, size: int, cut: bytes, first: bool, sure: int | None = None) -> Iterator[bytes]:
    """Bytes after the first cut at or after ``start - 1`` up to and with the first cut at or after ``end - 1``.

    The file's first range begins right at ``start``, its last one (``end`` = ``size``) ends with the file. All bytes up
    to ``sure`` (``end`` unless told) will be wanted; beyond it little is read at first.
    """
    place = start if first else start - 1
    sure, ahead = end if sure is None else sure, AHEAD_BYTES
    file.seek(place)
    skipping = not first
    while chunk := file.read(min(READ_BYTES, sure - place if place < sure else ahead)):
        if place >= sure:
            ahead *= 2
        base, place = place, place + len(chunk)
        if skipping:
            k = chunk.find(cut)
            if base + (k if k >= 0 else len(chunk)) >= end - 1 and end < size:
                return
            if k < 0:
                continue
            skipping, chunk, base = False, chunk[k + 1 :], base + k + 1
        if end < size and place >= end:
            k = chunk.find(cut, max(0, end - 1 - base))
            if k >= 0:
                yield chunk[: k + 1]
                return
        if chunk:
            yield chunk


def whole_pieces(chunks: Iterable[bytes], cut: bytes) -> Iterator[bytes]:
    """The same bytes, cut after cut bytes only (but for the end)."""
    held: list[bytes] = []
    for chunk in chunks:
        k = chunk.rfind(cut) + 1
        if not k:
            held.append(chunk)
            continue
        yield b"".join([*held, chunk[:k]])
        held = [chunk[k:]] if k < len(chunk) else []
    if held:
        yield b"".join(held)


def records(pieces: Iterable[bytes], more: Callable[[], Iterable[bytes]], scanner: Scanner, state: State) -> Iterator[tuple[int, bytes]]:
    """(line ends before it, record) of the records that start in ``pieces``; ``more`` gives what follows them."""
    held: list[bytes] = []  # the record that is not finished yet
    own, lines, pending = state == OUTSIDE, 0, 0
    for piece in pieces:
        state, ends = scanner.scan(piece, state)
        start = 0
        for end in ends.tolist():
            data = piece[start : end + 1]
            if own and (found := scanner.record(b"".join([*held, data]) if held else data)) is not None:
                yield lines, found
            lines += pending + data.count(b"\n")
            held, start, own, pending = [], end + 1, True, 0
        if start < len(piece):
            if own:
                held.append(piece[start:])
            pending += piece.count(b"\n", start)
    if not own or (not held and state == OUTSIDE):
        return
    for piece in whole_pieces(more(), scanner.cut):
        state, ends = scanner.scan(piece, state)
        if len(ends):
            held.append(piece[: int(ends[0]) + 1])
            if (found := scanner.record(b"".join(held))) is not None:
                yield lines, found
            return
        held.append(piece)
    if (found := scanner.rest(b"".join(held), state)) is not None:
        yield lines, found


def _file_records(opener: Opener, scanner: Scanner, row: dict[str, Any]) -> Iterator[tuple[int, bytes]]:
    with opener.open(row["path"]) as file:
        if row["whole"]:
            if row["start"]:
                _pass_over(file, row["start"])
            yield from records(whole_pieces(iter(lambda: file.read(READ_BYTES), b""), scanner.cut), lambda: (), scanner, OUTSIDE)
            return
        own = region(file, row["start"], row["end"], row["size"], scanner.cut, row["first"])

        def more() -> Iterator[bytes]:
            if row["end"] >= row["size"]:
                return
            # The range's own bytes end with the first cut from end - 1 on, and what follows starts there.
            yield from region(file, row["end"], row["size"], row["size"], scanner.cut, False, sure=row["end"] - 1)

        yield from records(whole_pieces(own, scanner.cut), more, scanner, (row["inside"], row["depth"]))


def _pass_over(file, count: int) -> None:
    while count and (chunk := file.read(min(count, READ_BYTES))):
        count -= len(chunk)


# ------------------------------------------------------------ over all files
@dataclass(frozen=True)
class Head:
    """What comes before a file's data: lines to skip, the names, rows to skip after them."""

    skip: int = 0
    header: bool = False
    after: int = 0
    ignore_empty: bool = True

    def __bool__(self) -> bool:
        return bool(self.skip or self.header or self.after)


FILES = "path string, size bigint, offset bigint, names string, line bigint, record bigint"


def files_with_heads(spark: SparkSession, path: str, scanner: Scanner, opener: Opener, head: Head) -> DataFrame:
    """(path, size, offset, names, line, record) of every file: where its data starts, and its line of names.

    Each file's head is read by one task, which stops where the data starts.
    """
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"))  # no content is read
    if not head:
        return files.selectExpr("path", "size", "0L AS offset", "CAST(NULL AS STRING) AS names", "0L AS line", "0L AS record")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                with opener.open(row["path"]) as file:
                    found.append([row["path"], row["size"], *_head(file, scanner, head)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*found), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))]
                if found else [pa.array([], kind) for kind in (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())],
                ["path", "size", "offset", "names", "line", "record"],
            )

    return files.mapInArrow(read, FILES)


def _head(file, scanner: Scanner, head: Head) -> tuple[int, str | None, int, int]:
    """Bytes, names, lines and records of a file's head."""
    skip, header, after, names = head.skip, head.header, head.after, None
    state, offset, lines, count, held = OUTSIDE, 0, 0, 0, b""
    if not (skip or header or after):
        return 0, None, 0, 0
    for piece in whole_pieces(iter(lambda: file.read(READ_BYTES if skip > 1000 else 1 << 16), b""), scanner.cut):
        state, ends = scanner.scan(piece, state)
        start = 0
        for end in ends.tolist():
            data = held + piece[start : end + 1]
            held, start = b"", end + 1
            offset += len(data)
            lines += data.count(b"\n")
            count += 1
            if skip:
                skip -= 1
            elif header:
                line = scanner.record(data)
                if line or not head.ignore_empty:
                    header, names = False, (line or b"").decode(errors="replace")
            else:
                after -= 1
            if not (skip or header or after):
                return offset, names, lines, count
        held += piece[start:]
    if held and not skip and header:
        names = (scanner.rest(held, state) or b"").decode(errors="replace") or None
    return offset + len(held), names, lines, count


def byte_ranges(files: DataFrame, opener: Opener, range_bytes: int) -> DataFrame:
    """Files with their offsets → ranges; a compressed file is one."""
    if opener.codec == "AUTO":
        whole = F.lit(False)
        for suffix, codec in SUFFIX_CODECS.items():
            if codec in STREAM_CODECS:
                whole = whole | F.col("path").endswith(suffix)
    else:
        whole = F.lit(opener.codec in STREAM_CODECS)
    files = files.withColumn("whole", whole)
    starts = F.when(F.col("whole"), F.array("offset")).when(
        F.col("offset") < F.col("size"), F.sequence("offset", F.col("size") - 1, F.lit(range_bytes).cast("bigint"))
    )
    ranges = files.select("path", "size", "offset", "whole", "line", "record", F.explode(starts).alias("start"))
    end = F.when(F.col("whole"), F.col("size")).otherwise(F.least(F.col("start") + range_bytes, "size"))
    return ranges.select("path", "size", "whole", "line", "record", "start", end.alias("end"), (F.col("start") == F.col("offset")).alias("first"))


def task_bound(total: int, split_bytes: int) -> int:
    """How many tasks may share files of ``total`` bytes."""
    return max(MOST_TASKS, -(-total // split_bytes))


def _spread(ranges: DataFrame, most: int) -> DataFrame:
    """One range for each task, more or less, up to ``most`` tasks."""
    return ranges.repartition(max(1, min(most, ranges.count())), "path", "start")


STATES = "path string, size bigint, whole boolean, start bigint, end bigint, first boolean, inside int, depth bigint, line bigint, record bigint"
_SUMS = ("inside0", "depth0", "records0", "inside1", "depth1", "records1", "lines")


def with_states(ranges: DataFrame, scanner: Scanner, opener: Opener, numbered: bool, most: int) -> DataFrame:
    """The state each range starts in, and (``numbered``) the lines and records of its file before it."""
    if len(scanner.starts) == 1 and not numbered:
        return ranges.selectExpr("path", "size", "whole", "start", "`end`", "first", "0 AS inside", "0L AS depth", "line", "record")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_sums(opener, scanner, row) for row in batch.to_pylist()]
            columns = [pa.array([row[k] for row in found], pa.int64()) for k in range(len(_SUMS))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *_SUMS])

    def compose(table: pa.Table) -> pa.Table:
        table = table.sort_by("start")
        inside, depth, line, record = 0, 0, table["line"][0].as_py(), table["record"][0].as_py()
        out = []
        for row in table.to_pylist():
            out.append((inside, depth, line, record))
            s = inside
            inside, depth = row[f"inside{s}"], depth + row[f"depth{s}"]
            line, record = line + row["lines"], record + row[f"records{s}"]
        kept = table.select(["path", "size", "whole", "start", "end", "first"])
        for name, kind, column in zip(("inside", "depth", "line", "record"), (pa.int32(), pa.int64(), pa.int64(), pa.int64()), zip(*out)):
            kept = kept.append_column(name, pa.array(column, kind))
        return kept

    sums = ", ".join(f"{name} bigint" for name in _SUMS)
    kinds = "path string, size bigint, whole boolean, line bigint, record bigint, start bigint, end bigint, first boolean"
    summed = _spread(ranges, most).mapInArrow(add_up, f"{kinds}, {sums}")
    # A file has as many rows here as it has ranges.
    return checkpointed(summed.groupBy("path").applyInArrow(compose, STATES))


def _sums(opener: Opener, scanner: Scanner, row: dict[str, Any]) -> tuple[int, ...]:
    if row["whole"]:
        return (0,) * len(_SUMS)  # the only range of its file
    states: list[State] = [(s, 0) for s in scanner.starts]
    counts, lines = [0] * len(states), 0
    with opener.open(row["path"]) as file:
        for piece in whole_pieces(region(file, row["start"], row["end"], row["size"], scanner.cut, row["first"]), scanner.cut):
            lines += piece.count(b"\n")
            if isinstance(scanner, QuotedLines):
                effect = scanner.both(piece)
                counts = [counts[k] + effect[s][1] for k, (s, _) in enumerate(states)]
                states = [effect[s][0] for s, _ in states]
                continue
            for k, state in enumerate(states):
                states[k], ends = scanner.scan(piece, state)
                counts[k] += len(ends)
    one = (*states[0], counts[0])
    two = (*states[1], counts[1]) if len(states) > 1 else one
    return (*one, *two, lines)


def read_records(states: DataFrame, scanner: Scanner, opener: Opener, numbered: bool, most: int) -> DataFrame:
    """``value`` (one row for each record), and with ``numbered`` its file, the line it starts on and its number, from 1."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                # The ends before the range, and that of the record it starts inside.
                number = row["record"] + ((row["inside"], row["depth"]) != OUTSIDE)
                for lines, values in _batched(_file_records(opener, scanner, row)):
                    data = pa.array(values, pa.binary())
                    text = pa.Array.from_buffers(pa.string(), len(data), data.buffers())
                    if not numbered:
                        yield pa.RecordBatch.from_arrays([text], ["value"])
                        continue
                    count = len(values)
                    paths = pa.array([row["path"]] * count, pa.string())
                    line = pa.array(np.array(lines, np.int64) + row["line"] + 1)
                    yield pa.RecordBatch.from_arrays([text, paths, line, pa.array(np.arange(count) + number + 1)], ["value", "path", "line", "record"])
                    number += count

    schema = "value string" + ", path string, line bigint, record bigint" * numbered
    return _spread(states, most).mapInArrow(read, schema)


def _batched(found: Iterable[tuple[int, bytes]]) -> Iterator[tuple[list[int], list[bytes]]]:
    lines: list[int] = []
    values: list[bytes] = []
    size = 0
    for line, value in found:
        lines.append(line)
        values.append(value)
        size += len(value)
        if size >= BATCH_BYTES or len(values) >= BATCH_ROWS:
            yield lines, values
            lines, values, size = [], [], 0
    if values:
        yield lines, values


def file_records(
    spark: SparkSession, path: str, scanner: Scanner, opener: Opener, head: Head = Head(), numbered: bool = False, range_bytes: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Records of all files, and the files with their heads.

    Ranges are as long as Spark's file splits may be, unless told. A told length is a block: a range has as many blocks as
    keep the ranges of all files to about ``MOST_TASKS``, or to the file splits if those are more.
    """
    split_bytes = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    files = files_with_heads(spark, path, scanner, opener, head)
    if head:
        files = checkpointed(files)
    total = files.agg(F.sum("size")).first()[0] or 0
    most = task_bound(total, split_bytes)
    block = range_bytes or split_bytes
    ranges = byte_ranges(files, opener, block * max(1, -(-total // (block * most))))
    return read_records(with_states(ranges, scanner, opener, numbered, most), scanner, opener, numbered, most), files
