"""Removal of repeated byte strings by a suffix array built in two stages.

A window is ``width`` bytes of one document. It goes if the same bytes also start in a document of smaller id; every
byte that such a window covers goes.

1. Blocks of texts look for windows worth sorting. In each window of bytes the least hash of its 20-byte strings is its
   anchor: equal windows have equal anchors. Blocks send their distinct anchors, 4 bytes each, to buckets, which answer
   with one bit each: whether another block has it too.
2. Windows in a row that share such an anchor form one string of at most ``64 + width - 1`` bytes. Blocks send their
   distinct strings with the smallest id to the bucket of the anchor. So every copy of a window meets in one bucket,
   and a string that a third of all documents have comes at most once from each block.
3. A bucket sorts the suffixes of its strings in two stages: only suffixes smaller than their successors are sorted
   directly; the others follow by one scan over the buckets of first bytes. Neighbours with a common prefix of a window
   are equal windows. A window is marked if its group has a smaller id than the string it came with.
4. The marks return to the blocks, 8 bytes for each string that has any. Blocks add what they know themselves, cover
   the bytes and cut them out.

Defined results: a null text is empty, has no windows and loses nothing. Null ids count as the largest. Equal rows each
get their row, and neither removes the other; matches never cross documents. Only the id and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import blocks
from millrace.llm.blocks import RESULT, SCATTER, Block, by_bucket, covered_by, runs_of, scatter, sha
from millrace.workdir import checkpointed

ANCHOR = 20
#: Windows in one string: the marks of a string are the bits of one number.
MOST_WINDOWS = 64

#: kind 0: anchors of a block, or which of them others have; kind 1: strings of a block, or their marks.
MESSAGE = "bucket int, block int, kind int, data binary, sizes binary, ids binary"


def _message(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = ["bucket", "block", "kind", "data", "sizes", "ids"]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _window_minimum(h: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` values in a row."""
    span, least = 1, h
    while span * 2 <= size:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = size - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


class _Cut:
    """The strings of a block: runs of windows with one anchor."""

    def __init__(self, table: pa.Table, width: int, buckets: int):
        self.block, self.width = Block(table), width
        data = self.block.data
        n = len(data)
        if n < width:
            self.starts = self.ends = self.owner = np.zeros(0, np.int64)
            self.keys = np.zeros(0, np.uint64)
        else:
            eight = np.ndarray((n - ANCHOR + 1 + 12,), "<u8", buffer=data + b"\0" * 8, strides=(1,))
            h = eight[: n - ANCHOR + 1] * SCATTER[0]
            h ^= (eight[8 : n - ANCHOR + 9] * SCATTER[1]) >> np.uint64(7)
            h += eight[12 : n - ANCHOR + 13] * SCATTER[2]
            h ^= h >> np.uint64(32)
            h *= SCATTER[0]
            least = _window_minimum(h, width - ANCHOR + 1)
            valid = np.ones(len(least), bool)
            for end in self.block.ends.tolist():
                valid[max(0, end - width + 1) : end] = False
            cut = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])))
            ends = np.append(cut[1:], len(least))
            cut, ends = cut[valid[cut]], ends[valid[cut]]
            pieces = -(-(ends - cut) // MOST_WINDOWS)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            self.starts = np.repeat(cut, pieces) + nth * MOST_WINDOWS
            self.ends = np.minimum(self.starts + MOST_WINDOWS, np.repeat(ends, pieces))
            self.owner = np.searchsorted(self.block.ends, self.starts, side="right")
            mixed = scatter(least[self.starts])
            self.keys = (mixed >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | (mixed & np.uint64(0xFFFFFFFF))
        self.distinct, self.which = np.unique(self.keys, return_inverse=True)

    def anchors(self, block: int) -> pa.Table:
        low = (self.distinct & np.uint64(0xFFFFFFFF)).astype("<u4")
        high = (self.distinct >> np.uint64(32)).astype(np.int64)
        return _message([(b, block, 0, low[i:j].tobytes(), None, None) for b, i, j in by_bucket(high, len(high))])

    def strings(self, answers: pa.Table) -> dict[int, dict[bytes, tuple[int, list[int]]]]:
        """By bucket and in a fixed order: strings with an anchor that another text has, their smallest id and runs."""
        shared = np.zeros(len(self.distinct), bool)
        high = (self.distinct >> np.uint64(32)).astype(np.int64)
        spans = {b: (i, j) for b, i, j in by_bucket(high, len(high))}
        for b, kind, bits in zip(*(answers[c].to_pylist() for c in ("bucket", "kind", "data")), strict=True):
            if kind == 0:
                i, j = spans[b]
                shared[i:j] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=j - i).astype(bool)
        # Anchors that several texts of this block have.
        if len(self.which):
            low, high_owner = np.full(len(shared), len(self.block.texts)), np.full(len(shared), -1)
            np.minimum.at(low, self.which, self.owner)
            np.maximum.at(high_owner, self.which, self.owner)
            shared |= low != high_owner
        found: dict[int, dict[bytes, tuple[int, list[int]]]] = {}
        data, firsts = self.block.data, self.block.firsts
        for k in np.flatnonzero(shared[self.which]).tolist():
            string = data[self.starts[k] : self.ends[k] + self.width - 1]
            bucket = found.setdefault(int(high[self.which[k]]), {})
            first, runs = bucket.get(string, (None, []))
            mine = int(firsts[self.owner[k]])
            runs.append(k)
            bucket[string] = (mine if first is None else min(first, mine), runs)
        return {b: dict(sorted(strings.items())) for b, strings in sorted(found.items())}


def type_b(data: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors; the last one is not."""
    n = len(data)
    change = np.append(data[:-1] != data[1:], True)
    at = np.minimum.accumulate(np.where(change, np.arange(n), n)[::-1])[::-1]
    return np.append(data, 0)[at] < np.append(data, 0)[at + 1] if n else np.zeros(0, bool)


def suffix_array(text: bytes, depth: int) -> np.ndarray:
    """The suffixes in order of their first ``depth`` bytes at least, by two-stage sorting."""
    n = len(text)
    data = np.frombuffer(text, np.uint8)
    smaller = type_b(data)
    if n:
        smaller[-1] = False

    # First stage: sort the suffixes smaller than their successors, eight bytes at a time while neighbours are equal.
    eight = np.ndarray((n + depth,), ">u8", buffer=text + b"\0" * (depth + 8), strides=(1,))
    direct = np.flatnonzero(smaller)
    keys = eight[direct].astype(np.uint64)
    order = np.argsort(keys, kind="stable")
    direct, keys = direct[order], keys[order]
    same = np.append(keys[1:] == keys[:-1], False)
    for at in range(8, depth, 8):
        tied = same | np.append(False, same[:-1])
        places = np.flatnonzero(tied)
        if not len(places):
            break
        group = np.cumsum(np.append(True, ~same[:-1]))[places]
        members = direct[places]
        keys = eight[members + at].astype(np.uint64)
        order = np.argsort(keys, kind="stable")
        order = order[np.argsort(group[order], kind="stable")]
        direct[places] = members[order]
        keys, group = keys[order], group[order]
        same[places] = np.append((keys[1:] == keys[:-1]) & (group[1:] == group[:-1]), False)

    # Second stage: scan by first byte. A suffix is followed by the larger ones that start one byte earlier.
    bounds = np.searchsorted(data[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n:
        waiting[data[-1]].append(np.array([n - 1]))
    out: list[np.ndarray] = []
    for byte in range(256):
        layer = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        layers = []
        while len(layer):  # a run of one byte follows from itself
            layers.append(layer)
            before = layer[layer > 0] - 1
            layer = before[(data[before] == byte) & ~smaller[before]]
        full = np.concatenate([*layers, direct[bounds[byte] : bounds[byte + 1]]])
        if not len(full):
            continue
        out.append(full)
        before = full[full > 0] - 1
        before = before[~smaller[before] & (data[before] > byte)]
        firsts = data[before]
        order = np.argsort(firsts, kind="stable")
        for b, i, j in by_bucket(firsts[order], len(order)):
            waiting[b].append(before[order[i:j]])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def equal_windows(text: bytes, windows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Window starts in suffix order, and whether each has a common prefix of ``width`` with the one before."""
    order = suffix_array(text, width)
    order = order[windows[order]]
    eight = np.ndarray((len(text) + width,), "<u8", buffer=text + b"\0" * (width + 8), strides=(1,))
    alike = np.ones(max(0, len(order) - 1), bool)
    steps = [*range(0, width - 7, 8), width - 8] if width >= 8 else []
    for at in steps:
        values = eight[order + at]
        alike &= values[1:] == values[:-1]
    return order, np.append(np.zeros(min(1, len(order)), bool), alike)


def _sorted_bucket(rows: pa.Table, width: int) -> pa.Table:
    """The marks for the strings of one bucket."""
    distinct: dict[bytes, int] = {}
    firsts: list[int] = []
    sent = []
    for block, data, sizes, ids in zip(*(rows[c].to_pylist() for c in ("block", "data", "sizes", "ids")), strict=True):
        places, at = [], 0
        own = np.frombuffer(ids, "<i8")
        for size, first in zip(np.frombuffer(sizes, np.uint8).tolist(), own.tolist(), strict=True):
            string = data[at : at + size]
            at += size
            k = distinct.setdefault(string, len(firsts))
            if k == len(firsts):
                firsts.append(first)
            else:
                firsts[k] = min(firsts[k], first)
            places.append(k)
        sent.append((block, np.array(places), own))
    sizes = np.array([len(s) for s in distinct], np.int64)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    windows = np.arange(sizes.sum()) <= (starts + sizes - width)[owner]
    order, alike = equal_windows(b"".join(distinct), windows, width)
    groups = np.flatnonzero(~alike)
    least = np.repeat(np.minimum.reduceat(np.array(firsts, np.int64)[owner[order]], groups), np.diff(np.append(groups, len(order))))
    # For every string the least id of each of its windows, in order of their place.
    by_place = np.argsort(order, kind="stable")
    least = least[by_place]
    ends = np.cumsum(sizes - width + 1)
    out = []
    for block, places, own in sent:
        counts = (sizes - width + 1)[places]
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        which = np.repeat(ends[places] - counts, counts) + inner
        hit = least[which] < np.repeat(own, counts)
        if hit.any():
            marks = np.zeros(len(places), np.uint64)
            np.bitwise_or.at(marks, np.repeat(np.arange(len(places)), counts)[hit], np.uint64(1) << inner[hit].astype(np.uint64))
            marked = np.flatnonzero(marks)
            out.append((rows["bucket"][0].as_py(), block, 1, marks[marked].astype("<u8").tobytes(), marked.astype("<u4").tobytes(), None))
    return _message(out)


def _common_anchors(rows: pa.Table) -> pa.Table:
    """For each block one bit for each of its anchors: whether another block has it."""
    sent = [np.frombuffer(data, "<u4") for data in rows["data"].to_pylist()]
    values, counts = np.unique(np.concatenate(sent), return_counts=True)
    common = values[counts > 1]
    out = []
    for block, mine in zip(rows["block"].to_pylist(), sent, strict=True):
        at = np.minimum(np.searchsorted(common, mine), max(0, len(common) - 1))
        shared = common[at] == mine if len(common) else np.zeros(len(mine), bool)
        if shared.any():
            out.append((rows["bucket"][0].as_py(), block, 0, np.packbits(shared).tobytes(), None, None))
    return _message(out)


def repeated_bytes(docs: DataFrame, width: int = 50, text: str = "text", id_column: str = "doc_id",
                   block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, kept_sha256 and ``runs``, the removed byte ranges."""
    stored = blocks.store(docs, text, id_column, block_bytes)
    buckets = stored.blocks
    table = stored.table.groupBy("block")

    def send_anchors(key: tuple, rows: pa.Table) -> pa.Table:
        return _Cut(rows, width, buckets).anchors(key[0].as_py())

    def send_strings(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for b, strings in _Cut(rows, width, buckets).strings(answers).items():
            sizes = np.array([len(s) for s in strings], np.uint8).tobytes()
            ids = np.array([first for first, _ in strings.values()], "<i8").tobytes()
            out.append((b, key[0].as_py(), 1, b"".join(strings), sizes, ids))
        return _message(out)

    def finish(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        return _finished(_Cut(rows, width, buckets), answers)

    common = checkpointed(table.applyInArrow(send_anchors, MESSAGE).groupBy("bucket").applyInArrow(_common_anchors, MESSAGE))
    strings = table.cogroup(common.groupBy("block")).applyInArrow(send_strings, MESSAGE)
    marks = checkpointed(strings.groupBy("bucket").applyInArrow(lambda rows: _sorted_bucket(rows, width), MESSAGE))
    answers = common.union(marks)
    results = checkpointed(table.cogroup(answers.groupBy("block")).applyInArrow(finish, RESULT))
    stored.drop()
    return blocks.with_copies(docs, results, "n_bytes", width, text, id_column)


def _finished(cut: _Cut, answers: pa.Table) -> pa.Table:
    block, width = cut.block, cut.width
    marks: dict[int, dict[int, int]] = {}
    for b, kind, data, sizes in zip(*(answers[c].to_pylist() for c in ("bucket", "kind", "data", "sizes")), strict=True):
        if kind == 1:
            marks[b] = dict(zip(np.frombuffer(sizes, "<u4").tolist(), np.frombuffer(data, "<u8").tolist(), strict=True))
    removed = np.zeros(len(block.data), bool)  # by window
    for b, strings in cut.strings(answers).items():
        marked = marks.get(b, {})
        for k, (first, runs) in enumerate(strings.values()):
            mark = marked.get(k, 0)
            for run in runs:
                start, end = cut.starts[run], cut.ends[run]
                if block.firsts[cut.owner[run]] > first:
                    removed[start:end] = True
                elif mark:
                    removed[start:end] = np.unpackbits(np.array([mark], "<u8").view(np.uint8), bitorder="little")[: end - start].astype(bool)
    return result_table(block, block.starts, block.ends, covered_by(removed, width, len(removed)), lambda t, kept: kept_bytes(block.texts[t], kept))


def kept_bytes(raw: bytes, kept: np.ndarray) -> bytes:
    return np.frombuffer(raw, np.uint8)[kept].tobytes()


def result_table(block: Block, starts: np.ndarray, ends: np.ndarray, covered: np.ndarray, keep) -> pa.Table:
    """The results of a block's texts. ``starts`` and ``ends`` place each text's units in ``covered``."""
    out: dict[str, list] = {k: [] for k in ("sha", "first", "units", "n_removed", "kept_sha256", "runs")}
    for t, (start, end) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        mine = covered[start:end]
        lost = int(mine.sum())
        out["sha"].append(sha(block.texts[t]))
        out["first"].append(int(block.firsts[t]))
        out["units"].append(end - start)
        out["n_removed"].append(lost)
        out["kept_sha256"].append(sha(keep(t, ~mine)))
        out["runs"].append([{"start": a, "end": b} for a, b in zip(*(x.tolist() for x in runs_of(mine)), strict=True)] if lost else [])
    shape = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), shape]
    return pa.table([pa.array(c, k) for c, k in zip(out.values(), kinds, strict=True)], names=list(out))
