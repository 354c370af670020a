"""Removal of repeated word sequences with fixed-block anchors.

A window is ``width`` words of one document. It goes if the same words also start in a document of smaller id; every
word that such a window covers goes.

1. Every text is a reference: its non-overlapping blocks of half a window are the index. Whatever window two texts
   share holds such a block of either text whole. Every text is also a query: all its rolling windows of that length
   probe the index. Blocks of texts send both to buckets, 4 bytes each, probes made distinct; one bit for each probe
   comes back: the index has it, and at least two blocks of texts do.
2. A hit is extended: all windows that hold it are compared, which finds the maximal exact repeats around it. Their
   128-bit keys go to buckets with the smallest id that each block of texts knows; one bit comes back: another block
   knows a smaller id for this window.
3. Covered words are cut out.

Defined results: a null or blank text has no words and loses none. Null ids count as the largest. Equal rows each get
their row, and neither removes the other; windows never cross documents. Only the id and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from millrace.llm import blocks
from millrace.llm.blocks import RESULT, SCATTER, Block, by_bucket, covered_by, scatter
from millrace.llm.suffixes import result_table
from millrace.workdir import checkpointed

#: kind 0: probes and index entries of a block, or its hits; kind 1: keys of its windows, or which go.
MESSAGE = "bucket int, block int, kind int, data binary, extra binary"
_LOW = np.uint64(0xFFFFFFFF)


def _message(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    names = ["bucket", "block", "kind", "data", "extra"]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


class _Words:
    """The words of a block of texts as hashes, and the keys of all runs of ``anchor`` of them."""

    def __init__(self, table: pa.Table, width: int, buckets: int):
        self.block, self.width, self.anchor, self.buckets = Block(table), width, width // 2, buckets
        words = [t.split() for t in self.block.texts]
        sizes = np.array([len(w) for w in words], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.hashes = np.array([h for w in words for h in map(xxhash.xxh3_64_intdigest, w)], np.uint64)
        self.owner = np.repeat(np.arange(len(words)), sizes)
        self.at = self._whole(self.anchor)
        mixed = self._keys(self.at, self.anchor, SCATTER[0])
        self.keys = self._dealt(mixed)
        self.probes, self.which = np.unique(self.keys, return_inverse=True)
        is_block = (self.at - self.starts[self.owner[self.at]]) % self.anchor == 0
        self.index = np.unique(self.keys[is_block])

    def _whole(self, size: int) -> np.ndarray:
        """Where a run of so many words of one text starts."""
        at = np.arange(max(0, len(self.hashes) - size + 1))
        return at[self.owner[at] == self.owner[at + size - 1]] if len(at) else at

    def _keys(self, at: np.ndarray, size: int, factor: np.uint64) -> np.ndarray:
        """Polynomials over scattered word hashes, scattered again."""
        key = np.zeros(len(at), np.uint64)
        words = scatter(self.hashes ^ factor)
        for k in range(size):
            key = key * factor + words[at + k]
        return scatter(key)

    def _dealt(self, key: np.ndarray) -> np.ndarray:
        return (key >> np.uint64(32)) % np.uint64(self.buckets) << np.uint64(32) | (key & _LOW)

    def probes_and_index(self, block: int) -> pa.Table:
        out = []
        marks = np.isin(self.probes, self.index, assume_unique=True)
        for b, i, j in by_bucket((self.probes >> np.uint64(32)).astype(np.int64), len(self.probes)):
            out.append((b, block, 0, (self.probes[i:j] & _LOW).astype("<u4").tobytes(), np.packbits(marks[i:j]).tobytes()))
        return _message(out)

    def candidates(self, answers: pa.Table) -> _Windows:
        """All windows that hold a hit; hits within this block of texts it knows itself."""
        hit = np.zeros(len(self.probes), bool)
        spans = {b: (i, j) for b, i, j in by_bucket((self.probes >> np.uint64(32)).astype(np.int64), len(self.probes))}
        for b, kind, bits in zip(*(answers[c].to_pylist() for c in ("bucket", "kind", "data")), strict=True):
            if kind == 0:
                i, j = spans[b]
                hit[i:j] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=j - i).astype(bool)
        if len(self.which):
            low, high = np.full(len(hit), len(self.starts)), np.full(len(hit), -1)
            np.minimum.at(low, self.which, self.owner[self.at])
            np.maximum.at(high, self.which, self.owner[self.at])
            hit |= (low != high) & np.isin(self.probes, self.index, assume_unique=True)
        at = self._whole(self.width)
        count = np.zeros(len(self.hashes) + 1, np.int64)
        if len(self.at):
            count[self.at[hit[self.which]] + 1] = 1
        count = np.cumsum(count)
        at = at[count[at + self.width - self.anchor + 1] > count[at]] if len(at) else at
        return _Windows(self, at)


class _Windows:
    """Candidate windows of a block of texts by distinct key."""

    def __init__(self, words: _Words, at: np.ndarray):
        self.at = at
        first = words._keys(at, words.width, SCATTER[1])
        second = words._keys(at, words.width, SCATTER[2])
        bucket = (first >> np.uint64(32)) % np.uint64(words.buckets)
        order = np.lexsort((second, first, bucket))
        first, second, bucket = first[order], second[order], bucket[order]
        new = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])) if len(at) else np.zeros(0, bool)
        groups = np.flatnonzero(new)
        self.bucket, self.keys = bucket[groups].astype(np.int64), np.stack([first[groups], second[groups]], axis=1)
        ids = words.block.firsts[words.owner[at]]
        self.least = np.minimum.reduceat(ids[order], groups) if len(at) else ids
        self.which = np.empty(len(at), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.ids = ids

    def message(self, block: int) -> pa.Table:
        return _message([
            (b, block, 1, self.keys[i:j].astype("<u8").tobytes(), self.least[i:j].astype("<i8").tobytes())
            for b, i, j in by_bucket(self.bucket, len(self.bucket))
        ])

    def gone(self, answers: pa.Table) -> np.ndarray:
        """The windows for which a smaller id than their own is known here or elsewhere."""
        smaller = np.zeros(len(self.least), bool)
        spans = {b: (i, j) for b, i, j in by_bucket(self.bucket, len(self.bucket))}
        for b, kind, bits in zip(*(answers[c].to_pylist() for c in ("bucket", "kind", "data")), strict=True):
            if kind == 1:
                i, j = spans[b]
                smaller[i:j] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=j - i).astype(bool)
        return self.at[(self.ids > self.least[self.which]) | smaller[self.which]]


def _hits(rows: pa.Table) -> pa.Table:
    """One bit for each probe of each block: it is in the index, and another block has it too."""
    sent = [np.frombuffer(data, "<u4") for data in rows["data"].to_pylist()]
    marks = [np.unpackbits(np.frombuffer(bits, np.uint8), count=len(p)).astype(bool) for bits, p in zip(rows["extra"].to_pylist(), sent, strict=True)]
    index = np.unique(np.concatenate([p[m] for p, m in zip(sent, marks, strict=True)]))
    places = [_place(index, p) for p in sent]
    counts = np.zeros(len(index) + 1, np.int64)
    for place in places:
        counts[place[place >= 0]] += 1
    out = []
    for block, place in zip(rows["block"].to_pylist(), places, strict=True):
        hit = (place >= 0) & (counts[place] > 1)
        if hit.any():
            out.append((rows["bucket"][0].as_py(), block, 0, np.packbits(hit).tobytes(), None))
    return _message(out)


def _place(sorted_values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted value is, or -1."""
    if not len(sorted_values):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return np.where(sorted_values[at] == wanted, at, -1)


def _smaller_elsewhere(rows: pa.Table) -> pa.Table:
    sent = [(np.frombuffer(k, "<u8").reshape(-1, 2), np.frombuffer(i, "<i8")) for k, i in zip(rows["data"].to_pylist(), rows["extra"].to_pylist(), strict=True)]
    keys, ids = np.concatenate([k for k, _ in sent]), np.concatenate([i for _, i in sent])
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.append(True, (keys[order][1:] != keys[order][:-1]).any(axis=1))
    groups = np.flatnonzero(new)
    least = np.empty(len(ids), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(ids[order], groups), np.diff(np.append(groups, len(ids))))
    smaller, at, out = least < ids, 0, []
    for block, (_, mine) in zip(rows["block"].to_pylist(), sent, strict=True):
        bits = smaller[at : at + len(mine)]
        at += len(mine)
        if bits.any():
            out.append((rows["bucket"][0].as_py(), block, 1, np.packbits(bits).tobytes(), None))
    return _message(out)


def repeated_words(docs: DataFrame, width: int = 50, text: str = "text", id_column: str = "doc_id",
                   block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and ``runs``, the removed ranges of words."""
    stored = blocks.store(docs, text, id_column, block_bytes)
    buckets = stored.blocks
    table = stored.table.groupBy("block")

    def send_probes(key: tuple, rows: pa.Table) -> pa.Table:
        return _Words(rows, width, buckets).probes_and_index(key[0].as_py())

    def send_windows(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        return _Words(rows, width, buckets).candidates(answers).message(key[0].as_py())

    def finish(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        words = _Words(rows, width, buckets)
        windows = np.zeros(len(words.hashes), bool)
        windows[words.candidates(answers).gone(answers)] = True
        covered = covered_by(windows, width, len(windows))

        def keep(t: int, kept: np.ndarray) -> bytes:
            return b" ".join([w for w, k in zip(words.block.texts[t].split(), kept.tolist(), strict=True) if k])

        return result_table(words.block, words.starts, words.ends, covered, keep)

    hits = checkpointed(table.applyInArrow(send_probes, MESSAGE).groupBy("bucket").applyInArrow(_hits, MESSAGE))
    windows = table.cogroup(hits.groupBy("block")).applyInArrow(send_windows, MESSAGE)
    smaller = checkpointed(windows.groupBy("bucket").applyInArrow(_smaller_elsewhere, MESSAGE))
    answers = hits.union(smaller)
    results = checkpointed(table.cogroup(answers.groupBy("block")).applyInArrow(finish, RESULT))
    stored.drop()
    return blocks.with_copies(docs, results, "n_words", width, text, id_column)
