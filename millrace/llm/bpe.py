"""Byte-level BPE by monoid tree reduction.

A text is cut into halves again and again; short pieces are encoded directly; neighbours are joined. The elements are
(text, ids), and joining is exact, so any tree gives the same ids:

* Before a space that a non-space follows, the pattern always starts a new match, in the piece as in the whole: no
  match class takes an inner space, white space runs stop short of that last space, and nothing looks back. To join two
  pieces, a window around the border is encoded again. It grows until it reaches such a space (or the end of the text)
  on either side; ids outside it provably stay as they are.
* Within one match, ranks decide. A sequence of ids is what merging by rank gives if and only if each two neighbours
  are what merging gives for their bytes. A long match is halved too; the window around the border grows until it
  agrees with the id before it and the id after it.

Decoding concatenates up the same tree.

Defined results: null and empty texts have no ids. Equal rows each get their row. Other columns are carried along;
the computed ones get the names asked for.
"""

from __future__ import annotations

import base64
import heapq
import os
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from millrace.llm.common import map_batches

#: Characters of a piece that is encoded directly, and bytes of a match that are merged directly.
LEAF_CHARS = 16_384
LEAF_BYTES = 48
#: Bytes of the texts whose new pieces are merged together.
GROUP_BYTES = 2_000_000
#: Bytes from which merging keeps a heap.
MANY_BYTES = 200
UNRANKED = 1 << 62
#: Distinct pieces between spaces and matches whose ids a worker remembers, and pairs of tokens whose verdict it does.
REMEMBERED = 200_000
REMEMBERED_MATCHES = 200_000
REMEMBERED_PAIRS = 200_000


class Codec:
    """One vocabulary: ``ranks`` by token bytes, ``pattern`` for the matches that are encoded separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.matches = regex.compile(pattern).findall
        self.bytes_to_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = sorted(
            (ranks[token[:k]] << 32 | ranks[token[k:]], rank)
            for token, rank in ranks.items() for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks
        )
        self.pair_keys, self.pair_ranks = np.array(pairs, np.int64).T.copy()
        self.known = _Memory(self._piece, REMEMBERED // 4)
        self.known_spaced = _Memory(lambda word: self._piece(" " + word), REMEMBERED)
        self.known_matches = _Memory(self._one, REMEMBERED_MATCHES)
        self.pairs = _Memory(self._pair, REMEMBERED_PAIRS)

    # Within one match.

    def _merged(self, data: bytes) -> list[int]:
        """Merge the neighbours of lowest rank, the first of equals first, until none has a rank."""
        ranks = self.ranks
        if data in ranks:
            return [ranks[data]]
        if len(data) > MANY_BYTES:
            return self._merged_many(data)
        rank = ranks.get
        parts = [data[k : k + 1] for k in range(len(data))]
        pairs = [rank(data[k : k + 2], UNRANKED) for k in range(len(data) - 1)]
        while (best := min(pairs)) != UNRANKED:
            at = pairs.index(best)
            parts[at : at + 2] = [merged] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if not pairs:
                break
            if at < len(pairs):
                pairs[at] = rank(merged + parts[at + 1], UNRANKED)
            if at:
                pairs[at - 1] = rank(parts[at - 1] + merged, UNRANKED)
        return [ranks[p] for p in parts]

    def _merged_many(self, data: bytes) -> list[int]:
        """The same with a heap of ranked neighbours over a linked list, for windows that had to grow far."""
        n, rank = len(data), self.ranks.get
        end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, k + 2) for k in range(n - 1) if (r := rank(data[k : k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, reach = heapq.heappop(heap)
            follower = after[k] if end[k] else n
            if not end[k] or follower >= n or end[follower] != reach:
                continue  # one of the two has been merged since
            end[k], end[follower], after[k] = reach, 0, after[follower]
            if after[k] < n:
                before[after[k]] = k
                if (r := rank(data[k : end[after[k]]])) is not None:
                    heapq.heappush(heap, (r, k, end[after[k]]))
            if (b := before[k]) >= 0 and (r := rank(data[b:reach])) is not None:
                heapq.heappush(heap, (r, b, reach))
        out, k = [], 0
        while k < n:
            out.append(self.ranks[data[k : end[k]]])
            k = after[k]
        return out

    def _pair(self, key: int) -> bool:
        a, b = key >> 32, key & 0xFFFFFFFF
        return self._merged(self.tokens[a] + self.tokens[b]) == [a, b]

    def pair(self, a: int, b: int) -> bool:
        return self.pairs[a << 32 | b]

    def match(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self._merged(data)
        half = len(data) // 2
        return self._join_matches(self.match(data[:half]), self.match(data[half:]))

    def _join_matches(self, left: list[int], right: list[int]) -> list[int]:
        if self.pair(left[-1], right[0]):
            return left + right
        size = 2
        while True:
            before, inner_left = left[:-size], left[-size:]
            inner_right, after = right[:size], right[size:]
            window = self._merged(b"".join(map(self.tokens.__getitem__, inner_left + inner_right)))
            if (not before or self.pair(before[-1], window[0])) and (not after or self.pair(window[-1], after[0])):
                return before + window + after
            size *= 4

    def merged_together(self, matches: list[bytes]) -> list[bytes]:
        """Packed ids of many short matches: in every round each match has its best pair merged, all at once."""
        if not matches:
            return []
        sizes = np.fromiter(map(len, matches), np.int64, len(matches))
        ids = self.bytes_to_ids[np.frombuffer(b"".join(matches), np.uint8)]
        owner = np.repeat(np.arange(len(matches)), sizes)
        done_ids, done_owner = [], []
        while len(ids):
            found = self._ranks_of(ids[:-1], ids[1:])
            found = np.append(np.where(owner[:-1] == owner[1:], found, UNRANKED), UNRANKED)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.repeat(np.minimum.reduceat(found, starts), np.diff(np.append(starts, len(ids))))
            whole = best == UNRANKED
            done_ids.append(ids[whole])
            done_owner.append(owner[whole])
            at = np.flatnonzero((found == best) & ~whole)
            at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])] if len(at) else at
            ids[at] = best[at]
            whole[at + 1] = True
            ids, owner = ids[~whole], owner[~whole]
        owner = np.concatenate(done_owner) if done_owner else owner
        order = np.argsort(owner, kind="stable")
        packed = (np.concatenate(done_ids)[order] if done_ids else ids).astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(owner, minlength=len(matches))) * 4
        return [packed[a:b] for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True)]

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], UNRANKED)

    def learn(self, texts: list[str]) -> None:
        """Remember the ids of all new pieces of some texts, so that their short matches are merged together."""
        words = set()
        for text in texts:
            if not _UNEVEN(text):
                words.update(text.split(" ")[1:])
        new = [word for word in words if len(word) < 64 and word not in self.known_spaced]
        cut = [self.matches(" " + word) for word in new]
        unknown = [m for m in {m for matches in cut for m in matches} if m not in self.known_matches]
        short = [(m, data) for m in unknown if len(data := m.encode()) <= LEAF_BYTES]
        if len(self.known_matches) + len(short) > self.known_matches.most:
            self.known_matches.clear()
        self.known_matches.update(zip([m for m, _ in short], self.merged_together([data for _, data in short]), strict=True))
        if len(self.known_spaced) + len(new) > self.known_spaced.most:
            self.known_spaced.clear()
        ids = self.known_matches.__getitem__
        self.known_spaced.update((word, b"".join(map(ids, matches))) for word, matches in zip(new, cut, strict=True))

    # Between matches.

    def _piece(self, piece: str) -> bytes:
        """Packed ids of a piece that is short or that no border runs through."""
        return b"".join(map(self.known_matches.__getitem__, self.matches(piece)))

    def _one(self, found: str) -> bytes:
        return array("I", self.match(found.encode())).tobytes()

    def leaf(self, text: str) -> bytes:
        """Packed ids of a short text: cut before each space that a non-space follows, and look the pieces up."""
        parts = text.split(" ")
        if len(parts) == 1:
            return self.known[text]
        if not _UNEVEN(text):
            first, *rest = parts
            return (self.known[first] if first else b"") + b"".join(map(self.known_spaced.__getitem__, rest))
        pieces = [parts[0]] if parts[0] else []
        held = "" if parts[0] else None
        for part in parts[1:]:
            if part and not part[0].isspace():
                if held:
                    pieces.append(held)
                held = None
                pieces.append(" " + part)
            elif pieces and held is None:
                held = pieces.pop() + " " + part
            else:
                held = (held or "") + " " + part
        if held:
            pieces.append(held)
        return b"".join(map(self.known.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(text) <= LEAF_CHARS:
            return self.leaf(text) if text else b""
        half = len(text) // 2
        left, right = text[:half], text[half:]
        return self.join(left, self.encode(left), right, self.encode(right))

    def join(self, left: str, left_ids: bytes, right: str, right_ids: bytes) -> bytes:
        size = 32
        while True:
            a, b = _first_border(left, max(0, len(left) - size)), _last_border(right, min(len(right), size))
            if (a is not None or size >= len(left)) and (b is not None or size >= len(right)):
                break
            size *= 2
        a, b = a or 0, len(right) if b is None else b
        keep_left = self._ids_for(left_ids, len(left[a:].encode()), from_end=True)
        keep_right = self._ids_for(right_ids, len(right[:b].encode()), from_end=False)
        window = left[a:] + right[:b]
        again = self.leaf(window) if len(window) <= 4 * LEAF_CHARS else self._piece(window)
        return left_ids[:keep_left] + again + right_ids[keep_right:]

    def _ids_for(self, ids: bytes, size: int, from_end: bool) -> int:
        """Where in the packed ids the token border lies that is so many bytes of text from the end or the start."""
        at = len(ids) if from_end else 0
        while size:
            at -= 4 if from_end else 0
            size -= len(self.tokens[int.from_bytes(ids[at : at + 4], "little")])
            at += 0 if from_end else 4
        return at

    def decode(self, ids: bytes) -> bytes:
        """Bytes of packed ids; halves are concatenated up the tree."""
        if len(ids) <= 4 * (1 << 16):
            return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))
        half = len(ids) // 8 * 4
        return self.decode(ids[:half]) + self.decode(ids[half:])


#: A space that no word follows.
_UNEVEN = regex.compile(r" (?:\s|$)").search


class _Memory(dict):
    """A bounded dictionary that fills itself."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, piece):
        made = self.make(piece)
        if isinstance(piece, int) or len(piece) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[piece] = made
        return made


def _border(text: str, k: int) -> bool:
    return text[k] == " " and k + 1 < len(text) and not text[k + 1].isspace()


def _first_border(text: str, start: int) -> int | None:
    """The first place from ``start`` on where a match surely starts; the text's start counts, its end does not."""
    if start == 0:
        return 0
    k = text.find(" ", start)
    while k >= 0:
        if _border(text, k):
            return k
        k = text.find(" ", k + 1)
    return None


def _last_border(text: str, end: int) -> int | None:
    k = text.rfind(" ", 1, end) if end > 1 else -1
    while k > 0:
        if _border(text, k):
            return k
        k = text.rfind(" ", 1, k) if k > 1 else -1
    return len(text) if end >= len(text) else None


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for each Python process and vocabulary."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(read_ranks(path), pattern)
    return _CODECS[path, pattern]


def public_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Path and pattern of a vocabulary that is installed on every node."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name)), public_tokenizers.PATTERN


def _slices(batch: pa.RecordBatch, sizes: list[int], most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose rows together have about ``most``."""
    start, size = 0, 0
    for k, n in enumerate(sizes):
        size += n
        if size >= most:
            yield batch.slice(start, k + 1 - start)
            start, size = k + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def _add(docs: DataFrame, column: str, into: str, make: Callable[[list], list[bytes]]) -> DataFrame:
    """One more binary column, made of slices of ``column`` at a time so that a worker holds little."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_pylist()
            for part in _slices(batch, sizes, GROUP_BYTES):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(make(part[column].to_pylist()), pa.binary())], [*part.schema.names, into])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, BinaryType())]))


def encode(docs: DataFrame, vocabulary: tuple[str, str], text: str = "text", into: str = "ids") -> DataFrame:
    """The input with its packed ids (binary) in one more column. ``vocabulary``: path on every node, and pattern."""

    def make(texts: list[str | None]) -> list[bytes]:
        found, texts = codec(*vocabulary), [t or "" for t in texts]
        found.learn(texts)
        return list(map(found.encode, texts))

    return _add(docs, text, into, make)


def decode(docs: DataFrame, vocabulary: tuple[str, str], ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The input with the bytes that its packed ids stand for in one more column."""
    return _add(docs, ids, into, lambda packed: [codec(*vocabulary).decode(i or b"") for i in packed])


def unpacked(docs: DataFrame, ids: str = "ids") -> DataFrame:
    """Packed ids as an array of integers."""

    def change(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = pa.array([None if i is None else array("I", i) for i in batch[ids].to_pylist()], pa.list_(pa.int32()))
        return batch.set_column(batch.schema.get_field_index(ids), ids, lists)

    fields = [StructField(f.name, ArrayType(IntegerType()) if f.name == ids else f.dataType) for f in docs.schema.fields]
    return map_batches(docs, change, StructType(fields))
