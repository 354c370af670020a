"""Benchmark decontamination with an Aho-Corasick automaton.

Texts become words: A-Z in lower case, runs of digits, letters and any byte beyond ASCII; all else separates. A window
is ``size`` consecutive words of a benchmark item (the whole item if it has fewer). One automaton over all windows, its
alphabet the words of the benchmark, reads every document once and names each occurrence by the places of its words, for
which the byte offsets in the original text are kept.

The windows are the only thing sent to all workers. They are counted first; where they exceed `BLOCK_WORDS`, they are
dealt by hash into several automata of at most about that size, the documents are read once for each, and the hits are
put together by row.

Defined results: a null or empty text has no words and no hits. An item without words is in no window; a null item_id
counts as an empty name; an item given twice counts once. Equal rows each get their result. Other columns are not read,
or, in `keep_clean`, carried along untouched.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, raw_texts
from millrace.workdir import checkpointed

#: Words of windows in one automaton; one word is at most one node of about 100 bytes.
BLOCK_WORDS = 2_000_000

_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _SEPARATORS, b"abcdefghijklmnopqrstuvwxyz" + b" " * len(_SEPARATORS))

RANGE = "array<struct<word:int,word_end:int,byte:int,byte_end:int>>"
HITS = f"n_words bigint, ranges {RANGE}, items array<string>"


def normal_words(text: bytes | None) -> list[bytes]:
    """Translation keeps every byte's place, so that words can be found again in the original."""
    return text.translate(_NORMAL).split() if text else []


def windows(benchmark: DataFrame, size: int, text: str, item_id: str) -> DataFrame:
    """Distinct (window, item), a window as its words joined by spaces."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, names = [], []
        for name, raw in zip(batch["item"].to_pylist(), raw_texts(batch["text"]), strict=True):
            words = normal_words(raw)
            for k in range(max(1, len(words) - size + 1) if words else 0):
                found.append(b" ".join(words[k : k + size]))
                names.append(name)
        return pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(names, pa.string())], ["window", "item"])

    items = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{text}`").alias("text"))
    return map_batches(items, cut, "window binary, item string").distinct()


class Matcher:
    """The automaton of one block of windows."""

    def __init__(self, rows: list[tuple[bytes, str]]):
        self.words: dict[bytes, int] = {}
        self.names: list[str] = []
        self.lengths: list[int] = []
        self.owners: list[list[int]] = []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        names: dict[str, int] = {}
        at: dict[bytes, int] = {}
        for window, name in rows:
            if window not in at:
                at[window] = len(self.owners)
                key = tuple(self.words.setdefault(w, len(self.words) + 1) for w in window.split())
                self.automaton.add_word(key, at[window])
                self.lengths.append(len(key))
                self.owners.append([])
            if name not in names:
                names[name] = len(self.names)
                self.names.append(name)
            self.owners[at[window]].append(names[name])
        if self.owners:
            self.automaton.make_automaton()

    def scan(self, text: bytes | None) -> tuple[int, list[dict], list[str]]:
        """Words, maximal ranges of hit words, and the names of the items with an occurring window."""
        words = normal_words(text)
        if not self.owners or not words:
            return len(words), [], []
        ranges: list[list[int]] = []
        windows: set[int] = set()
        for last, window in self.automaton.iter(tuple(map(self.words.get, words, repeat(0)))):
            windows.add(window)
            start = last + 1 - self.lengths[window]
            while ranges and ranges[-1][0] > start:
                ranges.pop()
            if ranges and start <= ranges[-1][1]:
                ranges[-1][1] = last + 1
            else:
                ranges.append([start, last + 1])
        items = sorted({self.names[k] for w in windows for k in self.owners[w]})
        return len(words), _placed(text, words, ranges), items


def _placed(text: bytes, words: list[bytes], ranges: list[list[int]]) -> list[dict]:
    """Word ranges with their byte offsets in the text as it was."""
    found, at, k = [], 0, 0
    normal = text.translate(_NORMAL) if ranges else b""
    for first, end in ranges:
        places = []
        for wanted in (first, end - 1):
            while k <= wanted:
                at = normal.index(words[k], at)
                begin, at = at, at + len(words[k])
                k += 1
            places.append((begin, at))
        found.append({"word": first, "word_end": end, "byte": places[0][0], "byte_end": places[1][1]})
    return found


_MATCHERS: dict[str, Matcher] = {}


def _matcher(rows: Broadcast) -> Matcher:
    """One automaton for each Python process and block."""
    name, windows_of_block = rows.value
    if name not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[name] = Matcher(windows_of_block)
    return _MATCHERS[name]


def _blocks(benchmark: DataFrame, size: int, text: str, item_id: str, block_words: int) -> Iterator[Broadcast]:
    found = checkpointed(windows(benchmark, size, text, item_id))
    context = benchmark.sparkSession.sparkContext
    n = max(1, math.ceil(found.count() * size / block_words))
    for block in range(n):
        part = found if n == 1 else found.filter(F.pmod(F.xxhash64("window", "item"), F.lit(n)) == block)
        rows = [(bytes(row["window"]), row["item"]) for row in part.orderBy("window", "item").collect()]
        yield context.broadcast((uuid.uuid4().hex, rows))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, text: str = "text", id_column: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, ``ranges`` of hit words with byte offsets, ``items`` (sorted names).

    ``docs`` must give the same rows in the same order when it is read again, as a stored table does.
    """
    kind = docs.select(F.col(f"`{id_column}`")).schema[0].dataType.simpleString()
    narrow = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    blocks = list(_blocks(benchmark, size, item_text, item_id, block_words))
    numbered = narrow.withColumn("row", F.monotonically_increasing_id()) if len(blocks) > 1 else narrow.withColumn("row", F.lit(0).cast("bigint"))

    def scanned(rows: Broadcast) -> DataFrame:
        def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
            matcher = _matcher(rows)
            n, ranges, items = zip(*map(matcher.scan, raw_texts(batch["text"])), strict=True) if batch.num_rows else ((), (), ())
            shape = pa.list_(pa.struct([(k, pa.int32()) for k in ("word", "word_end", "byte", "byte_end")]))
            columns = [pa.array(n, pa.int64()), pa.array(ranges, shape), pa.array(items, pa.list_(pa.string()))]
            return pa.RecordBatch.from_arrays([batch["doc_id"], batch["row"], *columns], ["doc_id", "row", "n_words", "ranges", "items"])

        return map_batches(numbered, scan, f"doc_id {kind}, row bigint, {HITS}")

    if len(blocks) == 1:
        return scanned(blocks[0]).drop("row")
    # Each block was a pass of its own: the hits of a row meet, and overlapping ranges are merged.
    parts = scanned(blocks[0])
    for rows in blocks[1:]:
        parts = parts.unionByName(scanned(rows))
    met = parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list("ranges"))).alias("ranges"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )

    def merged(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = pa.array([_merged(ranges) for ranges in batch["ranges"].to_pylist()], batch["ranges"].type)
        return batch.set_column(batch.schema.get_field_index("ranges"), "ranges", column)

    return map_batches(met.select("doc_id", "n_words", "ranges", "items"), merged, f"doc_id {kind}, {HITS}")


def _merged(ranges: list[dict]) -> list[dict]:
    out: list[dict] = []
    for r in ranges:
        if out and r["word"] <= out[-1]["word_end"]:
            if r["word_end"] > out[-1]["word_end"]:
                out[-1] |= {"word_end": r["word_end"], "byte_end": r["byte_end"]}
        else:
            out.append(dict(r))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = 10, text: str = "text", item_text: str = "text",
               item_id: str = "item_id", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents in which no window occurs, as they are. With several blocks each pass filters what the last one left."""
    blocks = list(_blocks(benchmark, size, item_text, item_id, block_words))
    for k, rows in enumerate(blocks):

        def clean(batch: pa.RecordBatch, rows: Broadcast = rows) -> pa.RecordBatch:
            matcher = _matcher(rows)
            return batch.filter(pa.array([not matcher.scan(raw)[1] for raw in raw_texts(batch[text])], pa.bool_()))

        docs = map_batches(docs, clean, docs.schema)
        if k + 1 < len(blocks):
            docs = checkpointed(docs)
    return docs
