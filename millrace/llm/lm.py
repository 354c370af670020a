"""Language-model scores from a log-frequency Bloom filter.

Training counts words and pairs of neighbours. A count c is held as a level, 1 + floor(2 * log2(c)): the filter has a
key for every level up to it, so that probing levels upwards until the first miss gives the count back, at most a factor
of 1.42 too small. Each segment of the n-grams (by hash) gets a filter sized for its own keys.

The probability of a word w after v is ``(1 - weight) * p(w) + weight * count(v w) / count(v)``, where p smooths the
word's count as the base does; a context's count is rounded up and a pair's down, so that nothing exceeds 1 but by false
positives, of which there are fewer than 1 in 100 probes. Unseen contexts leave p alone.

The filter is broadcast. Its size is known before: what exceeds `FILTER_BYTES` goes in several rounds, each with some
segments, and the levels found so far travel with the documents. The exact counts, which the base needs, are broadcast
for the words that make up at least 1 in `HEAD` of all tokens, of which there are at most `HEAD`; for rarer words they
are joined.

Defined results: a null or blank text is one token, the end. A null id counts as an empty one for the hold-out. Equal
rows each get their row. Without training text N and V are 0, every count is 0, and scores follow from the same
formulas. Only the id and the text are read; ``docs`` must give the same rows in the same order when read again.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import SCATTER, by_bucket, scatter
from millrace.llm.common import ASCII_LOWER, free_unused, map_batches, raw_texts, text_bytes
from millrace.workdir import checkpointed

HEAD = 1 << 20
FILTER_BYTES = 256 << 20
BITS_PER_KEY, PROBES = 10, 6
#: Bytes of text whose n-grams make one segment, and of texts that are counted together.
SEGMENT_BYTES, GROUP_BYTES = 32_000_000, 5_000_000
WEIGHT = 0.4
LEVELS = 128

END, START = np.uint64(xxhash.xxh3_64_intdigest(b"\n")), np.uint64(xxhash.xxh3_64_intdigest(b"\t"))
#: kind 0: words, kind 1: pairs.
COUNTS = "segment int, kind int, hashes binary, counts binary"
MODEL = "segment int, words bigint, tokens bigint, hashes binary, counts binary, bits binary"


def tokens(text: bytes | None) -> np.ndarray:
    """Hashes of the lower-cased words, then of the end."""
    words = text.translate(ASCII_LOWER).split() if text else []
    return np.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), END)


def _pairs(t: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    before = np.append(START, t[:-1]) if len(t) else t
    before[starts] = START
    return before, scatter(before * SCATTER[0] + t)


def _groups(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text or b"")
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _segment(h: np.ndarray, segments: int) -> np.ndarray:
    return ((scatter(h) >> np.uint64(32)) % np.uint64(segments)).astype(np.int64)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.where(counts > 0, 1 + np.floor(2 * np.log2(np.maximum(counts, 1)) + 1e-9), 0).astype(np.int64)


def _trained(rows: pa.Table) -> pa.Table:
    """The counts and the filter of one segment."""
    merged = []
    for kind in (0, 1):
        mine = rows.filter(pc.equal(rows["kind"], kind))
        hashes = np.concatenate([np.frombuffer(x, "<u8") for x in mine["hashes"].to_pylist()] or [np.zeros(0, np.uint64)])
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in mine["counts"].to_pylist()] or [np.zeros(0, np.uint32)])
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order].astype(np.int64)
        cuts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
        merged.append((hashes[cuts], np.add.reduceat(counts, cuts) if len(cuts) else counts))
    levels = [level_of(counts) for _, counts in merged]
    size = max(64, -(-int(sum(x.sum() for x in levels)) * BITS_PER_KEY // 8)) * 8
    bits = np.zeros(size, bool)
    for (hashes, _), level in zip(merged, levels, strict=True):
        for k in range(1, int(level.max(initial=0)) + 1):
            a = scatter(hashes[level >= k] + np.uint64(k) * SCATTER[1])
            b = scatter(a ^ SCATTER[2]) | np.uint64(1)
            for probe in range(PROBES):
                bits[(a + np.uint64(probe) * b) % np.uint64(size)] = True
    (words, counts), _ = merged
    row = (rows["segment"][0].as_py(), len(words), int(counts.sum()), words.astype("<u8").tobytes(), counts.astype("<i8").tobytes(), np.packbits(bits).tobytes())
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array([c], k) for c, k in zip(row, kinds, strict=True)], names=["segment", "words", "tokens", "hashes", "counts", "bits"])


@dataclass(frozen=True)
class Model:
    """A trained model: one row per segment in the shared folder."""

    table: DataFrame
    segments: int
    n: int
    v: int

    @property
    def floor(self) -> float:
        return self.n + 0.1 * (self.v + 1)

    @property
    def rare(self) -> float:
        """Words with fewer tokens than this are joined; at most `HEAD` words have as many."""
        return self.n / HEAD

    def head(self) -> tuple[np.ndarray, np.ndarray]:
        least = self.rare

        def pick(batch: pa.RecordBatch) -> pa.RecordBatch:
            h, c = _blobs(batch)
            often = c >= least
            return pa.RecordBatch.from_arrays([pa.array([h[often].tobytes()], pa.binary()), pa.array([c[often].tobytes()], pa.binary())], ["h", "c"])

        rows = map_batches(self.table.select("hashes", "counts"), pick, "h binary, c binary").collect()
        h = np.frombuffer(b"".join(r["h"] for r in rows), "<u8")
        order = np.argsort(h)
        return h[order], np.frombuffer(b"".join(r["c"] for r in rows), "<i8")[order]

    def tail(self) -> DataFrame:
        """(hash, count) of the rarer words."""
        least = self.rare

        def pick(batch: pa.RecordBatch) -> pa.RecordBatch:
            h, c = _blobs(batch)
            seldom = c < least
            return pa.RecordBatch.from_arrays([pa.array(h[seldom].view(np.int64)), pa.array(c[seldom])], ["hash", "count"])

        return map_batches(self.table.select("hashes", "counts"), pick, "hash bigint, count bigint")

    def rounds(self, most: int) -> Iterator[list[int]]:
        """Segments whose filters together stay within ``most`` bytes (a single larger one goes alone)."""
        group, size = [], 0
        for row in self.table.select("segment", F.octet_length("bits").alias("size")).orderBy("segment").collect():
            if group and size + row["size"] > most:
                yield group
                group, size = [], 0
            group.append(row["segment"])
            size += row["size"]
        yield group

    def filters(self, group: list[int]) -> tuple[list[tuple[int, int]], np.ndarray]:
        """(segment, bytes) in order, and their filters in one array, filled partition by partition."""
        rows = self.table.filter(F.col("segment").isin(group))
        total = rows.agg(F.sum(F.octet_length("bits"))).first()[0] or 0
        bits, sizes, at = np.zeros(total, np.uint8), [], 0
        for row in rows.select("segment", "bits").toLocalIterator():
            bits[at : at + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
            sizes.append((row["segment"], len(row["bits"])))
            at += len(row["bits"])
        return sizes, bits


def _blobs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    h = np.frombuffer(b"".join(batch["hashes"].to_pylist()), "<u8")
    return h, np.frombuffer(b"".join(batch["counts"].to_pylist()), "<i8")


def train(docs: DataFrame, text: str = "text", segment_bytes: int = SEGMENT_BYTES) -> Model:
    spark = docs.sparkSession
    segments = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(text_bytes(docs, text) / segment_bytes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in _groups(raw_texts(batch["text"])):
                each = [tokens(t) for t in group]
                t = np.concatenate(each)
                starts = np.cumsum([0, *map(len, each[:-1])])
                rows = []
                for kind, h in ((0, t), (1, _pairs(t, starts)[1])):
                    values, counts = np.unique(h, return_counts=True)
                    where = _segment(values, segments)
                    order = np.argsort(where, kind="stable")
                    values, counts, where = values[order], counts[order], where[order]
                    rows += [(s, kind, values[i:j].astype("<u8").tobytes(), counts[i:j].astype("<u4").tobytes()) for s, i, j in by_bucket(where, len(where))]
                kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["segment", "kind", "hashes", "counts"])

    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, COUNTS)
    table = checkpointed(counted.groupBy("segment").applyInArrow(_trained, MODEL))
    total = table.agg(F.sum("tokens"), F.sum("words")).first()
    return Model(table, segments, int(total[0] or 0), int(total[1] or 0))


class _Probe:
    """Some segments' filters, side by side."""

    def __init__(self, filters: tuple[list[tuple[int, int]], np.ndarray], segments: int):
        self.segments = segments
        sizes, self.bits = filters
        self.sizes, self.offsets = np.zeros(segments, np.uint64), np.zeros(segments, np.uint64)
        at = 0
        for segment, size in sizes:
            self.sizes[segment], self.offsets[segment] = size * 8, at * 8
            at += size

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The highest level of each n-gram that, with all below it, is in these filters."""
        values, which = np.unique(h, return_inverse=True)
        where = _segment(values, self.segments)
        left = np.flatnonzero(self.sizes[where])
        found = np.zeros(len(values), np.uint8)
        for level in range(1, LEVELS):
            if not len(left):
                break
            a = scatter(values[left] + np.uint64(level) * SCATTER[1])
            b = scatter(a ^ SCATTER[2]) | np.uint64(1)
            size, offset = self.sizes[where[left]], self.offsets[where[left]]
            for k in range(PROBES):
                at = (a + np.uint64(k) * b) % size + offset
                there = (self.bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1
                left, a, b, size, offset = left[there], a[there], b[there], size[there], offset[there]
            found[left] = level
        return found[which]


_PROBES: dict[str, tuple] = {}


def _shared(value: Broadcast, segments: int) -> tuple[_Probe, np.ndarray, np.ndarray]:
    """One probe for each Python process and round."""
    name, filters, head_hashes, head_counts = value.value
    if name not in _PROBES:
        _PROBES.clear()
        _PROBES[name] = (_Probe(filters, segments), head_hashes, head_counts)
    return _PROBES[name]


def score(docs: DataFrame, model: Model, text: str = "text", id_column: str = "doc_id", weight: float = WEIGHT,
          filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, base_score, score."""
    spark = docs.sparkSession
    free_unused(spark)  # what training shuffled
    kind = docs.select(F.col(f"`{id_column}`")).schema[0].dataType.simpleString()
    head_hashes, head_counts = model.head()
    segments, floor = model.segments, model.floor
    place = F.monotonically_increasing_id()
    frame = docs.select(place.alias("row"), F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.lit(None).cast("binary").alias("levels"))
    groups = list(model.rounds(filter_bytes))
    for turn, group in enumerate(groups):
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, model.filters(group), head_hashes, head_counts))
        final = turn + 1 == len(groups)

        def probe(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared, final: bool = final) -> Iterator[pa.RecordBatch]:
            filters, hashes, counts = _shared(shared, segments)
            for batch in batches:
                done, levels = 0, batch["levels"].to_pylist()
                for texts in _groups(raw_texts(batch["text"])):
                    part = batch.slice(done, len(texts))
                    each = [tokens(t) for t in texts]
                    t, sizes = np.concatenate(each), np.array(list(map(len, each)))
                    starts = np.cumsum(sizes) - sizes
                    before, pairs = _pairs(t, starts)
                    words = filters.levels(t)
                    context = np.append(np.uint8(0), words[:-1])  # that of the word before
                    context[starts] = 0
                    found = np.stack([filters.levels(pairs), context, words])
                    known = levels[done : done + len(texts)]
                    if known and known[0] is not None:
                        found = np.maximum(found, np.concatenate([np.frombuffer(x, np.uint8).reshape(3, -1) for x in known], axis=1))
                    done += len(texts)
                    if not final:
                        packed = [found[:, a : a + n].tobytes() for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays([part["row"], part["doc_id"], part["text"], pa.array(packed, pa.binary())], part.schema.names)
                        continue
                    yield pa.RecordBatch.from_arrays(
                        [part["row"], part["doc_id"], *_scored(t, starts, sizes, found, before, hashes, counts, floor, weight)],
                        ["row", "doc_id", "n_tokens", "head_known", "head_score", "score", "tail"],
                    )

        if final:
            frame = frame.mapInArrow(probe, f"row bigint, doc_id {kind}, n_tokens bigint, head_known bigint, head_score double, score double, tail array<bigint>")
        else:
            frame = checkpointed(frame.mapInArrow(probe, frame.schema))
    scored = checkpointed(frame)
    each = scored.select("row", F.explode("tail").alias("hash")).join(model.tail(), "hash", "left")
    count = F.coalesce("count", F.lit(0))
    rest = each.groupBy("row").agg(F.sum(F.log10((count + 0.1) / F.lit(floor))).alias("tail_score"), F.sum((count > 0).cast("bigint")).alias("tail_known"))
    return scored.join(rest, "row", "left").select(
        "doc_id", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        (F.col("head_score") + F.coalesce("tail_score", F.lit(0.0))).alias("base_score"), "score",
    )


def _scored(t, starts, sizes, levels, before, hashes, counts, floor, weight) -> list[pa.Array]:
    at = np.minimum(np.searchsorted(hashes, t), max(0, len(hashes) - 1))
    often = hashes[at] == t if len(hashes) else np.zeros(len(t), bool)
    count = np.where(often, counts[at], 0) if len(hashes) else np.zeros(len(t))
    base = np.where(often, np.log10((count + 0.1) / floor), 0.0)
    pair, context, word = levels.astype(np.float64)
    context[before == START] = 0  # how often texts start is not counted
    low = lambda level: np.where(level > 0, 2 ** ((level - 1) / 2), 0)
    alone = (low(word) + 0.1) / floor
    after = np.where(context > 0, np.minimum(1, low(pair) / np.maximum(1, 2 ** (context / 2))), 0)
    use = np.where(context > 0, weight, 0)
    logs = np.log10((1 - use) * alone + use * after)
    ends = (starts + sizes).tolist()
    seldom = [t[a:b][~often[a:b]].view(np.int64) for a, b in zip(starts.tolist(), ends, strict=True)]
    return [
        pa.array(sizes, pa.int64()), pa.array(np.add.reduceat(often.astype(np.int64), starts)), pa.array(np.add.reduceat(base, starts)),
        pa.array(np.add.reduceat(logs, starts)), pa.array(seldom, pa.list_(pa.int64())),
    ]
