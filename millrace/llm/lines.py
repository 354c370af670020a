"""Line dedup that can be taken back: exact reference counts, and cuckoo filters over them.

A line's key is the line without white space at its ends, in ASCII lower case; a ledger knows it by 128 bits of BLAKE2b.
The ledger counts for every key how many documents hold it. Documents are inserted and deleted; either way keys cross the
threshold from which a line is repeated. Keys are dealt into shards by their hash, and each shard has a cuckoo filter of
its repeated keys: 32-bit fingerprints in one of two buckets of four. A key that crosses upward is put in, one that
crosses downward is taken out, and nothing else of a filter changes. A shard's exact counts are what a filter falls back
on: it is built anew from them when it is full, and the keys of the ledger that it takes for repeated by mistake are found
with them and stored beside it. So for documents that the ledger holds a filter's word is exact.

Filters of all shards are broadcast while they are within ``FILTER_BYTES`` (checked before). Beyond that, or for documents
the ledger may not hold, the lines' keys are joined with the counts instead, with the same result.

Every change writes a new version beside the old ones: counts, then filters, then a row of settings. A version without its
last part is not there, so a job that died leaves the ledger as it was. Hot lines are folded in every batch before they are
shuffled, and a shard has about a million keys, whatever the number of documents.

Defined results: a null or empty text is one empty line. Lines shorter than ``min_chars`` code points without their white
space are never counted and never dropped. Each row is a document, whatever its id; equal rows count apart, null ids are
kept. Empty tables change nothing. Deleting documents that were not inserted is an error if a count would go below zero.
Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.errors import ConfigError
from millrace.llm.common import ASCII_LOWER, raw_texts
from millrace.workdir import fresh_dir

#: Keys that a shard has at most on average, and bytes of filters that are broadcast.
SHARD_KEYS = 1_000_000
FILTER_BYTES = 128 << 20
#: Fingerprints in a bucket, and the share of places that a new filter fills.
WIDTH, FILL = 4, 0.8
#: Rounds of moving fingerprints on before a filter is built anew, twice as large.
ROUNDS = 200
#: Documents that are taken together within a task.
TOGETHER = 1000

_U32, _U64 = np.uint32, np.uint64


def _prints(keys: np.ndarray) -> np.ndarray:
    """A fingerprint other than 0 of each key, a row of two 64-bit halves."""
    found = keys[:, 0].astype(_U64) & _U64(0xFFFFFFFF)
    return np.where(found == 0, 1, found).astype(_U32)


def _other(bucket: np.ndarray, prints: np.ndarray, mask: np.ndarray | int) -> np.ndarray:
    """The second bucket of a fingerprint, from either of the two."""
    mixed = (prints.astype(_U64) * _U64(0x5BD1E995)) >> _U64(7)
    return bucket ^ (mixed.astype(np.int64) & mask)


class Cuckoo:
    """A filter of ``buckets`` (a power of two) times four fingerprints."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots
        self.mask = len(slots) - 1

    @classmethod
    def of(cls, keys: np.ndarray) -> Cuckoo:
        """The smallest filter that holds all keys."""
        wanted = max(1, -(-len(keys) // int(WIDTH * FILL)))
        buckets = 1 << (wanted - 1).bit_length()
        while not (made := cls(np.zeros((buckets, WIDTH), _U32))).insert(keys):
            buckets *= 2
        return made

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return keys[:, 1].astype(np.int64) & self.mask

    def insert(self, keys: np.ndarray) -> bool:
        """Put in all keys at once; False if no place was found for one (the filter is then of no use)."""
        prints, bucket = _prints(keys), self._first(keys)
        moved = np.zeros(len(keys), bool)
        for turn in range(ROUNDS):
            if not len(prints):
                return True
            order = np.argsort(bucket, kind="stable")
            prints, bucket, moved = prints[order], bucket[order], moved[order]
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            place = np.arange(len(bucket)) - np.repeat(starts, np.diff(np.append(starts, len(bucket))))  # within the bucket
            free = np.argsort(self.slots[bucket[starts]] != 0, axis=1, kind="stable")
            room = (self.slots[bucket[starts]] == 0).sum(axis=1)
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(bucket))))
            fits = place < room[group]
            self.slots[bucket[fits], free[group[fits], place[fits]]] = prints[fits]
            prints, bucket, moved, place = prints[~fits], bucket[~fits], moved[~fits], place[~fits]
            # Whoever has tried one bucket tries the other; of those that have tried both, one in each bucket takes a place.
            fresh = ~moved
            bucket[fresh] = _other(bucket[fresh], prints[fresh], self.mask)
            old = np.flatnonzero(~fresh)
            old = old[np.unique(bucket[old], return_index=True)[1]]
            slot = (prints[old].astype(np.int64) + turn) % WIDTH
            out = self.slots[bucket[old], slot].copy()
            self.slots[bucket[old], slot] = prints[old]
            prints[old], bucket[old] = out, _other(bucket[old], out, self.mask)
            moved[:] = True
        return not len(prints)

    def delete(self, keys: np.ndarray) -> None:
        """Take out one fingerprint of each key; every key must have been put in."""
        prints, bucket = _prints(keys), self._first(keys)
        other = _other(bucket, prints, self.mask)
        while len(prints):
            # Keys of equal fingerprint and buckets go one after the other.
            todo = np.unique(np.minimum(bucket, other) << 32 | prints.astype(np.int64), return_index=True)[1]
            rest = np.ones(len(prints), bool)
            rest[todo] = False
            for side in (bucket, other):
                where = side[todo]
                hit = self.slots[where] == prints[todo][:, None]
                found = hit.any(axis=1)
                self.slots[where[found], hit[found].argmax(axis=1)] = 0
                todo = todo[~found]
            prints, bucket, other = prints[rest], bucket[rest], other[rest]

    def probe(self, keys: np.ndarray) -> np.ndarray:
        prints, bucket = _prints(keys), self._first(keys)
        one, two = self.slots[bucket], self.slots[_other(bucket, prints, self.mask)]
        return ((one == prints[:, None]) | (two == prints[:, None])).any(axis=1)


class Filters:
    """The filters of all shards, with the keys that they are wrong about."""

    def __init__(self, shards: int, rows: list[tuple[int, bytes, bytes]]):
        self.shards = shards
        self.cuckoos = {shard: Cuckoo(np.frombuffer(slots, _U32).reshape(-1, WIDTH)) for shard, slots, _ in rows}
        self.wrong = {key for _, _, wrong in rows for key in map(tuple, np.frombuffer(wrong, np.int64).reshape(-1, 2).tolist())}

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        shard = shard_of(keys[:, 0], self.shards)
        found = np.zeros(len(keys), bool)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.append(True, shard[order][1:] != shard[order][:-1])) if len(keys) else []
        for start, end in zip(cuts, [*cuts[1:], len(keys)], strict=True):
            some = order[start:end]
            if (cuckoo := self.cuckoos.get(int(shard[some[0]]))) is not None:
                found[some] = cuckoo.probe(keys[some])
        if self.wrong:
            found[[k for k in np.flatnonzero(found) if tuple(keys[k].tolist()) in self.wrong]] = False
        return found


def shard_of(high: np.ndarray, shards: int) -> np.ndarray:
    """Shards (a power of two) by the first half's upper bits."""
    return (high.astype(np.int64) >> 32) & (shards - 1)


def _lines(raw: bytes | None, min_chars: int) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text and the hash of each one's key; None for lines that do not count."""
    raw = raw or b""
    hashes: list[bytes | None] = []
    for key in raw.translate(ASCII_LOWER).split(b"\n"):
        key = key.strip()  # for bytes, just the six ASCII white space characters
        enough = len(key) >= min_chars and (min_chars <= 1 or sum(b & 0xC0 != 0x80 for b in key) >= min_chars)
        hashes.append(blake2b(key, digest_size=16).digest() if key and enough else None)
    return raw.split(b"\n"), hashes


def _halves(hashes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(start, TOGETHER)


def _record(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns], names.split())


def counted(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """(a, b, docs): how many documents hold each key."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter()
            for raw in raw_texts(batch["text"]):
                found.update({h for h in _lines(raw, min_chars)[1] if h is not None})
            keys = _halves(list(found))
            yield _record("a b docs", keys[:, 0], keys[:, 1], np.array(list(found.values()), np.int64))

    each = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "a bigint, b bigint, docs bigint")
    return each.groupBy("a", "b").agg(F.sum("docs").alias("docs"))


@dataclass(frozen=True)
class Ledger:
    """One version of the counts and filters below ``path``. Changes give the next one; this one stays as it is."""

    spark: SparkSession
    path: str
    version: str | None
    shards: int
    min_docs: int
    min_chars: int

    @classmethod
    def create(cls, spark: SparkSession, path: str | None = None, min_docs: int = 10, min_chars: int = 1) -> Ledger:
        if min_docs < 1 or min_chars < 1:
            raise ConfigError("min_docs and min_chars are at least 1")
        return cls(spark, path or fresh_dir(spark, "lines"), None, 1, min_docs, min_chars)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Ledger:
        """The newest complete version."""
        try:
            settings = spark.read.parquet(f"{path}/settings").orderBy(F.desc("number")).first()
        except AnalysisException as error:
            raise ConfigError(f"no ledger at {path}") from error
        return cls(spark, path, settings["version"], settings["shards"], settings["min_docs"], settings["min_chars"])

    def counts(self) -> DataFrame:
        """(a, b, docs) of the keys that a document holds."""
        if self.version is None:
            return self.spark.createDataFrame([], "a bigint, b bigint, docs bigint")
        return self.spark.read.parquet(f"{self.path}/{self.version}/counts").filter("docs > 0").select("a", "b", "docs")

    def filters(self) -> DataFrame:
        """(shard, slots, wrong): each shard's filter and the cold keys that it takes for repeated."""
        if self.version is None:
            return self.spark.createDataFrame([], "shard int, slots binary, wrong binary")
        return self.spark.read.parquet(f"{self.path}/{self.version}/filters")

    def insert(self, docs: DataFrame, text: str = "text") -> Ledger:
        return self._changed(docs, text, 1)

    def delete(self, docs: DataFrame, text: str = "text") -> Ledger:
        return self._changed(docs, text, -1)

    def _changed(self, docs: DataFrame, text: str, sign: int) -> Ledger:
        spark, least = self.spark, self.min_docs
        version = f"version-{uuid.uuid4().hex}"
        folder = f"{self.path}/{version}"
        delta = counted(docs, text, self.min_chars).select("a", "b", F.lit(0).cast("bigint").alias("before"), (sign * F.col("docs")).alias("delta"))
        known = self.counts().select("a", "b", F.col("docs").alias("before"), F.lit(0).cast("bigint").alias("delta"))
        now = F.sum("before") + F.sum("delta")
        checked = F.when(now < 0, F.raise_error(F.lit("documents are deleted that the ledger does not hold"))).otherwise(now)
        both = known.unionByName(delta) if self.version else delta
        both.groupBy("a", "b").agg(F.sum("before").alias("before"), checked.cast("bigint").alias("docs")).write.parquet(f"{folder}/counts")
        counts = spark.read.parquet(f"{folder}/counts")
        shards = self.shards
        while counts.count() > shards * SHARD_KEYS:
            shards *= 2

        def build(key, table: pa.Table, old: pa.Table) -> pa.Table:
            keys = np.stack([table["a"].to_numpy(), table["b"].to_numpy()], axis=1).reshape(-1, 2)
            before, docs = table["before"].to_numpy() >= least, table["docs"].to_numpy() >= least
            cuckoo = None
            if old.num_rows:
                cuckoo = Cuckoo(np.frombuffer(old["slots"][0].as_py(), _U32).reshape(-1, WIDTH).copy())
                cuckoo.delete(keys[before & ~docs])
            if cuckoo is None or not cuckoo.insert(keys[docs & ~before]):
                cuckoo = Cuckoo.of(keys[docs])
            cold = keys[~docs]
            wrong = cold[cuckoo.probe(cold)]
            return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "slots": pa.array([cuckoo.slots.tobytes()], pa.binary()),
                             "wrong": pa.array([np.ascontiguousarray(wrong).tobytes()], pa.binary())})

        by_shard = F.shiftright("a", 32).bitwiseAND(F.lit(shards - 1)).cast("int")
        old = self.filters() if shards == self.shards else spark.createDataFrame([], "shard int, slots binary, wrong binary")
        dealt = counts.withColumn("shard", by_shard).groupBy("shard").cogroup(old.groupBy("shard"))
        dealt.applyInArrow(build, "shard int, slots binary, wrong binary").write.parquet(f"{folder}/filters")
        number = 0 if self.version is None else spark.read.parquet(f"{self.path}/settings").agg(F.max("number")).first()[0] + 1
        settings = spark.createDataFrame([(number, version, shards, least, self.min_chars)], "number bigint, version string, shards int, min_docs int, min_chars int")
        settings.coalesce(1).write.mode("append").parquet(f"{self.path}/settings")
        return Ledger(spark, self.path, version, shards, least, self.min_chars)

    def without_repeats(self, docs: DataFrame, text: str = "text", id_column: str = "doc_id", inserted: bool = True,
                        filter_bytes: int = FILTER_BYTES) -> DataFrame:
        """(doc_id, n_lines, n_dropped, kept): every document without the lines that ``min_docs`` documents or more hold.

        ``inserted``: the ledger holds all these documents, so that filters decide alone where they can be broadcast.
        """
        narrow = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
        size = self.filters().agg(F.sum(F.octet_length("slots") + F.octet_length("wrong"))).first()[0] or 0
        return self._by_filters(narrow) if inserted and size <= filter_bytes else self._by_counts(narrow)

    def _by_filters(self, narrow: DataFrame) -> DataFrame:
        min_chars = self.min_chars
        rows = [(r["shard"], bytes(r["slots"]), bytes(r["wrong"])) for r in self.filters().collect()]  # within the checked size
        sent = self.spark.sparkContext.broadcast((self.shards, rows))

        def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = Filters(*sent.value)
            for batch in _parts(batches):
                texts = [_lines(raw, min_chars) for raw in raw_texts(batch["text"])]
                hashes = [h for _, found in texts for h in found if h is not None]
                answers = iter(filters.repeated(_halves(hashes)).tolist())
                yield _stripped(batch["doc_id"], ((lines, [h is not None and next(answers) for h in found]) for lines, found in texts))

        kind = narrow.schema["doc_id"].dataType.simpleString()
        return narrow.mapInArrow(drop, f"doc_id {kind}, n_lines bigint, n_dropped bigint, kept string")

    def _by_counts(self, narrow: DataFrame) -> DataFrame:
        min_chars = self.min_chars
        path = fresh_dir(self.spark, "rows")
        narrow.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
        stored = self.spark.read.parquet(path)

        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _parts(batches):
                found = [list({h for h in _lines(raw, min_chars)[1] if h is not None}) for raw in raw_texts(batch["text"])]
                halves = _halves([h for some in found for h in some])
                yield _record("row a b", np.repeat(batch["row"].to_numpy(), [len(some) for some in found]), halves[:, 0], halves[:, 1])

        def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _parts(batches):
                texts = [_lines(raw, min_chars) for raw in raw_texts(batch["text"])]
                gone = [{(r["a"], r["b"]) for r in some or ()} for some in batch["gone"].to_pylist()]
                marked = ((lines, [h is not None and tuple(_halves([h])[0].tolist()) in known for h in found] if known else [False] * len(found))
                          for (lines, found), known in zip(texts, gone, strict=True))
                yield _stripped(batch["doc_id"], marked)

        repeated = self.counts().filter(F.col("docs") >= self.min_docs).select("a", "b")
        # One side has every key once; where a key of the other is in very many documents, adaptive execution cuts its partition.
        hits = stored.select("row", "text").mapInArrow(keys, "row bigint, a bigint, b bigint").join(repeated, ["a", "b"])
        gone = hits.groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("gone"))
        kind = narrow.schema["doc_id"].dataType.simpleString()
        joined = stored.join(gone, "row", "left").select("doc_id", "text", "gone")
        return joined.mapInArrow(drop, f"doc_id {kind}, n_lines bigint, n_dropped bigint, kept string")


def _stripped(ids: pa.Array, texts) -> pa.RecordBatch:
    """The result's rows for texts given as their lines and which of them go."""
    n_lines, n_dropped, kept = [], [], []
    for lines, goes in texts:
        n_lines.append(len(lines))
        n_dropped.append(sum(goes))
        kept.append(b"\n".join(line for line, gone in zip(lines, goes, strict=True) if not gone))
    return _record("doc_id n_lines n_dropped kept", ids, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()))
