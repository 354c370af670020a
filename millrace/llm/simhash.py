"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits: bit i is set if more than half of the XXH64 values of a text's shingles have it set. Two
fingerprints within an even radius have a point in the middle, at most half the radius from both. So every distinct
fingerprint emits all variants within half the radius (65 for radius 2), the variants are shuffled, and fingerprints
that meet at a variant are linked to the smallest of them. At most as many distinct fingerprints as there are variants
can meet at one, so no group grows with the data; all of them are within the radius of each other, which is verified.
Copies share a fingerprint and are folded before anything is emitted.

Defined results: a null or blank text has no words and fingerprint zero, which links like any other. A text of fewer
words than a shingle has one shingle, the whole sequence. Null ids come last: a class whose ids are all null has the id
null. Equal rows each get their row; `keep_one` keeps one of them. Only the id and the text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from millrace.errors import ConfigError
from millrace.llm.blocks import SCATTER, scatter
from millrace.llm.common import ASCII_LOWER, free_unused, id_or_last, map_batches, raw_texts, unused
from millrace.llm.components import components
from millrace.workdir import checkpointed, fresh_dir

BITS = 64
#: Nodes of a print with all that it meets, or of one shingle, up to which all their pairs are made at once.
CROWD = 32
#: Nodes of a block in which sets are compared, on average.
BLOCK_NODES = 64
#: Nodes of a crowded shingle that are met in the first round, and how many times as many in each further one.
FEW, PARTNERS = 8, 64
#: Sets of up to so many shingles, whose fingerprints say little, are paired by their shingles.
SHORT = 20
#: First bits of a shingle's hash by which it is counted, and tasks' counts that are added in one task.
COUNTED_BITS, ADDED_AT_ONCE = 20, 16
#: Rows up to which the numbers of wanted texts are broadcast.
BROADCAST_ROWS = 1_000_000


def fingerprints(text: bytes | None, width: int, seeds: Sequence[int]) -> list[int]:
    """The fingerprints of one text under each seed, as unsigned integers."""
    words = text.translate(ASCII_LOWER).split() if text else []
    if not words:
        return [0] * len(seeds)
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False)))
    return [_majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), ">u8", len(shingles))) for seed in seeds]


def _majority(hashes: np.ndarray) -> int:
    if len(hashes) == 1:
        return int(hashes[0])
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, name: str, text: str, width: int, seeds: Sequence[int]) -> DataFrame:
    """The input, but for the text, with an array of fingerprints, one for each seed: signed bigints of the same bits."""
    seeds = list(seeds)

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprints(raw, width, seeds) for raw in raw_texts(batch[text])], np.uint64).reshape(-1)
        lists = pa.ListArray.from_arrays(np.arange(0, len(found) + 1, len(seeds), dtype=np.int32), pa.array(found.view(np.int64)))
        rest = [k for k in batch.schema.names if k != text]
        return pa.RecordBatch.from_arrays([*(batch[k] for k in rest), lists], [*rest, name])

    fields = [f for f in docs.schema.fields if f.name != text]
    return map_batches(docs, add, StructType([*fields, StructField(name, ArrayType(LongType()))]))


def ball(half: int) -> list[int]:
    """All masks of at most ``half`` bits, as signed 64-bit integers."""
    masks = [sum(1 << b for b in bits) for k in range(half + 1) for bits in combinations(range(BITS), k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fingerprints: DataFrame, radius: int = 2) -> DataFrame:
    """Verified links (a, b) that connect all of the distinct bigints in column ``fp`` within ``radius`` of each other."""
    if radius < 0 or radius % 2:
        raise ConfigError("the radius has to be even, so that two fingerprints have a middle")
    masks = F.array(*(F.lit(m).cast("bigint") for m in ball(radius // 2)))
    variants = fingerprints.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    met = variants.withColumn("least", F.min("fp").over(Window.partitionBy("variant")))
    pairs = met.filter("fp != least").select(F.col("least").alias("a"), F.col("fp").alias("b")).distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def classes(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(fp, component_id) for every distinct fingerprint of ``prints`` (doc_id, fp): the smallest id of its component."""
    by_print = checkpointed(prints.groupBy("fp").agg(F.min(id_or_last(F.col("doc_id"))).alias("first")))
    roots = components(links(by_print.select("fp"), radius))
    rooted = by_print.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root")
    known = F.when(F.col("component_id") < 2**63 - 1, F.col("component_id"))
    return checkpointed(named.select("fp", known.alias("component_id")))


def near_duplicates(docs: DataFrame, radius: int = 2, width: int = 3, seed: int = 42, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, fp, component_id."""
    narrow = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = with_fingerprints(narrow, "fps", "text", width, [seed])
    prints = checkpointed(prints.select("doc_id", F.col("fps")[0].alias("fp")))
    return prints.join(classes(prints, radius), "fp")


def _apart(similarity: float) -> float:
    """The share of bits in which two texts of this similarity (of their shingle sets) differ on average."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


@dataclass(frozen=True)
class Tables:
    """Short prints cut out of the fingerprints of several seeds, each with balls of its own."""

    bits: int
    count: int
    seeds: int

    @classmethod
    def plan(cls, documents: int, similarity: float, recall: float) -> Tables:
        """Prints grow with the logarithm of the documents, so that each meets only a few others by chance; as many
        tables as it takes for a pair of this similarity to meet in one of them with probability ``recall``."""
        bits = min(58, max(16, math.ceil(math.log2(max(2, documents))) + 7))
        p = _apart(similarity)
        hit = sum(math.comb(bits, k) * p**k * (1 - p) ** (bits - k) for k in range(3))
        count = math.ceil(math.log(1 - recall) / math.log(1 - hit))
        return cls(bits, count, max(8, math.ceil(count / (BITS // bits))))

    def prints(self, fps: Column) -> Column:
        """Table and print in one number, for each table."""
        each = BITS // self.bits
        mask = F.lit((1 << self.bits) - 1).cast("bigint")
        cut = [F.shiftrightunsigned(F.get(fps, F.lit(t // each)), t % each * self.bits).bitwiseAND(mask) for t in range(self.count)]
        return F.array(*(print_ + F.lit(t << self.bits).cast("bigint") for t, print_ in enumerate(cut)))


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """The distinct XXH64 values of a text's shingles, ascending; a text without words has one empty shingle."""
    words = text.translate(ASCII_LOWER).split() if text else []
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False)))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles), np.uint64, len(shingles)))


def with_sketches(docs: DataFrame, text: str, width: int, seeds: Sequence[int]) -> DataFrame:
    """The input, but for the text, with ``node``, which names the set of shingles, its size ``n`` and its fingerprints
    ``fps``: of the set, since similarity counts each shingle once. The values are hashed again for each seed."""
    salts = np.array([s % (1 << 64) for s in seeds], np.uint64) * SCATTER[0]

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        node, n, found = [], [], []
        for raw in raw_texts(batch[text]):
            hashes = shingle_set(raw, width)
            node.append(xxhash.xxh64_intdigest(hashes.tobytes()))
            n.append(len(hashes))
            found.extend(_majority(scatter(hashes + salt).astype(">u8")) for salt in salts)
        lists = pa.ListArray.from_arrays(np.arange(0, len(found) + 1, len(salts), dtype=np.int32), pa.array(np.array(found, np.uint64).view(np.int64)))
        rest = [k for k in batch.schema.names if k != text]
        made = [pa.array(np.array(node, np.uint64).view(np.int64)), pa.array(n, pa.int32()), lists]
        return pa.RecordBatch.from_arrays([*(batch[k] for k in rest), *made], [*rest, "node", "n", "fps"])

    fields = [f for f in docs.schema.fields if f.name != text]
    more = [StructField("node", LongType()), StructField("n", IntegerType()), StructField("fps", ArrayType(LongType()))]
    return map_batches(docs, add, StructType([*fields, *more]))


def _settled(df: DataFrame) -> DataFrame:
    """A checkpoint, after which what was shuffled for it goes."""
    stored = checkpointed(df)
    df = None
    free_unused(stored.sparkSession)
    return stored


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b")


def _pairs_of(lists: DataFrame) -> DataFrame:
    """All pairs (a, b) of each array ``all``."""
    each = lists.select("all", F.posexplode("all").alias("k", "a"))
    return each.select("a", F.explode(F.expr("slice(all, k + 2, size(all))")).alias("b"))


def candidates(nodes: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of nodes with prints within 2 bits in some table, and the nodes in crowded places, whose pairs with
    each other need not be among them.

    Each distinct print emits the ball of half radius 1; at most ``bits + 1`` of them meet at a variant. A print that,
    with all that it meets, has more than ``CROWD`` nodes is full, and its nodes are crowded. Every pair of nodes of two
    prints that meet, or of one, is a pair here, unless both prints are full. So what meets a full print by chance, which
    ever more texts do, is paired with its nodes and not crowded itself: a print that is not full has few pairs.
    """
    prints = nodes.select("node", F.explode(tables.prints(F.col("fps"))).alias("print"))
    points = prints.groupBy("print").agg(F.min("node").alias("node"), F.least(F.count(F.lit(1)), F.lit(CROWD + 1)).cast("int").alias("rows"))
    points = _settled(points)
    # Only a variant and the bit that leads back to its print are sent.
    masks = F.array(*(F.lit(m).cast("bigint") for m in [0, *(1 << k for k in range(tables.bits))]))
    balls = points.select(F.posexplode(F.transform(masks, lambda m: F.col("print").bitwiseXOR(m))).alias("bit", "variant"))
    balls = balls.select("variant", F.col("bit").cast("tinyint").alias("bit"))
    met = balls.withColumn("points", F.count(F.lit(1)).over(Window.partitionBy("variant"))).filter("points > 1")
    print_ = F.col("variant").bitwiseXOR(F.get(masks, F.col("bit").cast("int")))
    near = _pairs_of(met.groupBy("variant").agg(F.array_sort(F.collect_list(print_)).alias("all"))).distinct()
    for x in "ab":
        known = points.select(F.col("print").alias(f"print_{x}"), F.col("node").alias(f"node_{x}"), F.col("rows").alias(f"rows_{x}"))
        near = near.withColumnRenamed(x, f"print_{x}").join(known, f"print_{x}")
    near = _settled(near)
    sides = F.array(*(F.struct(F.col(f"print_{x}").alias("print"), F.col(f"rows_{x}").alias("rows"), F.col(f"rows_{y}").alias("others")) for x, y in ("ab", "ba")))
    around = near.select(F.explode(sides).alias("side")).groupBy("side.print").agg((F.max("side.rows") + F.sum("side.others")).alias("rows"))
    full = _settled(around.union(points.select("print", "rows")).filter(f"rows > {CROWD}").select("print").distinct())
    for x in "ab":
        near = near.join(full.select(F.col("print").alias(f"print_{x}"), F.lit(True).alias(f"full_{x}")), f"print_{x}", "left")
    near = _settled(near.filter("full_a IS NULL OR full_b IS NULL"))
    alone = near.filter("rows_a = 1 AND rows_b = 1").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    few = near.filter("rows_a + rows_b > 2").select("print_a", "print_b")
    few = few.join(prints.select(F.col("print").alias("print_a"), F.col("node").alias("a")), "print_a")
    few = few.join(prints.select(F.col("print").alias("print_b"), F.col("node").alias("b")), "print_b").select("a", "b")
    shared = prints.join(points.filter("rows > 1").select("print").join(full, "print", "left_anti"), "print")
    shared = _pairs_of(shared.groupBy("print").agg(F.collect_list("node").alias("all")))
    crowded = prints.join(full, "print").select("node").union(nodes.filter(f"n <= {SHORT}").select("node")).distinct()
    return _ordered(alone.union(few).union(shared)).distinct(), crowded


def _counted(sets: DataFrame, shift: np.uint64) -> np.ndarray:
    """How many shingles of all ``hashes`` have each head. A task sends the heads it has in one row; rows are added in a tree."""

    def packed(counts: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array([at.astype("<u4").tobytes()], pa.binary()), pa.array([counts[at].tobytes()], pa.binary())], ["heads", "rows"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNTED_BITS, np.int64)
        for batch in batches:
            found = batch["hashes"].flatten().to_numpy(zero_copy_only=False).view(np.uint64) >> shift
            counts += np.bincount(found.astype(np.int64), minlength=len(counts))
        yield packed(counts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNTED_BITS, np.int64)
        for batch in batches:
            for heads, rows in zip(batch["heads"].to_pylist(), batch["rows"].to_pylist(), strict=True):
                counts[np.frombuffer(heads, "<u4")] += np.frombuffer(rows, np.int64)
        yield packed(counts)

    parts = _settled(sets.select("hashes").mapInArrow(count, "heads binary, rows binary"))
    left = parts.count()
    while left > 1:
        left = -(-left // ADDED_AT_ONCE)
        parts = parts.repartition(left).mapInArrow(add, "heads binary, rows binary")
    counts = np.zeros(1 << COUNTED_BITS, np.int64)
    for row in parts.collect():
        counts[np.frombuffer(row["heads"], "<u4")] += np.frombuffer(row["rows"], np.int64)
    return counts


def by_rare_shingles(sets: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """For nodes with ``hashes``: all pairs (a, b) that can have the similarity and share one of their rare shingles, but
    of a shingle of more than ``CROWD`` nodes only those with its smallest node; and (token, node, n, at, rows) of such
    shingles, ``at`` being how many of the node's shingles are rarer.

    Two sets of the similarity share a shingle among the rarest ``n - ceil(similarity * n) + 1`` of each, whatever the
    order, if it is one for all. What a passage or template brings into many texts comes last. Shingles are counted by
    their first bits; that only orders them, so the counts decide nothing but the work.
    """
    shift = np.uint64(BITS - COUNTED_BITS)

    counts = _counted(sets, shift)

    def rarest(batch: pa.RecordBatch) -> pa.RecordBatch:
        token, owner, at = [], [], []
        for k, hashes in enumerate(batch["hashes"]):
            own = hashes.values.to_numpy(zero_copy_only=False).view(np.uint64)
            least = len(own) - math.ceil(similarity * len(own) - 1e-9) + 1
            token.append(own[np.lexsort((own, counts[(own >> shift).astype(np.int64)]))[:least]].view(np.int64))
            owner.append(np.full(len(token[-1]), k, np.int32))
            at.append(np.arange(len(token[-1]), dtype=np.int32))
        owners = pa.array(np.concatenate([np.zeros(0, np.int32), *owner]))
        tokens = pa.array(np.concatenate([np.zeros(0, np.int64), *token]))
        places = pa.array(np.concatenate([np.zeros(0, np.int32), *at]))
        return pa.RecordBatch.from_arrays([tokens, batch["node"].take(owners), batch["n"].take(owners), places], ["token", "node", "n", "at"])

    # Stored, since it is read twice: to count a shingle's nodes, and to list them.
    rare = _settled(map_batches(sets.select("node", "n", "hashes"), rarest, "token bigint, node bigint, n int, at int"))
    sizes = rare.groupBy("token").agg(F.count(F.lit(1)).alias("rows"), F.min("node").alias("least")).filter("rows > 1")
    listed = _settled(rare.join(sizes, "token"))
    small = listed.filter(f"rows <= {CROWD}").groupBy("token").agg(F.collect_list(F.struct("node", "n", "at")).alias("all"))
    sides = [F.col(f"{x}.{k}") for x in "ab" for k in ("n", "at")]
    small = _pairs_of(small).filter(_can_be_similar(*sides, similarity)).select("a.node", "b.node").toDF("a", "b")
    large = listed.filter(f"rows > {CROWD}")
    stars = large.select(F.col("least").alias("a"), F.col("node").alias("b"))
    return _ordered(small.union(stars)).distinct(), large.select("token", "node", "n", "at", "rows")


def _can_be_similar(n_a: Column, at_a: Column, n_b: Column, at_b: Column, similarity: float) -> Column:
    """Whether sets of these sizes can have the similarity if the rarest shingle they share has these places in them.

    They share at most what follows it in both. A shared shingle that is not their rarest may refuse them wrongly; but
    similar sets also meet at their rarest, where they are not refused.
    """
    common = F.least(n_a - at_a, n_b - at_b)
    return (F.least(n_a, n_b) >= similarity * F.greatest(n_a, n_b) - 1e-9) & ((1 + similarity) * common >= similarity * (n_a + n_b) - 1e-9)


def across(large: DataFrame, roots: DataFrame, tables: Tables, similarity: float, partners: int) -> DataFrame:
    """Pairs (a, b) of nodes that share a shingle, are alike, and are in different components; one of the two is outside
    the shingle's largest component, and the other is among about ``partners`` of its nodes, picked by their hash.

    Places and fingerprints come along, so that what meets and cannot be similar or is not alike never leaves the join.
    """
    placed = large.join(roots.withColumnRenamed("root", "part"), "node", "left")
    placed = _settled(placed.select("token", "node", "n", "at", "rows", "fps", F.coalesce("part", "node").alias("part")))
    main = placed.groupBy("token", "part").agg(F.count(F.lit(1)).alias("many")).groupBy("token").agg(F.max_by("part", F.struct("many", "part")).alias("main"))
    outside = placed.join(main, "token").filter("part != main").select("token", *(F.col(x).alias(f"{x}_a") for x in ("node", "n", "at", "fps", "part")))
    picked = placed.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < F.lit(float(partners << 30)) / F.col("rows"))
    met = outside.join(picked, "token").filter("part != part_a")
    met = met.filter(_can_be_similar(*map(F.col, ("n", "at", "n_a", "at_a")), similarity)).filter(_close("fps", "fps_a", tables, similarity))
    return _ordered(met.select(F.col("node_a").alias("a"), F.col("node").alias("b"))).distinct()


def joined_across(found: DataFrame, large: DataFrame, nodes: DataFrame, sets: DataFrame, tables: Tables, similarity: float) -> DataFrame:
    """The links with more of them, until no pair of a crowded shingle is left that is similar and in two components.

    A family of near copies has the square of its number in pairs. So nodes outside a shingle's largest component first
    meet a few of its nodes; what that links is one component, and no pair within it is looked at again. Those still
    outside meet many times as many, and in the last round all, so that none is missed.
    """
    most = large.agg(F.max("rows")).first()[0] or 0
    if not most:
        return found
    large = _settled(large.join(nodes.select("node", "fps"), "node"))
    partners = 0
    while partners < most:
        partners = partners * PARTNERS or FEW
        roots = _settled(components(found))
        pairs = _settled(across(large, roots, tables, similarity, partners))
        held = roots.select(F.col("root").alias("a"), F.col("node").alias("b")).filter("a != b")
        found = _settled(held.union(verified_in_blocks(pairs, sets, large, similarity)))
    return found


def _close(x: str, y: str, tables: Tables, similarity: float) -> Column:
    """Whether fingerprints differ in no more bits than those of texts of this similarity do but for five deviations."""
    apart = sum((F.bit_count(F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))) for k in range(tables.seeds)), F.lit(0))
    bits, p = BITS * tables.seeds, _apart(similarity)
    return apart <= math.ceil(bits * p + 5 * math.sqrt(bits * p * (1 - p)))


def alike(pairs: DataFrame, nodes: DataFrame, tables: Tables, similarity: float) -> DataFrame:
    """The pairs whose fingerprints are close enough for texts of this similarity."""
    pairs = pairs.join(nodes.select(F.col("node").alias("a"), F.col("fps").alias("x")), "a")
    pairs = pairs.join(nodes.select(F.col("node").alias("b"), F.col("fps").alias("y")), "b")
    return pairs.filter(_close("x", "y", tables, similarity)).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets of shingles have the similarity, exactly."""
    pairs = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
    pairs = pairs.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
    both = F.size(F.array_intersect("x", "y"))
    return pairs.filter(both / (F.size("x") + F.size("y") - both) >= similarity).select("a", "b")


def verified_in_blocks(pairs: DataFrame, sets: DataFrame, large: DataFrame, similarity: float) -> DataFrame:
    """The same for pairs of nodes that share crowded shingles, many of which have the same few nodes.

    The nodes of a shingle are dealt into blocks, each node by the most crowded of its shingles; two blocks meet with each
    of their sets once, whatever the number of their pairs.
    """
    home = large.groupBy("node").agg(F.max_by(F.struct("token", "rows"), F.struct("rows", "token")).alias("home"))
    block = F.xxhash64("home.token", F.pmod(F.xxhash64("node"), F.ceil(F.col("home.rows") / BLOCK_NODES)))
    blocks = home.select("node", block.alias("block"))
    for x in "ab":
        pairs = pairs.join(blocks.select(F.col("node").alias(x), F.col("block").alias(f"block_{x}")), x)
    low, high = F.least("block_a", "block_b"), F.greatest("block_a", "block_b")
    keyed = _settled(pairs.select(low.alias("low"), high.alias("high"), "a", "b"))
    meeting = keyed.groupBy("low", "high").agg(F.collect_list(F.struct("a", "b")).alias("pairs"))
    need = keyed.select("low", "high", F.explode(F.array("a", "b")).alias("node")).distinct().join(sets.select("node", "hashes"), "node")
    held = need.groupBy("low", "high").agg(F.map_from_entries(F.collect_list(F.struct("node", "hashes"))).alias("sets"))

    def close(pair: Column) -> Column:
        x, y = F.element_at("sets", pair["a"]), F.element_at("sets", pair["b"])
        both = F.size(F.array_intersect(x, y))
        return both / (F.size(x) + F.size(y) - both) >= similarity

    good = meeting.join(held, ["low", "high"]).select(F.explode(F.filter("pairs", close)).alias("pair"))
    return good.select("pair.a", "pair.b")


def sets_of(wanted: DataFrame, nodes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(node, n, hashes) of the nodes in ``wanted``, from the stored texts (row, text)."""
    rows = _settled(wanted.join(nodes, "node").select("node", "n", "row"))
    found = texts.join(F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows, "row").select("node", "n", "text")

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes = [shingle_set(raw, width).view(np.int64) for raw in raw_texts(batch["text"])]
        lists = pa.array(hashes, pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([batch["node"], batch["n"], lists], ["node", "n", "hashes"])

    return map_batches(found, add, "node bigint, n int, hashes array<bigint>")


def similar(nodes: DataFrame, texts: DataFrame, tables: Tables, similarity: float, width: int) -> DataFrame:
    """Links (a, b) of at least this similarity between distinct ``node`` with ``n``, ``row`` and ``fps``.

    Pairs come from prints that meet, and of nodes in crowded places from the shingles they share. Bits only sort out
    pairs; the sets of shingles decide.
    """
    met, crowded = candidates(nodes, tables)
    met, crowded = _settled(alike(met, nodes, tables, similarity)), _settled(crowded)
    ends = met.select(F.explode(F.array("a", "b")).alias("node"))
    sets = _settled(sets_of(ends.union(crowded).distinct(), nodes, texts, width))
    shared, large = by_rare_shingles(sets.join(crowded, "node", "left_semi"), similarity)
    found = _settled(verified(met.union(alike(shared, nodes, tables, similarity)).distinct(), sets, similarity))
    return joined_across(found, large, nodes, sets, tables, similarity)


def keep_one(docs: DataFrame, similarity: float = 0.8, width: int = 5, recall: float = 0.95, seed: int = 42, text: str = "text",
             id_column: str = "doc_id") -> DataFrame:
    """One document of each class of similar ones, the one of smallest id, as it is.

    Two documents are linked only if their sets of shingles have the similarity, exactly. Pairs of that similarity are
    found with probability ``recall``, more similar ones with more (above 0.999 at 0.9); pairs in crowded places always,
    but for what the prefilter loses, about one in a million.
    Rows are numbered once, in a stored copy that everything after reads, so that their numbers rest on no later split.
    """
    row = unused(docs, "_row")
    path = fresh_dir(docs.sparkSession, "numbered")
    docs.withColumn(row, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    tables = Tables.plan(stored.count(), similarity, recall)
    narrow = stored.select(F.col(row).alias("row"), id_or_last(F.col(f"`{id_column}`")).alias("id"), F.col(f"`{text}`").alias("text"))
    prints = _settled(with_sketches(narrow, "text", width, range(seed, seed + tables.seeds)))
    nodes = _settled(prints.groupBy("node", "n", "fps").agg(F.min("row").alias("row")))
    roots = _settled(components(similar(nodes, narrow.select("row", "text"), tables, similarity, width)))
    named = prints.select("row", "id", "node").join(roots, "node", "left").select("row", "id", F.coalesce("root", "node").alias("root"))
    first = named.groupBy("root").agg(F.min(F.struct("id", "row")).alias("first"))
    first = _settled(first.select("root", F.col("first.row").alias("kept")))
    losers = _settled(named.join(first, "root").filter("row != kept").select(F.col("row").alias(row)))
    return stored.join(losers, row, "left_anti").select(*(F.col(f"`{name}`") for name in docs.columns))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
