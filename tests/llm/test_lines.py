"""Line dedup beside a plain version, forward and back."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.errors import ConfigError
from millrace.llm import lines
from millrace.llm.lines import Cuckoo, Ledger

SPACE = " \t\n\x0b\x0c\r"
AWKWARD = [None, "", "\n", "  \n\t", "Same Line", " same line\t", "same line\nsame line", "x\nSAME LINE", "é\n É", "é\né", "a\x1cb\n\x85", "long " * 20_000,
           "\n".join(f"l{k % 7}" for k in range(50_000)), "l3", "same line　", "same line\r\nother\r\n"]
IDS = [*range(len(AWKWARD) - 3), None, None, 3]


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(texts, held, min_docs, min_chars):
    """Lines, dropped lines and what is kept, of texts, with counts from the texts of a ledger."""
    counts = Counter(k for t in held for k in {key(line) for line in (t or "").split("\n")} if len(k) >= min_chars)
    for t in texts:
        cut = (t or "").split("\n")
        kept = [line for line in cut if counts[key(line)] < min_docs or not key(line)]
        yield len(cut), len(cut) - len(kept), "\n".join(kept)


def results(found):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in found.collect())


@pytest.mark.parametrize("limit", [lines.FILTER_BYTES, 0])
@pytest.mark.parametrize("settings", [(2, 1), (3, 4), (1, 1)])
def test_awkward_documents(spark, stored, settings, limit):
    docs = stored(AWKWARD, IDS, ["n_lines", "kept", "row", "a"])
    ledger = Ledger.create(spark, min_docs=settings[0], min_chars=settings[1]).insert(docs)
    found = ledger.without_repeats(docs, filter_bytes=limit)
    want = Counter((i, *row) for i, row in zip(IDS, plain(AWKWARD, AWKWARD, *settings), strict=True))
    assert results(found) == want
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "kept"]


@pytest.mark.parametrize("limit", [lines.FILTER_BYTES, 0])
def test_no_documents(spark, stored, make, limit):
    none = stored([])
    ledger = Ledger.create(spark, min_docs=2).insert(none)
    assert ledger.without_repeats(none, filter_bytes=limit).collect() == []
    assert ledger.delete(none).insert(make(["a", "a"])).without_repeats(make(["a", "b"]), filter_bytes=limit, inserted=False).count() == 2


def test_whole_corpus(spark, corpus):
    rows = corpus.select("doc_id", "text").collect()
    found = Ledger.create(spark, min_docs=10).insert(corpus).without_repeats(corpus)
    texts = [r.text for r in rows]
    assert results(found) == Counter((r.doc_id, *row) for r, row in zip(rows, plain(texts, texts, 10, 1), strict=True))


def test_insertions_and_deletions_lead_back(spark, make, monkeypatch):
    """Random changes, with shards that split on the way, beside counting from scratch; undone, everything is as before."""
    monkeypatch.setattr(lines, "SHARD_KEYS", 60)
    rng = np.random.default_rng(3)
    held, ledger = [], Ledger.create(spark, min_docs=3)
    states = []
    for _ in range(4):
        new = ["\n".join(f"line {k}" for k in rng.zipf(1.3, 12) % 400) for _ in range(25)]
        gone = [held[k] for k in rng.choice(len(held), min(8, len(held)), replace=False)]
        states.append((ledger, new, gone))
        ledger = ledger.insert(make(new))
        ledger = ledger.delete(make(gone)) if gone else ledger
        held = list((Counter(held) + Counter(new) - Counter(gone)).elements())
        found = ledger.without_repeats(make(held))
        assert results(found) == Counter((i, *row) for i, row in enumerate(plain(held, held, 3, 1)))
    assert ledger.shards > 1
    for before, new, gone in reversed(states):
        ledger = ledger.delete(make(new))
        ledger = ledger.insert(make(gone)) if gone else ledger
        assert {tuple(r) for r in ledger.counts().collect()} == {tuple(r) for r in before.counts().collect()}
    assert ledger.counts().count() == 0
    assert all(not any(r.slots) for r in ledger.filters().collect())


def test_versions(spark, make):
    ledger = Ledger.create(spark, min_docs=2)
    with pytest.raises(ConfigError):
        Ledger.open(spark, ledger.path)
    one = ledger.insert(make(["a\nb", "a"]))
    two = one.insert(make(["b"]))
    assert Ledger.open(spark, ledger.path) == two
    assert {r.kept for r in one.without_repeats(make(["a\nb"])).collect()} == {"b"}
    assert {r.kept for r in two.without_repeats(make(["a\nb"])).collect()} == {""}
    with pytest.raises(Exception, match="does not hold"):
        two.delete(make(["never"]))
    assert Ledger.open(spark, ledger.path) == two
    with pytest.raises(ConfigError):
        Ledger.create(spark, min_docs=0)


def test_one_line_in_every_document(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("hot\n"), F.col("id").cast("string")).alias("text")).repartition(8)
    ledger = Ledger.create(spark).insert(docs)
    found = ledger.without_repeats(docs)
    assert found.filter("n_dropped = 1 AND kept = CAST(doc_id AS STRING)").count() == 20_000
    each = lines.counted(docs, "text", 1)
    assert each.count() == 20_001


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(2**63), 2**63 - 1, (50_000, 2), np.int64)
    made = Cuckoo.of(keys)
    assert made.probe(keys).all()
    assert (made.slots != 0).sum() == len(keys)
    assert made.slots.size < 4 * len(keys)
    others = rng.integers(-(2**63), 2**63 - 1, (200_000, 2), np.int64)
    assert made.probe(others).sum() <= 1
    made.delete(keys[:30_000])
    assert made.probe(keys[30_000:]).all() and (made.slots != 0).sum() == 20_000
    assert made.probe(keys[:30_000]).sum() <= 1
    assert made.insert(keys[:30_000]) and made.probe(keys).all()
    made.delete(keys)
    assert not made.slots.any()
    twice = np.repeat(keys[:1], 8, axis=0)
    made = Cuckoo.of(twice)
    made.delete(twice[:7])
    assert made.probe(twice).all()


def test_a_filter_that_errs_is_put_right(spark, make, monkeypatch):
    """With fingerprints of two values, most cold lines are taken for repeated; the list beside the filter knows them."""
    monkeypatch.setattr(lines, "_prints", lambda keys: (keys[:, 0].astype(np.uint64) % np.uint64(2) + np.uint64(1)).astype(np.uint32))
    texts = [f"hot {k % 3}\ncold {k}" for k in range(12)]
    # Groups run in other processes, so that the shard is built here as they would.
    keys = lines._halves([h for t in texts for h in lines._lines(t.encode(), 1)[1]])
    hot, cold = np.unique(keys[::2], axis=0), keys[1::2]
    cuckoo = Cuckoo.of(hot)
    wrong = cold[cuckoo.probe(cold)]
    assert len(wrong)
    filters = lines.Filters(1, [(0, cuckoo.slots.tobytes(), np.ascontiguousarray(wrong).tobytes())])
    assert filters.repeated(hot).all() and not filters.repeated(cold).any()
