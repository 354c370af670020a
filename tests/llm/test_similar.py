"""The near-duplicate stage beside all pairs of exact similarity, with the parameters the pipeline runs with."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest

from millrace.llm import simhash


def shingles(text):
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def linked(texts, least=0.8):
    """Pairs of at least this similarity, by brute force."""
    sets = [shingles(t) for t in texts]
    out = set()
    for a, b in combinations(range(len(sets)), 2):
        if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
            out.add((a, b))
    return out


def kept_by(pairs, count):
    root = list(range(count))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in sorted(pairs):
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return [k for k in range(count) if find(k) == k]


def edited(rng, words, edits):
    out = list(words)
    for at in rng.choice(len(out), edits, replace=False):
        out[at] = f"e{rng.integers(1 << 40)}"
    return out


@pytest.fixture
def passages():
    """Texts that share a long passage, so that prints are crowded, and pairs of similarity 0.7 to 0.97 among them."""
    rng = np.random.default_rng(11)
    passage = [f"p{k}" for k in range(150)]
    texts = []
    for k in range(90):
        own = passage + [f"t{k}w{j}" for j in range(70)]
        texts.append(" ".join(own))
        texts.append(" ".join(edited(rng, own, 1 + k % 9)))
    return texts


def test_pairs_in_a_crowd_are_found(stored, passages, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 4, raising=False)
    kept = sorted(r.doc_id for r in simhash.keep_one(stored(passages)).collect())
    assert kept == kept_by(linked(passages), len(passages))


def test_no_text_below_the_similarity_goes(stored):
    rng = np.random.default_rng(5)
    texts = []
    for k in range(240):
        own = [f"d{k}w{j}" for j in range(204)]
        texts += [" ".join(own), " ".join(edited(rng, own, 2 + k % 8))]
    pairs = linked(texts)
    kept = {r.doc_id for r in simhash.keep_one(stored(texts)).collect()}
    gone = set(range(len(texts))) - kept
    assert gone <= {b for _, b in pairs}, "no text without a similar one goes"
    assert len(gone) >= 0.95 * len(pairs)


def test_like_fingerprints_are_no_like_texts(stored):
    texts = ["same words over and over " * 40 + " ".join(f"x{k}y{j}" for j in range(60)) for k in range(3)]
    assert simhash.keep_one(stored(texts)).count() == 3


def test_a_large_family_is_one(stored):
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(300)]
    texts = [" ".join(edited(rng, base, 3)) for _ in range(150)]
    assert [r.doc_id for r in simhash.keep_one(stored(texts)).collect()] == kept_by(linked(texts), len(texts))


def test_texts_that_only_share_a_passage_are_not_compared_pair_by_pair(spark, monkeypatch):
    """Where a shared passage is the rarest that two sets share, what follows it shows that they cannot be similar."""
    passage = " ".join(f"p{k}" for k in range(19))
    texts = [f"{passage} x{k} y{k} z{k}" for k in range(80)]
    assert not linked(texts)
    verify, compared = simhash.verified_in_blocks, []
    monkeypatch.setattr(simhash, "verified_in_blocks", lambda pairs, *rest: compared.append(pairs.count()) or verify(pairs, *rest))
    kept = simhash.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(80))
    assert sum(compared) <= len(texts)


def test_what_meets_a_crowd_by_chance_is_not_crowded(spark, monkeypatch):
    """A print beside a full one that is not full itself has its few pairs made at once; its nodes are not crowded."""
    monkeypatch.setattr(simhash, "CROWD", 4)
    tables = simhash.Tables(16, 1, 1)
    # Six of one print, 7 within 2 bits of it, 8 within 2 bits of 7 only, 9 far from all.
    prints = {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0b11, 8: 0b1111, 9: 0xFF00}
    meeting = {(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2}
    nodes = spark.createDataFrame([(k, 100, [p]) for k, p in prints.items()], "node bigint, n int, fps array<bigint>")
    pairs, crowded = simhash.candidates(nodes, tables)
    pairs, crowded = {tuple(r) for r in pairs.collect()}, {r.node for r in crowded.collect()}
    assert crowded == {1, 2, 3, 4, 5, 6, 7}, "8 meets 7 only"
    assert pairs == {(7, 8)}
    assert meeting - pairs <= {(a, b) for a in crowded for b in crowded}, "what is no pair here has both ends crowded"
