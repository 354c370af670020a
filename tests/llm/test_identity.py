"""Rows keep their numbers when the same table is split otherwise at a second read."""

from __future__ import annotations

from collections import Counter

import pytest

from millrace.llm import bpe, simhash, token_shards

ONE_SPLIT = {"spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}


@pytest.fixture
def splits(spark):
    def one(wanted):
        for name, value in ONE_SPLIT.items():
            spark.conf.set(name, value) if wanted else spark.conf.unset(name)

    yield one
    one(False)


def test_losers_are_the_same_rows_at_any_split(stored, splits):
    texts = [" ".join(f"t{k // 2}w{j}" for j in range(60)) for k in range(400)]
    kept = simhash.keep_one(stored(texts))
    splits(True)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 400, 2))


def test_sequences_keep_their_slots_at_any_split(stored, splits):
    docs = stored([" ".join(f"t{k}w{j}" for j in range(60)) for k in range(400)]).repartition(3)
    splits(True)
    found = token_shards.in_training_order(token_shards.sequences(docs, bpe.public_vocabulary(), 64), 5, 100)
    splits(False)
    rows = found.collect()
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert len(Counter(r.doc_id for r in rows)) == 400
