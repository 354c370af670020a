"""Importance resampling beside a plain version."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import importance
from millrace.llm.common import added_up

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [None, "", "...", "One two  three", "ONE TWO THREE", "é日本 x1 x1", "a" * 300_000, " ".join(f"w{k % 50}" for k in range(200_000)), "a\x00b\x7fc\x80d",
         *[" ".join(f"w{k * j % 97}" for j in range(30)) for k in range(40)], *["copy of a text " * 6] * 30]
IDS = [*range(len(TEXTS) - 3), None, None, 3]


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs(text, longest):
    w = words(text)
    return [" ".join(w[k : k + n]) for n in range(1, longest + 1) for k in range(len(w) - n + 1)]


def plain(rows, target, percent, min_words, buckets, longest):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, text in rows for f in runs(text, longest))
    t = Counter(bucket(f) for text in target for f in runs(text, longest))
    S, T = float(sum(s.values())), float(sum(t.values()))
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (S + buckets) / ((s[b] + 1.0) * (T + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        f = runs(text, longest)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    k = percent * len(able) // 100
    drawn = Counter((*r, n + 1) for n, r in enumerate(able[:k]))
    return drawn + Counter((*r, None) for r in (Counter(out) - Counter(able[:k])).elements())


@pytest.mark.parametrize("settings", [(10, 20, 10_000, 1), (50, 1, 64, 2), (100, 0, 10_000, 3), (0, 5, 10, 1)])
def test_awkward_documents(spark, stored, settings):
    percent, min_words, buckets, longest = settings
    docs = stored(TEXTS, IDS, ["score", "rank", "weight", "_row"])
    target = [None, "", "w1 w2 w3 One", "日本"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id bigint, text string")
    found = importance.resampled(docs, frame, percent, min_words, buckets=buckets, longest=longest)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, found.collect())) == plain(list(zip(IDS, TEXTS, strict=True)), target, *settings)


@pytest.mark.parametrize("rows_a_sort", [importance.SORTED_ROWS, 7])
@pytest.mark.parametrize("accuracy", [importance.ACCURACY, 3, 20])
def test_whole_corpus(spark, corpus, monkeypatch, accuracy, rows_a_sort):
    """Coarse sketches widen their bracket; small ranges give the same ranks."""
    monkeypatch.setattr(importance, "SORTED_ROWS", rows_a_sort)
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [tuple(r) for r in corpus.select("doc_id", "text").collect()]
    found = importance.resampled(corpus, target, accuracy=accuracy)
    assert Counter(map(tuple, found.collect())) == plain(rows, [r.text for r in target.collect()], 10, 20, 10_000, 1)


def test_empty_tables(spark, stored):
    none = stored([])
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert importance.resampled(none, bench).collect() == []
    found = importance.resampled(stored(["a b c"] * 30), bench, min_words=3)
    assert sorted(r["rank"] for r in found.collect() if r["rank"]) == [1, 2, 3]


def test_brackets_hold_the_place(spark):
    """Whatever the sketch says, the k-th highest is inside, and exactly so many are above."""
    scores = [k % 13 if k % 3 else k for k in range(3000)]
    frame = spark.createDataFrame([(s,) for s in scores], "score bigint")
    ordered = sorted(scores, reverse=True)
    for k in (1, 2, 299, 1500, 2999, 3000):
        for accuracy in (2, 50, 10_000):
            above, inside, n_above, n_inside = importance.bracket(frame, "score", k, len(scores), accuracy)
            assert n_above < k <= n_above + n_inside
            assert frame.filter(above).count() == n_above and frame.filter(inside).count() == n_inside
            assert ordered[k - 1] in {r[0] for r in frame.filter(inside).collect()}
            assert all(r[0] > ordered[k - 1] for r in frame.filter(above).collect())


def test_equal_rows_are_cut_into_ranges(spark, monkeypatch):
    monkeypatch.setattr(importance, "SORTED_ROWS", 100)
    rows = spark.range(2000).select(F.lit(5).cast("bigint").alias("score"), F.col("id").alias("_row"))
    found = importance.numbered(rows, [F.col("score").desc(), F.col("_row")], 2000, 10)
    assert sorted((r["_row"], r["rank"]) for r in found.collect()) == [(k, k + 11) for k in range(2000)]


def test_arrays_are_added_in_a_tree(spark, monkeypatch):
    import numpy as np

    parts = spark.createDataFrame([(np.array([k, -k, 1]).tobytes(),) for k in range(9000)], "packed binary").repartition(3)
    assert added_up(parts, 3).tolist() == [9000 * 8999 // 2, -9000 * 8999 // 2, 9000]
    assert added_up(parts.limit(0), 3).tolist() == [0, 0, 0]
