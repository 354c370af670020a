"""Clustering beside a plain version, and the search beside measuring every distance."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from millrace.llm import centroids
from millrace.llm.centroids import Centroids


def plain(rows, clusters=16, rounds=3, dims=64, scale=64, seed=1):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [max(-(2**27), min(2**27, math.floor(scale * x))) for x in v]))
    named = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (named(r[0]), np.array(r[1], np.int32).tobytes()))
    middle = [v for _, v in order[:clusters]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((far(v, c), k) for k, c in enumerate(middle))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        middle = [[sum(col) // len(groups[k]) for col in zip(*groups[k], strict=True)] if k in groups else c for k, c in enumerate(middle)]
    return Counter((i, *reversed(nearest(v))) for i, v in kept), middle


def run(spark, rows, kind="float", **settings):
    table = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").repartition(3)
    return centroids.clustered(table.selectExpr("*", "7 AS cluster", "8 AS packed", "9 AS distance"), **settings)


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("settings", [{}, {"clusters": 5, "rounds": 1, "seed": 9}, {"clusters": 40, "rounds": 0}])
def test_awkward_vectors(spark, settings, kind):
    rng = np.random.default_rng(2)
    rows = [(k, np.float32(rng.normal(0, 0.3, 64)).tolist()) for k in range(60)]
    rows += [(None, rows[0][1]), (None, rows[0][1]), (3, rows[3][1]), (61, None), (62, []), (63, [1.0] * 63), (64, [1.0] * 65), (65, [None] + [1.0] * 63),
             (66, [math.nan] * 64), (67, [math.inf] + [0.0] * 63), (68, [0.0] * 64), (69, [1e30] * 64), (70, [-1e30] * 64), (71, [0.5] * 64)]
    found = run(spark, rows, kind, **settings)
    want, middle = plain(rows, **settings)
    assert found.vectors.columns == ["vec_id", "cluster", "distance"]
    assert Counter(map(tuple, found.vectors.collect())) == want
    assert found.centroids.rows.tolist() == middle
    for r in found.summary.collect():
        assert r["size"] == sum(n for (_, c, _), n in want.items() if c == r["cluster"])
        assert r["inertia"] == min(2**63 - 1, sum(d * n for (_, c, d), n in want.items() if c == r["cluster"]))
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, middle[r["cluster"]])).encode()).hexdigest()


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    found = centroids.clustered(table)
    assert Counter(map(tuple, found.vectors.collect())) == plain([(r.vec_id, r.embedding) for r in table.collect()])[0]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.1] * 64)], [(1, [0.1] * 64)] * 30])
def test_few_vectors(spark, rows):
    found = run(spark, rows)
    want, middle = plain(rows)
    assert Counter(map(tuple, found.vectors.collect())) == want and found.centroids.rows.tolist() == middle


@pytest.mark.parametrize("scale", [3, 1000, 1 << 27])
@pytest.mark.parametrize("count", [1, 2, 7, 300])
def test_search_finds_the_nearest(scale, count):
    """Of equals the smaller number; also where many centroids share their sum, and far from all."""
    rng = np.random.default_rng(count)
    rows = rng.integers(-scale, scale, (count, 8), endpoint=True)
    rows[count // 2 :] = rng.permutation(rows[0])
    vectors = np.concatenate([rng.integers(-scale, scale, (500, 8), endpoint=True), rows, np.full((1, 8), scale), np.full((1, 8), -scale)])
    number, best = Centroids(rows).nearest(vectors)
    every = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c, strict=True)) for c in rows] for v in vectors]
    assert best.tolist() == [min(d) for d in every]
    assert number.tolist() == [d.index(min(d)) for d in every]


def test_search_skips_most_centroids(monkeypatch):
    """The point of the bounds: far fewer distances than vectors times centroids."""
    rng = np.random.default_rng(0)
    rows = rng.normal(0, 50, (400, 16)).astype(np.int64) + rng.normal(0, 400, (400, 1)).astype(np.int64)
    vectors = rows[rng.integers(0, 400, 2000)] + rng.integers(-5, 6, (2000, 16))
    measured = []
    real = np.einsum
    monkeypatch.setattr(centroids.np, "einsum", lambda spec, a, b: measured.append(len(a)) or real(spec, a, b))
    Centroids(rows).nearest(vectors)
    assert sum(measured) < 0.1 * 400 * 2000
