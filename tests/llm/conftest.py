from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def make(spark):
    """Documents of texts, numbered from 0, with a column whose name clashes with results."""

    def documents(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, DOCS)

    return documents


@pytest.fixture
def stored(spark, make, tmp_path_factory):
    """The same, stored as Parquet in a few files, so that it reads alike each time."""

    def documents(texts, ids=None, more=()):
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        frame = make(texts, ids)
        for name in more:
            from pyspark.sql import functions as F

            frame = frame.withColumn(name, F.lit(7))
        frame.repartition(3, "text").write.parquet(path)
        return spark.read.parquet(path)

    return documents


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
