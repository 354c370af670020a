from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from check import session  # noqa: E402
from millrace import prepare  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    found = session(4)
    found.sparkContext.environment["PYTHONPATH"] = str(Path(__file__).parent)
    prepare(found)
    found.sparkContext.addPyFile(str(Path(__file__).with_name("fake_clients.py")))
    yield found
    found.stop()


@pytest.fixture
def sample(spark):
    return spark.createDataFrame([(1, "alpha"), (2, "beta")], "id bigint, name string")


def rows(df):
    return sorted(tuple(row) for row in df.collect())
