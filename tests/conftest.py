from __future__ import annotations

import sys
from collections.abc import Iterator
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
for entry in (ROOT, ROOT / "tests"):
    sys.path.insert(0, str(entry))

from siltstone.session import local_session  # noqa: E402
from siltstone.workload.scratch import drop_namespaces, new_namespace  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> Iterator[SparkSession]:
    session = local_session(8, memory="4g", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture()
def namespace(spark: SparkSession) -> Iterator[str]:
    name, _ = new_namespace(spark)
    yield name
    drop_namespaces(spark)


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL


def rows(df) -> list[tuple]:
    """Rows as tuples in a fixed order, NULL first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, str(v)) for v in t])
