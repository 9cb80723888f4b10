from pathlib import Path

import pytest


@pytest.fixture(scope="session")
def small_dir() -> str:
    """The smallest given tables."""
    folder = Path("/root/testdata/sf0.001")
    if not folder.is_dir():
        pytest.skip("no test tables")
    return str(folder)


@pytest.fixture(scope="session")
def documents(spark, small_dir):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
