from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from given import SMALL  # noqa: E402


@pytest.fixture
def make(spark, tmp_path):
    """A folder with the tables given as name=(rows, ddl)."""

    def build(**tables):
        for name, (rows, ddl) in tables.items():
            spark.createDataFrame(rows, ddl).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return build


@pytest.fixture
def small_docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
