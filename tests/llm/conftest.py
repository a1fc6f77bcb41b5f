import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text) as documents; extra columns on demand."""

    def build(rows, extra=""):
        return spark.createDataFrame(rows, "doc_id long, text string" + extra)

    return build


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


#: Nulls in every column, empty and blank texts, a repeated row, equal ids with different texts.
ODD = [(None, None), (None, "a b"), (3, None), (4, ""), (5, " \n\t "), (6, "a b"), (6, "a b"), (7, "x"), (7, "y z")]
