import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Makes a document table from texts, with columns whose names clash."""
    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", "s", 0, -1.0, "x", 7) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, component_id string, n int").repartition(2)
    return make


@pytest.fixture
def tables(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
