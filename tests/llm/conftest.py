from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_rows import DOCS  # noqa: E402


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with what operators use inside."""

    def make(rows, parts=3):
        full = [(i, t, "en" if k % 2 else None, f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
        df = spark.createDataFrame(full, DOCS)
        return df.selectExpr("*", "'x' as key", "'y' as tag", "1 as fp", "2 as n", "'z' as component", "3 as rank").repartition(parts)

    return make
