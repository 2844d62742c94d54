"""The driver contract, with and without the optional subpackage."""

from __future__ import annotations

import os
import subprocess
import sys

from ledgerlake.plans.oracle import oracle_queries
from ledgerlake.plans.registry import QUERIES

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

WITHOUT = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("ledgerlake.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
print(sorted(e.queries()) == sorted(%r) and sorted(e.oracle_sql()) == sorted(%r))
"""


def test_every_lakehouse_query_has_an_oracle():
    assert set(oracle_queries()) == set(QUERIES)


def test_entry_works_where_the_subpackage_is_not_installed():
    code = WITHOUT % (list(QUERIES), list(oracle_queries()))
    done = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "True", done.stderr[-2000:]
