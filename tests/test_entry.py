"""The contract file: names, SQL, and an installation without the optional parts."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["nation", "bucket", "n", "pct", "pct_top", "ord"] and df.count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_optional_parts_may_be_missing():
    code = "import sys; sys.modules['vellum.llm'] = None; sys.modules['vellum.llm.queries'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not [n for n in q if n[:2] == 'op' or n == 'pipeline'], q; assert set(e.oracle_sql()) == set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
