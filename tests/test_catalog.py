"""Every query of the core against its SQL, on the smallest tables; those without SQL must run and give rows."""

from __future__ import annotations

import pytest

from oracle import compare
from vellumine.plans import catalog

SF = "/root/testdata/sf0.001"
Q, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    compare(spark, SF, Q[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(Q) - set(SQL)))
def test_runs(spark, name):
    assert Q[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.columns == ["chunk_id", "doc_id", "title", "dense_rank", "lexical_rank", "score", "rank"]
    assert df.count() == 12


def test_core_without_llm(tmp_path):
    """The core imports nothing of the llm subpackage."""
    import re
    from pathlib import Path

    root = Path(catalog.__file__).parents[1]
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"^\s*(from|import) vellumine\.llm", p.read_text(), re.M), p
