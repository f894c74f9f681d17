"""Every query of the subpackage runs over whole tables; those with SQL agree with DuckDB."""

import pytest

from fjordmill.llm import queries
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_runs(spark, sf, name):
    assert queries.queries()[name](spark, sf).count() >= 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, sf, name):
    assert compare(queries.queries()[name](spark, sf), connect(sf), queries.oracle_sql()[name]) == ""


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    root = Path(queries.__file__).resolve().parent.parent
    for f in root.rglob("*.py"):
        if f.parent.name != "llm":
            assert "fjordmill.llm" not in f.read_text()
