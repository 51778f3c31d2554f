"""Queries with an SQL twin give the same rows in both engines."""

import pytest

from conftest import SF_DIR
from inkfold.llm import oracles, queries
from inkfold.plans import check


@pytest.mark.parametrize("name", sorted(oracles.sql()))
def test_same_rows(spark, name):
    found = queries.REGISTRY[name](spark, SF_DIR)
    result = check.connect(SF_DIR).execute(oracles.sql()[name])
    assert check.rows_of(found.columns, [tuple(r) for r in found.collect()]) == check.rows_of(
        [d[0] for d in result.description], result.fetchall())


def test_entry_points_hold_all_queries():
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {k.split("_")[0] for k in entry.queries() if k == "pipeline" or k.startswith("op")}
    assert set(entry.oracle_sql()) <= set(entry.queries())
