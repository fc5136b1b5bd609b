"""Operators' queries against SQL, where SQL can say them."""

import pytest
from oracle import connect, difference

from ledgerlake.llm.oracles import ORACLES
from ledgerlake.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(spark, connect(sf_dir), QUERIES[name], ORACLES[name], sf_dir) == ""


def test_registered():
    import __spark_entry__

    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
