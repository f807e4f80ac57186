"""Every query on texts and vectors against its SQL; the rest of this folder has the brute-force versions."""
import pytest

from checks.compare import connect, rows
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    found, wanted = QUERIES[name](spark, sf).toPandas(), connect(sf).execute(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
