"""Every query against its SQL, or for schema and rows where SQL cannot follow."""
import pytest

from checks.compare import difference, rows
from checks.oracles import ORACLES
from checks.queries import QUERIES

ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    assert difference(spark, sf, name) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_query_without_sql_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_comparison_notices_a_changed_value(spark, sf):
    frame = QUERIES["quality_report"](spark, sf).toPandas()
    changed = frame.assign(clean_rows=frame.clean_rows + 1)
    assert rows(frame) != rows(changed)
