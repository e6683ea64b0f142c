"""Every core query against its SQL, on the smallest tables."""

import pytest

from conftest import SMALL, same_rows
from helixframe.plans import file_queries  # noqa: F401 (registers its queries)
from helixframe.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    assert name in ORACLES
    same_rows(got, duck.sql(ORACLES[name]).df())


def test_entry_module(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).schema.names == ["protein_id", "sequence", "n_res"]
