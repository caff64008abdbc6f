"""Every query against its DuckDB SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
from tests.compare import difference, duck_connection

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return duck_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.ORACLE))
def test_equals_sql(spark, duck, name):
    rows = entry.QUERIES[name](spark, FOLDER).toPandas()
    assert len(rows) > 0
    assert difference(rows, duck.execute(entry.ORACLE[name]).df()) == ""


def test_only_factorisation_has_no_sql():
    assert set(entry.QUERIES) - set(entry.ORACLE) == {"als_recs"}


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0
    assert {"user_id", "song_id", "similarity", "rank"} <= set(rows.columns)
